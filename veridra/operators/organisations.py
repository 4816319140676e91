"""Organisations that free fields name: one key for all spellings of one.

A name is an array of words. What is known of words is data (a Lexicon, which a caller may
replace): phrases that lead up to a name, phrases of legal form that end it, words spelled out,
marks of governments and agencies, and keys of one institution. Columns only compare words with it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import stored, tasks


@dataclass(frozen=True)
class Agency:
    """A part of a government: words that name it, and letters that do when all blanks are left out."""

    key: str
    words: tuple[str, ...] = ()
    inside: tuple[str, ...] = ()
    at_end: tuple[str, ...] = ()


@dataclass(frozen=True)
class Lexicon:
    """Words and phrases whose meaning is agreed on, in natural order."""

    #: What a name may begin with that is not part of it (articles are dropped everywhere).
    leads: tuple[str, ...] = (
        "TRUSTEES OF", "BOARD OF TRUSTEES OF", "BOARD OF REGENTS OF", "REGENTS OF", "PRESIDENT AND FELLOWS OF",
        "NATIONAL UNIVERSITY CORPORATION", "RHE TRUSTEES OF", "GOVERNING COUNCIL OF", "GOVERNING COUNCEL OF",
        "CHANCELLOR MASTERS AND SCHOLARS OF", "MASTERS AND SCHOLARS OF", "BOARD OF SUPERVISORS OF",
    )
    #: Legal forms that a name may end with.
    forms: tuple[str, ...] = (
        "INC", "INCORPORATED", "LLC", "LTD", "LIMITED", "CORP", "CORPORATION", "CO", "COMPANY",
        "BV", "B V", "NV", "AS", "A S", "AB", "AG", "SE", "SA", "SAS", "GMBH", "PLC", "LP", "LLP", "PC",
    )
    #: Abbreviations that are spelled out.
    spelled_out: dict[str, str] = field(default_factory=lambda: {
        "UNIV": "UNIVERSITY", "MED": "MEDICAL", "BR": "BRANCH", "INST": "INSTITUTE", "CTR": "CENTER",
        "SCH": "SCHOOL", "HOSP": "HOSPITAL", "RES": "RESEARCH", "LAB": "LABORATORY", "LABS": "LABORATORIES",
        "DEPT": "DEPARTMENT", "NATL": "NATIONAL", "TECH": "TECHNOLOGY", "SCI": "SCIENCES", "HLTH": "HEALTH",
    })
    #: Words of states and cities, which are no federal government.
    local: tuple[str, ...] = ("STATE", "COMMONWEALTH", "COUNTY", "CITY")
    #: The country, as a first word and as letters within a name; who acts for it.
    country_first: tuple[str, ...] = ("US", "USA")
    country_inside: str = "UNITEDSTATES"
    government: str = "GOVERNMENT"
    represented: str = "ASREPRESENTED"
    agencies: tuple[Agency, ...] = (
        Agency("US ARMY", words=("ARMY",), inside=("MATERIALCOMMAND", "MATERIELCOMMAND")),
        Agency("US DEPARTMENT OF HEALTH AND HUMAN SERVICES", words=("HHS",), inside=("HEALTHANDHUMAN", "HUMANSER"), at_end=("SECRETARYOFDEPARTMENTOFHEALTH",)),
    )
    no_agency: str = "US GOVERNMENT"
    #: Keys of one institution under several names.
    aliases: dict[str, str] = field(default_factory=lambda: {
        "USAMRIID": "US ARMY",
        "BOSTON UNIVERSITY MEDICAL CAMPUS": "BOSTON UNIVERSITY",
        "LELAND STANFORD JUNIOR UNIVERSITY": "STANFORD UNIVERSITY",
        "UNIVERSITY OF TEXAS MEDICAL BRANCH GALVESTON": "UNIVERSITY OF TEXAS MEDICAL BRANCH",
        "UNIVERSITY OF TEXAS MEDICAL BRANCH AT GALVESTON": "UNIVERSITY OF TEXAS MEDICAL BRANCH",
        "UNIVERSITY OF NORTH CAROLINA CHAPEL HILL": "UNIVERSITY OF NORTH CAROLINA AT CHAPEL HILL",
        "VANDERBILT UNIVERSITY MEDICAL CENTER": "VANDERBILT UNIVERSITY",
        "ALBERT EINSTEIN COLLEGE OF MEDICINE OF YESHIVA UNIVERSITY": "ALBERT EINSTEIN COLLEGE OF MEDICINE",
        "COLUMBIA UNIVERSITY IN CITY OF NEW YORK": "COLUMBIA UNIVERSITY",
        "COLUMBIA UNIVERSITY HEALTH SCIENCES": "COLUMBIA UNIVERSITY",
        "GENERAL HOSPITAL": "MASSACHUSETTS GENERAL HOSPITAL",
        "WARF WISCONSIN ALUMNI RESEARCH FOUNDATION": "WISCONSIN ALUMNI RESEARCH FOUNDATION",
        "WISCONSIN ALUMNI RESEARCH FOUNDATION WARF": "WISCONSIN ALUMNI RESEARCH FOUNDATION",
        "WISTARE INSTITUTE OF ANATOMY AND BIOLOGY": "WISTAR INSTITUTE OF ANATOMY AND BIOLOGY",
    })


KNOWN = Lexicon()


@F.pandas_udf(StringType())
def ascii_upper(values: pd.Series) -> pd.Series:
    """Upper-case ASCII letters, accents dropped."""
    return values.map(lambda v: unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode().upper(), na_action="ignore")


def _lookup(entries: dict[str, str], key: Column) -> Column:
    """The entry of a key, or the key itself."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in entries.items() for x in kv]), key), key) if entries else key


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where value is worked out once however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _within(words: Column, phrases: tuple[str, ...]) -> Column:
    """How many of the first words are phrases of the lexicon, one after the other, the longest first."""
    by_size: dict[int, list[str]] = {}
    for p in phrases:
        by_size.setdefault(p.count(" ") + 1, []).append(p)

    def next_phrase(at: Column) -> Column:
        taken = [F.when(F.array_join(F.slice(words, at + 1, n), " ").isin(some), n).otherwise(0) for n, some in by_size.items()]
        return F.greatest(F.lit(0), *taken)

    # there are no more phrases than words
    return F.aggregate(words, F.lit(0), lambda at, _: at + next_phrase(at))


def _without(words: Column, phrases: tuple[str, ...]) -> Column:
    """The words behind the phrases that they begin with."""
    return F.slice(words, _within(words, phrases) + 1, F.size(words))


def name_words(upper: Column, known: Lexicon = KNOWN) -> Column:
    """Words of an upper-case name that are its own: no articles, leads or legal forms, abbreviations spelled out."""
    plain = F.replace(F.replace(F.replace(upper, F.lit("&"), F.lit(" AND ")), F.lit("U.S.A."), F.lit("USA ")), F.lit("U.S."), F.lit("US"))
    words = F.filter(F.regexp_extract_all(plain, F.lit("[A-Z0-9]+"), F.lit(0)), lambda w: w != "THE")
    forms = tuple(" ".join(reversed(p.split())) for p in known.forms)
    own = _let(words, lambda w: F.transform(_without(w, known.leads), lambda x: _lookup(known.spelled_out, x)))
    return F.reverse(_let(F.reverse(own), lambda w: _without(w, forms)))


def organisation_key(name: Column, known: Lexicon = KNOWN) -> Column:
    """The key that all spellings of an organisation's name share; empty if nothing is left of it, null of null.

    A name that speaks of the federal government has the key of its agency, or one for all that state
    none; names of states and cities keep their words. Known aliases are one.
    """
    # a lambda can't hold a Python function, but its argument can be one's result
    named = _let(ascii_upper(name), lambda upper: name_words(upper, known))
    return _let(_let(named, lambda w: F.struct(w.alias("words"), F.array_join(w, " ").alias("key"), F.array_join(w, "").alias("letters"))), lambda x: _key_of(x["words"], x["key"], x["letters"], known))


def _key_of(words: Column, key: Column, letters: Column, known: Lexicon) -> Column:
    any_of = lambda parts, test: F.exists(F.array(F.lit(False), *[test(p) for p in parts]), lambda x: x)
    first = F.get(words, F.lit(0))
    # STATE OF AMERICA is what a slip makes of the country
    at = F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1)))
    local = F.exists(at, lambda i: F.get(words, i - 1).isin(*known.local) & (F.array_join(F.slice(words, i + 1, 2), " ") != "OF AMERICA"))
    country = F.contains(letters, F.lit(known.country_inside)) | (first.isin(*known.country_first) & (F.size(words) > 1))
    # GOVERNMENT is misspelled more often than not: two letters may differ
    acting = F.contains(letters, F.lit(known.government)) | F.exists(words, lambda w: F.levenshtein(w, F.lit(known.government), 2) >= 0)
    federal = country | acting | F.contains(letters, F.lit(known.represented)) | first.startswith("DEPARTMENT")

    def stated(a: Agency) -> Column:
        return any_of(a.words, lambda w: F.array_contains(words, w)) | any_of(a.inside, lambda x: F.contains(letters, F.lit(x))) | any_of(a.at_end, lambda x: F.endswith(letters, F.lit(x)))

    def told(facts: Column) -> Column:
        out = F.when(key.isNull() | facts["local"], key)
        for a in known.agencies:
            out = out.when(facts["federal"] & stated(a), F.lit(a.key))
        return out.when(facts["country"], F.lit(known.no_agency)).otherwise(key)

    facts = F.struct(F.coalesce(local, F.lit(False)).alias("local"), F.coalesce(country, F.lit(False)).alias("country"), F.coalesce(federal, F.lit(False)).alias("federal"))
    return _let(_let(facts, told), lambda k: _lookup(known.aliases, k))


def organisation_names(field: Column, known: Lexicon = KNOWN) -> Column:
    """Names in a field that joins them by bare commas: a comma before a blank or a legal form belongs to the name.

    What is no organisation goes: persons (`Last; First`), two-letter fragments of addresses, bare legal forms.
    """
    own = lambda x: F.size(name_words(F.upper(x), known)) > 0

    def put(names: Column, part: Column) -> Column:
        belongs = (F.size(names) > 0) & (F.startswith(part, F.lit(" ")) | ~own(part))
        longer = F.concat(F.slice(names, 1, F.size(names) - 1), F.array(F.concat_ws(",", F.element_at(names, -1), part)))
        return F.when(belongs, longer).when(F.trim(part) == "", names).otherwise(F.array_append(names, part))

    names = F.transform(F.aggregate(F.split(field, ","), F.array().cast("array<string>"), put), lambda x: F.trim(x))
    letters = lambda x: F.translate(F.lower(x), "abcdefghijklmnopqrstuvwxyz'-. ", "")
    person = lambda x: (letters(x) == ";") & (F.length(F.trim(F.split_part(x, F.lit(";"), F.lit(1)))) > 0) & (F.length(F.trim(F.split_part(x, F.lit(";"), F.lit(2)))) > 0)
    fragment = lambda x: (F.length(F.rtrim(x, F.lit("."))) == 2) & (letters(x) == "")
    return F.array_distinct(F.filter(names, lambda x: ~person(x) & ~fragment(x) & own(x)))


def organisation_fields(rows: DataFrame, field: str, known: Lexicon = KNOWN) -> DataFrame:
    """(field, spelling, org_key) of what each distinct field names.

    A field is taken apart once and a spelling gets its key once, however many rows have them, and both are
    dealt over tasks: a table of short fields is few splits, and its work many times its size.
    """
    n = tasks(rows)
    fields = rows.select(F.col(field).alias("field")).where("field IS NOT NULL").distinct().repartition(n, "field")
    each = stored(fields.select("field", F.explode(organisation_names(F.col("field"), known)).alias("spelling")))
    spellings = each.select("spelling").distinct().repartition(n, "spelling")
    return stored(each.join(spellings.withColumn("org_key", organisation_key(F.col("spelling"), known)), "spelling").select("field", "spelling", "org_key"))


def organisation_links(rows: DataFrame, field: str, role: str, ident: str, known: Lexicon = KNOWN) -> tuple[DataFrame, DataFrame]:
    """Organisations (org_key, display, spellings, roles) and links (org_key, role, ident) of rows that name them in a field."""
    each = rows.select(F.col(field).alias("field"), F.col(role).alias("role"), F.col(ident).alias("ident"))
    named = organisation_fields(rows, field, known).where("org_key <> ''")
    often = each.groupBy("field").agg(F.count("*").alias("n"), F.collect_set("role").alias("roles"))
    counted = often.join(named, "field").groupBy("org_key", "spelling").agg(F.sum("n").alias("n"), F.array_distinct(F.flatten(F.collect_list("roles"))).alias("roles"))
    # the most frequent spelling is shown; mixed case and shorter ones win ties
    order = F.struct(-F.col("n"), F.upper("spelling") == F.col("spelling"), F.length("spelling"), F.col("spelling"))
    organisations = counted.groupBy("org_key").agg(
        F.min_by("spelling", order).alias("display"), F.array_sort(F.collect_set("spelling")).alias("spellings"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("roles")))).alias("roles"),
    )
    return organisations, each.join(named.select("field", "org_key").distinct(), "field").select("org_key", "role", "ident").distinct()
