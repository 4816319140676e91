"""Cleaning, parsing and naming of single values, as column expressions.

Parsers give null for what they cannot read and never fail.
"""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# ---- blanks and typed parsing


def blank_to_none(c: Column) -> Column:
    """Without outer white space; null if nothing is left."""
    return F.nullif(F.regexp_replace(c.cast("string"), r"(?U)^\s+|\s+$", ""), F.lit(""))


def placeholder_to_none(c: Column, *marks: str) -> Column:
    """Null for source-specific marks of absence, whatever their case."""
    v = blank_to_none(c)
    return F.when(~F.lower(v).isin([m.lower() for m in marks]), v)


def safe_float(c: Column) -> Column:
    return blank_to_none(c).try_cast("double")


def safe_int(c: Column) -> Column:
    """The integer part of a number; null if it is not finite or does not fit 64 bits."""
    v = safe_float(c)
    return F.when(F.abs(v) < 9.2e18, F.when(v >= 0, F.floor(v)).otherwise(F.ceil(v)))


#: Date layouts, as patterns that the whole value must match and as formats.
DATE_LAYOUTS = (
    (r"\d{4}-\d{1,2}-\d{1,2}(?:[T ]\d{1,2}:\d{1,2}:\d{1,2}(?:\.\d{1,6})?Z?)?", None),
    (r"\d{1,2}/\d{1,2}/\d{4}", "M/d/yyyy"),
    (r"\d{1,2}/\d{1,2}/\d{2}", "M/d/yy"),
    (r"\d{1,2}-[A-Za-z]{3}-\d{4}", "d-MMM-yyyy"),
)


def safe_date(c: Column) -> Column:
    """A full date in one of the known layouts; partial dates are null."""
    v = blank_to_none(c)
    tries = []
    for pattern, layout in DATE_LAYOUTS:
        ok = v.rlike(f"^(?:{pattern})$")
        if layout is None:
            day = F.try_to_timestamp(F.regexp_extract(v, r"^(\d{4}-\d{1,2}-\d{1,2})", 1), F.lit("yyyy-M-d"))
        else:
            day = F.try_to_timestamp(F.initcap(v) if "MMM" in layout else v, F.lit(layout))
        tries.append(F.when(ok, day.cast("date")))
    return F.coalesce(*tries)


def safe_year(c: Column) -> Column:
    """Year of a full date, of a year, or of a year and month; ranges are null."""
    v = blank_to_none(c)
    partial = F.nullif(F.regexp_extract(v, r"^(\d{4})(?:-\d{2})?$", 1), F.lit("")).try_cast("int")
    return F.coalesce(F.year(safe_date(c)), partial)


def document_year(c: Column) -> Column:
    """A four-digit year, checked before it is cast."""
    return F.when(c.rlike(r"^\d{4}$"), c.try_cast("int"))


# ---- identifiers


def base_accession(c: Column) -> Column:
    return F.regexp_replace(blank_to_none(c), r"\.\d+$", "")


def normalize_document_id(c: Column) -> Column:
    """Country, number and kind code, spaced; other values pass trimmed."""
    pattern = r"^\s*([A-Z]{2})\s*(\d+)\s*([A-Z]\d?)\s*$"
    parts = [F.regexp_extract(c, pattern, i) for i in (1, 2, 3)]
    return F.when(c.rlike(pattern), F.concat_ws(" ", *parts)).otherwise(blank_to_none(c))


def compact_id(c: Column) -> Column:
    return F.regexp_replace(c, r"\s+", "")


def document_id_variants(c: Column) -> Column:
    """Spellings of a document id to search for: as given, compact, and without the kind code."""
    compact = compact_id(c)
    return F.array_distinct(F.array(c, compact, F.regexp_replace(compact, r"[A-Z]\d?$", "")))


def family_id(c: Column) -> Column:
    return F.regexp_replace(blank_to_none(c), r"\.0$", "")


def kind_code(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"\s([A-Z]\d?)$", 1), F.lit(""))


#: Activity codes of contracts, whose core numbers are cut off at the source.
CONTRACT_CODES = ("N01", "N02", "N43", "N44", "Y01")


def award_key(core: Column, project: Column, activity: Column) -> Column:
    """The core number; for contracts the project number without its last segment."""
    contract = activity.isin(*CONTRACT_CODES) & (F.coalesce(project, F.lit("")) != "")
    return F.when(contract, F.regexp_replace(project, r"-[^-]*$", "")).otherwise(core)


def award_key_staging(core: Column, project: Column, record: Column, no_task: tuple[str, ...] = ("", "0", "00000000")) -> Column:
    """The core number if it is a standard one; else contract number and task order."""
    core = F.trim(F.coalesce(core, F.lit("")))
    base = F.coalesce(F.nullif(project, F.lit("")), F.nullif(core, F.lit("")), record.cast("string"))
    parts = F.split(base, "-")
    task = F.coalesce(F.get(parts, F.lit(2)), F.lit(""))
    rebuilt = F.when(task.isin(*no_task), F.get(parts, F.lit(0))).otherwise(F.concat_ws("-", F.get(parts, F.lit(0)), task))
    return F.when(core.rlike(r"^[A-Z][A-Z0-9]{2}[A-Z]{2}\d{6}$"), core).otherwise(rebuilt)


def core_award_number(c: Column) -> Column:
    """`1 U19 AI109762-01` -> `U19AI109762`."""
    v = F.regexp_replace(F.upper(c), r"\s+", "")
    return F.nullif(F.regexp_extract(v, r"([A-Z]\d{2}[A-Z]{2}\d{6})", 1), F.lit(""))


def evidence_id(*parts: Column) -> Column:
    """16 hexadecimal digits of the SHA-1 of the joined key."""
    return F.substring(F.sha1(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 16)


# ---- text


@F.pandas_udf(StringType())
def clean_text(values: pd.Series) -> pd.Series:
    """Entities decoded, control characters and double-decoded UTF-8 repaired, blank -> null."""
    return values.map(_clean, na_action="ignore")


def _single_bytes(codec: str) -> dict[str, int]:
    """The letters of a single-byte encoding above ASCII; bytes it leaves undefined stand for themselves."""
    return {bytes([b]).decode(codec, "ignore") or chr(b): b for b in range(0x80, 0x100)}


_AS_BYTE = {**_single_bytes("latin-1"), **_single_bytes("cp1252")}
_CONTROLS = {c: " " for c in [*range(0x20), 0x7F] if chr(c) not in "\t\n\r"} | {0x13: "–", 0x14: "—"}


def _class(low: int, high: int) -> str:
    return "[" + "".join(re.escape(c) for c, b in _AS_BYTE.items() if low <= b <= high) + "]"


#: A UTF-8 sequence of two to four bytes, each read as one letter.
_DOUBLE = re.compile(
    f"{_class(0xC2, 0xDF)}{_class(0x80, 0xBF)}|{_class(0xE0, 0xEF)}{_class(0x80, 0xBF)}{{2}}|{_class(0xF0, 0xF4)}{_class(0x80, 0xBF)}{{3}}"
)


def _undone(m: re.Match) -> str:
    try:
        return bytes(_AS_BYTE[c] for c in m[0]).decode("utf-8")
    except UnicodeDecodeError:
        return m[0]


def _clean(text: str) -> str | None:
    text = html.unescape(text.strip()).translate(_CONTROLS)
    # UTF-8 that was read as single bytes, up to three times over
    for _ in range(3):
        once = _DOUBLE.sub(_undone, text)
        if once == text:
            break
        text = once
    return text.strip() or None


def clean_lines(c: Column) -> Column:
    """White space collapsed within lines; line feeds stay, blank lines go."""
    lines = F.transform(F.split(c, r"\r?\n"), lambda x: F.trim(F.regexp_replace(x, r"[ \t\x0B\f\r]+", " ")))
    return F.nullif(F.array_join(F.filter(lines, lambda x: x != ""), "\n"), F.lit(""))


def strip_html(c: Column) -> Column:
    text = F.regexp_replace(c, r"(?is)<head\b.*?</head>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"<[^>]*>", " "), r"\s+", " "))


@F.pandas_udf(StringType())
def ascii_fold(values: pd.Series) -> pd.Series:
    """Lower-case ASCII letters of a name, accents dropped."""
    return values.map(lambda v: unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode().lower(), na_action="ignore")


def norm_title(c: Column) -> Column:
    """Lower-case words of a title, single-spaced."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", " "))


def name_key(folded: Column) -> Column:
    return F.regexp_replace(F.lower(folded), "[^a-z]", "")


def name_tokens(folded: Column) -> Column:
    return F.filter(F.split(F.lower(folded), "[^a-z]+"), lambda x: x != "")


def truncate_text(c: Column, letters: int = 160) -> Column:
    return F.when(F.length(c) > letters, F.concat(F.substring(c, 1, letters - 1), F.lit("…"))).otherwise(c)


def snippet(text: Column, at: Column, length: Column, reach: int = 160) -> Column:
    """The text around a match that begins at letter `at` (from 1), the match in double brackets."""
    start = F.greatest(at - reach, F.lit(1))
    before = F.substr(text, start, at - start)
    hit = F.substr(text, at, length)
    return F.when(at > 0, F.concat(before, F.lit("[["), hit, F.lit("]]"), F.substr(text, at + length, F.lit(reach))))


# ---- vocabularies


def parse_neutralizing(c: Column) -> Column:
    """yes/no, qualifiers in brackets ignored; anything else is unknown."""
    token = F.trim(F.lower(F.split_part(blank_to_none(c), F.lit("("), F.lit(1))))
    return F.when(token.isin("yes", "y", "true", "neutralizing"), True).when(token.isin("no", "n", "false", "non-neutralizing"), False)


def dictionary(entries: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in entries.items() for x in kv])


def parse_phrases(c: Column, index: dict[str, str], qualifiers: tuple[str, ...]) -> tuple[Column, Column]:
    """(names found, fragments unmatched) of a list joined by commas or `and`."""
    known = dictionary(index)
    fragments = F.filter(F.transform(F.split(F.lower(c), r",|\band\b"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))), lambda x: x != "")
    pattern = r"\b(?:" + "|".join(qualifiers) + r")\b"
    bare = lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, pattern, ""), r"\s+", " "))
    name = lambda x: F.coalesce(F.try_element_at(known, x), F.try_element_at(known, bare(x)))
    found = F.array_distinct(F.filter(F.transform(fragments, name), lambda x: x.isNotNull()))
    rest = F.filter(fragments, lambda x: name(x).isNull() & (bare(x) != ""))
    return found, rest


def parse_methods(c: Column, patterns: list[tuple[str, str]]) -> Column:
    """Names of all patterns that occur, in vocabulary order."""
    return F.array_compact(F.array(*[F.when(c.rlike(p), F.lit(name)) for p, name in patterns]))


def first_rule(c: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """The value of the first pattern that occurs."""
    out = F.lit(default).cast("string")
    for pattern, value in reversed(rules):
        out = F.when(c.rlike(pattern), F.lit(value)).otherwise(out)
    return out


# ---- dates and people


def person_name(c: Column) -> Column:
    """`Last; First` turned round, `et al.` dropped."""
    v = F.trim(F.regexp_replace(c, r"(?i),?\s*\bet al\b\.?\s*$", ""))
    return F.regexp_replace(v, r"^([^;]+?)\s*;\s*([^;]+)$", "$2 $1")


def paper_date(c: Column) -> tuple[Column, Column]:
    """(date padded to the first day, precision) of a partial date."""
    parts = F.split(F.trim(F.coalesce(c, F.lit(""))), "-")
    padded = F.array_join(F.slice(F.concat(parts, F.array(F.lit("01"), F.lit("01"))), 1, 3), "-")
    precision = F.when(F.size(parts) == 1, "year").when(F.size(parts) == 2, "month").when(F.size(parts) == 3, "day").otherwise("")
    return padded, precision


def fiscal_year_start(year: Column) -> Column:
    return F.make_date(year - 1, F.lit(10), F.lit(1))


def contact_pi(flat: Column, people: Column) -> Column:
    """The flat column, else the contact entry of the JSON list; malformed JSON is null."""
    schema = "array<struct<full_name:string,is_contact_pi:boolean>>"
    contacts = F.filter(F.from_json(people, schema), lambda x: F.coalesce(x["is_contact_pi"], F.lit(False)))
    return F.coalesce(blank_to_none(flat), blank_to_none(F.get(contacts, F.lit(0))["full_name"]))


def match_confidence(method: Column, affiliation: Column, acknowledged: Column) -> Column:
    sure = F.coalesce(affiliation, F.lit(False)) | F.coalesce(acknowledged, F.lit(False))
    return F.when(sure, "high").when(method == "forename", "medium").otherwise("low")


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v)
    # a vector of zeros is like nothing: null
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a) * dot(b, b)), F.lit(0.0))


def clean_header(names: Column) -> Column:
    """The same of an array of names in each row."""
    plain = F.transform(names, lambda x: F.trim(F.regexp_replace(F.lower(F.trim(F.coalesce(x, F.lit("")))), "[^0-9a-z]+", "_"), F.lit("_")))
    plain = F.transform(plain, lambda x: F.when(x == "", "col").otherwise(x))

    def numbered(plain: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            n = F.size(F.filter(F.slice(plain, 1, i + 1), lambda y: y == x))
            return F.when(n == 1, x).otherwise(F.concat_ws("_", x, n.cast("string")))

        return F.transform(plain, one)

    # as an argument the cleaned names are worked out once, not once for each name
    return F.get(F.transform(F.array(plain), numbered), F.lit(0))


def clean_columns(names: list[str]) -> list[str]:
    """Header names in lower case with underscores; repeats get a number."""
    out: list[str] = []
    seen: dict[str, int] = {}
    for raw in names:
        name = re.sub("[^0-9a-z]+", "_", str(raw).strip().lower()).strip("_") or "col"
        seen[name] = seen.get(name, 0) + 1
        out.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return out
