"""Linking texts to a vocabulary of terms, and turning hits into links with support.

Terms are matched as whole tokens: a term may not continue with an ASCII letter or digit
on either side. A vocabulary within a bound is sent to all tasks, which pass over each text
once and never move it; a larger one is joined to the texts' n-grams.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored, tasks
from .joins import prefix_match

try:
    import ahocorasick
except ImportError:  # terms are then found by one pattern
    ahocorasick = None

#: Confidence of a match by where it stands, and the factor of ambiguous terms.
CONFIDENCE = {"identifier": 1.00, "title": 0.70, "abstract": 0.50, "query_scope": 0.40}
AMBIGUOUS = 0.5
#: Letters of all terms together that are sent to every task at most.
SENT_LETTERS = 1_000_000
#: Hits that a task puts into one batch, beside those of the last text.
HITS = 4096
_EDGE = frozenset("0123456789abcdefghijklmnopqrstuvwxyz")


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^0-9a-z]+"), lambda x: x != "")


def whole_token(term: Column, ignore_case: bool = True) -> Column:
    """A pattern that finds a term as whole tokens."""
    flag = "(?iu)" if ignore_case else ""
    literal = F.regexp_replace(term, r"([^0-9A-Za-z\s])", r"\\$1")
    return F.concat(F.lit(rf"{flag}(?<![0-9A-Za-z])"), literal, F.lit(r"(?![0-9A-Za-z])"))


def cased_pattern(term: str, follow: str = "") -> Column:
    """The pattern of one term: short upper-case terms and single letters match in that case only, and one of the following words may be asked for."""
    exact = len(term) == 1 or (len(term) <= 4 and term.isupper())
    after = rf"(?=\s+(?:{follow})(?![0-9A-Za-z]))" if follow else ""
    return F.lit(rf"{'' if exact else '(?iu)'}(?<![0-9A-Za-z]){re.escape(term)}(?![0-9A-Za-z]){after}")


def lower(text: str) -> str:
    """Lower case, letter by letter, so that places stay the same."""
    out = text.lower()
    return out if len(out) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


class Finder:
    """All places where lower-case terms stand as whole tokens."""

    def __init__(self, terms: Iterable[str]):
        self.terms = sorted(set(terms))
        if ahocorasick is not None and self.terms:
            self.machine = ahocorasick.Automaton()
            for i, t in enumerate(self.terms):
                self.machine.add_word(t, (i, len(t)))
            self.machine.make_automaton()
        else:
            self.machine = None

    def places(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(start, end, number of the term) in lower-case text."""
        if self.machine is not None:
            for last, (i, n) in self.machine.iter(text):
                start, end = last + 1 - n, last + 1
                if (end == len(text) or text[end] not in _EDGE) and (not start or text[start - 1] not in _EDGE):
                    yield start, end, i
            return
        for i, t in enumerate(self.terms):
            for m in re.finditer(rf"(?<![0-9a-z])(?={re.escape(t)}(?![0-9a-z]))", text):
                yield m.start(), m.start() + len(t), i

    def counts(self, text: str) -> dict[int, tuple[int, int]]:
        """How often each term occurs, places of one term that overlap counted once, and where it stands first."""
        out: dict[int, tuple[int, int]] = {}
        until: dict[int, int] = {}
        for start, end, i in self.places(text):
            if start >= until.get(i, 0):
                n, first = out.get(i, (0, start))
                out[i] = n + 1, first
                until[i] = end
        return out


def term_matches(
    docs: DataFrame, vocabulary: DataFrame, id_col: str, text_col: str, term_col: str, carry: tuple[str, ...] = (), sent_letters: int = SENT_LETTERS
) -> DataFrame:
    """(id, carried columns, term, n, at): terms that occur in each text as whole tokens, ignoring case, how often,
    and the place (from 1) of the first.

    vocabulary needs terms with at least one letter or digit; terms that differ in case only
    are all reported. A null text holds nothing.
    """
    terms = vocabulary.select(F.col(term_col).alias("term")).where(F.col(term_col).rlike("[0-9A-Za-z]")).distinct()
    size = terms.agg(F.coalesce(F.sum(F.length("term") + 1), F.lit(0))).first()[0]
    if size > sent_letters:
        return _joined_matches(docs, terms, id_col, text_col, term_col, carry)
    spellings: dict[str, list[str]] = {}
    for r in terms.collect():
        spellings.setdefault(lower(r["term"]), []).append(r["term"])
    src = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(spellings)
        for batch in batches:
            texts, others = batch.column("text"), batch.drop_columns("text")
            rows, term, n, at = [], [], [], []
            for row in range(len(texts)):
                # one text at a time, and its hits as soon as they are many: a worker holds a batch as it came and little else
                for i, (times, first) in finder.counts(lower(texts[row].as_py())).items():
                    for t in spellings[finder.terms[i]]:
                        rows.append(row)
                        term.append(t)
                        n.append(times)
                        at.append(first + 1)
                if len(rows) >= HITS or row == len(texts) - 1:
                    hits = [pa.array(term, pa.string()), pa.array(n, pa.int64()), pa.array(at, pa.int64())]
                    yield pa.RecordBatch.from_arrays([*others.take(pa.array(rows, pa.int64())).columns, *hits], [*others.schema.names, "term", "n", "at"])
                    rows, term, n, at = [], [], [], []

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in src.schema.fields if f.name != "text"]
    found = src.mapInArrow(run, ", ".join([*kinds, "term string", "n long", "at long"]))
    return found.select(F.col("id").alias(id_col), *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], F.col("term").alias(term_col), "n", "at")


def _joined_matches(docs: DataFrame, terms: DataFrame, id_col: str, text_col: str, term_col: str, carry: tuple[str, ...]) -> DataFrame:
    """The same for a vocabulary of any size: distinct n-grams of a text join the terms, and a pattern decides.

    Only n-grams that some term begins with are taken on; a text moves once, for its candidates.
    """
    terms = terms.withColumn("gram", F.array_join(tokens(F.col("term")), " "))
    longest = terms.agg(F.max(F.size(F.split("gram", " ")))).first()[0] or 1
    row = F.struct(*[F.col(c) for c in docs.columns])
    words = docs.where(F.col(text_col).isNotNull()).withColumn("_row", F.xxhash64(row)).withColumn("t", tokens(F.col(text_col)))
    grams = F.array_distinct(F.flatten(F.array(*[_grams(n) for n in range(1, longest + 1)])))
    candidates = words.select("_row", F.explode(grams).alias("gram")).join(terms, "gram").select("_row", "term").distinct()
    named = candidates.groupBy("_row").agg(F.collect_list("term").alias("_terms"))
    hits = words.drop("t").join(named, "_row").withColumn("term", F.explode("_terms")).withColumn("n", F.regexp_count(text_col, whole_token(F.col("term"))))
    at = F.regexp_instr(text_col, whole_token(F.col("term")))
    return hits.where(F.col("n") > 0).select(id_col, *carry, F.col("term").alias(term_col), F.col("n").cast("long").alias("n"), at.cast("long").alias("at"))


def _grams(n: int) -> Column:
    t = F.col("t")
    if n == 1:
        return t

    def gram(i: Column) -> Column:
        return F.array_join(F.slice(t, i, n), " ")

    none = F.array().cast("array<string>")
    return F.when(F.size(t) < n, none).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.size(t) - n + 1, F.lit(1))), gram))


def confidence(field: Column, ambiguous: Column) -> Column:
    base = F.create_map(*[F.lit(x) for kv in CONFIDENCE.items() for x in kv])[field]
    return F.round(base * F.when(ambiguous, AMBIGUOUS).otherwise(1.0), 2)


def match_method(term_type: Column) -> Column:
    return F.when(term_type == "db_gene_label", "gene_label").when(term_type.endswith("alias"), "synonym").otherwise("keyword")


def context_gate(hits: DataFrame, doc: str, entity_type: str, requires_context: str, context_type: str = "taxon") -> DataFrame:
    """Ambiguous hits stay only in documents that also hit an entity of the context type."""
    held = F.bool_or(F.col(entity_type) == context_type).over(Window.partitionBy(doc))
    return hits.withColumn("_held", held).where(F.col("_held") | ~F.col(requires_context)).drop("_held")


def collapse_links(hits: DataFrame, keys: list[str], confidence_col: str, order: list[str]) -> DataFrame:
    """One link per key: highest confidence, source of the first hit, number of supports."""
    first = F.min_by("source", F.struct(*order))
    return hits.groupBy(*keys).agg(F.max(confidence_col).alias("confidence"), first.alias("source"), F.count("*").alias("n_support"))


def best_by_priority(hits: DataFrame, keys: list[str], method: str, priority: list[str]) -> DataFrame:
    """For each key the hit with the most trusted method."""
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col(method))
    rank = F.when(rank == 0, len(priority) + 1).otherwise(rank)
    return hits.groupBy(*keys).agg(F.min_by(method, rank).alias(method))


def relevance_tier(title_hit: Column, mentions: Column) -> Column:
    """strong: a title names the topic; moderate: two mentions or more; weak: one."""
    return F.when(title_hit, "strong").when(mentions >= 2, "moderate").when(mentions == 1, "weak")


#: The forms of a grant number's parts (an application's type and activity, an institute, a serial).
ACTIVITY, INSTITUTE, SERIAL = r"[A-Z][0-9]{2}|Z[A-Z0-9]{2}", "[A-Z][A-Z1]", "[0-9]{5,6}(?![0-9])"


def grant_numbers(df: DataFrame, text_col: str) -> DataFrame:
    """df with one row per grant number in the text: `activity` (or null) and `serial`.

    Parts of a number may be joined, or set apart by blanks and hyphens. The text is read as
    phrases of words; every word that ends a number's head is looked at together with the
    word before it (an activity) and the word after it (a serial).
    """
    phrases = F.split(F.upper(text_col), r"[^A-Z0-9\s-]+")
    out = df.withColumn("_w", F.explode(F.transform(phrases, lambda p: F.split(F.trim(F.regexp_replace(p, r"[\s-]+", " ")), " "))))
    word = lambda i: F.coalesce(F.get("_w", i), F.lit(""))
    kind, head = rf"^[0-9]?({ACTIVITY})$", rf"^(?:[0-9]?({ACTIVITY}))?({INSTITUTE})"

    def number(_: Column, i: Column) -> Column:
        apart = word(i).rlike(rf"{head}$") & word(i + 1).rlike(f"^{SERIAL}")
        digits = F.when(apart, F.regexp_extract(word(i + 1), f"^({SERIAL})", 1)).otherwise(F.regexp_extract(word(i), rf"{head}({SERIAL})", 3))
        own = F.nullif(F.regexp_extract(word(i), head, 1), F.lit(""))
        before = F.nullif(F.regexp_extract(word(i - 1), kind, 1), F.lit(""))
        # the letter I is often read as the digit 1
        institute = F.replace(F.regexp_extract(word(i), head, 2), F.lit("1"), F.lit("I"))
        return F.when(digits != "", F.struct(F.coalesce(own, before).alias("activity"), F.concat(institute, F.lpad(digits, 6, "0")).alias("serial")))

    found = F.array_compact(F.transform("_w", number))
    return out.withColumn("_g", F.explode(found)).select(*df.columns, "_g.activity", "_g.serial")


#: Contracts as texts cite them, in capitals: twelve digits and a letter behind HHSN, often set apart, and the newer form.
CONTRACT = r"HHSN[\s-]?([\d\s-]{9,16})[A-Z]?|(75N9\d{4}[A-Z]\d{5})"


def contract_numbers(df: DataFrame, text_col: str) -> DataFrame:
    """df with one row per contract number in the text, as it stands there in capitals: `contract`."""
    found = F.regexp_extract_all(F.upper(text_col), F.lit(CONTRACT), F.lit(0))
    return df.withColumn("_c", F.explode(found)).select(*df.columns, F.regexp_replace("_c", r"^\s+|\s+$", "").alias("contract"))


def contract_awards(numbers: DataFrame, awards: DataFrame) -> DataFrame:
    """(contract, award): the awards whose keys begin with a contract's number, where all of them have one title.

    A contract is split into task orders, so one number means several awards; where their titles differ it is
    an umbrella, which says nothing of the project. Of a number of twelve digits the letter behind them, which
    is often misprinted, doesn't count; numbers under nine letters mean nothing.
    numbers: contract; awards: award, key, title.
    """
    part = F.coalesce(*[F.nullif(F.regexp_extract("contract", CONTRACT, n), F.lit("")) for n in (1, 2)])
    bare = F.regexp_replace(part, "[^0-9A-Z]", "")
    known = numbers.withColumn("prefix", F.when(bare.rlike(r"^[0-9]{12}"), F.substring(bare, 1, 12)).otherwise(bare))
    keys = awards.select("award", F.regexp_replace(F.upper("key"), "[^0-9A-Z]", "").alias("key"), F.lower(F.trim(F.coalesce("title", F.lit("")))).alias("title"))
    return prefix_match(known.where(F.length("prefix") >= 9), keys, "prefix", "key", 9, "title").select("contract", "award")


def resolve_grants(found: DataFrame, awards: DataFrame, contracts: DataFrame | None = None) -> DataFrame:
    """(doc, award, matched): an exact core number first, else every award of the serial; contracts by the beginning of their keys.

    found: doc, activity, serial; awards: award, core, and with contracts (doc, contract) key and title of awards.
    """
    serial = F.coalesce(F.col("core").rlike(r"^(?:[A-Z]\d{2}|Z[A-Z0-9]{2})[A-Z]{2}\d{6}$"), F.lit(False))
    own = awards.where(serial).select("award", "core", F.expr("right(core, 8)").alias("own"))
    # which awards a number means is a matter of the number alone, so it is told once for all documents that name it
    both = found.select("activity", "serial").distinct().join(own, F.col("serial") == F.col("own"))
    exact = F.col("core") == F.concat("activity", "serial")
    any_exact = F.bool_or(F.coalesce(exact, F.lit(False))).over(Window.partitionBy("activity", "serial"))
    meant = both.withColumn("any_exact", any_exact).where(~F.col("any_exact") | exact)
    meant = stored(meant.select(F.col("activity").alias("a"), F.col("serial").alias("s"), "award", F.concat(F.coalesce("activity", F.lit("")), "serial").alias("matched")))
    named = found.join(meant, F.col("activity").eqNullSafe(F.col("a")) & (F.col("serial") == F.col("s"))).select("doc", "award", "matched")
    if contracts is not None:
        credited = stored(contract_awards(contracts.select("contract").distinct(), awards.where(~serial)))
        named = named.union(contracts.join(credited, "contract").select("doc", "award", F.col("contract").alias("matched")))
    return named.repartition(tasks(found), "doc").distinct()


#: Types whose spans may overlap each other: an organism inside a condition's name.
_PARTNER = {"taxon": "condition", "condition": "taxon"}
_STOPS = ".!?;\n"


def chosen_spans(starts: np.ndarray, ends: np.ndarray, types: list[str], letters: int) -> list[int]:
    """Numbers of the spans that stay, longest first.

    For each type a count of accepted spans is kept on every letter. A span is refused if on
    some letter of it an accepted span stands that neither is the same span nor has the
    partner type.
    """
    cover: dict[str, np.ndarray] = {}
    same: dict[tuple[int, int], list[str]] = {}
    total = np.zeros(letters, np.int32)
    out = []
    for i in np.lexsort((starts, starts - ends)).tolist():
        a, b, kind = int(starts[i]), int(ends[i]), types[i]
        partner = _PARTNER.get(kind)
        against = total[a:b] - sum(t != partner for t in same.get((a, b), ()))
        if partner in cover:
            against = against - cover[partner][a:b]
        if not against.any():
            out.append(i)
            same.setdefault((a, b), []).append(kind)
            total[a:b] += 1
            cover.setdefault(kind, np.zeros(letters, np.int32))[a:b] += 1
    return out


def in_context(starts: np.ndarray, ends: np.ndarray, types: list[str], text: str, window: int) -> list[bool]:
    """For each span of type `generic`, whether a taxon's span begins in its sentence within `window` letters; true for others."""
    stops = np.array([i for i, c in enumerate(text) if c in _STOPS], np.int64)
    sentence = np.searchsorted(stops, starts)
    taxon = np.array([t == "taxon" for t in types], bool)
    out = []
    for i, kind in enumerate(types):
        near = np.minimum(np.abs(starts - starts[i]), np.abs(ends - ends[i])) <= window
        out.append(kind != "generic" or bool((taxon & near & (sentence == sentence[i])).any()))
    return out


@dataclass(frozen=True)
class TermRule:
    """What a term's surroundings must be: a pattern found in its sentence, and one not found in the letters just before it."""

    sentence: str | None = None
    not_before: str | None = None
    letters: int = 20


class Rules:
    """Rules of single terms, by lower-case term."""

    def __init__(self, rules: dict[str, TermRule]):
        self.rules = {lower(t): (r, re.compile(r.sentence) if r.sentence else None, re.compile(r.not_before) if r.not_before else None) for t, r in rules.items()}

    def hold(self, text: str, starts: np.ndarray, terms: list[str]) -> list[bool]:
        """For each span of a term, whether its rule holds; sentences end at the stops that in_context knows."""
        if not self.rules or not any(lower(t) in self.rules for t in terms):
            return [True] * len(terms)
        stops = np.array([i for i, c in enumerate(text) if c in _STOPS], np.int64)
        out = []
        for start, term in zip(starts.tolist(), terms, strict=True):
            rule, inside, before = self.rules.get(lower(term), (None, None, None))
            n = int(np.searchsorted(stops, start))
            first, last = int(stops[n - 1]) + 1 if n else 0, int(stops[n]) if n < len(stops) else len(text)
            good = not inside or bool(inside.search(text, first, last))
            out.append(good and not (before and before.search(text[max(0, start - rule.letters) : start])))
        return out


def longest_spans(
    docs: DataFrame, terms: list[tuple[str, str, str]], id_col: str, text_col: str, window: int = 80, rules: dict[str, TermRule] | None = None
) -> DataFrame:
    """Accepted hits of a small vocabulary [(term, entity, type)]: longest spans first, no overlaps.

    A hit of type `generic` also needs a taxon hit in its sentence within `window` letters, and a hit of a
    term that rules name needs what its rule says; hits that fall out take no other's place.
    Short upper-case terms match in that case only. The choice is sequential within
    one text, so texts are handled in Arrow batches, each by itself; terms are found in one
    pass over a text, however many there are.
    """
    rows = sorted(set(terms))
    exact = [len(t) == 1 or (len(t) <= 4 and t.isupper()) for t, _, _ in rows]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder, single = Finder(lower(t) for t, _, _ in rows), Rules(rules or {})
        number = {t: i for i, t in enumerate(finder.terms)}
        owners: dict[int, list[int]] = {}
        for k, (t, _, _) in enumerate(rows):
            owners.setdefault(number[lower(t)], []).append(k)
        for pdf in batches:
            out = []
            for ident, text in zip(pdf["id"], pdf["text"], strict=True):
                text = text or ""
                hits = [
                    (a, b, k) for a, b, i in finder.places(lower(text)) for k in owners[i]
                    if not exact[k] or text[a:b] == rows[k][0]
                ]
                hits.sort(key=lambda h: rows[h[2]])
                at = np.array([h[:2] for h in hits], np.int64).reshape(-1, 2)
                kept = chosen_spans(at[:, 0], at[:, 1], [rows[h[2]][2] for h in hits], len(text))
                at, kinds = at[kept], [rows[hits[i][2]][2] for i in kept]
                ok = in_context(at[:, 0], at[:, 1], kinds, text, window)
                ok = [a and b for a, b in zip(ok, single.hold(text, at[:, 0], [rows[hits[i][2]][0] for i in kept]), strict=True)]
                out += [(ident, *hits[i][:2], *rows[hits[i][2]]) for i, good in zip(kept, ok, strict=True) if good]
            yield pd.DataFrame(out, columns=["id", "start", "end", "term", "entity", "type"])

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return src.mapInPandas(run, "id long, start long, end long, term string, entity string, type string").withColumnRenamed("id", id_col)
