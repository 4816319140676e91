"""Personal data: patterns, and terms that give a protected entity away.

The four base kinds are found by pattern, and so are secrets: long runs of letters and
digits mixed, of at least 80 bits if each letter is as likely. Each distinct value is a protected entity.
All terms of the documents that mention an entity are candidates, and the corpus says how
strongly a term t reveals an entity e: with document counts n(t,e), n(t), n(e) and N,
    PMI(t;e) = log2(n(t,e) N / (n(t) n(e)))   and   IC(e) = log2(N / n(e)).
PMI = IC means that t never occurs without e. A term whose PMI reaches a share of IC is
removed (or, from a lower share on, generalised) in all documents that mention e. Only
built-in expressions are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, stored

#: Pairs of a document's words and entities that go to one task.
PAIRS = 250_000

KINDS = ("email", "ip", "card", "phone")
#: Patterns as the kinds are defined, in the form that never backtracks over a long run:
#: what follows each possessive part can't begin with a letter of that part. A match starts
#: a run of its letters or follows the match before (\G).
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![\p{L}\p{N}])(?=[A-Za-z]*[0-9])(?=[0-9]*[A-Za-z])[A-Za-z0-9]{20,}+(?![\p{L}\p{N}])",
}
#: Kinds that are entities: the base ones, which are the contract's, and what the method adds.
ENTITIES = (*KINDS, "secret")
#: What a text must hold for a kind to be searched.
GATES = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "secret": r"[0-9][A-Za-z]|[A-Za-z][0-9]"}
TERM = r"[\p{L}\p{M}\p{N}]+"
SPANS = "array<struct<start:int,end:int,value:string>>"


#: Elements that a running value is built over at a time: an array is copied for each element added.
STRIDE = 256
#: Letters of the blocks that a text is cut into to be read from any place.
BLOCK = 1_024


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once, also where use names it in a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, step: Callable[[Column, Column], Column], zero: Column) -> Column:
    """For each element of an array what step makes of those before it, from zero on.

    step must not care how its operands are grouped: elements go STRIDE at a time, then the blocks
    of them, so that the work grows far less than with the array's square.
    """

    def one_by_one(a: Column) -> Column:
        """As many elements and one more: the last is of all."""
        return F.aggregate(a, F.array(zero), lambda acc, x: F.array_append(acc, step(F.element_at(acc, -1), x)))

    def by_blocks(a: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.floor((F.size(a) - 1) / STRIDE).cast("int"), F.lit(0)))
        inner = F.transform(starts, lambda i: one_by_one(F.slice(a, i * STRIDE + 1, STRIDE)))
        return let(inner, lambda b: F.flatten(F.zip_with(
            b, F.slice(one_by_one(F.transform(b, lambda x: F.element_at(x, -1))), 1, F.size(b)),
            lambda x, before: F.transform(F.slice(x, 1, F.size(x) - 1), lambda y: step(before, y)),
        )))

    return let(values, by_blocks)


def found(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of all matches, in code points."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def placed(pairs: Column) -> Column:
        sizes = F.transform(pairs, lambda x: F.length(x["g"]) + F.length(x["v"]))
        return F.zip_with(pairs, running(sizes, lambda a, b: a + b, F.lit(0)), lambda x, at: F.struct(
            (at + F.length(x["g"])).alias("start"), (at + F.length(x["g"]) + F.length(x["v"])).alias("end"), x["v"].alias("value")
        ))

    # behind the last match there is one gap more
    return let(values, lambda v: F.when(F.size(v) == 0, F.array().cast(SPANS)).otherwise(
        let(F.arrays_zip(F.slice(gaps, 1, F.size(v)).alias("g"), v.alias("v")), placed)
    ))


def apart(spans: Column, base: Callable[[Column], Column]) -> Column:
    """Spans, sorted by start, without those that are not base and overlap a base one."""
    last = 2**31 - 1

    def tell(s: Column) -> Column:
        ends = F.transform(s, lambda x: F.when(base(x), x["end"]).otherwise(0))
        starts = F.transform(F.reverse(s), lambda x: F.when(base(x), x["start"]).otherwise(last))
        before = running(ends, lambda a, b: F.greatest(a, b), F.lit(0))
        after = F.reverse(running(starts, lambda a, b: F.least(a, b), F.lit(last)))
        return F.transform(
            F.filter(F.arrays_zip(s.alias("s"), before.alias("before"), after.alias("after")), lambda z: base(z["s"]) | ((z["before"] <= z["s"]["start"]) & (z["after"] >= z["s"]["end"]))),
            lambda z: z["s"],
        )

    return let(spans, tell)


def replaced(text: Column, spans: Column, label: Callable[[Column], Column]) -> Column:
    """text with label(span) for each span; spans are sorted by start, and one that begins within another adds no label of its own."""

    def part(blocks: Column, a: Column, b: Column) -> Column:
        at = lambda x: F.floor(x / BLOCK).cast("int")
        return F.substr(F.array_join(F.slice(blocks, at(a) + 1, at(b) - at(a) + 1), ""), a - at(a) * BLOCK + 1, b - a)

    def joined(blocks: Column, s: Column) -> Column:
        covered = running(F.transform(s, lambda x: x["end"]), lambda a, b: F.greatest(a, b), F.lit(0))
        pieces = F.zip_with(s, covered, lambda x, at: F.when(x["start"] >= at, F.concat(part(blocks, at, x["start"]), label(x))).otherwise(""))
        end = F.array_max(F.transform(s, lambda x: x["end"]))
        return F.array_join(F.concat(pieces, F.array(let(end, lambda e: part(blocks, e, F.greatest(F.length(text), e))))), "")

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    return F.when(F.size(spans) == 0, text).otherwise(let(blocks, lambda b: let(spans, lambda s: joined(b, s))))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    def add(acc: Column, i: Column) -> Column:
        d = F.substr(F.reverse(number), i, F.lit(1)).cast("int")
        twice = d * 2
        return acc + F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
VALID = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: v.rlike(rf"^{PART}\.{PART}\.{PART}\.{PART}$"),
    "card": lambda v: F.length(digits(v)).between(12, 19) & luhn(digits(v)),
    "phone": lambda v: F.length(digits(v)).between(9, 15),
    "secret": lambda v: F.lit(True),
}


def base_spans(df: DataFrame, text_col: str, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """df with `_spans`: array<struct<start, n, kind, end, value>>, by start, then kind as listed."""
    text = F.col(f"`{text_col}`")
    def valid(kind: str, n: int) -> Column:
        some = F.when(text.rlike(GATES[kind]), found(text, PATTERNS[kind])).otherwise(F.array().cast(SPANS))
        return F.transform(
            F.filter(some, lambda x: VALID[kind](x["value"])),
            lambda x: F.struct(
                x["start"].alias("start"), F.lit(n).alias("n"), F.lit(kind).alias("kind"),
                x["end"].alias("end"), x["value"].alias("value"),
            ),
        )

    some = F.flatten(F.array(*[valid(kind, n) for n, kind in enumerate(kinds)]))
    # exploded from an array of one, so that no filter or projection above works it out again
    return df.withColumn("_spans", F.explode(F.array(F.sort_array(some))))


def kind_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def sanitise(
    docs: DataFrame, remove_at: float = 0.9, generalise_at: float = 0.7, min_contexts: int = 2,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """docs plus `_base`, `_spans` (arrays of struct<start, n, kind, end, value>) and `_clean` (the safe text).

    Kinds beside the base ones are `secret`, `term` (removed) and `general` (generalised to [TERM]).
    A term must share min_contexts distinct texts with an entity, wherever it stands in them:
    copies of one text are one context, so with min_contexts=2 an entity that one text alone mentions
    gives no term away (with 1, all terms that stand nowhere else would go with it). Terms are runs of
    letters and digits of any length. Spans that overlap a base span are left out.
    A null text counts as empty: no spans, clean text empty. Rows that repeat an id and text are as many
    documents in every count, and are treated alike. Other columns pass through, but for
    any named like the three new ones. An empty table gives no rows.

    One plan at every size: texts are read twice for their patterns and words, where they are, and
    sorted once, to meet what was found for them. The work on a text grows with its length; the terms
    of a document that mentions many entities are dealt over tasks.
    """
    docs, names = numbered(docs)
    text = F.col("_text")
    work = docs.withColumn("_text", F.coalesce(F.col(names[text_col]), F.lit("")))
    work = work.withColumn("_row", F.xxhash64(names[id_col], text))

    def terms_of(t: Column) -> Column:
        return F.array_distinct(F.regexp_extract_all(F.lower(t), F.lit(TERM), F.lit(0)))

    # documents that mention an entity, with all their words: what is counted over pairs needs no other text
    spans = base_spans(work.select("_row", "_text"), "_text", ENTITIES).where(F.size("_spans") > 0)
    spans = spans.select("_row", "_text", apart(F.col("_spans"), lambda x: x["kind"] != "secret").alias("spans"), F.col("_spans").alias("all"))
    words = F.transform(found(text, TERM), lambda x: F.struct(F.lower(x["value"]).alias("term"), x["start"].alias("start"), x["end"].alias("end")))
    told = spans.select(
        F.col("_row").alias("row"), F.xxhash64(text, F.length(text)).alias("content"), "spans", words.alias("words"),
        F.array_distinct(F.transform("all", lambda s: F.concat_ws(":", s["kind"], s["value"]))).alias("entities"),
    )
    # rows that repeat id and text are one here, with their number
    mentions = stored(told.groupBy("row", "content").agg(F.count("*").alias("copies"), *(F.first(c).alias(c) for c in ("spans", "words", "entities"))))
    stands = mentions.groupBy("content").agg(F.min("row").alias("stands"))
    # one row of each text stands for it: what its words prove is proved once
    salts = F.floor(F.size("words").cast("long") * F.size("entities") / PAIRS).cast("int") + 1
    once = mentions.select("row", "content", "copies", "entities", salts.alias("salts")).join(stands.hint("merge"), "content")
    holders = stored(
        once.withColumn("context", (F.col("row") == F.col("stands")).cast("long"))
        .select("row", "context", "copies", "salts", F.explode("entities").alias("entity"))
    )
    # an entity of fewer texts than a term needs can't be revealed by any
    n_e = holders.groupBy("entity").agg(F.sum("copies").alias("n_e"), F.sum("context").alias("contexts"))
    holders = stored(holders.join(n_e.where(F.col("contexts") >= min_contexts).drop("contexts").hint("merge"), "entity"))
    rows = stored(holders.select("row").distinct())
    near = mentions.select("row", salts.alias("salts"), F.explode(F.array_distinct(F.transform("words", lambda w: w["term"]))).alias("term"))
    near = near.join(rows.hint("merge"), "row", "left_semi")
    terms = stored(near.groupBy("term").agg(F.count("*").alias("n")).where(F.col("n") >= min_contexts).select("term"))
    total = F.lit(work.count())
    # counted before anything is dealt out: each task sends one row a term
    n_t = work.select(F.explode(terms_of(text)).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    n_t = n_t.join(terms.hint("merge"), "term")
    ic = F.round(F.log2(total / F.col("n_e")), 9)

    def pmi(both: Column) -> Column:
        return F.round(F.log2(both * total / (F.col("n_t") * F.col("n_e"))), 9)

    # even if every document of the rarer one held the other, common terms can't reveal anything
    able = (F.col("ic") > 0) & (pmi(F.least("n_e", "n_t")) >= F.round(F.col("ic") * generalise_at, 9))
    # what can't reveal the most frequent entity can't reveal any
    most = F.broadcast(holders.where(F.col("n_e") < total).agg(F.max("n_e").alias("n_e")).withColumn("ic", ic))
    n_t = stored(n_t.join(most).where(able).select("term", "n_t"))
    # the terms of a document meet its entities in as many tasks as their pairs ask for
    dealt = near.join(n_t.hint("merge"), "term").withColumn("salt", F.pmod(F.xxhash64("term"), F.col("salts")).cast("int")).drop("salts")
    spread = holders.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    scored = stored(
        dealt.join(spread.hint("merge"), ["row", "salt"]).withColumn("ic", ic).where(able)
        .groupBy("entity", "term", "n_t", "n_e", "ic").agg(F.sum("copies").alias("n_te"), F.sum("context").alias("contexts"))
        .where(F.col("contexts") >= min_contexts)
        .withColumn("pmi", pmi(F.col("n_te")))
        .where(F.col("pmi") >= F.round(F.col("ic") * generalise_at, 9))
        .select("entity", "term", (F.col("pmi") >= F.round(F.col("ic") * remove_at, 9)).alias("gone"))
    )
    hidden = stored(holders.join(scored.hint("merge"), "entity").groupBy("row", "term").agg(F.max("gone").alias("gone")))
    # where the hidden terms stand
    at = len(ENTITIES)
    places = (
        mentions.join(hidden.select("row").distinct().hint("merge"), "row", "left_semi")
        .select("row", F.explode("words").alias("w")).select("row", "w.term", "w.start", "w.end")
        .join(hidden.hint("merge"), ["row", "term"])
        .groupBy("row").agg(F.collect_list(F.struct("start", F.when(F.col("gone"), at).otherwise(at + 1).alias("n"), F.when(F.col("gone"), "term").otherwise("general").alias("kind"), "end", F.lit("").alias("value"))).alias("own"))
    )
    none = F.array().cast("array<struct<start:int,n:int,kind:string,end:int,value:string>>")
    every = F.sort_array(F.concat("spans", F.coalesce("own", none)))
    known = mentions.select("row", "spans").join(places.hint("merge"), "row", "left")
    known = stored(known.select(F.col("row").alias("_told"), F.col("spans").alias("_found"), apart(every, lambda x: x["n"] < at).alias("_hidden")))
    # joined by sorting at any size: a plan that turns at some size can't be foreseen from small runs
    out = work.join(known.hint("merge"), F.col("_row") == F.col("_told"), "left")
    out = out.withColumn("_base", F.filter(F.coalesce("_found", none), lambda x: x["kind"] != "secret"))
    out = out.withColumn("_spans", F.coalesce("_hidden", none))
    label = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "secret": "[SECRET]", "term": "[REMOVED]", "general": "[TERM]"}

    def labelled(x: Column) -> Column:
        out = F.lit("")
        for kind, word in label.items():
            out = F.when(x["kind"] == kind, word).otherwise(out)
        return out

    out = out.withColumn("_clean", replaced(text, F.col("_spans"), labelled))
    new = ("_base", "_spans", "_clean")
    return out.select(*[F.col(c).alias(n) for n, c in names.items() if n not in new], *new)
