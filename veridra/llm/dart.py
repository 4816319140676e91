"""Near-duplicate documents by DartMinHash over weighted shingles.

A document is a weighted set: its runs of five words, weighted by how often they occur.
Darts are thrown at each element's region (weight x rank) by hashing alone, so that equal
regions of two documents get equal darts. A dart lands under a document's weight or not;
of those that do, each of k coordinates keeps the earliest. Two signatures agree in a
coordinate with probability equal to the weighted Jaccard similarity. The number of darts
a document needs depends on k, not on its length: throwing stops at a rank that falls with
the total weight.

Bands of coordinates propose candidates among distinct texts: texts that share a bucket. First
each text is compared with leaders of its buckets, which merges most of what is alike into
classes. Then every pair of a bucket that is still in two classes is compared, unless a bound that
loses nothing rules it out: a text shares with no other what it alone holds, and of the rest no more
than both hold of each group of shingles. All candidates are verified by the exact weighted Jaccard;
classes are the components of the verified links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, stored
from .shingles import U, mix, shingles, text_bytes, words

K, ROWS = 150, 5
#: Of the lowest bits of K coordinates, this many may differ: at similarity 0.8 a tenth do,
#: and more than this in fewer than one pair of ten million (the bands miss one of 150,000).
BITS_APART = 38
#: Times that texts are compared with a leader of each bucket before all pairs are.
LEADERS = 2
#: Groups, by hash, that a text's shingles are counted in: what two texts share is no more than they share of each.
BINS = 32
#: Texts of a bucket that are compared with the others in one task.
DEALT = 2_000
#: A table with a row a text is written by 8 tasks a core, or by more of this many rows each.
TASK_ROWS = 2_000


def weighted(doc: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, item) pairs with their counts, by document and item."""
    order = np.lexsort((item, doc))
    doc, item = doc[order], item[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])] if len(doc) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return doc[at], item[at], np.diff(np.r_[at, len(doc)]).astype(float)


def _unit(h: np.ndarray) -> np.ndarray:
    """A number in (0, 1) from each hash."""
    return ((h >> U(11)).astype(float) + 0.5) / 2.0**53


def signatures(doc: np.ndarray, item: np.ndarray, weight: np.ndarray, n_docs: int, k: int = K) -> np.ndarray:
    """n_docs x k ranks of the earliest darts; a document without items has infinite ranks.

    doc ascends. Weight slabs are [0,1), [1,2), [2,4), [4,8), ...: within one, darts arrive
    along the rank axis at a rate of the slab's width, and each has a weight; darts above
    the element's weight miss.
    """
    out = np.full((n_docs, k), np.inf)
    total = np.bincount(doc, weight, n_docs) if len(doc) else np.zeros(n_docs)
    open_docs = total > 0
    darts = k * (np.log(k) + 4.0)
    while open_docs.any():
        take = open_docs[doc]
        d, x, w = doc[take], item[take], weight[take]
        limit = darts / np.maximum(total, 1e-300)
        slab = 0
        low, high = 0.0, 1.0
        while len(d):
            seed = mix(x ^ mix(np.full(1, 0x5851F42D4C957F2D + slab, U)))
            who, h, wt, rank = d, seed, w, np.zeros(len(d))
            while len(who):
                h = mix(h + U(0x9E3779B97F4A7C15))
                rank = rank - np.log(_unit(h)) / (high - low)
                alive = rank < limit[who]
                who, h, wt, rank = who[alive], h[alive], wt[alive], rank[alive]
                g = mix(h ^ U(0xD6E8FEB86659FD93))
                hit = (low + _unit(g) * (high - low) < wt) if slab else (_unit(g) < wt)
                at = who[hit] * k + (mix(g[hit]) % U(k)).astype(np.int64)
                np.minimum.at(out.reshape(-1), at, rank[hit])
            more = w > high
            d, x, w = d[more], x[more], w[more]
            low, high, slab = high, high * 2, slab + 1
        open_docs = open_docs & np.isinf(out).any(axis=1)
        darts *= 2
    return out


def _signed(docs: DataFrame, width: int, k: int, rows: int) -> DataFrame:
    """(id, node, bands array<long>, bits array<long>, size: number of shingles) of documents (id, text, node); no bands without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            lengths = np.diff(text_bytes(batch.column(1))[1])
            step = np.cumsum(lengths) // 1_000_000
            for part in np.split(np.arange(n), np.flatnonzero(np.diff(step)) + 1) if n else []:
                texts = batch.column(1).slice(part[0], len(part))
                raw, starts = text_bytes(texts)
                doc, run_hash = shingles(*words(raw, starts)[:2], width)
                sig = signatures(*weighted(doc, run_hash), len(part), k)
                size = np.bincount(doc, minlength=len(part))
                some = np.isfinite(sig[:, 0])
                bits = mix(np.ascontiguousarray(sig).view(U))
                bands = np.zeros((len(part), k // rows), U)
                for b in range(k // rows):
                    h = np.full(len(part), b + 1, U)
                    for c in range(rows):
                        h = mix(h ^ bits[:, b * rows + c])
                    bands[:, b] = h
                low = np.zeros((len(part), -(-k // 63)), np.int64)
                for c in range(k):
                    low[:, c // 63] |= (bits[:, c] & U(1)).astype(np.int64) << (c % 63)
                none = pa.array(~some)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part[0], len(part)), batch.column(2).slice(part[0], len(part)),
                        pc.if_else(none, pa.scalar(None, pa.list_(pa.int64())), pa.array(list(bands.view(np.int64)), pa.list_(pa.int64()))),
                        pa.array(list(low), pa.list_(pa.int64())), pa.array(size),
                    ],
                    ["id", "node", "bands", "bits", "size"],
                )

    return docs.mapInArrow(run, "id long, node long, bands array<long>, bits array<long>, size long")


def _shingled(docs: DataFrame, width: int) -> DataFrame:
    """(node, items binary, counts binary, bins) of (node, text): the sorted distinct shingles of a text, and how many are in each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, counts, bins = [], [], []
            for i in range(batch.num_rows):
                raw, starts = text_bytes(batch.column(1).slice(i, 1))
                _, item, weight = weighted(*shingles(*words(raw, starts)[:2], width))
                items.append(item.tobytes())
                counts.append(weight.astype("<u4").tobytes() if (weight > 1).any() else b"")
                bins.append(np.bincount((item % U(BINS)).astype(np.int64), weight, BINS).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(items, pa.binary()), pa.array(counts, pa.binary()), pa.array(bins, pa.list_(pa.int64()))],
                ["node", "items", "counts", "bins"],
            )

    return docs.mapInArrow(run, "node long, items binary, counts binary, bins array<long>")


def jaccard(items_a: bytes, counts_a: bytes, items_b: bytes, counts_b: bytes) -> float:
    """Weighted Jaccard of two documents as packed by _shingled."""
    a, b = np.frombuffer(items_a, U), np.frombuffer(items_b, U)
    wa = np.frombuffer(counts_a, "<u4").astype(float) if counts_a else np.ones(len(a))
    wb = np.frombuffer(counts_b, "<u4").astype(float) if counts_b else np.ones(len(b))
    if not len(a) or not len(b):
        return 0.0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    same = b[at] == a
    shared = np.minimum(wa[same], wb[at[same]]).sum()
    return float(shared / (wa.sum() + wb.sum() - shared))


def _verified(pairs: DataFrame, packed: DataFrame, least: float) -> DataFrame:
    """Rows of pairs (a, b, ...) whose exact similarity is at least `least`; a may be in any number of pairs."""

    @F.pandas_udf("double")
    def similar(ia: pd.Series, ca: pd.Series, ib: pd.Series, cb: pd.Series) -> pd.Series:
        return pd.Series([jaccard(*x) for x in zip(ia, ca, ib, cb, strict=True)], dtype=float)

    left = packed.select(F.col("node").alias("a"), F.col("items").alias("ia"), F.col("counts").alias("ca"))
    right = packed.select(F.col("node").alias("b"), F.col("items").alias("ib"), F.col("counts").alias("cb"))
    # by sorting at any size; no grouping follows in these stages, so that Spark can split what a hot text brings
    both = pairs.join(right.hint("merge"), "b").join(left.hint("merge"), "a")
    return stored(both.where(similar("ia", "ca", "ib", "cb") >= least).select(*pairs.columns))


def _close(x: Column, y: Column, least: float) -> Column:
    """Few enough low bits of two signatures differ, and the sizes allow the similarity."""
    apart = sum((F.bit_count(x["bits"][i].bitwiseXOR(y["bits"][i])) for i in range(-(-K // 63))), F.lit(0))
    return (F.least(x["size"], y["size"]) >= least * F.greatest(x["size"], y["size"])) & (apart <= BITS_APART)


def _led(members: DataFrame, order: Column, least: float) -> DataFrame:
    """(a, b, pa, pb, order): members (key, node, part, size, bits, ...) with the last of their bucket by order, if they are in two classes."""
    whole = F.struct("node", "part", "size", "bits", order.alias("order"))
    leads = members.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.max_by(whole, order).alias("lead"))
    leads = stored(leads.where("lo < hi").select("key", "lead"))
    lead = F.col("lead")
    found = members.join(leads.hint("merge"), "key").where((F.col("part") != lead["part"]) & _close(F.struct("size", "bits"), lead, least))
    return found.select(lead["node"].alias("a"), F.col("node").alias("b"), lead["part"].alias("pa"), F.col("part").alias("pb"), lead["order"].alias("order"))


def _own_weight(packed: DataFrame) -> DataFrame:
    """(node, own): the weight, by group, of the shingles that no other text of packed holds; texts without any are not in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, items, counts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                item = np.frombuffer(items, np.int64)
                weight = np.frombuffer(counts, "<u4").astype(np.int64) if counts else np.ones(len(item), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(item), node)), pa.array(item), pa.array(weight)], ["node", "item", "weight"])

    items = packed.select("node", "items", "counts").mapInArrow(run, "node long, item long, weight long")
    alone = items.groupBy("item").agg(F.count("*").alias("n"), F.min("node").alias("node"), F.sum("weight").alias("weight")).where("n = 1")
    group = F.pmod("item", F.lit(BINS))  # 2^64 is a multiple of BINS
    return alone.groupBy("node").agg(F.array(*[F.sum(F.when(group == i, F.col("weight")).otherwise(0)) for i in range(BINS)]).alias("own"))


def _across(members: DataFrame, least: float) -> DataFrame:
    """Every pair (a, b, pa, pb) of members (key, node, part, size, bits, able, bins) that shares a bucket, is in two
    classes and may be alike; able is the most weight a text can share with any other, bins that of each group.

    The largest class of a bucket meets the others, and they meet each other; its own pairs are never formed.
    The members of a bucket are dealt over tasks, to each of which the others are sent.
    """
    # what two texts of that similarity share is that part of the larger one at least
    members = stored(members.where(F.col("able") >= least * F.col("size")))
    parts = members.groupBy("key", "part").agg(F.count("*").alias("n"))
    buckets = parts.groupBy("key").agg(F.max_by("part", F.struct("n", "part")).alias("large"), F.sum("n").alias("all"), F.count("*").alias("parts"))
    buckets = stored(buckets.where("parts > 1").select("key", "large", (F.floor(F.col("all") / DEALT) + 1).alias("salts")))
    inside = stored(members.join(buckets.hint("merge"), "key"))
    whole = F.struct("node", "part", "size", "bits", "able", "bins")
    left = inside.select("key", F.pmod(F.xxhash64("node"), F.col("salts")).alias("salt"), whole.alias("x"), (F.col("part") == F.col("large")).alias("main"))
    right = inside.where("part <> large").select("key", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), whole.alias("y"))
    x, y = F.col("x"), F.col("y")
    # one of two ways round; similarity s asks for a share of s / (1 + s) of both sizes together
    once = (x["part"] != y["part"]) & (F.col("main") | (x["node"] < y["node"]))
    needed = (least / (1 + least)) * (x["size"] + y["size"]) - 1e-6
    shared = F.aggregate(F.zip_with(x["bins"], y["bins"], lambda a, b: F.least(a, b)), F.lit(0).cast("long"), lambda a, b: a + b)
    pairs = left.join(right.hint("merge"), ["key", "salt"]).where(once & (F.least(x["able"], y["able"]) >= needed) & _close(x, y, least) & (shared >= needed))
    pairs = pairs.select(x["node"].alias("a"), y["node"].alias("b"), x["part"].alias("pa"), y["part"].alias("pb"))
    # a pair of several buckets may come either way round
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.least("pa", "pb").alias("pa"), F.greatest("pa", "pb").alias("pb")).distinct()


def _roots(links: DataFrame) -> DataFrame:
    """(node, part) of stored links (a, b) in which every b has one a, and no circle: the topmost a, by jumping over known ones."""
    jumps = links.select(F.col("b").alias("node"), F.col("a").alias("part"))
    while True:
        ahead = jumps.select(F.col("node").alias("part"), F.col("part").alias("top"))
        further = stored(jumps.join(ahead.hint("merge"), "part", "left").select("node", F.coalesce("top", "part").alias("part"), F.col("top").isNotNull().alias("moved")))
        if not further.where("moved").head(1):
            return further.drop("moved")
        jumps = further.drop("moved")


def _merged(part: DataFrame, links: DataFrame) -> DataFrame:
    """part (node, part) after verified links between parts (pa, pb)."""
    if not links.head(1):
        return part
    wider = components(links, "pa", "pb").select(F.col("node").alias("part"), "component")
    return stored(part.join(wider.hint("merge"), "part", "left").select("node", F.coalesce("component", "part").alias("part")))


def _by_text(df: DataFrame, texts: int) -> DataFrame:
    """df, a row or so for each of so many texts, stored by no more tasks than they are worth: each costs a file. Its keys must repeat seldom."""
    most = max(8 * df.sparkSession.sparkContext.defaultParallelism, texts // TASK_ROWS)
    return stored(df.coalesce(most))


def near_duplicates(
    docs: DataFrame, least: float = 0.8, width: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id_col, class_id, n_copies (ids with its text, itself included), kept.

    Words are runs of letters, digits and underscores of the lower-case text. A text of
    fewer than `width` words is one shingle. class_id is the smallest id of the component
    under links of weighted Jaccard >= least; kept is true for that document. Documents
    without words (null, empty, punctuation) link with nothing: each is its own class.
    Rows that repeat an id and text are one document; an id with several texts has the links
    of all of them. A null id is left out (it can't be named in a
    result). An empty table gives no rows. Other columns are dropped.

    Distinct texts are told apart by a 64-bit hash. Texts meet if one of 30 bands
    of 5 coordinates is the same, which a pair of similarity 0.8 misses once in 150,000.
    """
    base = docs.where(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.lower(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("text")
    ).withColumn("node", F.xxhash64("text"))
    every = stored(_signed(base, width, K, ROWS))
    worded = F.col("bands").isNotNull()
    texts = every.count()
    copies = _by_text(every.groupBy("id", "node").agg(F.max(worded).alias("worded")), texts)
    signed = _by_text(every.where(worded).groupBy("node").agg(*(F.first(c).alias(c) for c in ("bands", "bits", "size"))), texts)
    buckets = signed.select("node", F.explode("bands").alias("key"))
    filled = stored(buckets.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1))
    buckets = stored(buckets.join(filled.hint("merge"), "key"))
    # the member that shares the most is likely the text that the others are copies of
    weight = buckets.groupBy("node").agg(F.sum("n").alias("weight"))
    member = _by_text(signed.drop("bands").join(weight.hint("merge"), "node"), texts)
    # the shingles of all texts that share a bucket, made once
    needed = copies.groupBy("node").agg(F.min("id").alias("id")).join(member.select("node").hint("merge"), "node", "left_semi")
    first = base.join(needed.hint("merge"), ["id", "node"], "left_semi").dropDuplicates(["node"])
    packed = _by_text(_shingled(first.select("node", "text"), width), texts)

    rows = buckets.select("node", "key")
    part = member.select("node", F.col("node").alias("part"))
    for turn in range(LEADERS):
        members = rows.join(member.join(part.hint("merge"), "node").hint("merge"), "node")
        if turn == 0:
            found = _led(members, F.struct("weight", F.bitwise_not("node")), least)
            # one candidate a text first: most of the others are then of one class
            first = found.groupBy("b").agg(F.max_by("a", "order").alias("a"))
            top = _roots(_verified(first.select("a", "b"), packed, least))
            part = _by_text(part.select("node").join(top.hint("merge"), "node", "left").select("node", F.coalesce("part", "node").alias("part")), texts)
        else:
            found = _led(members, F.struct(F.xxhash64("node", F.lit(turn)), "node"), least).select("a", "b", "pa", "pb").distinct()
            part = _merged(part, _verified(found, packed, least).select("pa", "pb"))
    # what is left: every pair of two classes that shares a bucket, but for what can't be alike
    members = stored(rows.join(part.hint("merge"), "node"))
    open_keys = stored(members.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("key"))
    members = stored(members.join(open_keys.hint("merge"), "key", "left_semi"))
    nodes = _by_text(members.select("node").distinct(), texts)
    own = _own_weight(packed.join(nodes.hint("merge"), "node", "left_semi"))
    facts = nodes.join(member.hint("merge"), "node").join(packed.select("node", "bins").hint("merge"), "node").join(own.hint("merge"), "node", "left")
    rest = F.when(F.col("own").isNull(), F.col("bins")).otherwise(F.zip_with("bins", "own", lambda a, b: a - b))
    able = F.aggregate(rest, F.lit(0).cast("long"), lambda a, b: a + b)
    facts = facts.select("node", "size", "bits", able.alias("able"), rest.alias("bins"))
    rest = _across(members.join(facts.hint("merge"), "node"), least)
    part = _merged(part, _verified(rest, packed, least).select("pa", "pb"))
    # the texts of one id are one class; texts without words are alike in nothing
    own = copies.where("worded").select("id", "node").join(part.hint("merge"), "node", "left")
    own = stored(own.select("id", "node", F.coalesce("part", "node").alias("part")))
    lowest = stored(own.groupBy("id").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a <> b"))
    if lowest.head(1):
        across = own.join(lowest.select("id", "a").hint("merge"), "id").where("part <> a").select("a", F.col("part").alias("b"))
        wider = stored(components(across).select(F.col("node").alias("part"), "component"))
        own = stored(own.join(wider.hint("merge"), "part", "left").select("id", "node", F.coalesce("component", "part").alias("part")))
    class_id = _by_text(own.groupBy("part").agg(F.min("id").alias("class_id")), texts)
    same = _by_text(own.groupBy("node").agg(F.count("*").alias("n_copies")), texts)
    named = stored(own.join(class_id.hint("merge"), "part").join(same.hint("merge"), "node").select("id", "class_id", "n_copies"))
    named = named.groupBy("id").agg(F.min("class_id").alias("class_id"), F.max("n_copies").alias("n_copies"))
    out = copies.select("id").distinct().join(named.hint("merge"), "id", "left")
    class_id = F.coalesce("class_id", "id")
    return out.select(
        F.col("id").alias(id_col), class_id.alias("class_id"), F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        (class_id == F.col("id")).alias("kept"),
    )
