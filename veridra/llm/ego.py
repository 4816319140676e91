"""Embedding near-dedup by an epsilon grid order join.

Unit vectors link when their cosine is at least a bound, that is when their distance is at
most eps. Vectors are sorted in the order of grid cells of side eps on the leading
principal dimensions; the sorted sequence is cut into blocks, and intervals of blocks are
joined recursively: a pair of intervals whose bounding boxes (on those dimensions) are
further apart than eps is skipped with all it holds. The pairs of blocks that remain are
joined by matrix products, and inside a task the same recursion goes on. Equal vectors are
folded first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, stored
from .vectors import matrix, usable

#: Leading principal dimensions: of the grid order, and of the bounding boxes.
ORDER_DIMS, BOX_DIMS = 6, 16
#: Inside a task intervals are split down to LEAF. A block holds vectors of this many bytes at most (as doubles).
LEAF, BLOCK_BYTES = 512, 32_000_000
#: Children of an interval at each level of the recursion over blocks.
FAN = 8
TRAIN_ROWS = 20_000


def _boxes_apart(a_lo, a_hi, b_lo, b_hi) -> np.ndarray:
    """Smallest distance of points in two boxes."""
    gap = np.maximum(0.0, np.maximum(b_lo - a_hi, a_lo - b_hi))
    return np.sqrt((gap * gap).sum(axis=-1))


def join_blocks(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, least: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) of unit rows of x and y with cosine >= least; i < j if both are one block."""
    eps = np.sqrt(max(0.0, 2.0 - 2.0 * least)) + 1e-9
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        if a >= b or c >= d or (same and d <= a + 1):
            continue
        if _boxes_apart(px[a:b].min(0), px[a:b].max(0), py[c:d].min(0), py[c:d].max(0)) > eps:
            continue
        if b - a <= LEAF and d - c <= LEAF:
            cos = x[a:b] @ y[c:d].T
            i, j = np.nonzero(cos >= least - 1e-9)
            # close calls are decided by a product that doesn't depend on the block's shape
            close = np.flatnonzero(np.abs(cos[i, j] - least) <= 1e-9)
            if len(close):
                keep = np.ones(len(i), bool)
                keep[close] = (x[a + i[close]] * y[c + j[close]]).sum(axis=1) >= least
                i, j = i[keep], j[keep]
            i, j = i + a, j + c
            if same:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield i, j
        elif b - a >= d - c:
            m = (a + b) // 2
            todo += [(a, m, c, d), (m, b, c, d)]
        else:
            m = (c + d) // 2
            todo += [(a, b, c, m), (a, b, m, d)]


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that keep what is connected by (i, j) connected: at most n - 1 of them."""
    from_, to = [], []
    label = np.arange(n)
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        if not len(i):
            break
        hi, lo = np.maximum(a, b), np.minimum(a, b)
        first = np.unique(hi, return_index=True)[1]
        from_.append(i[first])
        to.append(j[first])
        # each larger label takes the smaller one of its chosen link; then labels are followed to their roots
        jump = np.arange(n)
        jump[hi[first]] = lo[first]
        while True:
            next_ = jump[jump]
            if (next_ == jump).all():
                break
            jump = next_
        label = jump[label]
    empty = np.zeros(0, np.int64)
    return (np.concatenate(from_), np.concatenate(to)) if from_ else (empty, empty)


def block_rows(n: int, width: int, cores: int) -> int:
    """Vectors of a block: every vector meets all blocks in the worst case, so there are only so many that all cores have pairs to join."""
    return int(min(max(LEAF, n / (2 * np.sqrt(cores))), max(LEAF, BLOCK_BYTES // (8 * width))))


def near_duplicates(
    vectors: DataFrame, least: float = 0.9, block: int | None = None, id_col: str = "vec_id", vec_col: str = "embedding",
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """One row per id: id_col, n_links, component_id, kept.

    Links are pairs of different ids whose vectors have a cosine of at least `least` in
    double precision; none is left out. component_id is the smallest id reachable by links,
    kept marks it. Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing: no links, their own component. Rows that repeat an id and vector
    count once; an id with several vectors has the links of all of them (a pair of ids that
    is linked by several of them counts as often). Rows with a null id are left out. All
    vectors must have one length. Other columns are dropped. An empty table gives no rows. Principal
    axes come from about train_rows vectors: they decide what is skipped early, never what links.
    """
    spark = vectors.sparkSession
    ids = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id")).where(F.col("id").isNotNull()).distinct()
    rows = usable(vectors, id_col, vec_col).distinct()
    copies = stored(rows.withColumn("copy", F.unhex(F.sha2(F.array_join("vec", ",").cast("binary"), 256))))
    heads = copies.groupBy("copy").agg(F.min("id").alias("head"), F.count("*").alias("n"), F.first("vec").alias("vec"))
    heads = stored(heads)
    n = heads.count()
    share = min(1.0, train_rows / max(1, n))
    sample = heads.where(F.pmod(F.xxhash64("copy"), F.lit(1_000_003)) < int(share * 1_000_003) + 1).select("vec").toArrow()
    if sample.num_rows:
        s = matrix(sample.column("vec"))
        s = s / np.linalg.norm(s, axis=1, keepdims=True)
        axes = np.linalg.eigh(s.T @ s / len(s))[1][:, ::-1][:, :BOX_DIMS]
    else:
        axes = np.zeros((1, 1))
    eps = float(np.sqrt(max(0.0, 2.0 - 2.0 * least)))
    block = block or block_rows(n, axes.shape[0], spark.sparkContext.defaultParallelism)
    kind = np.float32 if heads.schema["vec"].dataType.simpleString() == "array<float>" else np.float64
    d = axes.shape[1]
    g = min(ORDER_DIMS, d)

    def units(raw: bytes, rows: int) -> np.ndarray:
        """Unit rows of packed vectors, in doubles."""
        x = np.frombuffer(raw, kind).reshape(rows, -1).astype(float)
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = matrix(batch.column("vec")).astype(kind)
                p = units(v.tobytes(), len(v)) @ axes[:, :g]
                cells = np.floor(p / max(eps, 1e-6)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("head"), batch.column("n"), pa.array([r.tobytes() for r in v], pa.binary()),
                     pa.array(list(cells), pa.list_(pa.int64())), pa.array(p[:, 0])],
                    ["head", "n", "v", "cells", "first"],
                )

    placed = heads.select("head", "n", "vec").mapInArrow(project, "head long, n long, v binary, cells array<long>, first double")
    # a total order (the id breaks ties), so that one crowded cell is cut like any other stretch
    order = [*[F.col("cells")[i] for i in range(g)], F.col("first"), F.col("head")]
    parts = max(1, min(spark.sparkContext.defaultParallelism, n // 1000 + 1), n // (4 * block))
    run_ = placed.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    run_ = stored(run_)
    counts = run_.groupBy("part").agg(F.count("*").alias("c"))
    firsts = counts.select("part", (F.sum("c").over(Window.orderBy("part")) - F.col("c")).alias("start"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    ranked = run_.withColumn("i", rank).join(F.broadcast(firsts), "part").withColumn("block", ((F.col("start") + F.col("i")) / block).cast("long"))

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["start", "i"])
        raw = b"".join(pdf["v"])
        p = units(raw, len(pdf)) @ axes
        return pd.DataFrame({
            "block": [pdf["block"].iloc[0]], "heads": [pdf["head"].to_numpy(np.int64).tobytes()], "n": [pdf["n"].to_numpy(np.int64).tobytes()],
            "v": [raw], "lo": [p.min(0).tolist()], "hi": [p.max(0).tolist()],
        })

    blocks = ranked.select("block", "start", "i", "head", "n", "v").groupBy("block").applyInPandas(
        gather, "block long, heads binary, n binary, v binary, lo array<double>, hi array<double>"
    )
    blocks = stored(blocks)
    n_blocks = -(-n // block)

    # the recursion over intervals of blocks: each level joins the boxes of its intervals to the pairs left
    def level(size: int) -> DataFrame:
        at = (F.col("block") / size).cast("long").alias("at")
        low = [F.min(F.col("lo")[i]).alias(f"l{i}") for i in range(d)]
        high = [F.max(F.col("hi")[i]).alias(f"h{i}") for i in range(d)]
        boxes = blocks.groupBy(at).agg(*low, *high)
        return boxes.select("at", F.array(*[f"l{i}" for i in range(d)]).alias("lo"), F.array(*[f"h{i}" for i in range(d)]).alias("hi"))

    sizes = [1]
    while sizes[-1] < n_blocks:
        sizes.append(sizes[-1] * FAN)
    pairs = spark.range(1).select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    for size in reversed(sizes[:-1]):
        child = F.sequence(F.lit(0), F.lit(FAN - 1))
        pairs = (
            pairs.withColumn("i", F.explode(child)).withColumn("j", F.explode(child))
            .select((F.col("a") * FAN + F.col("i")).alias("a"), (F.col("b") * FAN + F.col("j")).alias("b")).where("a <= b")
        )
        boxes = level(size)
        pairs = pairs.join(boxes.select(F.col("at").alias("a"), F.col("lo").alias("alo"), F.col("hi").alias("ahi")), "a")
        pairs = pairs.join(boxes.select(F.col("at").alias("b"), F.col("lo").alias("blo"), F.col("hi").alias("bhi")), "b")
        gap = F.aggregate(
            F.sequence(F.lit(0), F.lit(d - 1)), F.lit(0.0),
            lambda acc, i: acc + F.pow(F.greatest(F.lit(0.0), F.get("blo", i) - F.get("ahi", i), F.get("alo", i) - F.get("bhi", i)), 2),
        )
        pairs = pairs.where(gap <= (eps + 1e-9) ** 2).select("a", "b")
    # each block goes once to every pair it is in, packed as it came
    pairs = stored(pairs)
    sides = pairs.select("a", "b", F.col("a").alias("block"), F.lit(0).alias("side")).union(
        pairs.where("a < b").select("a", "b", F.col("b").alias("block"), F.lit(1).alias("side"))
    )
    work = blocks.select("block", "heads", "n", "v").join(sides, "block").drop("block")
    work = work.repartition(max(2 * spark.sparkContext.defaultParallelism, n_blocks), "a", "b")

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values("side").to_dict("records")
        same = len(rows) == 1
        packs = []
        for r in (rows[0], rows[-1]):
            ids, n = np.frombuffer(r["heads"], np.int64), np.frombuffer(r["n"], np.int64)
            x = units(r["v"], len(ids))
            packs.append((ids, n, x, x @ axes))
        (heads_a, n_a, x, px), (heads_b, n_b, y, py) = packs
        links_a, links_b = np.zeros(len(heads_a), np.int64), np.zeros(len(heads_b), np.int64)
        fi, fj = np.zeros(0, np.int64), np.zeros(0, np.int64)
        shift = 0 if same else len(heads_a)
        for i, j in join_blocks(x, y, px, py, least, same):
            links_a += np.bincount(i, n_b[j], len(heads_a)).astype(np.int64)
            links_b += np.bincount(j, n_a[i], len(heads_b)).astype(np.int64)
            fi, fj = _forest(np.concatenate([fi, i]), np.concatenate([fj, j + shift]), len(heads_a) + len(heads_b))
        every = np.concatenate([heads_a, heads_b])
        out = [pd.DataFrame({"a": every[fi], "b": every[fj], "n": 0})]
        for heads_, links_ in ((heads_a, links_a), (heads_b, links_b)):
            some = links_ > 0
            out.append(pd.DataFrame({"a": heads_[some], "b": -1, "n": links_[some]}))
        return pd.concat(out)

    found = stored(work.groupBy("a", "b").applyInPandas(join, "a long, b long, n long"))
    links = found.where("n > 0").groupBy(F.col("a").alias("head")).agg(F.sum("n").alias("links"))
    edges = found.where("n = 0").select("a", "b")
    part = components(edges).withColumnRenamed("node", "head")
    per_copy = (
        heads.select("copy", "head", "n").join(links, "head", "left").join(part, "head", "left")
        .select("copy", "head", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "head").alias("component"))
    )
    each = copies.select("id", "copy").join(per_copy, "copy").groupBy("id").agg(F.sum("links").alias("links"), F.min("component").alias("component"))
    out = ids.join(each, "id", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        (component == F.col("id")).alias("kept"),
    )
