"""Approximate nearest neighbours by additive quantisation.

A vector is approximated by a sum of codewords, one from each of several codebooks whose
codewords span all dimensions. Codebooks start as residual k-means and are refitted
together by least squares; encoding keeps a beam of partial sums, extended codebook by
codebook. With the codes of a vector its norm and its approximation's norm are stored.
A query builds a table of its products with all codewords; the score of a vector is the
sum of the entries its codes name, scaled by the ratio of the stored norms. The best of
each block are ranked again by exact products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .vectors import matrix, usable

BOOKS, WORDS, BEAM = 16, 256, 8
#: Vectors that codebooks are fitted on, at most about.
TRAIN_ROWS = 8192
#: Rows of a block of codes at most, queries of a block, candidates of a block ranked exactly for a query.
BLOCK, QUERY_BLOCK, RERANK = 65_536, 65_536, 200


def _nearest(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return ((words * words).sum(axis=1) - 2.0 * x @ words.T).argmin(axis=1)


def encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """Codes (n x books) by beam search: the `beam` best partial sums survive each codebook."""
    m, k, _ = books.shape
    out = np.empty((len(x), m), np.uint8 if k <= 256 else np.uint16)
    square = (books * books).sum(axis=2)
    for at in range(0, len(x), 256):
        part = x[at : at + 256]
        n = len(part)
        rest = part[:, None, :]
        codes = np.zeros((n, 1, 0), np.int64)
        for j in range(m):
            width = rest.shape[1]
            # squared length of what remains after each extension
            cost = (rest * rest).sum(axis=2)[:, :, None] - 2.0 * rest @ books[j].T + square[j]
            keep = min(beam, width * k) if j < m - 1 else 1
            flat = cost.reshape(n, width * k)
            best = np.argpartition(flat, keep - 1, axis=1)[:, :keep]
            parent, word = best // k, best % k
            each = np.arange(n)[:, None]
            rest = rest[each, parent] - books[j][word]
            codes = np.concatenate([codes[each, parent], word[:, :, None]], axis=2)
        out[at : at + n] = codes[:, 0]
    return out


def decode(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    return sum(books[j][codes[:, j]] for j in range(books.shape[0]))


def fit(x: np.ndarray, m: int = BOOKS, k: int = WORDS, rounds: int = 2, seed: int = 5) -> np.ndarray:
    """Codebooks (m x k x dimensions) fitted on the rows of x."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    books = np.zeros((m, k, x.shape[1]))
    rest = x.copy()
    for j in range(m):
        words = rest[rng.permutation(len(x))[:k]].copy()
        for _ in range(6):
            near = _nearest(rest, words)
            count = np.bincount(near, minlength=k)
            sums = np.stack([np.bincount(near, rest[:, d], k) for d in range(x.shape[1])], axis=1)
            words = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], words)
        books[j] = words
        rest = rest - words[_nearest(rest, words)]
    for _ in range(rounds):
        codes = encode(x, books, 4).astype(np.int64)
        # all codewords at once: least squares on the indicator matrix, slightly damped
        at = codes + np.arange(m) * k
        gram = np.zeros((m * k, m * k))
        for i in range(m):
            for j in range(m):
                np.add.at(gram, (at[:, i], at[:, j]), 1.0)
        right = np.zeros((m * k, x.shape[1]))
        for j in range(m):
            np.add.at(right, at[:, j], x)
        prior = books.reshape(m * k, -1)
        damp = 1.0
        gram[np.diag_indices(m * k)] += damp
        books = np.linalg.solve(gram, right + damp * prior).reshape(m, k, -1)
    return books


def _exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each by itself, so that equal rows get equal scores."""
    return (x.astype(float) * q).sum(axis=1)


def search(
    vectors: DataFrame, is_query: Column, top: int = 20, rerank: int = RERANK, train_rows: int = TRAIN_ROWS,
    books: int = BOOKS, words: int = WORDS, id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): the `top` nearest found of every query by inner product.

    Queries are the usable rows for which is_query holds, candidates all usable rows but
    those of the query's own id. Ties go to the smaller id. Fewer candidates than `top`:
    all of them. Vectors that are null, empty, zero or hold null or non-finite components
    take no part, nor do rows with a null id. Rows that repeat an id and vector count once;
    of rows that repeat an id with other vectors each takes part. All vectors must have one
    length. No usable row: no rows.

    Every row is coded; the sample for the codebooks, about train_rows rows by a hash of
    id, is the only bound. Each block of queries meets each block of codes in one task, which
    sends on only `top` rows a query. A coded row is sent once for every 65,536 queries, a
    query once for every block of codes; blocks are so large that all cores have two, up to a bound.
    """
    spark = vectors.sparkSession
    flagged = vectors.withColumn("_query", F.coalesce(is_query, F.lit(False)))
    rows = usable(flagged, id_col, vec_col)
    query_ids = flagged.where("_query").select(F.col(f"`{id_col}`").cast("long").alias("id")).distinct()
    rows = stored(rows.distinct())
    n = rows.count()
    share = min(1.0, train_rows / max(1, n))
    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(1_000_003)) < int(share * 1_000_003) + 1).orderBy("id").toArrow()
    model = fit(matrix(sample.column("vec")), books, words) if sample.num_rows else None
    sent = spark.sparkContext.broadcast(model)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("vec"))
                codes = encode(x, sent.value)
                near = np.linalg.norm(decode(codes, sent.value), axis=1)
                own = np.linalg.norm(x, axis=1)
                ratio = own / np.maximum(near, 1e-12)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("vec"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(ratio.astype(np.float32))],
                    ["id", "vec", "codes", "ratio"],
                )

    index = rows.mapInArrow(code, f"id long, vec {rows.schema['vec'].dataType.simpleString()}, codes binary, ratio float")
    blocks = max(n // BLOCK + 1, min(2 * spark.sparkContext.defaultParallelism, n // 1024 + 1))
    index = index.withColumn("block", F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)).cast("int"))
    queries = rows.join(query_ids, "id", "left_semi")
    groups = max(1, queries.count() // QUERY_BLOCK + 1)
    queries = queries.withColumn("qblock", F.pmod(F.xxhash64("vec", "id"), F.lit(groups)).cast("int"))
    left = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = index.withColumn("qblock", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    wide = np.uint8 if model is None or model.shape[1] <= 256 else np.uint16

    def meet(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(q) and len(c):
            qx, cx = np.stack(q["vec"].to_numpy()).astype(float), np.stack(c["vec"].to_numpy())
            qid, cid = q["id"].to_numpy(), c["id"].to_numpy()
            codes = np.frombuffer(b"".join(c["codes"]), wide).reshape(len(c), -1)
            ratio = c["ratio"].to_numpy().astype(np.float32)
            take = min(rerank + 1, len(c))
            for at in range(0, len(q), 64):
                # products of the queries with all codewords, by codebook
                table = np.einsum("mkd,qd->mkq", sent.value, qx[at : at + 64]).astype(np.float32)
                score = np.zeros((len(c), table.shape[2]), np.float32)
                for j in range(codes.shape[1]):
                    score += table[j][codes[:, j]]
                score *= ratio[:, None]
                best = np.argpartition(-score, take - 1, axis=0)[:take] if take < len(c) else np.tile(np.arange(len(c))[:, None], (1, score.shape[1]))
                for i in range(score.shape[1]):
                    rows_i = best[:, i][cid[best[:, i]] != qid[at + i]]
                    exact = _exact(cx[rows_i], qx[at + i])
                    order = np.lexsort((cid[rows_i], -exact))[:top]
                    out["query_id"].append(np.full(len(order), qid[at + i]))
                    out["vec_id"].append(cid[rows_i][order])
                    out["score"].append(exact[order])
        return pd.DataFrame({k: np.concatenate(v) if v else np.zeros(0, float if k == "score" else np.int64) for k, v in out.items()})

    met = left.groupBy("qblock", "block").cogroup(right.groupBy("qblock", "block")).applyInPandas(
        meet, "query_id long, vec_id long, score double"
    )
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    met = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return met.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
