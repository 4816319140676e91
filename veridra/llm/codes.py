"""Compression of vectors to codes: one index a part, with integer codebooks refined in rounds.

Components become whole numbers and vectors are cut into equal parts. A codebook for each part
position starts from given vectors; in a round every part goes to its nearest entry, and each
entry becomes the rounded-down mean of its parts. All distances are |x|^2 - 2 x.c + |c|^2 in
64-bit integers, so ties are true ties and go to the first entry. The codebooks are broadcast
(their size is set by parameters); tasks send one row an entry, which a grouped shuffle merges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ROWS_PER_SALT, stored
from .vectors import finite, matrix, most_common_size

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: Components up to this size: squared distances of a vector then fit 64 bits.
LARGEST = 2**24


def whole(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as 64-bit integers; an error where squares could pass 64 bits."""
    x = np.floor(x * scale)
    if x.size and not np.abs(x).max() < LARGEST * scale:
        raise OverflowError("a component is too large for exact distances")
    return x.astype(np.int64)


def assign(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(indexes, squared distances), both rows x parts, of the nearest entry of each part's codebook; the first on ties."""
    parts, _, width = books.shape
    at, far = np.empty((len(x), parts), np.int64), np.empty((len(x), parts), np.int64)
    for p in range(parts):
        mine, book = x[:, p * width : (p + 1) * width], books[p]
        rest = (book * book).sum(axis=1) - 2 * (mine @ book.T)
        at[:, p] = rest.argmin(axis=1)
        far[:, p] = rest[np.arange(len(x)), at[:, p]] + (mine * mine).sum(axis=1)
    return at, far


def refined(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after one round over all rows (vec)."""
    sent = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        parts, entries, width = books.shape
        sums, counts = np.zeros_like(books), np.zeros((parts, entries), np.int64)
        for batch in batches:
            x = whole(matrix(batch.column(0)))
            if len(x):
                at, _ = assign(x, books)
                for p in range(parts):
                    counts[p] += np.bincount(at[:, p], minlength=entries)
                    np.add.at(sums[p], at[:, p], x[:, p * width : (p + 1) * width])
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(counts[p, e]), pa.array(list(sums[p, e]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    partial = rows.select("vec").mapInArrow(run, "part long, entry long, n long, sums array<long>")
    width = books.shape[2]
    merged = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)))
    out = books.copy()
    # at most one row an entry
    for r in merged.collect():
        out[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    return out


def listed(books: np.ndarray) -> str:
    """All entries' components in decimal, by part, entry and position, joined by commas."""
    return ",".join(map(str, books.reshape(-1).tolist()))


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """(id_col, code, error, label_error) of every usable row, and the codebooks (parts x entries x width).

    Components become floor(256 x). code has two hex digits a part; error is the squared distance to
    the named entries, summed over parts; label_error sums it over all rows of the same label, null
    labels being one. Rows whose vector is null, empty or holds null or non-finite components are left out,
    so are those of another length than most rows have (the longer on ties). Codebooks start from the
    rows of smallest id (null ids last, ties by vector and label); fewer rows than entries give fewer entries.
    Rows that repeat an id count and come back as often. An empty table gives no rows. A length that
    parts do not divide, or a component of 2^24 or more, raises an error. Other columns are dropped.

    The table is read once a round and twice more. Sums by label are kept by (label, share of its
    rows) until they are joined back, so no label's rows meet in one task.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an index must fit two hex digits")
    spark = vectors.sparkSession
    rows = finite(vectors, id_col, vec_col, label_col)
    size, n = most_common_size(rows)
    if size % parts:
        raise ValueError(f"vectors of {size} components can't be cut into {parts} equal parts")
    rows = rows.where(F.size("vec") == size)
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vec", "a").limit(entries).select("vec").toArrow()
    start = whole(matrix(first.column(0))) if first.num_rows else np.zeros((0, parts), np.int64)
    books = np.ascontiguousarray(start.reshape(len(start), parts, -1).transpose(1, 0, 2)) if len(start) else np.zeros((parts, 0, 1), np.int64)
    for _ in range(rounds if n else 0):
        books = refined(rows, books)
    sent = spark.sparkContext.broadcast(books)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole(matrix(batch.column(1)))
            if len(x):
                at, far = assign(x, sent.value)
                digits = at.astype(np.uint8).tobytes().hex()
                width = 2 * at.shape[1]
                codes = [digits[i : i + width] for i in range(0, len(digits), width)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(codes), pa.array(far.sum(axis=1))], ["id", "a", "code", "error"])

    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("id", "a")]
    coded = rows.mapInArrow(code, f"{kinds[0]}, {kinds[1]}, code string, error long")
    coded = stored(coded.withColumn("salt", F.pmod(F.xxhash64("id", "code"), F.lit(n // ROWS_PER_SALT + 1))))
    shares = coded.groupBy("a", "salt").agg(F.sum("error").alias("share"))
    total = shares.select("a", "salt", F.sum("share").over(Window.partitionBy("a")).alias("label_error"))
    total = total.select(F.col("a").alias("b"), F.col("salt").alias("with"), "label_error")
    out = coded.join(total, F.col("a").eqNullSafe(F.col("b")) & (F.col("salt") == F.col("with")))
    return out.select(F.col("id").alias(id_col), "code", "error", "label_error"), books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(listed(books).encode()).hexdigest()
