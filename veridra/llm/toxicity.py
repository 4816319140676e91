"""Toxicity by a classifier chain over categories.

Words and word beginnings that go with a category are found by counting over all labelled
documents; the strongest of each category form a bounded vocabulary. A linear model for
each category, in order, sees which of them a document holds and the probabilities of the
categories before it. In training those probabilities are out-of-fold predictions, so a
later model learns from what it will be given.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .langid import _runs
from .linear import logistic, sigmoid
from .shingles import U, mix, prefixes, text_bytes, words

#: Features of each category, and training rows, at most.
VOCABULARY, TRAIN_ROWS, FOLDS = 1000, 6_000, 5
PREFIX = 5


def held(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of all distinct words and word beginnings of lower-case texts."""
    raw, starts = text_bytes(texts)
    doc, h, first, end = words(raw, starts)
    long, p = prefixes(raw, first, end, PREFIX)
    doc = np.concatenate([doc, doc[long]])
    h = np.concatenate([h, mix(p ^ U(0xA5A5A5A5))])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])] if len(doc) else np.zeros(0, bool)
    return doc[new], h[new]


def _counted(labelled: DataFrame, categories: list[str]) -> DataFrame:
    """(feature, n, n_<i>...): documents that hold a feature, in all and of each category."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [np.array(batch.column(1 + i).to_pylist(), float) for i in range(len(categories))]
            docs, feats, base = [], [], 0
            for at, n in _runs(batch.column(0)):
                d, h = held(batch.column(0).slice(at, n))
                docs.append(d + at)
                feats.append(h)
            if not docs:
                continue
            d, h = np.concatenate(docs), np.concatenate(feats)
            names, where = np.unique(h, return_inverse=True)
            cols = [pa.array(names.view(np.int64)), pa.array(np.bincount(where, minlength=len(names)))]
            cols += [pa.array(np.bincount(where, m[d], len(names)).astype(np.int64)) for m in marks]
            yield pa.RecordBatch.from_arrays(cols, ["feature", "n", *[f"n_{i}" for i in range(len(categories))]])

    schema = "feature long, n long" + "".join(f", n_{i} long" for i in range(len(categories)))
    parts = labelled.mapInArrow(run, schema)
    return parts.groupBy("feature").agg(F.sum("n").alias("n"), *[F.sum(f"n_{i}").alias(f"n_{i}") for i in range(len(categories))])


def _strength(i: int, total: int, own: int) -> Column:
    """Signed root of the chi-square statistic of a feature and a category."""
    a, n = F.col(f"n_{i}").cast("double"), F.col("n").cast("double")
    mean = n * own / total
    spread = mean * (1 - own / total) * F.greatest(1 - n / total, F.lit(1e-9))
    return (a - mean) / F.sqrt(F.greatest(spread, F.lit(1e-9)))


class Chain:
    """Models of the categories in order, over a sorted vocabulary."""

    def __init__(self, vocabulary: np.ndarray, rows: list[np.ndarray], marks: np.ndarray, folds: np.ndarray):
        self.vocabulary = vocabulary
        n, d, c = len(rows), len(vocabulary), marks.shape[1]
        row = np.repeat(np.arange(n), [len(r) for r in rows])
        col = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        extra = np.zeros((n, c))
        self.models, self.cuts = [], []
        for i in range(c):
            y = marks[:, i]
            r = np.concatenate([row, np.tile(np.arange(n), i)])
            k = np.concatenate([col, np.repeat(np.arange(d, d + i), n)]).astype(np.int64)
            v = np.concatenate([np.ones(len(row)), extra[:, :i].T.reshape(-1)])
            unseen = np.zeros(n)
            for f in range(FOLDS):
                out = folds == f
                if not out.any():
                    continue
                use = ~out[r]
                w, b = self._fit(r[use], k[use], v[use], y, ~out, d + i)
                unseen += out * sigmoid(np.bincount(r, w[k] * v, n) + b)
            extra[:, i] = unseen
            self.models.append(self._fit(r, k, v, y, np.ones(n, bool), d + i))
            self.cuts.append(self._cut(unseen, y))

    @staticmethod
    def _fit(r: np.ndarray, k: np.ndarray, v: np.ndarray, y: np.ndarray, use: np.ndarray, d: int) -> tuple[np.ndarray, float]:
        number = np.cumsum(use) - 1
        return logistic(number[r], k, v, y[use], d) if use.any() else (np.zeros(d), 0.0)

    @staticmethod
    def _cut(p: np.ndarray, y: np.ndarray) -> float:
        """The threshold with the best F1 on out-of-fold predictions."""
        order = np.argsort(-p, kind="stable")
        hits = np.cumsum(y[order])
        f1 = 2 * hits / (np.arange(1, len(p) + 1) + max(1.0, y.sum()))
        f1[:-1][p[order][1:] == p[order][:-1]] = 0
        best = int(f1.argmax())
        below = p[order][best + 1] if best + 1 < len(p) else 0.0
        return float((p[order][best] + below) / 2)

    def vector(self, doc: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.vocabulary, feature), max(0, len(self.vocabulary) - 1))
        known = self.vocabulary[at] == feature if len(self.vocabulary) else np.zeros(len(feature), bool)
        return doc[known], at[known]

    def predict(self, doc: np.ndarray, col: np.ndarray, n: int) -> np.ndarray:
        d = len(self.vocabulary)
        p = np.zeros((n, len(self.models)))
        for i, (w, b) in enumerate(self.models):
            p[:, i] = sigmoid(np.bincount(doc, w[col], n) + p[:, :i] @ w[d:] + b)
        return p


#: Bits of the filter of labelled ids at most, 8 MB in all.
FILTER_BITS = 2**26


def _bits(ids: DataFrame, n: int) -> tuple[DataFrame, int]:
    """A filter of ids: words of 64 bits (word, mask), one bit an id, eight for each of n ids up to a bound."""
    size = 64
    while size < min(8 * n, FILTER_BITS):
        size *= 2
    at = F.pmod(F.xxhash64("id"), F.lit(size))
    bits = ids.select(F.floor(at / 64).cast("int").alias("word"), F.expr("shiftleft(1L, cast(pmod(xxhash64(id), 64L) as int))").alias("bit"))
    return stored(bits.groupBy("word").agg(F.bit_or("bit").alias("mask"))), size


def _among(df: DataFrame, ident: str, bits: DataFrame, size: int) -> DataFrame:
    """Rows whose id may be in the filter; none of those that are is lost. The filter is sent to the rows."""
    word = F.floor(F.pmod(F.xxhash64(ident), F.lit(size)) / 64).cast("int")
    one = F.expr(f"shiftleft(1L, cast(pmod(xxhash64({ident}), 64L) as int))")
    held = df.withColumn("_word", word).join(F.broadcast(bits), F.col("_word") == F.col("word"))
    return held.where(F.col("mask").bitwiseAND(one) != 0).select(*df.columns)


def classify(
    docs: DataFrame, labels: DataFrame, categories: dict[str, Column], vocabulary: int = VOCABULARY,
    train_rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
) -> DataFrame:
    """One row per document: id_col and, for each category, p_<category> and is_<category>.

    categories maps names, in chain order, to boolean columns of labels; rows of labels
    where one of them is null, or whose id is null, teach nothing. Counts cover all
    labelled documents; the models see about train_rows of them, chosen by a hash of the
    id. A null text counts as empty and gets the models' base rates. Without labels all
    probabilities are 0. Repeated rows give repeated rows (several label rows of one
    document all count). Other columns are dropped, whatever their names.
    """
    spark = docs.sparkSession
    names = list(categories)
    marks = labels.select(F.col(f"`{label_id}`").alias("_lid"), *[c.cast("int").alias(f"_c{i}") for i, c in enumerate(categories.values())]).dropna()
    marks = stored(marks)
    known_ids = _bits(marks.select(F.col("_lid").cast(docs.schema[id_col].dataType).alias("id")), marks.count())
    # joined by sorting at every size: labels grow with the documents
    marks = marks.hint("merge")
    text = F.lower(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    labelled = _among(docs.select(F.col(f"`{id_col}`").alias("_id"), text.alias("text")), "_id", *known_ids).join(marks, F.col("_id") == F.col("_lid"))
    flags = [f"_c{i}" for i in range(len(names))]
    totals = marks.join(docs.select(F.col(f"`{id_col}`").alias("_id")), F.col("_id") == F.col("_lid")).agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in flags]).first()
    chain = None
    if totals["n"]:
        counts = stored(_counted(labelled.select("text", *flags), names).where(F.col("n") >= 3))
        chosen: set[int] = set()
        for i, c in enumerate(flags):
            s = _strength(i, totals["n"], totals[c] or 0)
            top = counts.select("feature", s.alias("s")).orderBy(F.abs("s").desc(), "feature").limit(vocabulary)
            chosen |= {r["feature"] for r in top.collect()}
        chain_words = np.sort(np.array(sorted(chosen), np.int64).view(U))
        share = min(1.0, train_rows / totals["n"])
        sample = labelled.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_003)) < int(share * 1_000_003) + 1)  # taken before the join
        rows = sample.select("text", *flags, F.pmod(F.xxhash64("_id", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold"), F.xxhash64("_id").alias("o"))

        def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Chain.__new__(Chain)
            known.vocabulary = chain_words
            for batch in batches:
                for at, n in _runs(batch.column(0)):
                    d, k = known.vector(*held(batch.column(0).slice(at, n)))
                    cut = np.searchsorted(d, np.arange(n + 1))
                    packed = [k[cut[i] : cut[i + 1]].astype("<i4").tobytes() for i in range(n)]
                    part = batch.slice(at, n)
                    yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), *part.columns[1:]], ["at", *batch.schema.names[1:]])

        schema = "at binary, " + ", ".join(f"{c} int" for c in flags) + ", fold int, o long"
        got = sorted(rows.mapInArrow(vectors, schema).collect(), key=lambda r: (r["o"], bytes(r["at"])))
        if got:
            chain = Chain(
                chain_words, [np.frombuffer(r["at"], "<i4").astype(np.int64) for r in got],
                np.array([[r[c] for c in flags] for r in got], float), np.array([r["fold"] for r in got]),
            )
    sent = spark.sparkContext.broadcast(chain)
    todo = docs.select(F.col(f"`{id_col}`").alias("_id"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            for at, n in _runs(batch.column(1)):
                if m is None:
                    p, cuts = np.zeros((n, len(names))), [1.0] * len(names)
                else:
                    p, cuts = m.predict(*m.vector(*held(batch.column(1).slice(at, n))), n), m.cuts
                cols = [batch.column(0).slice(at, n)]
                for i in range(len(names)):
                    cols += [pa.array(p[:, i]), pa.array(p[:, i] >= cuts[i])]
                yield pa.RecordBatch.from_arrays(cols, ["_id", *[f"{x}_{c}" for c in names for x in ("p", "is")]])

    kind = todo.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}" + "".join(f", p_{c} double, is_{c} boolean" for c in names)
    return todo.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
