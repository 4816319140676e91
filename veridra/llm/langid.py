"""Language identification in two steps: the family, then the language within it.

A text is a vector of hashed byte n-grams (one to three bytes, lower case, everything but
letters read as a space). One-versus-rest linear SVMs choose the family; one-versus-one
linear SVMs between the languages of that family then vote.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .linear import sigmoid, svm
from .shingles import U, mix, text_bytes

#: Language families; a language that isn't listed is a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic", "bg": "slavic",
}
DIM = 4096
#: Bytes that are looked at together.
WINDOW = 1_000_000
#: Training rows of each language, about: a row is taken if a hash of its id falls under a share.
ROWS_PER_LANGUAGE = 600
#: Languages that are learnt at most, the most frequent first: a column of free text can't swamp the driver.
LANGUAGES = 200

_LETTER = np.full(256, 32, np.uint8)
for _b in [*range(97, 123), *range(128, 256)]:
    _LETTER[_b] = _b


def features(texts: pa.Array) -> np.ndarray:
    """Length-1 rows of n-gram weights (square roots of counts) of lower-case texts."""
    raw, starts = text_bytes(texts)
    n = len(texts)
    out = np.zeros(n * DIM)
    # a window at a time, so that a very long text takes no more memory than its bytes
    for a in range(0, len(raw), WINDOW):
        part = np.concatenate([_LETTER[raw[a : a + WINDOW + 2]], np.full(2, 32, np.uint8)]).astype(U)
        m = min(WINDOW, len(raw) - a)
        doc = np.repeat(np.arange(n), np.diff(np.clip(starts, a, a + m)))
        left = starts[doc + 1] - np.arange(a, a + m)
        gram = np.zeros(m, U)
        for size in range(3):
            gram = gram * U(256) + part[size : size + m]
            use = (left > size) & (gram != sum(32 << (8 * i) for i in range(size + 1)))
            at = doc[use] * DIM + (mix(gram[use] + U(size + 1 << 40)) % U(DIM)).astype(np.int64)
            out += np.bincount(at, minlength=n * DIM)
    out = np.sqrt(out.reshape(n, DIM))
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def _runs(texts: pa.Array, size: int = 500_000, rows: int = 150) -> Iterator[tuple[int, int]]:
    """(first, count) of slices of bounded size."""
    lengths = np.diff(text_bytes(texts)[1])
    at = total = 0
    for i, n in enumerate(lengths):
        total += int(n)
        if total >= size or i + 1 - at >= rows:
            yield at, i + 1 - at
            at, total = i + 1, 0
    if at < len(lengths):
        yield at, len(lengths) - at


class Model:
    """Families, their languages, and the weights of every separator, stacked."""

    def __init__(self, x: np.ndarray, lang: np.ndarray, families: dict[str, str]):
        self.languages = sorted(set(lang))
        of = {v: families.get(v, v) for v in self.languages}
        self.families = sorted(set(of.values()))
        family = np.array([of[v] for v in lang])
        rest = [svm(x, np.where(family == f, 1, -1)) for f in self.families] if len(self.families) > 1 else []
        self.pairs = [(a, b) for a, b in combinations(self.languages, 2) if of[a] == of[b]]
        duels = []
        for a, b in self.pairs:
            own = (lang == a) | (lang == b)
            duels.append(svm(x[own], np.where(lang[own] == a, 1, -1)))
        every = [*rest, *duels]
        self.n_rest = len(rest)
        self.w = np.stack([w for w, _ in every], axis=1) if every else np.zeros((x.shape[1], 0))
        self.b = np.array([b for _, b in every])
        self.of = of

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        z = x @ self.w + self.b
        if self.n_rest:
            p = sigmoid(3 * z[:, : self.n_rest])
            p /= p.sum(axis=1, keepdims=True)
        else:
            p = np.ones((len(x), 1))
        best = p.argmax(axis=1)
        at = {v: i for i, v in enumerate(self.languages)}
        won = np.zeros((len(x), len(at)))
        fought = np.zeros(len(at))
        votes = np.zeros((len(x), len(at)))
        for k, (a, b) in enumerate(self.pairs):
            q = sigmoid(3 * z[:, self.n_rest + k])
            won[:, at[a]] += q
            won[:, at[b]] += 1 - q
            votes[:, at[a]] += q >= 0.5
            votes[:, at[b]] += q < 0.5
            fought[at[a]] += 1
            fought[at[b]] += 1
        within = np.where(fought > 0, won / np.maximum(fought, 1), 1.0)
        own = np.array([[self.of[v] == f for v in self.languages] for f in self.families])
        # the most duels won, then the clearest wins, decide among the family's languages
        choice = np.where(own[best], votes + within / 2, -1.0).argmax(axis=1)
        each = np.arange(len(x))
        return [self.languages[i] for i in choice], np.clip(p[each, best] * within[each, choice], 0, 1)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def identify(
    docs: DataFrame, families: dict[str, str] | None = None, rows_per_language: int = ROWS_PER_LANGUAGE,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", carry: tuple[str, ...] = (), languages: int = LANGUAGES,
) -> DataFrame:
    """One row per document: id_col, held_out, lang_pred, score and the columns named in carry.

    Learns from text and lang of rows that aren't held out (crc32 of the id as text, modulo
    4, is 2) and have a lang, about rows_per_language of each language, chosen by a hash of
    id and text. Of more than `languages` languages the most frequent are learnt. Predicts from the whole text alone. `und` with score 0: null texts, texts
    without letters, and everything if there is nothing to learn from. Languages met in
    training only are predicted. Repeated rows give repeated rows; a null id counts as not
    held out; other columns are dropped. One pass over the texts and no shuffle of them.
    """
    spark = docs.sparkSession
    ident, text, lang = F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), F.col(f"`{lang_col}`")
    letters = text.rlike(r"\p{L}")
    learn = docs.where(~held_out(ident) & lang.isNotNull() & F.coalesce(letters, F.lit(False)))
    by_lang = learn.groupBy(lang.cast("string").alias("lang")).agg(F.count("*").alias("n"))
    counts = {r["lang"]: r["n"] for r in by_lang.orderBy(F.desc("n"), "lang").limit(languages).collect()}
    share = F.create_map(*[F.lit(x) for v, n in counts.items() for x in (v, min(1.0, rows_per_language / n))]) if counts else None
    model = None
    if share is not None:
        chance = F.pmod(F.xxhash64(ident, text), F.lit(1_000_003)) / 1_000_003.0
        sample = learn.where(chance < share[lang.cast("string")]).select(lang.cast("string").alias("lang"), F.lower(text).alias("text"))

        def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at, n in _runs(batch.column(1)):
                    x = features(batch.column(1).slice(at, n))
                    packed = [np.flatnonzero(r).astype("<i4").tobytes() for r in x]
                    values = [r[r != 0].astype("<f4").tobytes() for r in x]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(at, n), pa.array(packed, pa.binary()), pa.array(values, pa.binary())], ["lang", "at", "value"]
                    )

        rows = sample.mapInArrow(vectors, "lang string, at binary, value binary").collect()
        rows.sort(key=lambda r: (r["lang"], bytes(r["at"]), bytes(r["value"])))
        if rows:
            x = np.zeros((len(rows), DIM), np.float32)
            for i, r in enumerate(rows):
                x[i, np.frombuffer(r["at"], "<i4")] = np.frombuffer(r["value"], "<f4")
            langs = np.array([r["lang"] for r in rows])
            del rows
            model = Model(x, langs, FAMILIES if families is None else families)
    sent = spark.sparkContext.broadcast(model)
    todo = docs.select(
        ident.alias("_id"), held_out(ident).alias("held_out"), F.lower(text).alias("text"), F.coalesce(letters, F.lit(False)).alias("some"),
        *[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(carry)],
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            texts = batch.column("text").fill_null("")
            for at, n in _runs(texts):
                some = batch.column("some").slice(at, n).to_pylist()
                if m is None:
                    names, score = ["und"] * n, np.zeros(n)
                else:
                    names, score = m.predict(features(texts.slice(at, n)))
                    names = [v if s else "und" for v, s in zip(names, some, strict=True)]
                    score = np.where(some, score, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, n), batch.column(1).slice(at, n), pa.array(names, pa.string()), pa.array(score),
                     *[c.slice(at, n) for c in batch.columns[4:]]],
                    ["_id", "held_out", "lang_pred", "score", *batch.schema.names[4:]],
                )

    schema = f"_id {todo.schema['_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double"
    schema += "".join(f", _k{i} {todo.schema[f'_k{i}'].dataType.simpleString()}" for i in range(len(carry)))
    out = todo.mapInArrow(run, schema)
    return out.select(F.col("_id").alias(id_col), "held_out", "lang_pred", "score", *[F.col(f"_k{i}").alias(c) for i, c in enumerate(carry)])
