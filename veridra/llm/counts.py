"""Token counts of whole texts, where huge ones are encoded in overlapping chunks.

Merges of a byte-pair vocabulary are decided by the two symbols that meet alone. So a run of
tokens is the encoding of its text if and only if each two adjacent tokens are the encoding of
theirs. Two chunks that overlap and hold one token in common, at the same place, can therefore be
spliced behind it: every adjacent pair of the result is adjacent in one of the two encodings. That
is the proof of a stable boundary; tokens that merely end at one place would not be enough.

Texts up to a chunk are encoded where they are. Longer ones are cut into chunks that go to all
tasks; each sends back its number of tokens and the places of those in its overlaps. Where two
neighbours share no token (a long run of one letter, say), the text is cut anew into chunks and
overlaps four times as wide, at last into one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import slices
from .common import stored
from .shingles import text_bytes

#: Bytes of a chunk and of what it shares with the next one.
CHUNK, OVERLAP = 65_536, 512
#: Overlaps and chunks grow so many times where two chunks share no token.
WIDER = 4


class Pieces:
    """A sentencepiece BPE vocabulary: ids of texts, and how many letters each id stands for."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m, n = self.model, self.model.vocab_size()
        # a space and its mark in the vocabulary are one letter each; of a letter's bytes the first stands for it
        self.plain = np.array([not (m.is_byte(i) or m.is_unknown(i) or m.is_control(i)) for i in range(n)])
        self.letters = np.ones(n, np.int32)
        for i in range(n):
            if m.is_byte(i):
                self.letters[i] = 0x80 > int(m.id_to_piece(i)[3:5], 16) or int(m.id_to_piece(i)[3:5], 16) >= 0xC0
            elif self.plain[i]:
                self.letters[i] = len(m.id_to_piece(i))
        # a model may set a mark before every text
        self.prefix = int(self.letters[np.array(m.encode("a"), np.int64)].sum()) - 1

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    def zone(self, ids: np.ndarray, low: int, size: int) -> tuple[list[int], list[int]]:
        """(place and length as one number, index) of the tokens within letters low to low + size of a text."""
        end = np.cumsum(self.letters[ids]) - self.prefix
        start = end - self.letters[ids]
        at = np.flatnonzero((start >= low) & (end <= low + size) & self.plain[ids])
        return ((start[at] - low) * 65_536 + (end - start)[at]).tolist(), at.tolist()


_LOADED: dict[str, Pieces] = {}


def load(path: str) -> Pieces:
    """The vocabulary of a path, once a worker."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def _cuts(raw: np.ndarray, chunk: int, overlap: int) -> list[tuple[int, int, int]]:
    """(first byte, first byte of the next chunk, end byte) of every chunk, none within a letter."""

    def whole(at: int) -> int:
        while at < len(raw) and raw[at] & 0xC0 == 0x80:
            at += 1
        return at

    out, at = [], 0
    while True:
        after = whole(at + chunk)
        end = min(whole(after + overlap), len(raw))
        out.append((at, min(after, len(raw)), end))
        if end == len(raw):
            return out
        at = after


def _chunks(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(key, check, id, seq, before, shared) of (key, check, id, text): a chunk in two parts, the second of which the next one begins with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw, _ = text_bytes(batch.column("text").slice(i, 1))
                for n, (a, b, e) in enumerate(_cuts(raw, chunk, overlap)):
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c).slice(i, 1) for c in ("key", "check", "id")), pa.array([n]), pa.array([raw[a:b].tobytes().decode()]), pa.array([raw[b:e].tobytes().decode()])],
                        ["key", "check", "id", "seq", "before", "shared"],
                    )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"key long, check int, id {kind}, seq long, before string, shared string")


def _encoded(chunks: DataFrame, path: str, overlap: int) -> DataFrame:
    """Tokens of every chunk, and where those of its first and last letters stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for batch in batches:
            for i in range(batch.num_rows):
                before, shared = batch.column("before")[i].as_py(), batch.column("shared")[i].as_py()
                ids = np.array(pieces.ids([before + shared])[0], np.int64)
                head, tail = pieces.zone(ids, 0, overlap), pieces.zone(ids, len(before), overlap)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(i, 1) for c in ("key", "check", "id", "seq")), pa.array([len(ids)]),
                        *(pa.array([x], pa.list_(pa.int64())) for x in (*head, *tail)),
                    ],
                    ["key", "check", "id", "seq", "n", "head", "head_at", "tail", "tail_at"],
                )

    kind = chunks.schema["id"].dataType.simpleString()
    arrays = ", ".join(f"{c} array<long>" for c in ("head", "head_at", "tail", "tail_at"))
    return chunks.mapInArrow(run, f"key long, check int, id {kind}, seq long, n long, {arrays}")


def _spliced(encoded: DataFrame) -> DataFrame:
    """(key, check, id, copies, n_tokens) of every text; n_tokens is null where two neighbours share no token."""
    each = encoded.groupBy("key", "check", "id", "seq").agg(F.count("*").alias("copies"), *(F.first(c).alias(c) for c in ("n", "head", "head_at", "tail", "tail_at")))
    each = stored(each)
    after = each.select("key", "check", (F.col("seq") - 1).alias("seq"), F.col("head").alias("next"), F.col("head_at").alias("next_at"))
    both = each.drop("head", "head_at").join(after.hint("merge"), ["key", "check", "seq"], "left")
    token = F.get(F.array_intersect("tail", "next"), F.lit(0))

    def index(where: str, places: str):
        return F.get(places, (F.array_position(where, token) - 1).cast("int"))

    # up to the shared token from this chunk, behind it from the next: what both hold up to it counts once
    twice = F.when(F.col("next").isNull(), 0).otherwise(F.col("n") - index("tail", "tail_at") + index("next", "next_at"))
    return both.groupBy("key", "check", "id").agg(
        F.max("copies").alias("copies"), F.when(F.count(twice) == F.count("*"), F.sum(F.col("n")) - F.sum(twice)).alias("n_tokens")
    )


def count_tokens(
    docs: DataFrame, path: str, limit: int = 4096, chunk: int = CHUNK, overlap: int = OVERLAP,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of docs: id_col, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    path names a sentencepiece BPE model without normalisation; counts are those of encoding the
    whole text, without begin and end tokens. A null text counts as empty: 0 bytes, 0 tokens. Rows
    that repeat an id and text are encoded where they are and come back as often; ids may be null.
    Other columns are dropped, whatever their names. An empty table gives no rows.

    Texts of up to `chunk` bytes never move. Longer ones are sent once, in chunks, and once more for
    every time they have to be cut more widely; each round's numbers are written to the shared folder.
    """
    if overlap >= chunk:
        raise ValueError("a chunk must be longer than its overlap")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    docs = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    size = F.octet_length("text")
    kind = docs.schema["id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for batch in batches:
            row = 0
            for texts in slices(batch.column(1)):
                n_bytes = np.diff(text_bytes(texts)[1])
                n = np.array([len(x) for x in pieces.ids(texts.to_pylist())], np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(texts)), pa.array(n_bytes), pa.array(n)], ["id", "n_bytes", "n_tokens"])
                row += len(texts)

    out = docs.where(size <= chunk).mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
    # the number of bytes is part of the first hash: texts that share both hashes and differ are one in 2^96
    long = docs.where(size > chunk).select(F.xxhash64("id", F.col("id").isNull(), "text", size).alias("key"), F.hash("text").alias("check"), "id", "text")
    sizes = stored(long.groupBy("key", "check").agg(F.first(size.cast("long")).alias("n_bytes")))
    while sizes.head(1):
        dealt = _chunks(long, chunk, overlap).repartition("key", "check", "seq")
        done = stored(_spliced(_encoded(dealt, path, overlap)))
        good = done.where(F.col("n_tokens").isNotNull()).join(sizes.hint("merge"), ["key", "check"])
        out = out.unionByName(good.select("id", "n_bytes", "n_tokens", F.explode(F.sequence(F.lit(1), "copies"))).drop("col"))
        left = done.where(F.col("n_tokens").isNull()).select("key", "check")
        if not left.head(1):
            break
        long = long.join(left.hint("merge"), ["key", "check"], "left_semi")
        chunk, overlap = chunk * WIDER, overlap * WIDER
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
