"""Byte-level BPE: encoding by a queue of merge ranks over a linked symbol list, and decoding.

A word's bytes become a doubly linked list of symbols. Every adjacent pair that the
vocabulary can merge waits in a priority queue, lowest rank first and leftmost first on
ties. Taking a pair joins its two symbols and queues the two new neighbours; an entry
whose symbols have changed since it was queued is stale and is skipped. Decoding joins
the byte strings of the ids.

Words repeat, so each worker keeps the ids of pieces it has met, found by hash, up to a
bound; decoding the ids shows whether a hash was ambiguous, and such texts are encoded anew.
The bound changes the time taken, never the ids.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import string
import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import U, run_hashes, text_bytes

#: Pieces whose ids a worker keeps at most, and their longest in bytes: about 30 bytes of memory each.
CACHE_PIECES, CACHE_BYTES = 1_500_000, 40


def _bytes(members: Iterable[int]) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[*members]] = True
    return out


_BLANK, _CONTROL = _bytes([*range(9, 14), 32]), _bytes(range(28, 32))
_ALNUM = _bytes(string.ascii_letters.encode() + string.digits.encode())
_PUNCT = _bytes(string.punctuation.encode())
#: Blanks outside ASCII, in UTF-8.
WIDE_BLANKS = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1
    bytes stand for themselves, the others for the letters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def gather(flat: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """flat[at[i] : at[i] + size[i]] for all i, joined."""
    ends = np.cumsum(size)
    return flat[np.repeat(at - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


class PieceCache:
    """Ids of texts, piece by piece, for byte-level vocabularies.

    A piece starts at a blank that follows a non-blank letter and at punctuation that follows
    a letter or digit: no token crosses such a place. Texts that hold special tokens or
    control letters are one piece.
    """

    def __init__(self, encode_pieces: Callable[[list[str]], list[bytes]], strings: list[bytes], special: Iterable[str] = (), bound: int = CACHE_PIECES):
        self.encode_pieces, self.bound, self.special = encode_pieces, bound, [x.encode() for x in special]
        self.token_size = np.array([len(x) for x in strings], np.int64)
        self.token_at = np.cumsum(self.token_size) - self.token_size
        self.token_flat = np.frombuffer(b"".join(strings), np.uint8)
        self._clear()

    def _clear(self) -> None:
        self.keys, self.flat = np.zeros(0, U), np.zeros(0, np.uint32)
        self.at, self.size = np.zeros(0, np.int32), np.zeros(0, np.int32)

    def _cuts(self, raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and end byte of each piece, and whether it is a text that can't be cut."""
        blank = _BLANK[raw]
        data = raw.tobytes()
        for b in WIDE_BLANKS:
            at = data.find(b)
            while at >= 0:
                blank[at : at + len(b)] = True
                at = data.find(b, at + 1)
        cut = np.ones(len(raw) + 1, bool)
        cut[1:-1] = blank[1:] & ~blank[:-1] | _PUNCT[raw[1:]] & _ALNUM[raw[:-1]]
        cut[starts] = True
        at = [*np.flatnonzero(_CONTROL[raw]).tolist()]
        for b in self.special:
            p = data.find(b)
            while p >= 0:
                at.append(p)
                p = data.find(b, p + 1)
        odd = np.unique(np.searchsorted(starts, np.array(at, np.int64), "right") - 1)
        for i in odd.tolist():
            cut[starts[i] + 1 : starts[i + 1]] = False
        edge = np.flatnonzero(cut)
        return edge[:-1], edge[1:], np.isin(edge[:-1], starts[odd])

    def encode(self, raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's ids start (one more at the end)."""
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(starts), np.int64)
        first, end, odd = self._cuts(raw, starts)
        keys, one, which = np.unique(run_hashes(raw, first, end), return_index=True, return_inverse=True)
        pos = np.searchsorted(self.keys, keys)
        hit = np.zeros(len(keys), bool)
        if len(self.keys):
            hit = self.keys[np.minimum(pos, len(self.keys) - 1)] == keys
        keep = ((end - first)[one] <= CACHE_BYTES) & ~odd[one]
        new = np.concatenate([np.flatnonzero(~hit & keep), np.flatnonzero(~hit & ~keep)])
        n_keep = int((~hit & keep).sum())
        got = self.encode_pieces([raw[a:b].tobytes().decode() for a, b in zip(first[one[new]].tolist(), end[one[new]].tolist(), strict=True)])
        new_size = np.array([len(x) // 4 for x in got], np.int32)
        new_at = (len(self.flat) + np.cumsum(new_size) - new_size).astype(np.int32)
        flat = np.concatenate([self.flat, np.frombuffer(b"".join(got), np.uint32)])
        at, size = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        at[hit], size[hit] = self.at[pos[hit]], self.size[pos[hit]]
        at[new], size[new] = new_at, new_size
        if len(self.keys) + n_keep > self.bound:
            self._clear()
        elif n_keep:
            where = pos[new[:n_keep]]
            self.keys = np.insert(self.keys, where, keys[new[:n_keep]])
            self.at, self.size = np.insert(self.at, where, new_at[:n_keep]), np.insert(self.size, where, new_size[:n_keep])
            self.flat = flat[: len(self.flat) + int(new_size[:n_keep].sum())].copy()
        ids = gather(flat, at[which], size[which])
        upto = np.concatenate([[0], np.cumsum(size[which])])[np.searchsorted(first, starts)]
        back = self.decode(ids)
        if len(back) != len(raw) or (back != raw).any():
            each = self.encode_pieces([raw[a:b].tobytes().decode() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)])
            return np.frombuffer(b"".join(each), np.uint32), np.concatenate([[0], np.cumsum([len(x) // 4 for x in each])])
        return ids, upto

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The vocabulary's strings of all ids, joined."""
        return gather(self.token_flat, self.token_at[ids], self.token_size[ids])


class ByteBpe:
    """A byte-level BPE vocabulary read from a tokenizers JSON file."""

    def __init__(self, spec: dict, pattern: str):
        letters = byte_letters()
        back = {c: b for b, c in letters.items()}
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.pattern = regex.compile(pattern)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.at_special = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
            if self.special
            else None
        )
        self.first = [vocab[letters[b]] for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            left, right = m.split(" ") if isinstance(m, str) else m
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.strings: list[bytes] = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for s, i in vocab.items():
            self.strings[i] = bytes(back[c] for c in s)
        for s, i in self.special.items():
            self.strings[i] = s.encode()
        self.cache = PieceCache(self.encode_texts, self.strings, self.special)

    def merge_word(self, word: bytes) -> list[int]:
        """Ids of one word."""
        ids = [self.first[b] for b in word]
        n = len(ids)
        merges = self.merges
        if n == 1:
            return ids
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            if m := merges.get((ids[i], ids[i + 1])):
                queue.append((m[0], i, ids[i], ids[i + 1], m[1]))
        heapq.heapify(queue)
        while queue:
            _, i, left, right, joined = heapq.heappop(queue)
            j = after[i] if ids[i] == left else n
            if j >= n or ids[j] != right:
                continue  # stale
            ids[i], ids[j] = joined, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if m := merges.get((joined, ids[k])):
                    heapq.heappush(queue, (m[0], i, joined, ids[k], m[1]))
            if (h := before[i]) >= 0 and (m := merges.get((ids[h], joined))):
                heapq.heappush(queue, (m[0], h, ids[h], joined, m[1]))
        return [x for x in ids if x >= 0]

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, word by word, special tokens first."""
        out = []
        for t in texts:
            got = []
            for part in self.at_special.split(t) if self.at_special and "<" in t else (t,):
                if part in self.special:
                    got.append(self.special[part].to_bytes(4, "little"))
                    continue
                for w in self.pattern.findall(part):
                    ids = self.merge_word(w.encode())
                    got.append(struct.pack(f"<{len(ids)}I", *ids))
            out.append(b"".join(got))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        return encoded(self.cache, texts)

    def decode(self, ids: bytes | np.ndarray) -> str:
        """The text of ids; bytes that are not UTF-8 become replacement letters."""
        return self.cache.decode(np.frombuffer(ids, "<u4")).tobytes().decode("utf-8", "replace")


_LOADED: dict[str, ByteBpe] = {}


def load(path: str, pattern: str) -> ByteBpe:
    """The vocabulary of a path, once a worker."""
    if path not in _LOADED:
        with open(path, encoding="utf-8") as f:
            _LOADED[path] = ByteBpe(json.load(f), pattern)
    return _LOADED[path]


def encoded(cache: PieceCache, texts: list[str]) -> list[bytes]:
    """Little-endian unsigned 32-bit ids of each text."""
    ids, at = cache.encode(*text_bytes(pa.array(texts, pa.string())))
    return [ids[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def slices(texts: pa.Array, size: int = 1_000_000) -> Iterator[pa.Array]:
    """Runs of texts of about so many bytes, so that memory stays bounded."""
    step = np.cumsum(np.diff(text_bytes(texts)[1])) // size
    edge = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), len(texts)]
    return (texts.slice(a, b - a) for a, b in zip(edge, edge[1:], strict=False) if b > a)


def encode_decode(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """Encode every text and decode the ids again.

    Returns id_col, ids (binary, little-endian unsigned 32-bit), decoded (string) and the
    digests n_tokens, ids_sha256, decoded_sha256; with_ids=False leaves the first two out.
    A null text counts as empty (no ids, empty text). Rows are independent, so repeated
    rows and ties simply repeat; other columns are dropped, whatever their names. An empty
    table gives an empty result. No shuffle: one pass over the table.
    """
    docs = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    id_type = docs.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            row = 0
            for texts in slices(batch.column(1)):
                ids, at = bpe.cache.encode(*text_bytes(texts))
                parts = [ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                decoded = [bpe.decode(x) for x in parts]
                cols = [
                    batch.column(0).slice(row, len(texts)),
                    pa.array(np.diff(at)),
                    pa.array([hashlib.sha256(x).hexdigest() for x in parts]),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded]),
                ]
                names = ["_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols += [pa.array([x.tobytes() for x in parts], pa.binary()), pa.array(decoded)]
                    names += ["ids", "decoded"]
                row += len(texts)
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = f"_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids binary, decoded string"
    return docs.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
