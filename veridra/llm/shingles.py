"""Hashes of words and of runs of words, for whole batches of texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = pow(0x9E3779B97F4A7C15, 1, 2**64) | 1
_BACK = pow(_BASE, -1, 2**64)
_POWERS: dict[int, np.ndarray] = {}
WINDOW = 4_000_000
#: Letters and digits, and every byte of a letter outside ASCII, belong to words.
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), 95, *range(128, 256)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64: spreads 64 bits evenly."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 20), base, U)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= WINDOW + 1:
            _POWERS[base] = have
    return have[:n]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array, and where each text starts (one more at the end)."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[starts[0] : starts[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, starts - starts[0]


def words(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash, first byte, end byte) of every word, in order."""
    inside = _WORD[raw]
    edge = np.ones(len(raw) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[starts] = True
    at = np.flatnonzero(edge)
    first, end = at[:-1], at[1:]
    keep = inside[first] if len(first) else np.zeros(0, bool)
    first, end = first[keep], end[keep]
    text = np.searchsorted(starts, first, "right") - 1
    return text, run_hashes(raw, first, end), first, end


def run_hashes(raw: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of raw[first:end] for all of them; both ascend. WINDOW bytes are summed at a time, or one longer run."""
    out = np.empty(len(first), U)
    a = 0
    while a < len(first):
        low = first[a]
        b = max(a + 1, int(np.searchsorted(first, low + WINDOW)))
        part = raw[low : end[b - 1]]
        total = np.zeros(len(part) + 1, U)
        np.cumsum((part.astype(U) + U(1)) * _powers(_BASE, len(part)), out=total[1:])
        f, e = first[a:b] - low, end[a:b] - low
        value = (total[e] - total[f]) * _powers(_BACK, len(part) + 1)[f]
        out[a:b] = mix(value + U(0x9E3779B97F4A7C15) * (e - f).astype(U))
        a = b
    return out


def prefixes(raw: np.ndarray, first: np.ndarray, end: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(number, hash of the first `size` bytes) of the words that are longer than `size` bytes."""
    long = np.flatnonzero(end - first > size)
    at = first[long]
    h = np.zeros(len(at), U)
    for i in range(size):
        h = (h << U(8)) | raw[at + i].astype(U)
    return long, mix(h)


def shingles(text: np.ndarray, hashes: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every run of `width` words; a shorter text is one run."""
    n = len(hashes)
    if not n:
        return text, hashes
    begins = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    sizes = np.diff(np.r_[begins, n])
    run = np.zeros(n, U)
    for i in range(width):
        m = max(0, n - i)
        part = np.zeros(n, U)
        part[:m] = np.where(text[n - m :] == text[:m], hashes[n - m :], U(0))
        run = mix(run ^ (part + U(i + 1)))
    # a text of n words has n - width + 1 runs, and at least one
    left = np.repeat(sizes, sizes) - (np.arange(n) - np.repeat(begins, sizes))
    keep = (left >= width) | (np.arange(n) == np.repeat(begins, sizes))
    return text[keep], run[keep]
