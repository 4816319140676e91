import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from veridra.llm import bpe, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "a", "  a b", "a  b", "a \n b", " \n", "a\n b", "a\n\n b  ", "x<|endoftext|> y", "<|endoftext|>", "日本語 テスト １２３", "it's we'll  12 3四",
    "\tq", "é" * 50, "🎉🎉 x", "a b", "x\x1cy z", "word, next.", "1, 2. 3", "a" * 3000, "a\u00a0  b", "a \u3000\n c\u2028 d", "b's 'tis' it's", "x!\x1c y",
]


@pytest.fixture(scope="module")
def theirs():
    return Tokenizer.from_file(PATH)


def test_same_ids_as_the_tokenizers_library(theirs):
    rnd = random.Random(1)
    texts = ODD + ["".join(rnd.choice("ab  \n\t'stl1é,.<|>") for _ in range(rnd.randint(0, 30))) for _ in range(1500)]
    want = [np.array(e.ids, "<u4").tobytes() for e in theirs.encode_batch(texts, add_special_tokens=False)]
    ours = bpe.load(PATH, public_tokenizers.PATTERN)
    assert ours.encode(texts) == want
    assert [ours.decode(x) for x in want] == [theirs.decode(np.frombuffer(x, "<u4").tolist(), skip_special_tokens=False) for x in want]
    assert bpe.encoded(packing.encoder(PATH), texts) == want


def test_a_small_cache_and_equal_hashes_change_nothing(theirs, monkeypatch):
    want = {t: np.array(theirs.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in ODD}
    ours = bpe.load(PATH, public_tokenizers.PATTERN)
    cache = bpe.PieceCache(ours.encode_texts, ours.strings, ours.special, bound=3)
    assert all(bpe.encoded(cache, [t]) == [want[t]] for t in ODD * 2)
    cache = bpe.PieceCache(ours.encode_texts, ours.strings, ours.special)
    monkeypatch.setattr(bpe, "run_hashes", lambda raw, first, end: (end - first).astype(np.uint64) % np.uint64(3))
    assert bpe.encoded(cache, ODD) == [want[t] for t in ODD] == bpe.encoded(cache, ODD)


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, length int, sequence_id int, _id int, _text string")


def rows_of(texts):
    return [(i, t, "clash", 1, 2, 3, "clash") for i, t in enumerate(texts)]


def test_encode_decode_table(spark, theirs):
    rows = rows_of([*ODD, None]) + rows_of(["twice"]) + [(None, "no id", "", 0, 0, 0, "")]
    got = bpe.encode_decode(docs_of(spark, rows), PATH, public_tokenizers.PATTERN).collect()
    assert len(got) == len(rows)
    by_text = {hashlib.sha256((r[1] or "").encode()).hexdigest(): r[1] or "" for r in rows}
    for r in got:
        text = by_text[r["decoded_sha256"]]
        ids = theirs.encode(text, add_special_tokens=False).ids
        assert (r["decoded"], r["n_tokens"], bytes(r["ids"])) == (text, len(ids), np.array(ids, "<u4").tobytes())
    assert bpe.encode_decode(docs_of(spark, []), PATH, public_tokenizers.PATTERN).collect() == []


def check_packing(rows, got, theirs, size):
    seqs = {}
    pieces = {}
    for r in got:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault(r["doc_id"], []).append(r)
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    for r in rows:
        ids = [*theirs.encode(r[1] or "", add_special_tokens=False).ids, 0]
        mine = sorted(pieces[r[0]], key=lambda p: p["piece"])
        assert [p["piece"] for p in mine] == list(range(len(mine))) and sum(p["length"] for p in mine) == len(ids)
        assert all(p["length"] == size for p in mine[1:]) and len(mine) == math.ceil(len(ids) / size)
        for p in mine:
            part = np.array(ids[p["start"] : p["start"] + p["length"]], "<u4").tobytes()
            assert p["ids_crc32"] == zlib.crc32(part)
    return len(seqs)


def test_pack_table(spark, theirs):
    rnd = random.Random(5)
    texts = [None, "", *[" ".join(rnd.choice(["alpha", "beta", "x"]) for _ in range(rnd.choice([3, 20, 90, 400]))) for _ in range(150)]]
    rows = rows_of(texts)
    got = packing.pack(docs_of(spark, rows), PATH, size=128).collect()
    n = check_packing(rows, got, theirs, 128)
    total = sum(len(theirs.encode(t or "").ids) + 1 for t in texts)
    assert n <= math.ceil(total / 128) * 1.02 + 1
    assert packing.pack(docs_of(spark, []), PATH).collect() == []


def optimum(items, size):
    """Fewest bins by trying all placements (small inputs)."""
    best = [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for b in {b: k for k, b in enumerate(bins)}.values():
            if bins[b] + items[i] <= size:
                bins[b] += items[i]
                place(i + 1, bins)
                bins[b] -= items[i]
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best[0]


def test_bin_completion_is_near_the_optimum():
    rnd = random.Random(3)
    for _ in range(60):
        items = sorted((rnd.randint(1, 20) for _ in range(rnd.randint(1, 9))), reverse=True)
        histogram = {v: items.count(v) for v in items}
        runs = packing.bin_completion(histogram, 20)
        used = {}
        for times, pattern in runs:
            assert sum(v * k for v, k in pattern) <= 20
            for v, k in pattern:
                used[v] = used.get(v, 0) + times * k
        assert used == histogram
        assert sum(t for t, _ in runs) <= optimum(items, 20) + 1


def test_bin_completion_reaches_the_optimum():
    traced = [1038, 700, 674, 674, 505, 505]
    rnd = random.Random(8)
    cases = [(traced, 2048), *(([rnd.randint(lo, 60) for _ in range(rnd.randint(1, 10))], 100) for lo in [1, 12, 20, 25] * 15)]
    for items, size in cases:
        items = sorted(items, reverse=True)
        runs = packing.bin_completion({v: items.count(v) for v in items}, size)
        assert sorted((v for t, p in runs for v, k in p for _ in range(t * k)), reverse=True) == items
        assert all(sum(v * k for v, k in p) <= size for _, p in runs)
        assert sum(t for t, _ in runs) == optimum(items, size)


def test_one_hot_length_is_numbered_without_gaps(spark):
    from veridra.llm.common import ranked

    df = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 50 END AS k")
    got = ranked(df, "k", ["id"], 5000).groupBy("k").agg({"rank": "max", "*": "count"}).collect()
    assert all(r["max(rank)"] + 1 == r["count(1)"] for r in got)
