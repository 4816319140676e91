import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from veridra.llm import counts

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def theirs():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts():
    rnd = random.Random(2)
    bits = ["the ", " of", "word", "  ", "\n", "日本", "é", "🎉", "▁", "\t", "aaaa", "====", "1234", "<s>", "ﬁ", "\0", "x y"]
    out = [None, "", " ", "a", "a" * 5000, " " * 5000, "=" * 3000, "word " * 2000, "🎉" * 1000, "▁ " * 1500, "日本語" * 1200]
    out += ["".join(rnd.choice(bits) for _ in range(rnd.choice([3, 60, 900, 3000]))) for _ in range(60)]
    return [*out, "ab " * 900 + "c" * 4000 + " tail" * 700]


@pytest.mark.parametrize(("chunk", "overlap"), [(64, 16), (1000, 40), (65_536, 512)])
def test_counts_are_those_of_whole_texts(spark, theirs, chunk, overlap):
    rows = [(i, t, 1, 2, "k") for i, t in enumerate(texts())]
    rows += [rows[20], rows[20], rows[5], (None, rows[30][1], 1, 2, "k"), (7, "x " * 700, 1, 2, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, seq int, key string")
    got = sorted(tuple(r) for r in counts.count_tokens(df, PATH, limit=300, chunk=chunk, overlap=overlap).collect() if r[0] is not None)
    want = sorted((r[0], len((r[1] or "").encode()), n := len(theirs.encode(r[1] or "")), n > 300) for r in rows if r[0] is not None)
    assert got == want


def test_no_rows_and_other_ids(spark, theirs):
    df = spark.createDataFrame([("a", "word " * 50, 1)], "`my.id` string, `the text` string, other int")
    for rows in (df, df.limit(0)):
        got = counts.count_tokens(rows, PATH, chunk=64, overlap=16, id_col="my.id", text_col="the text")
        assert got.columns == ["my.id", "n_bytes", "n_tokens", "over_limit"]
        assert [r[2] for r in got.collect()] == ([len(theirs.encode("word " * 50))] if rows is df else [])


def test_letters_add_up(theirs):
    pieces = counts.load(PATH)
    for t in texts():
        if t:
            assert pieces.letters[np.array(theirs.encode(t))].sum() == len(t) + 1
