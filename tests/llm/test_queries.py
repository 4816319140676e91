"""The subpackage's queries: against SQL where there is some, and the pipeline against its parts."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import classes
from veridra.llm import chat
from veridra.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sql = con.execute(ORACLES[name])
    names = sorted(d[0] for d in sql.description)
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == names
    order = [d[0] for d in sql.description]
    want = sorted(str([r[order.index(n)] for n in names]) for r in sql.fetchall())
    assert sorted(str(list(r)) for r in df.select(*names).collect()) == want


def render(turns, who):
    out = ""
    for role, text in turns:
        as_ = "system" if role == "system" else "assistant" if role == who else f"user name={role}"
        out += f"<|im_start|>{as_}\n{text}<|im_end|>\n"
    return out


def test_chat_rendering_and_masks(spark):
    convs = {1: [("system", "be kind"), ("ann", "hi"), ("bob", "hello 🎉"), ("ann", "")], 2: [("system", "alone")], 3: [(f"p{i % 3}", f"turn {i}") for i in range(400)]}
    rows = [(c, i, r, t, 7) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    df = spark.createDataFrame([*rows, (None, 0, None, None, 7)], "conv_id long, turn long, role string, text string, start int").withColumns({"seq": F.lit(1), "_part": F.lit(2)})
    got = chat.rotate(df).collect()
    assert {(r["conv_id"], r["perspective"]) for r in got} == {(1, "ann"), (1, "bob"), (3, "p0"), (3, "p1"), (3, "p2"), (None, "unknown")}
    for c, who in [(1, "ann"), (1, "bob"), (3, "p1")]:
        mine = sorted((r for r in got if (r["conv_id"], r["perspective"]) == (c, who)), key=lambda r: r["seq"])
        whole = "".join(r["rendered"] for r in mine)
        assert whole == render(convs[c], who)
        for r, (role, text) in zip(mine, convs[c], strict=True):
            assert whole[r["start"] : r["end"]] == r["rendered"] and r["learn"] == (role == who)
            assert whole[r["mask_start"] : r["mask_end"]] == (f"{text}<|im_end|>" if role == who else "")
    assert chat.rotate(df.limit(0)).collect() == []


def test_pipeline_keeps_one_of_each_class(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(-1, None, "en", "s", 0), (-2, "123 456", "en", "s", 7)], docs.schema)
    docs = docs.unionByName(extra)
    ids = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == corpus_pipeline.COLUMNS
        ids[name] = {r[0] for r in docs.select("doc_id").collect()}
        if name == "language ID":
            assert {r[0] for r in before.collect()} - ids[name] == {-1, -2}
        if name == "MinHash near-dedup":
            want = classes([(r["doc_id"], r["text"]) for r in before.collect()])
            assert ids[name] == set(want.values())
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert not any("@mail" in t for t in text.values())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in packed} == set(text)


def test_near_duplicates_go_by_row(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(1, a), (1, b), (2, b), (None, c), (None, c), (None, d), (3, d), (4, None), (4, None), (None, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, df, SF).collect()]
    assert sorted(got, key=str) == sorted([(1, a), (1, b), (None, c), (3, d), (4, None), (None, "")], key=str)
