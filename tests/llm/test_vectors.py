import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import roots
from veridra.llm import additive, ego
from veridra.llm.common import components

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n, d=16, seed=1, copies=True):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).astype(np.float32)
    if copies:
        x[n // 3 : 2 * n // 3] = x[0] + rng.normal(scale=0.05, size=(2 * n // 3 - n // 3, d))
        x[5] = x[6] = x[7]
    return x


BAD = [(900, None, 0), (901, [], 0), (902, [0.0] * 16, 0), (903, [float("nan")] + [1.0] * 15, 0), (904, [float("inf")] + [1.0] * 15, 0), (None, [1.0] * 16, 0), (905, [None] + [1.0] * 15, 0)]


def table(spark, x):
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    df = spark.createDataFrame([*rows, *BAD, rows[3]], SCHEMA)
    return df.withColumns({"id": F.lit(1), "vec": F.lit(2), "copy": F.lit(3), "block": F.lit(4), "rank": F.lit(5)})


def test_every_link_and_class(spark):
    x = vectors(240).astype(float)
    n = x / np.linalg.norm(x, axis=1, keepdims=True)
    cos = n @ n.T >= 0.9
    np.fill_diagonal(cos, False)
    want = roots(range(len(x)), [(i, j) for i, j in zip(*np.nonzero(cos), strict=True) if i < j])
    for block in (8192, 32):
        got = {r["vec_id"]: r for r in ego.near_duplicates(table(spark, vectors(240)), 0.9, block=block).collect()}
        assert len(got) == 246
        assert all(got[i]["n_links"] == cos[i].sum() and got[i]["component_id"] == want[i] and got[i]["kept"] == (want[i] == i) for i in range(len(x)))
        assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i for i in range(900, 906))


def test_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ego.near_duplicates(empty).collect() == []
    assert additive.search(empty, F.col("vec_id") % 20 == 0).collect() == []
    only_bad = spark.createDataFrame(BAD, SCHEMA)
    assert {r["n_links"] for r in ego.near_duplicates(only_bad).collect()} == {0}
    assert additive.search(only_bad, F.col("vec_id") % 20 == 0).collect() == []


def test_small_search_is_exact(spark):
    x = vectors(60).astype(float)
    got = additive.search(table(spark, vectors(60)), F.col("vec_id") % 20 == 0).collect()
    for q in (0, 20, 40):
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        score = x @ x[q]
        order = [i for i in sorted(range(len(x)), key=lambda i: (-score[i], i)) if i != q][:20]
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert np.allclose([r["score"] for r in mine], score[order], atol=1e-9)
        assert len({r["vec_id"] for r in mine} & set(order)) >= 19


def test_fewer_candidates_than_asked_for(spark):
    got = additive.search(spark.createDataFrame([(0, [1.0, 2.0], 0), (1, [2.0, 1.0], 0), (2, [2.0, 1.0], 0)], SCHEMA), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [(1, 1, 4.0), (2, 2, 4.0)]


def test_recall_on_the_test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = additive.search(df, F.col("vec_id") % 20 == 0, rerank=60).toPandas()
    pdf = df.toPandas()
    x, ids = np.stack(pdf.embedding).astype(float), pdf.vec_id.to_numpy()
    hit = 0
    for q, g in got.groupby("query_id"):
        score = np.where(ids == q, -np.inf, x @ x[ids == q][0])
        hit += len(set(ids[np.argsort(-score)[:20]]) & set(g.vec_id))
    assert hit / len(got) >= 0.9


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 51), (51, 52), (52, 50)]])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    ids = {i for e in edges for i in e if e[0] != e[1]}
    assert {r["node"]: r["component"] for r in components(df).collect()} == roots(ids, [e for e in edges if e[0] != e[1]])
