"""Every query of the library itself against its SQL on the smallest tables."""

import math

import duckdb
import pytest

from veridra import plans
from veridra.registry import ORACLES, QUERIES
from veridra.session import TABLES

SF = "/root/testdata/sf0.001"
plans.load()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, (int, float)) or hasattr(v, "as_tuple"):
        return "null" if isinstance(v, float) and math.isnan(v) else f"{float(v):.9g}"
    return str(v)


def rows(names, got):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in got)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    sql = duck.execute(ORACLES[name])
    names = [d[0] for d in sql.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, sql.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_random_picks_repeat_and_are_unreviewed(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    reviewed = {r[0] for r in labels.select("doc_id").collect()}
    english = {r[0] for r in docs.where("lang = 'en'").select("doc_id").collect()}
    for name in ("filter_random_unreviewed", "review_next"):
        got = [QUERIES[name](spark, SF).collect() for _ in range(2)]
        assert got[0] == got[1] and len(got[0]) == 1 and got[0][0]["doc_id"] not in reviewed
    assert got[0][0]["doc_id"] in english
    first, again = (sorted(map(tuple, QUERIES["topk_sample_seeded"](spark, SF).collect())) for _ in range(2))
    assert first == again and len(set(first)) == len(first)
