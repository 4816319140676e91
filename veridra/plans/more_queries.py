"""Queries of document building, curated data, fuzzy matching, reviews and build comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import graph as G
from ..operators import linking as L
from ..operators import matching as M
from ..operators import resolve as R
from ..operators import sets as X
from ..registry import Tables, query
from ..session import scratch
from ..sources import files as FS
from .graph_queries import EDGES_SQL, NODES_SQL, edges, foreign_keys, nodes

# ---- building documents from delivered rows


@query("SELECT DISTINCT l_partkey FROM lineitem WHERE l_discount > 0.05 AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 10)")
def link_cited_papers(t):
    bundle = t.part.where("p_size < 10").select(F.col("p_partkey").alias("l_partkey"))
    return t.lineitem.where("l_discount > 0.05").select("l_partkey").distinct().join(bundle, "l_partkey", "left_anti")


@query("SELECT DISTINCT l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_tax > 0.079)")
def link_patent_cited(t):
    claimed = t.lineitem.where("l_tax > 0.079").select("l_suppkey")
    return t.lineitem.select("l_suppkey").distinct().join(claimed, "l_suppkey", "left_anti")


# ---- resolution and curated data


@query("SELECT l_orderkey, l_linenumber, s_suppkey FROM lineitem LEFT JOIN supplier ON s_name = 'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0')")
def er_alignment_members(t):
    label = F.concat(F.lit("seq/x/"), F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0"))
    li = t.lineitem.select("l_orderkey", "l_linenumber", F.regexp_extract(label, r"[^/]+$", 0).alias("s_name"))
    return li.join(t.supplier.select("s_name", "s_suppkey"), "s_name", "left").select("l_orderkey", "l_linenumber", "s_suppkey")


@query("WITH m AS (SELECT l_partkey AS k, arg_min(l_suppkey, (l_orderkey, l_linenumber)) AS s FROM lineitem WHERE l_discount > 0.05 GROUP BY 1) SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN l_discount > 0.05 THEN l_suppkey END, s) AS supplier FROM lineitem LEFT JOIN m ON k = l_partkey")
def er_structures(t):
    own = F.when(F.col("l_discount") > 0.05, F.col("l_suppkey"))
    m = t.lineitem.where("l_discount > 0.05").groupBy("l_partkey").agg(F.min_by("l_suppkey", F.struct("l_orderkey", "l_linenumber")).alias("s"))
    return t.lineitem.join(m, "l_partkey", "left").select("l_orderkey", "l_linenumber", F.coalesce(own, "s").alias("supplier"))


CURATED = [("Brand#11", "steel"), ("Brand#23", "brass"), ("Brand#99", "none")]
CURATED_SQL = ", ".join(f"('{a}', '{b}')" for a, b in CURATED)


def _curated(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(CURATED, "brand string, target string")


@query(f"SELECT p_partkey, target FROM part JOIN (VALUES {CURATED_SQL}) v(brand, target) ON p_brand = brand")
def er_curated_targets(t):
    return t.part.join(F.broadcast(_curated(t)), F.col("p_brand") == F.col("brand")).select("p_partkey", "target")


@query(f"SELECT brand FROM (VALUES {CURATED_SQL}) v(brand, target) WHERE brand NOT IN (SELECT p_brand FROM part)")
def er_curated_conditions(t):
    return _curated(t).join(t.part, F.col("p_brand") == F.col("brand"), "left_anti").select("brand")


@query(f"SELECT target, CAST(count(p_partkey) AS BIGINT) AS parts FROM (VALUES {CURATED_SQL}) v(brand, target) LEFT JOIN part ON p_brand = brand GROUP BY target")
def er_countermeasure_seed(t):
    return _curated(t).join(t.part, F.col("p_brand") == F.col("brand"), "left").groupBy("target").agg(F.count("p_partkey").alias("parts"))


@query("SELECT k, 'EXT_' || lpad(CAST(row_number() OVER (ORDER BY k) AS VARCHAR), 6, '0') AS node FROM (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 25))")
def er_external_nodes(t):
    ext = t.lineitem.select(F.col("l_partkey").alias("k")).distinct().join(t.part.where("p_size < 25").select(F.col("p_partkey").alias("k")), "k", "left_anti")
    n = R.number_entities(ext, ["k"], "k", "i")
    return n.select("k", F.concat(F.lit("EXT_"), F.lpad(F.col("i").cast("string"), 6, "0")).alias("node"))


@query("SELECT DISTINCT a, b FROM (SELECT o_orderkey AS a, o_custkey AS b FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 3 = 0)")
def er_combine_edges(t):
    o = t.orders.select(F.col("o_orderkey").alias("a"), F.col("o_custkey").alias("b"))
    return o.where("a % 2 = 0").unionByName(o.where("a % 3 = 0"), allowMissingColumns=True).dropDuplicates(["a", "b"])


# ---- fuzzy matching


# ---- sinks, comparison and reviews


@query(f"SELECT label, CAST(count(*) AS BIGINT) AS n FROM ({NODES_SQL}) GROUP BY label")
def sink_graph_nodes(t):
    path = scratch(t.spark)
    nodes(t).write.partitionBy("label").parquet(path)
    return t.spark.read.parquet(path).groupBy(F.col("label").cast("string").alias("label")).agg(F.count("*").alias("n"))


@query(f"SELECT type, CAST(count(*) AS BIGINT) AS n FROM ({EDGES_SQL}) GROUP BY type")
def sink_graph_edges(t):
    path = scratch(t.spark)
    edges(t).write.partitionBy("type").parquet(path)
    return t.spark.read.parquet(path).groupBy(F.col("type").cast("string").alias("type")).agg(F.count("*").alias("n"))


@query("SELECT 'orders' AS dependant, CAST(count(*) AS BIGINT) AS rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem")
def sink_truncate_cascade_report(t):
    hit = G.closure(foreign_keys(t), "child", "parent").where("ancestor = 'customer' AND hops > 0")
    names = [r["node"] for r in hit.select("node").distinct().collect()]
    parts = [getattr(t, n).agg(F.count("*").alias("rows")).select(F.lit(n).alias("dependant"), "rows") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("SELECT r_regionkey AS id, upper(r_name) AS name FROM region WHERE r_regionkey < 4")
def sink_upsert_vocab(t):
    old = t.region.where("r_regionkey < 2").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    new = t.region.where("r_regionkey < 4").select(F.col("r_regionkey").alias("id"), F.upper("r_name").alias("name"))
    return R.upsert_coalesce(old, new, "id", keep_old=False).join(new.select("id"), "id", "left_semi")


@query("SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0 OR c_custkey IN (SELECT o_custkey FROM orders)")
def sink_delete_stale(t):
    kept = t.customer.where("c_custkey % 2 = 0").select("c_custkey").union(t.orders.select("o_custkey")).distinct()
    return t.customer.select("c_custkey").join(kept, "c_custkey", "left_semi")


@query("""SELECT 'customer' AS tab, CAST(count(*) FILTER (WHERE c_custkey % 10 = 0) AS BIGINT) AS only_first, CAST(0 AS BIGINT) AS only_second FROM customer""")
def cmp_multiset_diff(t):
    d = X.multiset_diff(t.customer, t.customer.where("c_custkey % 10 <> 0"))
    count = lambda s: F.coalesce(F.sum(F.when(F.col("side") == s, F.col("n"))), F.lit(0))
    return d.agg(count("first").alias("only_first"), count("second").alias("only_second")).select(F.lit("customer").alias("tab"), "only_first", "only_second")


@query()
def filter_random_unreviewed(t):
    """A seeded random document that nobody has reviewed; the order is Spark's hash."""
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left_anti").orderBy(F.xxhash64(F.lit(3), "doc_id"), "doc_id").limit(1)


@query()
def review_next(t):
    """The same, among documents of one language."""
    d = t.documents.where("lang = 'en'").select("doc_id")
    return d.join(t.labels, "doc_id", "left_anti").orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(1)


@query("SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 1 - quality ELSE quality END AS quality FROM labels")
def review_record(t):
    new = t.labels.where("doc_id % 5 = 0").select("doc_id", (1 - F.col("quality")).alias("quality"))
    return R.upsert_coalesce(t.labels.select("doc_id", "quality"), new, "doc_id", keep_old=False)


@query("SELECT lang, CAST(count(*) AS BIGINT) AS available, CAST(count(quality) AS BIGINT) AS reviewed, CAST(coalesce(sum(quality), 0) AS BIGINT) AS accepted FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang")
def review_stats(t):
    d = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return d.groupBy("lang").agg(F.count("*").alias("available"), F.count("quality").alias("reviewed"), F.coalesce(F.sum("quality"), F.lit(0)).alias("accepted"))


# ---- more readers


@query("SELECT CAST(r_regionkey AS VARCHAR) AS r_regionkey, r_name FROM region")
def scan_utf8_bom(t):
    path = scratch(t.spark)
    lines = t.region.select(F.concat_ws(",", F.col("r_regionkey").cast("string"), "r_name").alias("value"))
    bom = t.spark.createDataFrame([("﻿r_regionkey,r_name",)], "value string")
    bom.unionByName(lines).coalesce(1).write.text(path)
    return FS.read_text_csv(t.spark, path)


@query("SELECT 'nation' AS stem, CAST(count(*) AS BIGINT) AS rows FROM nation UNION ALL SELECT 'region', count(*) FROM region")
def scan_csv_glob(t):
    base = scratch(t.spark)
    for name in ("nation", "region"):
        getattr(t, name).write.option("header", True).csv(f"{base}/{name}.csv")
    got = t.spark.read.option("header", False).text(f"{base}/*.csv").where("value NOT LIKE '%_regionkey%'")
    stem = F.regexp_extract(F.input_file_name(), r"/([^/]+)\.csv/", 1)
    return got.groupBy(stem.alias("stem")).agg(F.count("*").alias("rows"))
