"""Queries of joins, resolution, aggregation, windows, ordering and sets over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import joins as J
from ..operators import resolve as R
from ..operators import sets as X
from ..registry import Tables, query
from ..session import stored

# ---- joins


@query("""SELECT o_orderkey, CASE WHEN o_custkey IS NULL THEN 'blank key' WHEN c_custkey IS NULL THEN 'no customer' END AS unmatched
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) ON o_custkey = c_custkey""")
def join_hash_lookup(t):
    dim = t.customer.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("o_custkey"))
    return J.lookup(t.orders.select("o_orderkey", "o_custkey"), dim, "o_custkey", "no customer").select("o_orderkey", "unmatched")


@query("SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def join_left_enrich(t):
    n = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return t.customer.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "n_name", "r_name")


@query("""SELECT l_orderkey, l_linenumber, coalesce(a.p_name, b.p_name) AS name FROM lineitem
LEFT JOIN (SELECT * FROM part WHERE p_size < 20) a ON l_partkey = a.p_partkey LEFT JOIN (SELECT * FROM part WHERE p_size < 20) b ON l_suppkey = b.p_partkey""")
def join_left_fallback(t):
    dim = t.part.where("p_size < 20")
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return J.fallback(li, dim, ["l_partkey", "l_suppkey"], "p_partkey", "p_name", "name").select("l_orderkey", "l_linenumber", "name")


@query("""SELECT e.k, CAST(count(*) AS BIGINT) AS n FROM (SELECT CASE WHEN value > 50 THEN event_type END AS k FROM events) e
JOIN (SELECT DISTINCT CASE WHEN value > 50 THEN event_type END AS k FROM events) d ON e.k IS NOT DISTINCT FROM d.k GROUP BY e.k""")
def join_null_safe(t):
    e = t.events.select(F.when(F.col("value") > 50, F.col("event_type")).alias("k"))
    d = e.distinct().withColumnRenamed("k", "dk")
    return e.join(d, F.col("k").eqNullSafe(F.col("dk"))).groupBy("k").agg(F.count("*").alias("n"))


@query("""SELECT p_partkey, coalesce(s1.s_suppkey, s2.s_suppkey, s3.s_suppkey) AS supplier FROM part
LEFT JOIN supplier s1 ON p_partkey = s1.s_suppkey LEFT JOIN supplier s2 ON p_size = s2.s_suppkey LEFT JOIN supplier s3 ON p_partkey % 10 + 1 = s3.s_suppkey""")
def join_multi_key_first(t):
    p = t.part.select("p_partkey", "p_size", (F.col("p_partkey") % 10 + 1).alias("k3"))
    return J.fallback(p, t.supplier, ["p_partkey", "p_size", "k3"], "s_suppkey", "s_suppkey", "supplier").select("p_partkey", "supplier")


@query("SELECT o_orderkey, coalesce((SELECT r_regionkey FROM region WHERE r_regionkey = o_orderkey % 7), o_custkey % 5) AS r FROM orders")
def join_explode_multivalue(t):
    ids = F.concat_ws("|", (F.col("o_orderkey") % 7).cast("string"), (F.col("o_custkey") % 5).cast("string"))
    dim = t.region.select(F.col("r_regionkey").cast("string").alias("r"))
    out = J.first_of_list(t.orders.select("o_orderkey", ids.alias("ids")), dim, "ids", "r", "o_orderkey")
    return out.select("o_orderkey", F.col("r").cast("long").alias("r"))


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 100000)")
def join_semi_exists(t):
    big = t.orders.where("o_totalprice > 100000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey").join(big, "c_custkey", "left_semi")


@query("""WITH refs AS (SELECT DISTINCT 'part' AS kind, CAST(l_partkey + 5 AS VARCHAR) AS ident FROM lineitem UNION SELECT DISTINCT 'supplier', CAST(l_suppkey + 3 AS VARCHAR) FROM lineitem)
SELECT kind, ident FROM refs WHERE NOT (kind = 'part' AND ident IN (SELECT CAST(p_partkey AS VARCHAR) FROM part)) AND NOT (kind = 'supplier' AND ident IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier))""")
def join_anti_orphans(t):
    refs = t.lineitem.select(F.lit("part").alias("kind"), (F.col("l_partkey") + 5).cast("string").alias("ident")).union(
        t.lineitem.select(F.lit("supplier"), (F.col("l_suppkey") + 3).cast("string"))).distinct()
    return J.orphans(refs, {"part": t.part.select("p_partkey"), "supplier": t.supplier.select("s_suppkey")}, "kind", "ident")


@query("""SELECT o_custkey, o_orderkey, next_value FROM (SELECT o_custkey, o_orderkey, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_value FROM orders) WHERE next_value IS NOT NULL""")
def join_self_consecutive(t):
    return J.consecutive(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderkey")


@query("SELECT o_custkey, o_orderkey, next_value FROM (SELECT o_custkey, o_orderkey, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS next_value FROM orders) WHERE next_value IS NOT NULL")
def win_consecutive(t):
    return J.consecutive(t.orders, ["o_custkey"], ["o_orderkey"], "o_orderkey")


@query("SELECT a.o_orderkey AS a, b.o_orderkey AS b FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderstatus = 'O' AND b.o_orderstatus = 'F'")
def join_self_pairs(t):
    a = t.orders.where("o_orderstatus = 'O'").select("o_custkey", F.col("o_orderkey").alias("a"))
    b = t.orders.where("o_orderstatus = 'F'").select("o_custkey", F.col("o_orderkey").alias("b"))
    return a.join(b, "o_custkey").select("a", "b")


@query("SELECT DISTINCT least(l_partkey, l_suppkey) AS a, greatest(l_partkey, l_suppkey) AS b FROM lineitem WHERE l_partkey <> l_suppkey")
def join_bidirectional_edges(t):
    return J.undirected(t.lineitem.select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b")), "a", "b")


@query("""WITH w AS (SELECT p_partkey, p_brand, list_distinct(string_split(lower(p_name), ' ')) AS t FROM part)
SELECT a.p_partkey AS a, b.p_partkey AS b FROM w a JOIN w b ON a.p_brand = b.p_brand AND a.p_partkey < b.p_partkey WHERE 2 * len(list_intersect(a.t, b.t)) >= len(a.t)""")
def join_token_overlap(t):
    """Sets of words are compared once for all parts of a brand that have them; then lists of their parts meet, and pairs are made where they are read."""
    w = t.part.select("p_partkey", "p_brand", F.array_sort(F.array_distinct(F.split(F.lower("p_name"), " "))).alias("t"))
    sets = w.select("p_brand", "t").distinct()
    a, b = sets.select("p_brand", F.col("t").alias("ta")), sets.select("p_brand", F.col("t").alias("tb"))
    pairs = a.join(b, "p_brand").where(J.token_overlap(F.col("ta"), F.col("tb")))
    # a pair needs its lists once, not a row for each part and set
    parts = stored(J.listed(w, ["p_brand", "t"], "p_partkey"))
    left = parts.select("p_brand", F.col("t").alias("ta"), F.col("range").alias("ra"), F.col("values").alias("as")).join(pairs, ["p_brand", "ta"])
    left = left.select(F.struct("p_brand", "tb").alias("met"), "ra", "as")
    right = parts.select(F.struct("p_brand", F.col("t").alias("tb")).alias("met"), F.col("range").alias("rb"), F.col("values").alias("bs"))
    both = J.dealt_join(left, right, "met", 8).where(F.col("ra") <= F.col("rb"))
    return both.select(F.explode("as").alias("a"), "bs").select("a", F.explode("bs").alias("b")).where(F.col("a") < F.col("b"))


@query("""SELECT l_orderkey, l_linenumber, min(p_partkey) AS p_partkey FROM lineitem JOIN part ON 'P' || l_partkey = 'P' || p_partkey GROUP BY l_orderkey, l_linenumber""")
def join_versioned_accession(t):
    li = t.lineitem.select("l_orderkey", "l_linenumber", S.base_accession(F.concat(F.lit("P"), F.col("l_partkey").cast("string"), F.lit("."), F.col("l_linenumber").cast("string"))).alias("acc"))
    p = t.part.select("p_partkey", S.base_accession(F.concat(F.lit("P"), F.col("p_partkey").cast("string"), F.lit(".1"))).alias("acc"))
    return li.join(p, "acc").groupBy("l_orderkey", "l_linenumber").agg(F.min("p_partkey").alias("p_partkey"))


@query("SELECT DISTINCT c_custkey, s_suppkey FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN supplier ON s_nationkey = n_nationkey WHERE c_acctbal < 0")
def join_natural_key_symbol(t):
    n = t.nation.select("n_nationkey", "n_name")
    # a key with all its names: pairs come from the first name that both have, so they are distinct as they are
    own = lambda df, k, names: df.groupBy(k).agg(F.collect_set("n_name").alias(names)).select(k, names, F.explode(names).alias("n_name"))
    c = own(t.customer.where("c_acctbal < 0").join(n, F.col("c_nationkey") == F.col("n_nationkey")), "c_custkey", "cs")
    s = own(t.supplier.join(n, F.col("s_nationkey") == F.col("n_nationkey")), "s_suppkey", "ss")
    both = J.dealt_join(c, s, "n_name").where(F.array_min(F.array_intersect("cs", "ss")) == F.col("n_name"))
    return both.select("c_custkey", "s_suppkey")


@query("SELECT l_orderkey, l_linenumber, c_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE l_discount > 0.05")
def join_via_provenance(t):
    o = t.orders.select("o_orderkey", "o_custkey").join(t.customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
    return t.lineitem.where("l_discount > 0.05").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", "c_name")


@query("""SELECT c_custkey AS id, 'customer' AS kind, CAST(count(o_orderkey) AS BIGINT) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey
UNION ALL SELECT s_suppkey, 'supplier', CAST(count(l_orderkey) AS BIGINT) FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY s_suppkey""")
def join_lateral_union(t):
    a = t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left").groupBy(F.col("c_custkey").alias("id")).agg(F.count("o_orderkey").alias("n"))
    b = t.supplier.join(t.lineitem, F.col("l_suppkey") == F.col("s_suppkey"), "left").groupBy(F.col("s_suppkey").alias("id")).agg(F.count("l_orderkey").alias("n"))
    return a.select("id", F.lit("customer").alias("kind"), "n").unionByName(b.select("id", F.lit("supplier").alias("kind"), "n"))


@query("SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey")
def join_optional(t):
    return t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left").select("c_custkey", "o_orderkey")


@query("""WITH r AS (SELECT o_custkey, o_orderkey, first_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_orderdate DESC, o_orderkey) AS canonical FROM orders)
SELECT DISTINCT o_orderkey, canonical FROM r WHERE o_orderkey <> canonical""")
def join_dedup_genome(t):
    rank = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return R.canonical(t.orders, "o_custkey", "o_orderkey", [rank, F.col("o_orderdate").desc(), F.col("o_orderkey")])


# ---- resolution


@query("""SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN l_discount > 0.05 THEN l_discount END, CASE WHEN l_tax > 0.04 THEN l_tax END) AS value,
CASE WHEN l_discount > 0.05 THEN 'discount' WHEN l_tax > 0.04 THEN 'tax' END AS source FROM lineitem""")
def er_pick_field(t):
    value, source = R.pick_field([("discount", F.when(F.col("l_discount") > 0.05, F.col("l_discount"))), ("tax", F.when(F.col("l_tax") > 0.04, F.col("l_tax")))])
    return t.lineitem.select("l_orderkey", "l_linenumber", value.alias("value"), source.alias("source"))


@query("""SELECT p_partkey, 'name' AS field, CASE WHEN p_size > 25 THEN 'brand' ELSE 'name' END AS source FROM part
UNION ALL SELECT p_partkey, 'price', 'retail' FROM part WHERE p_retailprice > 1000""")
def er_field_provenance(t):
    return R.field_provenance(t.part, "p_partkey", {
        "name": [("brand", F.when(F.col("p_size") > 25, F.col("p_brand"))), ("name", F.col("p_name"))],
        "price": [("retail", F.when(F.col("p_retailprice") > 1000, F.col("p_retailprice")))],
    })


@query("""WITH a AS (SELECT c_custkey AS k, c_name AS name, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS bal FROM customer WHERE c_custkey % 2 = 0),
b AS (SELECT c_custkey AS k, upper(c_name) AS name, c_acctbal AS bal FROM customer WHERE c_custkey % 3 = 0)
SELECT coalesce(a.k, b.k) AS k, coalesce(a.name, b.name) AS name, coalesce(b.bal, a.bal) AS bal, CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN 'both' WHEN a.k IS NOT NULL THEN 'a' ELSE 'b' END AS sources FROM a FULL JOIN b ON a.k = b.k""")
def er_merge_sources(t):
    a = t.customer.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("bal"))
    b = t.customer.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("k"), F.upper("c_name").alias("name"), F.col("c_acctbal").alias("bal"))
    return R.merge_sources(a, b, "k", {"name": "a", "bal": "b"})


@query("""WITH c AS (SELECT c_custkey, min(c_custkey) OVER (PARTITION BY c_nationkey, c_mktsegment) AS canonical FROM customer)
SELECT o_orderkey, canonical AS customer FROM orders JOIN c ON o_custkey = c_custkey""")
def er_fold_duplicates(t):
    c = t.customer.select("c_custkey", F.min("c_custkey").over(Window.partitionBy("c_nationkey", "c_mktsegment")).alias("customer"))
    return t.orders.join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "customer")


@query("SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS kept, CAST(sum(n) - count(*) AS BIGINT) AS dropped FROM (SELECT l_returnflag, l_linestatus, l_shipdate, count(*) AS n FROM lineitem GROUP BY ALL)")
def er_exact_dedupe_count(t):
    return R.exact_dedupe(t.lineitem.select("l_returnflag", "l_linestatus", "l_shipdate"))


@query("SELECT p_brand, p_type, CAST(row_number() OVER (ORDER BY min(p_partkey), p_brand, p_type) AS BIGINT) AS entity_id FROM part GROUP BY p_brand, p_type")
def er_get_or_create(t):
    return R.number_entities(t.part, ["p_brand", "p_type"], "p_partkey", "entity_id")


@query("SELECT o_custkey, CAST(row_number() OVER (ORDER BY min(o_orderkey), o_custkey) AS BIGINT) AS id FROM orders GROUP BY o_custkey")
def win_running_ids(t):
    return R.number_entities(t.orders, ["o_custkey"], "o_orderkey", "id")


@query("""SELECT p_partkey, kind, total FROM (SELECT p_partkey, unnest(['size', 'price']) AS kind, unnest([CAST(p_size AS VARCHAR), split_part(CAST(CAST(p_retailprice AS BIGINT) AS VARCHAR) || '/' || p_size, '/', 2)]) AS total FROM part)""")
def er_epitopes_unpivot(t):
    both = F.concat_ws("/", F.round("p_retailprice").cast("long").cast("string"), F.col("p_size").cast("string"))
    wide = t.part.select("p_partkey", F.col("p_size").cast("string").alias("size"), F.split_part(both, F.lit("/"), F.lit(-1)).alias("price"))
    return wide.unpivot("p_partkey", ["size", "price"], "kind", "total")


@query("""WITH f(name, family) AS (VALUES ('brand#11', 'F1'), ('brand#23', 'F2'), ('standard', 'F3'), ('economy', 'F4'))
SELECT p_partkey, coalesce(a.family, b.family) AS family, CASE WHEN a.family IS NOT NULL THEN 'label' WHEN b.family IS NOT NULL THEN 'fallback' END AS basis
FROM part LEFT JOIN f a ON lower(trim(p_brand)) = a.name LEFT JOIN f b ON lower(split_part(p_type, ' ', 1)) = b.name""")
def er_family_assign(t):
    index = t.spark.createDataFrame([("Brand#11", "F1"), ("Brand#23", "F2"), ("STANDARD", "F3"), ("ECONOMY", "F4")], "name string, family string")
    p = t.part.withColumn("word", F.split_part("p_type", F.lit(" "), F.lit(1)))
    return R.assign_by_label(p, "p_brand", "word", F.broadcast(index), "name", "family").select("p_partkey", "family", "basis")


@query("SELECT n_nationkey, CASE WHEN regexp_matches(n_name, 'UNITED|STATE') THEN 'government' WHEN regexp_matches(n_name, 'IA$') THEN 'ia' ELSE 'other' END AS kind FROM nation")
def er_org_kind(t):
    return t.nation.select("n_nationkey", S.first_rule(F.col("n_name"), [("UNITED|STATE", "government"), ("IA$", "ia")], "other").alias("kind"))


@query("""SELECT p_brand, p_type AS display FROM (SELECT p_brand, p_type, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, length(p_type), p_type) AS rn FROM part GROUP BY p_brand, p_type) WHERE rn = 1""")
def er_org_display(t):
    g = t.part.groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))
    return g.groupBy("p_brand").agg(F.min_by("p_type", F.struct(-F.col("n"), F.length("p_type"), "p_type")).alias("display"))


@query("""WITH u AS (SELECT o_custkey AS k, arg_min(o_orderpriority, o_orderkey) AS note FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
SELECT c_custkey, coalesce(CASE WHEN c_acctbal > 5000 THEN c_mktsegment END, note) AS note FROM customer LEFT JOIN u ON k = c_custkey""")
def er_update_coalesce(t):
    u = t.orders.where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min_by("o_orderpriority", "o_orderkey").alias("new"))
    c = t.customer.join(u, "c_custkey", "left")
    return c.select("c_custkey", F.coalesce(F.when(F.col("c_acctbal") > 5000, F.col("c_mktsegment")), "new").alias("note"))


@query("""WITH o AS (SELECT c_custkey AS k, c_name AS ident FROM customer WHERE c_custkey % 2 = 0), n AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 2 <> 0),
m AS (SELECT max(CAST(regexp_extract(ident, '(\\d+)$', 1) AS BIGINT)) AS m FROM o)
SELECT k, ident FROM o UNION ALL SELECT k, 'NEW_' || lpad(CAST(m + row_number() OVER (ORDER BY k) AS VARCHAR), 6, '0') FROM n, m""")
def er_expand_dataset(t):
    old = t.customer.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("ident"))
    return R.expand_dataset(old, t.customer.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("k")), "k", "ident", 6)


@query("""WITH o AS (SELECT c_custkey AS k, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS v FROM customer WHERE c_custkey % 2 = 0), n AS (SELECT c_custkey AS k, 1.5 AS v FROM customer WHERE c_custkey % 3 = 0)
SELECT coalesce(o.k, n.k) AS k, CAST(coalesce(o.v, n.v) AS DOUBLE) AS v FROM o FULL JOIN n ON o.k = n.k""")
def sink_upsert_fill(t):
    old = t.customer.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("v"))
    return R.upsert_coalesce(old, t.customer.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("k"), F.lit(1.5).alias("v")), "k")


@query("SELECT p_partkey, coalesce(nullif(trim(CASE WHEN p_size < 10 THEN '' ELSE p_brand END), ''), p_type) AS filled FROM part")
def er_backfill_blank(t):
    return t.part.select("p_partkey", F.coalesce(S.blank_to_none(F.when(F.col("p_size") < 10, "").otherwise(F.col("p_brand"))), "p_type").alias("filled"))


# ---- aggregates and windows


@query("""WITH y AS (SELECT l_orderkey, CAST(year(l_shipdate) AS INTEGER) AS fy, bool_or(l_linenumber = 1) AS has_parent, sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE l_linenumber = 1) AS parent_amount, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS all_amount FROM lineitem GROUP BY l_orderkey, fy)
SELECT l_orderkey, CAST(sum(CASE WHEN has_parent THEN parent_amount ELSE all_amount END) AS DOUBLE) AS total, bool_or(NOT has_parent) AS partial FROM y GROUP BY l_orderkey""")
def agg_award_total(t):
    amount, parent = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_linenumber") == 1
    y = t.lineitem.groupBy("l_orderkey", F.year("l_shipdate").alias("fy")).agg(
        F.bool_or(parent).alias("has_parent"), F.sum(F.when(parent, amount)).alias("parent_amount"), F.sum(amount).alias("all_amount"))
    total = F.sum(F.when(F.col("has_parent"), F.col("parent_amount")).otherwise(F.col("all_amount"))).cast("double")
    return y.groupBy("l_orderkey").agg(total.alias("total"), F.bool_or(~F.col("has_parent")).alias("partial"))


@query("SELECT o_custkey, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS first_priority, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS last_status FROM orders GROUP BY o_custkey")
def agg_group_first(t):
    at = F.struct("o_orderdate", "o_orderkey")
    return t.orders.groupBy("o_custkey").agg(F.min_by("o_orderpriority", at).alias("first_priority"), F.max_by("o_orderstatus", at).alias("last_status"))


@query("SELECT l_partkey, CAST(min(year(l_shipdate)) AS INTEGER) AS first_year, CAST(max(year(l_shipdate)) AS INTEGER) AS last_year FROM lineitem GROUP BY l_partkey")
def agg_min_max_year(t):
    return t.lineitem.groupBy("l_partkey").agg(F.min(F.year("l_shipdate")).alias("first_year"), F.max(F.year("l_shipdate")).alias("last_year"))


@query("SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ';' ORDER BY c_mktsegment) AS segments FROM customer GROUP BY c_nationkey")
def agg_xref_pivot(t):
    return t.customer.groupBy("c_nationkey").agg(F.array_join(F.array_sort(F.collect_set("c_mktsegment")), ";").alias("segments"))


@query("SELECT l_partkey, CAST(count(DISTINCT l_suppkey) AS BIGINT) AS suppliers, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS orders FROM lineitem GROUP BY l_partkey")
def agg_count_distinct(t):
    return t.lineitem.groupBy("l_partkey").agg(F.countDistinct("l_suppkey").alias("suppliers"), F.countDistinct("l_orderkey").alias("orders"))


@query("SELECT l_partkey, CAST(count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS BIGINT) AS returned, CAST(count(DISTINCT CASE WHEN l_returnflag <> 'R' THEN l_orderkey END) AS BIGINT) AS kept FROM lineitem GROUP BY l_partkey")
def agg_conditional_distinct(t):
    r = F.col("l_returnflag") == "R"
    return t.lineitem.groupBy("l_partkey").agg(F.countDistinct(F.when(r, F.col("l_orderkey"))).alias("returned"), F.countDistinct(F.when(~r, F.col("l_orderkey"))).alias("kept"))


@query("SELECT o_custkey, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 10")
def agg_having(t):
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).where("n > 10")


@query("SELECT CAST(coalesce(sum(n) - count(*), 0) AS BIGINT) AS excess FROM (SELECT o_custkey, o_orderdate, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) > 1)")
def agg_duplicates_excess(t):
    g = t.orders.groupBy("o_custkey", "o_orderdate").agg(F.count("*").alias("n")).where("n > 1")
    return g.agg(F.coalesce(F.sum("n") - F.count("*"), F.lit(0)).alias("excess"))


@query("SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY event_type ORDER BY n DESC, event_type LIMIT 3")
def agg_value_counts(t):
    return t.events.groupBy("event_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "event_type").limit(3)


@query("SELECT upper(p_name) AS name, min(p_partkey) AS id FROM part GROUP BY upper(p_name)")
def agg_min_id_per_key(t):
    return t.part.groupBy(F.upper("p_name").alias("name")).agg(F.min("p_partkey").alias("id"))


@query("SELECT l_returnflag, l_linestatus, l_linenumber, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY ALL")
def agg_multiset_counter(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(F.count("*").alias("n"))


@query("""SELECT coalesce(CASE WHEN c_acctbal > 0 THEN n_name END, '(not recorded)') AS country, CAST(count(*) AS BIGINT) AS n, CAST(min(year(o_orderdate)) AS INTEGER) AS lo, CAST(max(year(o_orderdate)) AS INTEGER) AS hi
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def agg_country_years(t):
    d = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    country = F.coalesce(F.when(F.col("c_acctbal") > 0, F.col("n_name")), F.lit("(not recorded)"))
    y = F.year("o_orderdate")
    return d.groupBy(country.alias("country")).agg(F.count("*").alias("n"), F.min(y).alias("lo"), F.max(y).alias("hi"))


@query("""SELECT o_custkey, CAST(count(DISTINCT CASE WHEN o_orderdate < TIMESTAMP '1995-06-01' THEN o_orderkey END) AS BIGINT) AS before, CAST(count(DISTINCT CASE WHEN o_orderdate >= TIMESTAMP '1995-06-01' THEN o_orderkey END) AS BIGINT) AS after,
CAST(min(CASE WHEN o_orderstatus = 'F' THEN year(o_orderdate) END) AS INTEGER) AS first_year FROM orders GROUP BY o_custkey""")
def agg_pi_summary(t):
    before = F.col("o_orderdate") < F.lit("1995-06-01").cast("timestamp")
    return t.orders.groupBy("o_custkey").agg(
        F.countDistinct(F.when(before, F.col("o_orderkey"))).alias("before"), F.countDistinct(F.when(~before, F.col("o_orderkey"))).alias("after"),
        F.min(F.when(F.col("o_orderstatus") == "F", F.year("o_orderdate"))).alias("first_year"))


REVIEWS = "SELECT source, lang, quality, toxic FROM documents JOIN labels USING (doc_id)"


@query(f"SELECT lang, CAST(count(*) AS BIGINT) AS reviewed, CAST(sum(quality) AS BIGINT) AS accepted, round(sum(quality) / count(*), 4) AS precision FROM ({REVIEWS}) GROUP BY lang")
def agg_review_precision(t):
    d = t.documents.select("doc_id", "lang").join(t.labels, "doc_id")
    return d.groupBy("lang").agg(F.count("*").alias("reviewed"), F.sum("quality").alias("accepted"), F.round(F.sum("quality") / F.count("*"), 4).alias("precision"))


@query(f"SELECT source, CAST(count(*) FILTER (WHERE quality = 1 AND toxic = 1) AS BIGINT) AS both, CAST(count(*) FILTER (WHERE quality = 1 AND toxic = 0) AS BIGINT) AS first_only, CAST(count(*) FILTER (WHERE quality = 0 AND toxic = 1) AS BIGINT) AS second_only FROM ({REVIEWS}) GROUP BY source")
def agg_confusion(t):
    d = t.documents.select("doc_id", "source").join(t.labels, "doc_id")
    a, b = F.col("quality") == 1, F.col("toxic") == 1
    return d.groupBy("source").agg(F.count_if(a & b).alias("both"), F.count_if(a & ~b).alias("first_only"), F.count_if(~a & b).alias("second_only"))


@query(f"""WITH g AS (SELECT lang, CAST(sum(quality) AS DOUBLE) AS k, CAST(count(*) AS DOUBLE) AS n FROM ({REVIEWS}) GROUP BY lang)
SELECT lang, round((k/n + 3.8416/(2*n))/(1+3.8416/n) - 1.96/(1+3.8416/n)*sqrt(k/n*(1-k/n)/n + 3.8416/(4*n*n)), 6) AS lo, round((k/n + 3.8416/(2*n))/(1+3.8416/n) + 1.96/(1+3.8416/n)*sqrt(k/n*(1-k/n)/n + 3.8416/(4*n*n)), 6) AS hi FROM g""")
def agg_wilson(t):
    g = t.documents.select("doc_id", "lang").join(t.labels, "doc_id").groupBy("lang").agg(F.sum("quality").cast("double").alias("k"), F.count("*").cast("double").alias("n"))
    lo, hi = X.wilson(F.col("k"), F.col("n"))
    return g.select("lang", F.round(lo, 6).alias("lo"), F.round(hi, 6).alias("hi"))


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1")
def win_first_per_key(t):
    return R.first_per_key(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("SELECT o_orderkey, round((rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice) - 1) / count(*) OVER (PARTITION BY o_custkey), 6) AS percentile FROM orders")
def win_percentile_rank(t):
    w = Window.partitionBy("o_custkey")
    return t.orders.select("o_orderkey", F.round((F.rank().over(w.orderBy("o_totalprice")) - 1) / F.count("*").over(w), 6).alias("percentile"))


@query("SELECT l_partkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rn FROM lineitem) WHERE rn = 1")
def win_best_per_group(t):
    return R.first_per_key(t.lineitem.withColumn("neg", -F.col("l_extendedprice")), ["l_partkey"], ["neg", "l_orderkey", "l_linenumber"]).select("l_partkey", "l_orderkey", "l_linenumber")


@query("SELECT l_orderkey, l_linenumber, bool_or(l_returnflag = 'R') OVER (PARTITION BY l_orderkey) AS any_returned FROM lineitem")
def win_group_flag(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", F.bool_or(F.col("l_returnflag") == "R").over(Window.partitionBy("l_orderkey")).alias("any_returned"))


@query("SELECT p_partkey FROM (SELECT p_partkey, count(*) OVER (PARTITION BY p_brand, p_size) AS n FROM part) WHERE n = 1")
def win_unique_name(t):
    return t.part.withColumn("n", F.count("*").over(Window.partitionBy("p_brand", "p_size"))).where("n = 1").select("p_partkey")


@query("SELECT c_custkey, 'EXT_' || lpad(CAST(1000 + row_number() OVER (ORDER BY c_custkey) AS VARCHAR), 6, '0') AS ident FROM customer")
def win_sequential_ids(t):
    n = R.number_entities(t.customer, ["c_custkey"], "c_custkey", "i")
    return n.select("c_custkey", F.concat(F.lit("EXT_"), F.lpad((F.col("i") + 1000).cast("string"), 6, "0")).alias("ident"))


# ---- order


@query("SELECT o_orderkey, o_orderstatus FROM orders ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_totalprice DESC, o_orderkey LIMIT 50")
def topk_status_order(t):
    rank = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return t.orders.orderBy(rank, F.desc("o_totalprice"), "o_orderkey").limit(50).select("o_orderkey", "o_orderstatus")


@query("""SELECT doc_id, score FROM (SELECT p_partkey AS doc_id, CASE WHEN lower(p_name) = 'part 1' THEN 40 WHEN starts_with(lower(p_name), 'part 1') THEN 30 WHEN regexp_matches(lower(p_name), '\\b1') THEN 20 WHEN contains(lower(p_name), '1') THEN 10 ELSE 0 END AS score FROM part) WHERE score > 0 ORDER BY score DESC, doc_id LIMIT 50""")
def topk_search_rank(t):
    n = F.lower("p_name")
    score = F.when(n == "part 1", 40).when(n.startswith("part 1"), 30).when(n.rlike(r"\b1"), 20).when(n.contains("1"), 10).otherwise(0)
    return t.part.select(F.col("p_partkey").alias("doc_id"), score.alias("score")).where("score > 0").orderBy(F.desc("score"), "doc_id").limit(50)


@query("SELECT p_brand, p_partkey, p_name, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY lower(p_name), p_name, p_partkey) AS BIGINT) AS place FROM part")
def topk_case_tie_sort(t):
    """Names in order whatever their case, with ties settled; a brand of any size is sorted by ranges."""
    d = t.part.select("p_brand", "p_partkey", "p_name", F.lower("p_name").alias("_low"))
    return R.places(d, "p_brand", ["_low", "p_name", "p_partkey"], "place").drop("_low")


@query()
def topk_sample_seeded(t):
    """Three documents of each source by a seeded hash; the hash is Spark's, so SQL can't repeat it."""
    w = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(7), "doc_id"), "doc_id")
    return t.documents.select("source", "doc_id", F.row_number().over(w).alias("rn")).where("rn <= 3").select("source", "doc_id")


# ---- sets


@query("SELECT 'c' AS kind, c_nationkey AS n FROM customer UNION ALL SELECT 's', s_nationkey FROM supplier")
def set_union_all(t):
    return t.customer.select(F.lit("c").alias("kind"), F.col("c_nationkey").alias("n")).unionByName(t.supplier.select(F.lit("s").alias("kind"), F.col("s_nationkey").alias("n")))


@query("SELECT c_nationkey AS n FROM customer UNION SELECT s_nationkey FROM supplier")
def set_union_distinct(t):
    return t.customer.select(F.col("c_nationkey").alias("n")).union(t.supplier.select("s_nationkey")).distinct()


@query("SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders")
def set_difference_ids(t):
    return t.customer.select("c_custkey").join(t.orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


@query("SELECT c_nationkey AS n FROM customer WHERE c_acctbal > 9000 INTERSECT SELECT s_nationkey FROM supplier")
def set_intersect_keys(t):
    return t.customer.where("c_acctbal > 9000").select(F.col("c_nationkey").alias("n")).intersect(t.supplier.select("s_nationkey"))


@query("""WITH a AS (SELECT l_returnflag AS f, l_linenumber AS n FROM lineitem WHERE l_orderkey % 2 = 0), b AS (SELECT l_returnflag AS f, l_linenumber AS n FROM lineitem WHERE l_orderkey % 2 = 1),
u AS (SELECT f, n, sum(w) AS net FROM (SELECT *, 1 AS w FROM a UNION ALL SELECT *, -1 FROM b) GROUP BY f, n)
SELECT f, n AS line, CASE WHEN net > 0 THEN 'first' ELSE 'second' END AS side, CAST(abs(net) AS BIGINT) AS n FROM u WHERE net <> 0""")
def set_multiset_diff(t):
    li = t.lineitem.select("l_orderkey", F.col("l_returnflag").alias("f"), F.col("l_linenumber").alias("line"))
    return X.multiset_diff(li.where("l_orderkey % 2 = 0").drop("l_orderkey"), li.where("l_orderkey % 2 = 1").drop("l_orderkey"))


def _sets(t: Tables) -> DataFrame:
    a = t.lineitem.groupBy("l_orderkey").agg(F.collect_set(F.col("l_partkey") % 7).alias("a"))
    b = t.lineitem.where("l_discount > 0.04").groupBy("l_orderkey").agg(F.collect_set(F.col("l_suppkey") % 7).alias("b"))
    none = F.array().cast("array<bigint>")
    return a.join(b, "l_orderkey", "left").select("l_orderkey", "a", F.coalesce("b", none).alias("b"))


SETS_SQL = """WITH a AS (SELECT l_orderkey, list(DISTINCT l_partkey % 7) AS a FROM lineitem GROUP BY 1), b AS (SELECT l_orderkey, list(DISTINCT l_suppkey % 7) AS b FROM lineitem WHERE l_discount > 0.04 GROUP BY 1),
s AS (SELECT l_orderkey, a, coalesce(b, []) AS b FROM a LEFT JOIN b USING (l_orderkey)), c AS (SELECT l_orderkey, len(a) AS na, len(b) AS nb, len(list_intersect(a, b)) AS ni FROM s)"""


@query(SETS_SQL + """ SELECT l_orderkey, CASE WHEN na = 0 AND nb = 0 THEN 'none' WHEN nb = 0 THEN 'second_empty' WHEN na = 0 THEN 'first_empty' WHEN ni = na AND ni = nb THEN 'same' WHEN ni = nb THEN 'narrowed' WHEN ni = na THEN 'expanded' WHEN ni > 0 THEN 'shifted' ELSE 'disjoint' END AS pattern FROM c""")
def set_relation_pattern(t):
    return _sets(t).select("l_orderkey", X.relation(F.col("a"), F.col("b")).alias("pattern"))


@query(SETS_SQL + " SELECT l_orderkey, round(ni / (na + nb - ni), 3) AS jaccard FROM c")
def set_jaccard(t):
    return _sets(t).select("l_orderkey", X.jaccard(F.col("a"), F.col("b")).alias("jaccard"))


@query("""WITH a AS (SELECT DISTINCT o_custkey AS k, o_orderstatus AS s FROM orders WHERE o_orderkey % 2 = 0), b AS (SELECT DISTINCT o_custkey AS k, o_orderstatus AS s FROM orders WHERE o_orderkey % 2 = 1)
SELECT coalesce(a.k, b.k) AS k, coalesce(a.s, b.s) AS s, CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN 'shared' WHEN a.k IS NOT NULL THEN 'first_only' ELSE 'second_only' END AS side FROM a FULL JOIN b ON a.k = b.k AND a.s = b.s""")
def set_flow_rows(t):
    o = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("s"), "o_orderkey")
    return X.flow(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 = 1"), ["k", "s"])


@query("SELECT DISTINCT c_custkey, CAST(n_regionkey AS INTEGER) AS genus FROM customer JOIN nation ON c_nationkey = n_nationkey")
def set_genus_rollup(t):
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_regionkey").alias("genus")).distinct()


# ---- projections and filters


@query("SELECT c_custkey AS id, c_name AS display, CAST(c_acctbal AS VARCHAR) IS NOT NULL AS has_balance FROM customer")
def proj_rename_map(t):
    return t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("display"), F.col("c_acctbal").isNotNull().alias("has_balance"))


@query("SELECT p_partkey, coalesce(CASE WHEN p_size > 10 THEN p_name END, p_brand || ' ' || p_type) AS display FROM part")
def proj_display_name(t):
    return t.part.select("p_partkey", F.coalesce(F.when(F.col("p_size") > 10, F.col("p_name")), F.concat_ws(" ", "p_brand", "p_type")).alias("display"))


@query("SELECT o_orderkey, CASE WHEN o_totalprice > 100000 THEN 'priority;status' ELSE 'status' END AS kept FROM orders")
def proj_drop_nulls(t):
    props = F.create_map(F.lit("status"), F.col("o_orderstatus"), F.lit("priority"), F.when(F.col("o_totalprice") > 100000, F.col("o_orderpriority")))
    kept = F.array_sort(F.map_keys(F.map_filter(props, lambda k, v: v.isNotNull())))
    return t.orders.select("o_orderkey", F.array_join(kept, ";").alias("kept"))


@query("SELECT event_id FROM events WHERE event_type IN ('click', 'view')")
def filter_isin_types(t):
    return t.events.where(F.col("event_type").isin("click", "view")).select("event_id")


@query("SELECT event_id, event_type FROM events WHERE event_type <> 'click'")
def filter_scope(t):
    return t.events.where(F.col("event_type") != "click").select("event_id", "event_type")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey <> l_suppkey")
def filter_exclude_self(t):
    return t.lineitem.where("l_partkey <> l_suppkey").select("l_orderkey", "l_linenumber")


@query("SELECT p_partkey FROM part WHERE NOT regexp_matches(p_type, '(?i)brushed|polished')")
def filter_not_a_paper(t):
    return t.part.where(~F.col("p_type").rlike("(?i)brushed|polished")).select("p_partkey")
