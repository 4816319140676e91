"""The evidence graph over the star schema: nodes, edges, closure, subgraphs, questions and checks.

Nodes are regions, nations, customers, suppliers, parts and orders; edges are the foreign
keys, each typed by its relation. A node id is `<label>:<key>`.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import checks as C
from ..operators import graph as G
from ..operators import project as P
from ..operators import search as X
from ..operators.project import ident
from ..registry import Tables, query
from ..session import kept, scratch, snapshot, stored

NODES = [
    P.Node("region", "region", "r_regionkey", "r_name"), P.Node("nation", "nation", "n_nationkey", "n_name"), P.Node("customer", "customer", "c_custkey", "c_name"),
    P.Node("supplier", "supplier", "s_suppkey", "s_name"), P.Node("part", "part", "p_partkey", "p_name"), P.Node("orders", "orders", "o_orderkey", "o_orderstatus"),
]
EDGES = [
    P.Edge("IN_REGION", "nation", ("nation", "n_nationkey"), ("region", "n_regionkey")),
    P.Edge("LIVES_IN", "customer", ("customer", "c_custkey"), ("nation", "c_nationkey")),
    P.Edge("BASED_IN", "supplier", ("supplier", "s_suppkey"), ("nation", "s_nationkey")),
    P.Edge("PLACED_BY", "orders", ("orders", "o_orderkey"), ("customer", "o_custkey")),
    P.Edge("CONTAINS", "lineitem", ("orders", "l_orderkey"), ("part", "l_partkey"), repeats=True, seldom=True),
    P.Edge("SHIPPED_BY", "lineitem", ("orders", "l_orderkey"), ("supplier", "l_suppkey"), repeats=True, seldom=True),
]
#: What the whole graph has beside these: values that stand for themselves, and the corpus.
MORE_NODES = [
    P.Node("brand", "part", "p_brand", "p_brand", repeats=True), P.Node("type", "part", "p_type", "p_type", repeats=True),
    P.Node("segment", "customer", "c_mktsegment", "c_mktsegment", repeats=True), P.Node("priority", "orders", "o_orderpriority", "o_orderpriority", repeats=True),
    P.Node("status", "orders", "o_orderstatus", "o_orderstatus", repeats=True), P.Node("flag", "lineitem", "l_returnflag", "l_returnflag", repeats=True),
    P.Node("document", "documents", "doc_id", "source"), P.Node("language", "documents", "lang", "lang", repeats=True),
    P.Node("source", "documents", "source", "source", repeats=True), P.Node("quality", "labels", "quality", "quality", repeats=True),
    P.Node("page", "pages", "page_id", "url"), P.Node("item", "benchmark", "item_id", "item_id"),
    P.Node("conversation", "conversations", "conv_id", "conv_id", repeats=True), P.Node("role", "conversations", "role", "role", repeats=True),
    P.Node("user", "events", "user_id", "user_id", repeats=True), P.Node("event_type", "events", "event_type", "event_type", repeats=True),
    P.Node("vector", "embeddings", "vec_id", "label"), P.Node("cluster", "embeddings", "label", "label", repeats=True),
]
MORE_EDGES = [
    P.Edge("OF_BRAND", "part", ("part", "p_partkey"), ("brand", "p_brand")), P.Edge("OF_TYPE", "part", ("part", "p_partkey"), ("type", "p_type")),
    P.Edge("BRAND_MAKES", "part", ("brand", "p_brand"), ("type", "p_type"), repeats=True),
    P.Edge("IN_SEGMENT", "customer", ("customer", "c_custkey"), ("segment", "c_mktsegment")),
    P.Edge("IN_DEBT", "customer", ("customer", "c_custkey"), ("nation", "c_nationkey"), where="c_acctbal < 0"),
    P.Edge("HAS_PRIORITY", "orders", ("orders", "o_orderkey"), ("priority", "o_orderpriority")),
    P.Edge("HAS_STATUS", "orders", ("orders", "o_orderkey"), ("status", "o_orderstatus")),
    P.Edge("LARGE_ORDER_OF", "orders", ("orders", "o_orderkey"), ("customer", "o_custkey"), where="o_totalprice > 300000"),
    P.Edge("SUPPLIES", "lineitem", ("supplier", "l_suppkey"), ("part", "l_partkey"), repeats=True, seldom=True),
    P.Edge("RETURNED", "lineitem", ("orders", "l_orderkey"), ("part", "l_partkey"), where="l_returnflag = 'R'", repeats=True, seldom=True),
    P.Edge("DISCOUNTED", "lineitem", ("orders", "l_orderkey"), ("part", "l_partkey"), where="l_discount >= 0.1", repeats=True, seldom=True),
    P.Edge("FLAGGED", "lineitem", ("part", "l_partkey"), ("flag", "l_returnflag"), repeats=True),
    P.Edge("WRITTEN_IN", "documents", ("document", "doc_id"), ("language", "lang")), P.Edge("FROM_SOURCE", "documents", ("document", "doc_id"), ("source", "source")),
    P.Edge("SOURCE_WRITES", "documents", ("source", "source"), ("language", "lang"), repeats=True),
    P.Edge("JUDGED", "labels", ("document", "doc_id"), ("quality", "quality")), P.Edge("JUDGED_TOXIC", "labels", ("document", "doc_id"), ("quality", "quality"), where="toxic = 1"),
    P.Edge("SPOKE_IN", "conversations", ("role", "role"), ("conversation", "conv_id"), repeats=True),
    P.Edge("DID", "events", ("user", "user_id"), ("event_type", "event_type"), repeats=True),
    P.Edge("IN_CLUSTER", "embeddings", ("vector", "vec_id"), ("cluster", "label")),
]


def nodes(t: Tables) -> DataFrame:
    return P.nodes(lambda n: getattr(t, n), NODES)


def edges(t: Tables, *relations: str) -> DataFrame:
    return P.edges(lambda n: getattr(t, n), [e for e in EDGES if not relations or e.type in relations])


def _node_sql(n: P.Node) -> str:
    return f"SELECT '{n.label}:' || {n.key} AS id, '{n.label}' AS label, CAST({n.name} AS VARCHAR) AS name FROM {n.table} WHERE {n.key} IS NOT NULL"


def _edge_sql(e: P.Edge) -> str:
    (a, ak), (b, bk) = e.src, e.dst
    return f"SELECT '{a}:' || {ak} AS src, '{b}:' || {bk} AS dst, '{e.type}' AS type FROM {e.table} WHERE {ak} IS NOT NULL AND {bk} IS NOT NULL AND {e.where or 'true'}"


NODES_SQL, EDGES_SQL = " UNION ALL ".join(map(_node_sql, NODES)), " UNION ".join(map(_edge_sql, EDGES))
WITH = f"WITH RECURSIVE nodes AS ({NODES_SQL}), edges AS ({EDGES_SQL})"
TREE = "up AS (SELECT src AS c, dst AS p FROM edges WHERE type IN ('IN_REGION', 'LIVES_IN', 'BASED_IN'))"


@query(f"SELECT id, label, min(name) AS name FROM ({' UNION ALL '.join(map(_node_sql, NODES + MORE_NODES))}) GROUP BY id, label")
def graph_nodes(t):
    """24 labels from 12 tables, each scanned once."""
    return P.nodes(lambda n: getattr(t, n), NODES + MORE_NODES)


@query(" UNION ".join(map(_edge_sql, EDGES + MORE_EDGES)))
def graph_edges(t):
    """26 types from 10 tables, each scanned once."""
    return P.edges(lambda n: getattr(t, n), EDGES + MORE_EDGES)


@query("SELECT 'orders:' || l_orderkey AS src, 'part:' || l_partkey AS dst, 'CONTAINS' AS type, CAST(count(*) AS BIGINT) AS n_support, max(l_discount) AS confidence FROM lineitem GROUP BY l_orderkey, l_partkey")
def graph_evidence_edges(t):
    g = t.lineitem.groupBy("l_orderkey", "l_partkey").agg(F.count("*").alias("n_support"), F.max("l_discount").alias("confidence"))
    return g.select(ident("orders", "l_orderkey").alias("src"), ident("part", "l_partkey").alias("dst"), F.lit("CONTAINS").alias("type"), "n_support", "confidence")


CLOSURE = f"""{WITH}, {TREE}, walk(node, ancestor, hops) AS (SELECT id, id, 0 FROM nodes WHERE label IN ('region', 'nation', 'customer', 'supplier')
UNION ALL SELECT node, p, hops + 1 FROM walk JOIN up ON ancestor = c)"""


def tree(t: Tables) -> DataFrame:
    return G.closure(edges(t, "IN_REGION", "LIVES_IN", "BASED_IN"), "src", "dst")


@query(f"{CLOSURE} SELECT node, ancestor, hops FROM walk WHERE node IN (SELECT c FROM up UNION SELECT p FROM up)")
def graph_closure(t):
    return tree(t)


@query(f"{CLOSURE} SELECT DISTINCT node FROM walk WHERE ancestor IN ('region:1', 'nation:3')")
def graph_subtree(t):
    roots = P.nodes(lambda n: getattr(t, n), NODES[:2]).where(F.col("id").isin("region:1", "nation:3"))
    return G.descendants(edges(t, "IN_REGION", "LIVES_IN", "BASED_IN"), "src", "dst", roots)


FK = [("nation", "region"), ("customer", "nation"), ("supplier", "nation"), ("orders", "customer"), ("lineitem", "orders"), ("lineitem", "part"), ("lineitem", "supplier")]
FK_SQL = ", ".join(f"('{a}', '{b}')" for a, b in FK)


@query(f"""WITH RECURSIVE fk(child, parent) AS (VALUES {FK_SQL}), d(root, dependant) AS (SELECT parent, child FROM fk UNION SELECT d.root, fk.child FROM d JOIN fk ON d.dependant = fk.parent) SELECT root, dependant FROM d""")
def graph_fk_closure(t):
    """Which tables depend on which: a column of the same name as another table's key refers to it if all its values are there."""
    fk = foreign_keys(t)
    return G.closure(fk, "child", "parent").where("hops > 0").select(F.col("ancestor").alias("root"), F.col("node").alias("dependant")).distinct()


def foreign_keys(t: Tables) -> DataFrame:
    """(child, parent) of the star schema, told from the tables' columns and their values."""
    plain = lambda c: c.split("_", 1)[1]
    columns = {n: getattr(t, n).columns for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")}
    # the first column of a table is its key, unless an earlier table has one of that name
    keys: dict[str, tuple[str, str]] = {}
    for n, c in columns.items():
        keys.setdefault(plain(c[0]), (n, c[0]))
    maybe = [C.Orphans(f"{n} {keys[plain(c)][0]}", "error", n, c, *keys[plain(c)]) for n, cs in columns.items() for c in cs if plain(c) in keys and keys[plain(c)][0] != n]
    held = C.report(lambda n: getattr(t, n), maybe).where("passed")
    return held.select(F.split_part("check", F.lit(" "), F.lit(1)).alias("child"), F.split_part("check", F.lit(" "), F.lit(2)).alias("parent"))


BFS = f"""{WITH}, steps AS (SELECT src AS a, dst AS b FROM edges UNION SELECT dst, src FROM edges), h1 AS (SELECT DISTINCT b AS node FROM steps WHERE a = 'part:1'),
h2 AS (SELECT DISTINCT b AS node FROM steps WHERE a IN (SELECT node FROM h1)), seen AS (SELECT 'part:1' AS node, 0 AS hop UNION ALL SELECT node, 1 FROM h1 UNION ALL SELECT node, 2 FROM h2), hops AS (SELECT node, min(hop) AS hop FROM seen GROUP BY node)"""


def version(t: Tables, *tables: str) -> str:
    """What a snapshot of some tables is, down to each file."""
    return snapshot(t.spark, [f"{t.sf_dir}/{n}.parquet" for n in tables])


GRAPH_TABLES = tuple(sorted({x.table for x in (*NODES, *EDGES)}))


def adjacency(t: Tables) -> DataFrame:
    """The neighbours of every node, stored in buckets for a snapshot of the tables and built again when a file changes.

    Edges are taken as they come: one that several rows state is there several times.
    """
    def build() -> DataFrame:
        once = [replace(e, repeats=False) for e in EDGES]
        return G.adjacency(P.edges(lambda n: getattr(t, n), once), "src", "dst", "type")

    return kept(t.spark, f"adjacency of {t.sf_dir}", version(t, *GRAPH_TABLES), build)


def _start(t: Tables) -> DataFrame:
    return G.subgraph(adjacency(t), t.part.where("p_partkey = 1").select(ident("part", "p_partkey").alias("node")), 2)


@query(f"{BFS} SELECT node, CAST(hop AS INTEGER) AS hop FROM hops")
def graph_bfs_subgraph(t):
    return _start(t)


@query(f"{BFS} SELECT src, dst, type FROM edges WHERE src IN (SELECT node FROM hops) AND dst IN (SELECT node FROM hops)")
def explore_subgraph(t):
    return G.induced(adjacency(t), _start(t))


@query(f"{WITH} SELECT node, CAST(count(*) AS BIGINT) AS degree FROM (SELECT src AS node FROM edges UNION ALL SELECT dst FROM edges) GROUP BY node")
def graph_degree(t):
    return G.degrees(edges(t), "src", "dst")


@query(f"{WITH} SELECT id FROM nodes WHERE id NOT IN (SELECT src FROM edges UNION SELECT dst FROM edges)")
def graph_isolated(t):
    ends = G.ends(P.edges(lambda n: getattr(t, n), EDGES, once=False), "src", "dst").select(F.col("node").alias("id"))
    return nodes(t).select("id").join(ends, "id", "left_anti")


@query(f"{WITH} SELECT a.label AS src_label, type, b.label AS dst_label, CAST(count(*) AS BIGINT) AS n FROM edges JOIN nodes a ON src = a.id JOIN nodes b ON dst = b.id GROUP BY ALL")
def graph_schema_counts(t):
    label = lambda c: F.split_part(c, F.lit(":"), F.lit(1))
    return edges(t).groupBy(label("src").alias("src_label"), "type", label("dst").alias("dst_label")).agg(F.count("*").alias("n"))


@query(f"{WITH} SELECT label, CAST(count(*) AS BIGINT) AS n FROM nodes GROUP BY label")
def meta_schema_report(t):
    return nodes(t).groupBy("label").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT o_custkey AS customer, l_partkey AS part FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def graph_contract_path(t):
    a = t.orders.select(F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("o"))
    return G.contract(a, t.lineitem.select(F.col("l_orderkey").alias("o"), F.col("l_partkey").alias("part")), "customer", "o", "part")


@query(f"""{WITH} SELECT 'node' AS kind, label AS name, CAST(count(*) AS BIGINT) AS source, CAST(count(*) AS BIGINT) AS created FROM nodes GROUP BY label
UNION ALL SELECT 'edge', type, count(*), count(*) FROM edges JOIN nodes a ON src = a.id JOIN nodes b ON dst = b.id GROUP BY type""")
def graph_reconcile(t):
    """What was written against its source, by kind; edges need both ends. A difference fails the query."""
    base = scratch(t.spark)
    n, e = nodes(t), edges(t)
    n.write.parquet(f"{base}/nodes")
    e.write.parquet(f"{base}/edges")
    made, links = t.spark.read.parquet(f"{base}/nodes"), t.spark.read.parquet(f"{base}/edges")
    # ends that are no nodes are few, if any; as a small table they need no shuffle of the edges
    gone = stored(G.ends(links, "src", "dst").join(made.select(F.col("id").alias("node")), "node", "left_anti"))
    links = links.where("src IS NOT NULL AND dst IS NOT NULL")
    links = links.join(gone.withColumnRenamed("node", "src"), "src", "left_anti").join(gone.withColumnRenamed("node", "dst"), "dst", "left_anti")
    each = lambda a, b: a.select(F.lit("node").alias("kind"), F.col("label").alias("name")).unionByName(b.select(F.lit("edge").alias("kind"), F.col("type").alias("name")))
    return G.agree(each(n, e), each(made, links), ["kind", "name"])


@query(f"{WITH} SELECT CAST(count(*) AS BIGINT) AS edges, CAST(count(*) FILTER (WHERE a.id IS NULL) AS BIGINT) AS missing_src, CAST(count(*) FILTER (WHERE b.id IS NULL) AS BIGINT) AS missing_dst FROM edges LEFT JOIN nodes a ON src = a.id LEFT JOIN nodes b ON dst = b.id")
def graph_missing_ends(t):
    return G.reconcile(edges(t), nodes(t), "src", "dst", "id")


DEG = "deg AS (SELECT node, count(*) AS degree FROM (SELECT src AS node FROM edges UNION ALL SELECT dst FROM edges) GROUP BY node)"


@query(f"{WITH}, {DEG} SELECT label, CAST(count(*) AS BIGINT) AS nodes, CAST(count(*) FILTER (WHERE degree IS NULL) AS BIGINT) AS isolated, round(avg(coalesce(degree, 0)), 4) AS mean_degree, CAST(max(coalesce(degree, 0)) AS BIGINT) AS max_degree FROM nodes LEFT JOIN deg ON node = id GROUP BY label")
def agg_degree_report(t):
    n = nodes(t).join(G.degrees(edges(t), "src", "dst").withColumnRenamed("node", "id"), "id", "left")
    d = F.coalesce("degree", F.lit(0))
    return n.groupBy("label").agg(
        F.count("*").alias("nodes"), F.count_if(F.col("degree").isNull()).alias("isolated"), F.round(F.avg(d), 4).alias("mean_degree"), F.max(d).cast("long").alias("max_degree"))


@query(f"{WITH}, {DEG} SELECT node, CAST(degree AS BIGINT) AS degree FROM deg ORDER BY degree DESC, node LIMIT 15")
def topk_hubs(t):
    return G.degrees(edges(t), "src", "dst").orderBy(F.desc("degree"), "node").limit(15)


@query(f"{WITH}, {DEG} SELECT id, lower(label || ' ' || coalesce(name, '')) AS haystack, CAST(coalesce(degree, 0) AS BIGINT) AS degree FROM nodes LEFT JOIN deg ON node = id")
def graph_search_index(t):
    """Kept for a snapshot of the tables' files and built again when one changes."""
    return search_index(t)


def search_index(t: Tables) -> DataFrame:
    def build() -> DataFrame:
        d = G.degrees(edges(t), "src", "dst").withColumnRenamed("node", "id")
        hay = F.lower(F.concat_ws(" ", "label", F.coalesce("name", F.lit(""))))
        return stored(nodes(t).join(d, "id", "left").select("id", hay.alias("haystack"), F.coalesce("degree", F.lit(0)).cast("long").alias("degree")))

    return kept(t.spark, f"index of {t.sf_dir}", version(t, *GRAPH_TABLES), build)


@query(f"""{WITH}, {DEG}, s AS (SELECT id, name, coalesce(degree, 0) AS degree, CASE WHEN lower(name) = 'nation_1' THEN 0 WHEN starts_with(lower(name), 'nation_1') THEN 10 WHEN contains(lower(name), 'n_1') THEN 30 END + CASE WHEN label = 'orders' THEN 40 ELSE 0 END AS score FROM nodes LEFT JOIN deg ON node = id)
SELECT id, name, CAST(score AS INTEGER) AS score FROM s WHERE score IS NOT NULL ORDER BY score, degree DESC, id LIMIT 50""")
def explore_search(t):
    """Names that hold n_1, by posting lists of a stored index; what begins with or is nation_1 comes first."""
    lists = kept(t.spark, f"postings of {t.sf_dir}", version(t, *GRAPH_TABLES), lambda: X.postings(nodes(t), "id", "name"))
    n = F.lower("name")
    score = F.when(n == "nation_1", 0).when(n.startswith("nation_1"), 10).when(n.contains("n_1"), 30) + F.when(F.col("label") == "orders", 40).otherwise(0)
    found = X.search(nodes(t), lists, "id", "name", "n_1").withColumn("score", score)
    found = found.join(search_index(t).select("id", "degree"), "id", "left")
    return found.orderBy("score", F.desc(F.coalesce("degree", F.lit(0))), "id").limit(50).select("id", "name", "score")


# ---- fixed questions, with the parameter as a bound value

JOINED = "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
REGION = "ASIA"


def _geo(t: Tables) -> DataFrame:
    """Customers with their nation and region."""
    n = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return t.customer.join(n, F.col("c_nationkey") == F.col("n_nationkey"))


def _ordered(t: Tables) -> DataFrame:
    return t.orders.join(_geo(t), F.col("o_custkey") == F.col("c_custkey"))


#: Customers below a node of the tree, however deep it stands.
BELOW = f"{CLOSURE}, below AS (SELECT DISTINCT CAST(split_part(node, ':', 2) AS BIGINT) AS k FROM walk WHERE ancestor = 'region:2' AND starts_with(node, 'customer:'))"


def _below(t: Tables) -> DataFrame:
    """Customers in the subtree of a node: only what hangs below it is walked."""
    root = t.region.where("r_regionkey = 2").select(ident("region", "r_regionkey").alias("node"))
    under = G.descendants(edges(t, "IN_REGION", "LIVES_IN"), "src", "dst", root).where(F.col("node").startswith("customer:"))
    return under.select(F.split_part("node", F.lit(":"), F.lit(2)).cast("long").alias("o_custkey")).distinct()


def _lines_below(t: Tables) -> DataFrame:
    return t.lineitem.join(t.orders.join(_below(t), "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))


@query(f"{BELOW} SELECT o_orderkey, max(l_discount) AS confidence, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN below ON o_custkey = k GROUP BY o_orderkey, o_orderstatus ORDER BY confidence DESC, o_orderkey LIMIT 200")
def q_grants_for_virus(t):
    g = _lines_below(t).groupBy("o_orderkey", "o_orderstatus").agg(F.max("l_discount").alias("confidence"))
    return g.orderBy(F.desc("confidence"), "o_orderkey").limit(200)


@query(f"{BELOW} SELECT l_partkey, max(l_discount) AS confidence, CAST(min(CAST(l_shipdate AS DATE)) AS VARCHAR) AS day FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN below ON o_custkey = k GROUP BY l_partkey ORDER BY confidence DESC, l_partkey LIMIT 200")
def q_patents_for_virus(t):
    g = _lines_below(t).groupBy("l_partkey").agg(F.max("l_discount").alias("confidence"), F.min(F.to_date("l_shipdate")).cast("string").alias("day"))
    return g.orderBy(F.desc("confidence"), "l_partkey").limit(200)


@query(f"{BELOW} SELECT p_brand, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN below ON o_custkey = k JOIN part ON l_partkey = p_partkey GROUP BY p_brand")
def q_diseases_for_virus(t):
    """Brands one hop beyond the orders of a subtree."""
    d = _lines_below(t).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return d.groupBy("p_brand").agg(F.countDistinct("o_orderkey").alias("n"))


@query("SELECT coalesce(n_name, '(not recorded)') AS country, CAST(count(*) AS BIGINT) AS n, CAST(min(year(o_orderdate)) AS INTEGER) AS first_year, CAST(max(year(o_orderdate)) AS INTEGER) AS last_year FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey <> 3 GROUP BY 1")
def q_isolates_by_country(t):
    """Orders whose country is unknown (here: outside the nations that are known) count as not recorded."""
    known = t.nation.where("n_regionkey <> 3")
    d = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left").join(known, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    y = F.year("o_orderdate")
    return d.groupBy(F.coalesce("n_name", F.lit("(not recorded)")).alias("country")).agg(F.count("*").alias("n"), F.min(y).alias("first_year"), F.max(y).alias("last_year"))


def _lines(t: Tables) -> DataFrame:
    return t.lineitem.join(_ordered(t), F.col("l_orderkey") == F.col("o_orderkey"))


@query(f"SELECT l_suppkey, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS n FROM {JOINED} WHERE r_name = '{REGION}' GROUP BY l_suppkey ORDER BY n DESC, l_suppkey LIMIT 100")
def q_papers_for_virus(t):
    g = _lines(t).where(F.col("r_name") == REGION).groupBy("l_suppkey").agg(F.countDistinct("o_orderkey").alias("n"))
    return g.orderBy(F.desc("n"), "l_suppkey").limit(100)


@query(f"SELECT o_orderstatus AS status, CAST(count(DISTINCT l_partkey) AS BIGINT) AS parts FROM {JOINED} WHERE r_name = '{REGION}' GROUP BY o_orderstatus ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END")
def q_countermeasures_for_virus(t):
    g = _lines(t).where(F.col("r_name") == REGION).groupBy(F.col("o_orderstatus").alias("status")).agg(F.countDistinct("l_partkey").alias("parts"))
    return g.orderBy(F.when(F.col("status") == "F", 0).when(F.col("status") == "O", 1).otherwise(2))


@query("""SELECT 'order' AS kind, l_orderkey AS id FROM lineitem WHERE l_partkey = 1 UNION SELECT 'supplier', l_suppkey FROM lineitem WHERE l_partkey = 1 UNION SELECT 'customer', o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_partkey = 1""")
def q_documents_for_countermeasure(t):
    li = t.lineitem.where("l_partkey = 1")
    c = li.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    a = li.select(F.lit("order").alias("kind"), F.col("l_orderkey").alias("id")).union(li.select(F.lit("supplier"), "l_suppkey"))
    return a.union(c.select(F.lit("customer"), "o_custkey")).distinct()


@query("SELECT p_partkey, string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), ';' ORDER BY CAST(l_suppkey AS VARCHAR)) AS suppliers FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey")
def q_countermeasure_lineage(t):
    g = t.part.join(t.lineitem, F.col("l_partkey") == F.col("p_partkey"), "left").groupBy("p_partkey").agg(F.array_sort(F.collect_set(F.col("l_suppkey").cast("string"))).alias("s"))
    return g.select("p_partkey", F.nullif(F.array_join("s", ";"), F.lit("")).alias("suppliers"))


@query("SELECT DISTINCT o_orderkey, l_partkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' AND l_returnflag = 'R'")
def q_grants_that_led_to_patents(t):
    o, li = t.orders.where("o_orderstatus = 'F'"), t.lineitem.where("l_returnflag = 'R'")
    return o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "l_partkey").distinct()


@query("SELECT n_name, c.n AS customers, s.n AS suppliers FROM nation JOIN (SELECT c_nationkey AS k, CAST(count(*) AS BIGINT) AS n FROM customer GROUP BY 1) c ON c.k = n_nationkey JOIN (SELECT s_nationkey AS k, CAST(count(*) AS BIGINT) AS n FROM supplier GROUP BY 1) s ON s.k = n_nationkey")
def q_orgs_with_grants_and_patents(t):
    c = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("customers"))
    s = t.supplier.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("suppliers"))
    return t.nation.join(c, "n_nationkey").join(s, "n_nationkey").select("n_name", "customers", "suppliers")


@query("SELECT 'customer' AS kind, c_name AS name FROM customer WHERE contains(lower(c_name), '00001') UNION ALL SELECT 'supplier', s_name FROM supplier WHERE contains(lower(s_name), '00001')")
def q_organization_portfolio(t):
    c = t.customer.where(F.lower("c_name").contains("00001")).select(F.lit("customer").alias("kind"), F.col("c_name").alias("name"))
    return c.unionByName(t.supplier.where(F.lower("s_name").contains("00001")).select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name")))


@query("SELECT DISTINCT l_suppkey FROM lineitem WHERE l_partkey = 5")
def q_antibodies_for_gene(t):
    return t.lineitem.where("l_partkey = 5").select("l_suppkey").distinct()


@query("SELECT o_custkey, string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), ';' ORDER BY CAST(l_suppkey AS VARCHAR)) AS suppliers FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_partkey = 5 GROUP BY o_custkey")
def q_papers_on_antibodies_for_gene(t):
    d = t.lineitem.where("l_partkey = 5").join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return d.groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_set(F.col("l_suppkey").cast("string"))), ";").alias("suppliers"))


@query("SELECT l_orderkey, max(l_discount) AS confidence, o_orderpriority FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey WHERE l_partkey = 5 GROUP BY l_orderkey, o_orderpriority")
def q_grants_for_gene(t):
    d = t.lineitem.where("l_partkey = 5").join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return d.groupBy("l_orderkey", "o_orderpriority").agg(F.max("l_discount").alias("confidence"))


@query("SELECT DISTINCT l_orderkey FROM lineitem WHERE l_partkey = 5 AND l_returnflag = 'R'")
def q_patents_claiming_gene(t):
    return t.lineitem.where("l_partkey = 5 AND l_returnflag = 'R'").select("l_orderkey").distinct()


@query(f"SELECT n_name, CAST(count(DISTINCT l_partkey) AS BIGINT) AS parts, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS orders FROM {JOINED} GROUP BY n_name")
def q_epitopes_by_virus_for_family(t):
    return _lines(t).groupBy("n_name").agg(F.countDistinct("l_partkey").alias("parts"), F.countDistinct("o_orderkey").alias("orders"))


@query("""SELECT kind, id, max(c) AS confidence FROM (SELECT 'order' AS kind, l_orderkey AS id, l_discount AS c FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size < 5
UNION ALL SELECT 'supplier', l_suppkey, l_discount FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size < 5) GROUP BY kind, id""")
def q_documents_for_family(t):
    d = t.lineitem.join(t.part.where("p_size < 5"), F.col("l_partkey") == F.col("p_partkey"))
    u = d.select(F.lit("order").alias("kind"), F.col("l_orderkey").alias("id"), F.col("l_discount").alias("c")).union(d.select(F.lit("supplier"), "l_suppkey", "l_discount"))
    return u.groupBy("kind", "id").agg(F.max("c").alias("confidence"))


def _by_priority(name: str, value: str) -> None:
    def run(t: Tables) -> DataFrame:
        d = t.orders.where(F.col("o_orderpriority").startswith(value)).join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        return d.select("o_orderkey", "c_name")

    run.__name__ = name
    query(f"SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE starts_with(o_orderpriority, '{value}')")(run)


for _name, _value in (("q_grants_for_condition", "1"), ("q_grants_for_symptom", "2"), ("q_grants_for_assay", "3")):
    _by_priority(_name, _value)


@query("SELECT DISTINCT c_custkey, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE starts_with(o_orderpriority, '1')")
def q_isolates_with_symptom(t):
    return _ordered(t).where(F.col("o_orderpriority").startswith("1")).select("c_custkey", "n_name").distinct()


@query("SELECT l_partkey, CAST(count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS BIGINT) AS f, CAST(count(DISTINCT CASE WHEN o_orderstatus = 'O' THEN o_orderkey END) AS BIGINT) AS o FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_partkey HAVING f > 0 AND o > 0")
def q_shared_citations(t):
    d = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    by = lambda s: F.countDistinct(F.when(F.col("o_orderstatus") == s, F.col("o_orderkey")))
    return d.groupBy("l_partkey").agg(by("F").alias("f"), by("O").alias("o")).where("f > 0 AND o > 0")


@query("SELECT l_partkey, CAST(count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS BIGINT) AS returned, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, returned DESC, l_partkey LIMIT 100")
def q_most_cited_papers(t):
    g = t.lineitem.groupBy("l_partkey").agg(F.countDistinct(F.when(F.col("l_returnflag") == "R", F.col("l_orderkey"))).alias("returned"), F.countDistinct("l_orderkey").alias("n"))
    return g.orderBy(F.desc("n"), F.desc("returned"), "l_partkey").limit(100)


@query("SELECT DISTINCT l_orderkey, l_partkey, CASE l_returnflag WHEN 'R' THEN 'returned' WHEN 'A' THEN 'accepted' ELSE 'none' END AS label FROM lineitem")
def q_patent_citation_pairs(t):
    label = F.when(F.col("l_returnflag") == "R", "returned").when(F.col("l_returnflag") == "A", "accepted").otherwise("none")
    return t.lineitem.select("l_orderkey", "l_partkey", label.alias("label")).distinct()


@query("SELECT p_brand, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 100")
def q_top_genes_by_grants(t):
    g = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(F.countDistinct("l_orderkey").alias("n"))
    return g.orderBy(F.desc("n"), "p_brand").limit(100)


@query("SELECT 'part' AS kind, p_partkey AS id FROM part WHERE contains(lower(p_name), '11') UNION ALL SELECT 'customer', c_custkey FROM customer WHERE contains(lower(c_name), '11') UNION ALL SELECT 'supplier', s_suppkey FROM supplier WHERE contains(lower(s_name), '11')")
def q_search_titles(t):
    def part(df: DataFrame, kind: str, key: str, name: str) -> DataFrame:
        return df.where(F.lower(name).contains("11")).select(F.lit(kind).alias("kind"), F.col(key).alias("id"))

    return part(t.part, "part", "p_partkey", "p_name").union(part(t.customer, "customer", "c_custkey", "c_name")).union(part(t.supplier, "supplier", "s_suppkey", "s_name"))


def _options(name: str, table: str, column: str) -> None:
    def run(t: Tables) -> DataFrame:
        return getattr(t, table).select(F.col(column).cast("string").alias("option")).where("option is not null").distinct()

    run.__name__ = name
    query(f"SELECT DISTINCT CAST({column} AS VARCHAR) AS option FROM {table} WHERE {column} IS NOT NULL")(run)


for _name, _table, _column in (
    ("q_options_virus", "region", "r_name"), ("q_options_gene", "part", "p_brand"), ("q_options_family", "part", "p_type"),
    ("q_options_condition", "customer", "c_mktsegment"), ("q_options_symptom", "orders", "o_orderpriority"), ("q_options_assay", "events", "event_type"),
):
    _options(_name, _table, _column)


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority = '3-MEDIUM'")
def pred_param_whitelist(t):
    """A parameter must be one of the column's own values; a value that is not raises in the same query.

    The value is bound, never pasted into SQL, and keeps the column's type; no list of options goes to the driver.
    """
    value = "3-MEDIUM"
    options = t.orders.select("o_orderpriority").distinct()
    known = options.agg(F.bool_or(F.col("o_orderpriority") == F.lit(value)).alias("known"))
    checked = known.select(F.when(F.coalesce("known", F.lit(False)), F.lit(value)).otherwise(F.raise_error(F.lit(f"{value!r} is not an option"))).alias("p"))
    return t.orders.join(F.broadcast(checked), F.col("o_orderpriority") == F.col("p")).select("o_orderkey")


# ---- data-quality checks: one row a check, all in one union

#: name, severity, SQL of the offending rows (runs unchanged in Spark and in DuckDB).
CHECKS = [
    ("orphan_order_customer", "error", "SELECT o_orderkey AS k FROM orders LEFT ANTI JOIN customer ON o_custkey = c_custkey"),
    ("orphan_line_order", "error", "SELECT l_orderkey AS k FROM lineitem LEFT ANTI JOIN orders ON l_orderkey = o_orderkey"),
    ("orphan_line_part", "error", "SELECT l_partkey AS k FROM lineitem LEFT ANTI JOIN part ON l_partkey = p_partkey"),
    ("orphan_line_supplier", "error", "SELECT l_suppkey AS k FROM lineitem LEFT ANTI JOIN supplier ON l_suppkey = s_suppkey"),
    ("duplicate_line", "error", "SELECT l_orderkey AS k FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"),
    ("duplicate_customer_name", "warning", "SELECT min(c_custkey) AS k FROM customer GROUP BY c_name HAVING count(*) > 1"),
    ("duplicate_text", "warning", "SELECT min(doc_id) AS k FROM documents GROUP BY text HAVING count(*) > 1"),
    ("negative_balance", "warning", "SELECT c_custkey AS k FROM customer WHERE c_acctbal < 0"),
    ("shipped_before_ordered", "error", "SELECT l_orderkey AS k FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate"),
    ("discount_range", "error", "SELECT l_orderkey AS k FROM lineitem WHERE l_discount < 0 OR l_discount > 0.1"),
    ("empty_text", "warning", "SELECT doc_id AS k FROM documents WHERE text IS NULL OR trim(text) = ''"),
    ("wrong_length", "error", "SELECT doc_id AS k FROM documents WHERE n_chars <> length(text)"),
    ("label_without_document", "error", "SELECT labels.doc_id AS k FROM labels LEFT ANTI JOIN documents ON labels.doc_id = documents.doc_id"),
    ("customer_without_order", "info", "SELECT c_custkey AS k FROM customer LEFT ANTI JOIN orders ON o_custkey = c_custkey"),
    ("part_never_sold", "info", "SELECT p_partkey AS k FROM part LEFT ANTI JOIN lineitem ON l_partkey = p_partkey"),
    ("order_without_line", "warning", "SELECT o_orderkey AS k FROM orders LEFT ANTI JOIN lineitem ON l_orderkey = o_orderkey"),
    ("unknown_role", "error", "SELECT conv_id AS k FROM conversations WHERE role NOT IN ('system', 'user', 'assistant')"),
    ("null_event_user", "warning", "SELECT event_id AS k FROM events WHERE user_id IS NULL"),
]


#: Checks of every table that need no join, in one scan a table and one shuffle; with those above that do.
FUSED = [
    C.Orphans("orphan_order_customer", "error", "orders", "o_custkey", "customer", "c_custkey"),
    C.Orphans("orphan_line_order", "error", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    C.Orphans("orphan_line_part", "error", "lineitem", "l_partkey", "part", "p_partkey"),
    C.Orphans("orphan_line_supplier", "error", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    C.Orphans("orphan_customer_nation", "error", "customer", "c_nationkey", "nation", "n_nationkey"),
    C.Orphans("orphan_supplier_nation", "error", "supplier", "s_nationkey", "nation", "n_nationkey"),
    C.Orphans("orphan_nation_region", "error", "nation", "n_regionkey", "region", "r_regionkey"),
    C.Orphans("label_without_document", "error", "labels", "doc_id", "documents", "doc_id"),
    C.Unique("duplicate_line", "error", "lineitem", ("l_orderkey", "l_linenumber")),
    C.Unique("duplicate_order", "error", "orders", ("o_orderkey",)),
    C.Unique("duplicate_part", "error", "part", ("p_partkey",)),
    C.Unique("duplicate_part_name", "info", "part", ("p_name", "p_brand", "p_type", "p_size")),
    C.Unique("duplicate_document", "error", "documents", ("doc_id",)),
    C.Unique("duplicate_event", "error", "events", ("event_id",)),
    C.Unique("duplicate_turn", "error", "conversations", ("conv_id", "turn")),
    C.Unique("duplicate_page_url", "warning", "pages", ("url",)),
    C.Unique("duplicate_customer_name", "warning", "customer", ("c_name",)),
    C.Unique("duplicate_text", "warning", "documents", ("text",), digest=True),
    C.Childless("customer_without_order", "info", "customer", "c_custkey", "orders", "o_custkey"),
    C.Childless("part_never_sold", "info", "part", "p_partkey", "lineitem", "l_partkey"),
    C.Childless("order_without_line", "warning", "orders", "o_orderkey", "lineitem", "l_orderkey"),
    C.Childless("supplier_without_line", "info", "supplier", "s_suppkey", "lineitem", "l_suppkey"),
    C.Childless("document_without_label", "info", "documents", "doc_id", "labels", "doc_id"),
    C.Rows("negative_balance", "warning", "customer", "c_acctbal < 0"),
    C.Rows("discount_range", "error", "lineitem", "l_discount < 0 OR l_discount > 0.1"),
    C.Rows("tax_range", "error", "lineitem", "l_tax < 0 OR l_tax > 0.08"),
    C.Rows("no_quantity", "error", "lineitem", "l_quantity IS NULL OR l_quantity <= 0"),
    C.Rows("price_not_positive", "error", "orders", "o_totalprice IS NULL OR o_totalprice <= 0"),
    C.Rows("empty_text", "warning", "documents", "text IS NULL OR trim(text) = ''"),
    C.Rows("wrong_length", "error", "documents", "n_chars <> length(text)"),
    C.Rows("no_language", "warning", "documents", "lang IS NULL"),
    C.Rows("unknown_role", "error", "conversations", "role NOT IN ('system', 'user', 'assistant')"),
    C.Rows("null_event_user", "warning", "events", "user_id IS NULL"),
    C.Rows("no_vector", "error", "embeddings", "embedding IS NULL"),
]
JOINED_CHECKS = [c for c in CHECKS if c[0] not in {f.name for f in FUSED}]


def _checks(name: str, rows: list[tuple[str, str, str]], fused: list[C.Check]) -> None:
    def run(t: Tables) -> DataFrame:
        parts = [C.report(lambda n: getattr(t, n), fused)] if fused else []
        for check, severity, sql in rows:
            used = {n: getattr(t, n) for n in ("orders", "customer", "lineitem", "part", "supplier", "documents", "labels", "conversations", "events") if n in sql.replace("_", " ").replace(".", " ").split()}
            for n, df in used.items():
                df.createOrReplaceTempView(n)
            bad = t.spark.sql(sql)
            parts.append(bad.agg(F.count("*").alias("n")).select(F.lit(check).alias("check"), F.lit(severity).alias("severity"), "n", (F.col("n") == 0).alias("passed")))
        return reduce(DataFrame.unionByName, parts)

    run.__name__ = name
    counted = [(c, s, f"SELECT count(*) FROM ({q.replace('LEFT ANTI JOIN', 'ANTI JOIN')})") for c, s, q in rows] + [(c.name, c.severity, C.sql(c)) for c in fused]
    query(" UNION ALL ".join(f"""SELECT '{c}' AS "check", '{s}' AS severity, CAST(({q}) AS BIGINT) AS n, ({q}) = 0 AS passed""" for c, s, q in counted))(run)


_checks("checks_report", JOINED_CHECKS, FUSED)
for _c in CHECKS:
    _checks(f"check_{_c[0]}", [_c], [])
