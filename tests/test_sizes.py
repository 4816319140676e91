"""What must not grow with the input: batches, repeated work, single tasks."""

import difflib
import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from veridra.functions import scalars
from veridra.operators import graph, joins, linking, matching, organisations, project
from veridra.plans import ingest_queries, relational_queries
from veridra.sources import paged


def test_hits_leave_in_pieces(spark):
    docs = spark.range(6000).select("id", F.lit("x y x z").alias("text")).coalesce(1)
    found = linking.term_matches(docs, spark.createDataFrame([("x",), ("Y",), ("q",)], "term string"), "id", "text", "term")
    # batches of Arrow columns, cut by hits, not frames of all hits of a batch of texts
    assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()
    got = found.groupBy("term", "n", "at").agg(F.count("*").alias("rows"), F.countDistinct("id").alias("ids")).collect()
    assert sorted(map(tuple, got)) == [("Y", 1, 3, 6000, 6000), ("x", 2, 1, 6000, 6000)]
    assert linking.term_matches(docs.limit(0), spark.createDataFrame([("x",)], "term string"), "id", "text", "term").collect() == []


def test_a_field_is_taken_apart_once(spark):
    # one split, few fields: the dear work is on distinct fields, in more than one task
    rows = spark.range(4000).coalesce(1).select("id", F.concat(F.lit("Acme "), F.col("id") % 50, F.lit(", Inc.,Univ. of X"), F.when(F.col("id") % 2 == 0, "The X")).alias("field"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("role"))
    named = organisations.organisation_fields(rows, "field")
    assert named.select("field").distinct().count() == 25 and named.where("spelling = 'Univ. of XThe X'").count() == 25
    tasks = named.select(F.input_file_name().alias("f")).distinct().count()
    assert tasks > 1
    orgs, links = organisations.organisation_links(rows.withColumn("field", F.coalesce("field", F.lit("Acme 1 LLC"))), "field", "role", "id")
    got = {r["org_key"]: (r["display"], r["spellings"], r["roles"]) for r in orgs.collect()}
    assert got["ACME 1"] == ("Acme 1 LLC", ["Acme 1 LLC"], ["b"]) and got["UNIVERSITY OF XTHE X"][2] == ["a", "b"]
    assert links.where("org_key = 'ACME 1'").count() == 2000 and links.count() == 2000 + 2 * 2000


def test_headers_are_cleaned_once_a_row(spark):
    raw = F.array(F.col("id").cast("string"), F.lit("A b"), F.lit("a-B "), F.lit(None), F.lit(""))
    df = spark.range(3).select(scalars.clean_header(raw).alias("names"))
    assert [r["names"] for r in df.collect()] == [[str(i), "a_b", "a_b_2", "col", "col_2"] for i in range(3)]
    # one pattern in the plan: no copy of the cleaning inside the numbering
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1


def test_numbers_are_resolved_once_for_all_documents(spark):
    found = spark.createDataFrame([(1, "R43", "AI066487"), (1, "R43", "AI066487"), (2, None, "AI066487"), (3, "K08", "AI066487"), (4, None, "AI000001")], "doc int, activity string, serial string")
    awards = spark.createDataFrame([(1, "R43AI066487"), (2, "R44AI066487"), (5, "26120150000")], "award int, core string")
    got = linking.resolve_grants(found, awards)
    assert sorted(map(tuple, got.collect())) == [(1, 1, "R43AI066487"), (2, 1, "AI066487"), (2, 2, "AI066487"), (3, 1, "K08AI066487"), (3, 2, "K08AI066487")]
    # no window over the documents' rows is left
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_ends_are_counted_without_moving_edges(spark):
    edges = spark.createDataFrame([("a", "b"), ("a", "x"), ("x", "b"), (None, "a"), ("a", "b")], "src string, dst string")
    nodes = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "id string")
    got = graph.reconcile(edges, nodes, "src", "dst", "id")
    assert tuple(got.first()) == (5, 2, 1) and tuple(graph.reconcile(edges.limit(0), nodes, "src", "dst", "id").first()) == (0, 0, 0)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_repeats_stay_where_they_do_not_matter(spark):
    rows = spark.createDataFrame([(1, 2), (1, 2), (3, None)], "a int, b int")
    specs = [project.Edge("E", "t", ("x", "a"), ("y", "b"), repeats=True)]
    all_of, once = project.edges(lambda _: rows, specs, once=False), project.edges(lambda _: rows, specs)
    assert (all_of.count(), once.count()) == (2, 1) and "Aggregate" not in all_of._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["node"] for r in graph.ends(all_of, "src", "dst").collect()) == ["x:1", "y:2"]


def test_seldom_repeats_are_told_apart_after_the_shuffle(spark):
    rows = spark.createDataFrame([(1, 2, "x", 5.0), (1, 2, "x", None), (1, 3, "x", 9.0), (None, 3, "y", 9.0), (1, None, "y", 9.0), (1, 2, None, 1.0)], "a int, b bigint, s string, v double")
    x, y, z = ("x", "a"), ("y", "b"), ("z", "s")
    specs = [
        project.Edge("E", "t", x, y, repeats=True, seldom=True), project.Edge("F", "t", x, y, where="v > 4", repeats=True, seldom=True),
        project.Edge("G", "t", x, z, repeats=True), project.Edge("H", "t", y, z, where="v > 8"),
    ]
    got = project.edges(lambda _: rows, specs)
    want = [("x:1", "y:2", "E"), ("x:1", "y:2", "F"), ("x:1", "y:3", "E"), ("x:1", "y:3", "F"), ("x:1", "z:x", "G"), ("x:1", "z:y", "G"), ("y:3", "z:x", "H"), ("y:3", "z:y", "H")]
    assert sorted(map(tuple, got.collect())) == want and got.columns == ["src", "dst", "type"]
    # only pairs that often repeat are put together in front of a shuffle, and keys are shuffled bare, not as ids
    plan = project.edges(lambda _: rows, specs[:2])._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan.split("Exchange", 1)[1] and "x:" not in plan.split("Exchange", 1)[1] and plan.count("Exchange") == 1
    plan = project.edges(lambda _: rows, specs[2:3])._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" in plan.split("Exchange", 1)[1]
    # nothing in the plan that Spark doesn't compile
    assert "filter(array" not in project.edges(lambda _: rows, specs, once=False)._jdf.queryExecution().optimizedPlan().toString()


def test_types_of_several_projections_are_edges_once(spark):
    rows = spark.createDataFrame([(1, 1, "1", 5), (1, 1, "1", 5), (2, 1, "2", 7)], "a int, b bigint, s string, v int")
    x, y, also = ("x", "a"), ("y", "b"), ("x", "s")
    some = lambda **k: [project.Edge("E", "t", x, y, where="v < 6", **k), project.Edge("E", "t", x, y, where="v > 4", **k), project.Edge("E", "t", also, y, **k)]
    want = [("x:1", "y:1", "E"), ("x:2", "y:1", "E")]
    for k in ({"repeats": True}, {"repeats": True, "seldom": True}):
        assert sorted(map(tuple, project.edges(lambda _: rows, some(**k)).collect())) == want
    # more types between two columns than one number has bits for
    many = [project.Edge(f"T{i}", "t", x, y, where=f"v > {i % 6}", repeats=True, seldom=True) for i in range(150)]
    got = project.edges(lambda _: rows, many).collect()
    assert len(got) == len(set(got)) == 275 and {r["type"] for r in got} == {e.type for e in many}


def test_a_year_beyond_the_window_is_many_pages():
    class Service:
        held = sorted({k * k for k in range(1000)} | set(range(300)))

        def count(self, low, high, after=None, most=None):
            return len(self.held) if most is None else sum(after < k <= most for k in self.held)

    s = Service()
    pages = paged.plan(s, 2000, 2000, 10, 100, keys=(s.held[0], s.held[-1]))
    assert all(p.offset is not None and p.offset + p.limit <= 100 for p in pages)
    got = [k for p in pages for k in [k for k in s.held if p.keys[0] < k <= p.keys[1]][p.offset : p.offset + p.limit]]
    assert got == s.held and len(pages) > len(s.held) / 10
    assert paged.plan(s, 2000, 2000, 10, 100) == [paged.Page(2000, 2000, 10, None)]


def test_pairs_of_titles_that_bounds_rule_out_stay_in_their_task(spark):
    rnd = random.Random(3)
    words = ["virus", "entry", "study", "of", "cell", "model", "mice", "host", "human", "trial"]
    titles = [(" ".join(rnd.sample(words, 10)), str(i).encode()) for i in range(80)]
    sides = [spark.createDataFrame(titles[n::2], "title string, key binary") for n in (0, 1)]
    # the same letters and words in another order: counts tell none apart, so the pairs were all written and joined with their titles
    assert matching.title_candidates(*sides, 0.85).count() < 40
    # runs of letters are only shuffled where a shorter title looks for them
    held = matching._windows(sides[0], np.zeros(64, np.int64))
    assert held.count() == 0 and matching._windows(sides[0]).count() > 1000


def test_no_long_title_is_lost(spark):
    rnd = random.Random(8)
    words = ["".join(rnd.choice("etaoinsh") for _ in range(rnd.randint(1, 9))) + rnd.choice(["", "", "", "q", "z", "j7"]) for _ in range(40)]
    base = [" ".join(rnd.choice(words) for _ in range(n)) for n in (20, 40, 42, 45, 60, 200, 420)]

    def spoiled(t):
        t = list(t)
        for _ in range(rnd.randint(0, max(3, len(t) // 40))):
            i = rnd.randrange(len(t))
            t[i : i + rnd.randint(0, 2)] = rnd.choice(["x", "", "e", "ta"])
        return "".join(t)

    left, right = ([spoiled(t) for t in base for _ in range(6)] for _ in range(2))
    left += [t[: len(t) * 9 // 10] for t in base]
    right += [t[20:60] for t in base]
    a = spark.createDataFrame(list(enumerate(left)), "l int, title string")
    b = spark.createDataFrame(list(enumerate(right)), "r int, title string")

    def ratio(x, y):
        short, long = sorted((x, y), key=len)
        return 1.0 if len(short) >= 20 and short in long else difflib.SequenceMatcher(None, x, y).ratio()

    want = {(i, j): round(s, 6) for i, x in enumerate(left) for j, y in enumerate(right) if round(s := ratio(x, y), 6) >= 0.7}
    got = {(r["l"], r["r"]): r["score"] for r in matching.fuzzy_title_pairs(a, b, 0.7).collect()}
    assert got == want
    assert sum(s < 1 and len(left[i]) >= 200 for (i, _), s in want.items()) > 20 and any(s < 1 and len(left[i]) > 1024 for (i, _), s in want.items())


def test_parts_of_a_set_travel_as_lists(spark):
    names = ["red ring", "ring red", "red bolt", "Red", "blue ring hot", "old", None, ""]
    rows = [(k * 7 if k % 50 else k, names[k % 8], f"b{k % 3}" if k % 31 else None) for k in range(1500)] + [(7, "red ring", "b1"), (None, "red ring", "b1")]
    parts = spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string")
    held = joins.listed(parts, ["p_brand", "p_name"], "p_partkey", most=20, ranges=3)
    lists = held.collect()
    assert sorted((r["p_brand"], r["p_name"], v) for r in lists if r["p_brand"] and r["p_name"] for v in r["values"]) == sorted((b, n, k) for k, n, b in rows if b and n and k is not None)
    ends = [(min(v), max(v)) for n in range(3) if (v := [x for r in lists if r["range"] == n for x in r["values"]])]
    assert len(ends) == 3 and ends[0][1] < ends[1][0] and ends[1][1] < ends[2][0]
    assert joins.listed(parts.limit(0), ["p_brand"], "p_partkey").collect() == []
    got = relational_queries.join_token_overlap(SimpleNamespace(part=parts))
    some = [(k, frozenset(n.lower().split(" ")), b) for k, n, b in rows if k is not None and n is not None and b]
    assert sorted(map(tuple, got.collect())) == sorted((i, j) for i, s, x in some for j, t, y in some if x == y and i < j and 2 * len(s & t) >= len(s))
    # pairs are made above the join, which sees a row for each list and set it meets: 8 shares of lists, not of parts
    assert got._jdf.queryExecution().optimizedPlan().toString().index("Generate explode") < got._jdf.queryExecution().optimizedPlan().toString().index("Join")


def test_a_page_reads_the_row_groups_it_stands_in(tmp_path, monkeypatch):
    held = {2000: list(range(0, 300, 3)), 2001: [], 2002: [5, 7, 7, 7, *range(8, 90)]}
    for year, keys in held.items():
        for n, part in enumerate((keys[:47], keys[47:])):
            if part:
                (tmp_path / f"year={year}").mkdir(exist_ok=True)
                table = pa.table({"o_orderkey": pa.array(part, pa.int64()), "o_custkey": pa.array(part, pa.int64()), "o_totalprice": pa.array(part, pa.float64())})
                pq.write_table(table, tmp_path / f"year={year}" / f"{n}.parquet", row_group_size=10)
    shelf = ingest_queries.Shelf(str(tmp_path), {y: len(k) for y, k in held.items()} | {None: 3})
    keys = lambda *a, **k: paged.patiently(lambda: shelf.page(*a, **k), 2, 0.0).column("o_orderkey").to_pylist()
    every = [k for y in sorted(held) for k in held[y]]
    for offset in range(0, 200, 7):
        assert keys(2000, 2002, 23, offset) == every[offset : offset + 23]
    for after in range(-2, 95, 3):
        for most in (after, after + 1, after + 40, 400):
            between = [k for k in held[2002] if after < k <= most]
            assert shelf.count(2002, 2002, after=after, most=most) == len(between)
            assert keys(2002, 2002, 9, 4, after=after, most=most) == between[4:13]
        assert keys(2002, 2002, 9, after=after) == [k for k in held[2002] if k > after][:9]
    assert shelf.count(2000, 2001) == 100 and shelf.count(2001, 2001, after=0, most=9) == 0 and keys(2001, 2001, 5) == []
    read = []
    monkeypatch.setattr(ingest_queries, "_group", lambda path, year, n, f=ingest_queries._group: read.append(n) or f(path, year, n))
    assert keys(2000, 2000, 8, 55) == held[2000][55:63] and len(set(read)) == 2


def test_neighbouring_pages_are_one_task(spark):
    pages = [paged.Page(2000, 2000, 5, at, (0, 9)) for at in range(0, 35, 5)] + [paged.Page(2000, 2000, 5, at, (9, 20)) for at in (0, 5)] + [paged.Page(2001, 2001, 5, None)] * 2
    got = paged.together(pages, 3)
    assert [p for part in got for p in part.pages] == pages and [len(part.pages) for part in got] == [3, 3, 1, 2, 1, 1]

    class Service:
        def count(self, low, high):
            return 4000

        def page(self, low, high, limit, offset=0, after=None):
            return pa.RecordBatch.from_pydict({"id": pa.array(range(offset, min(4000, offset + limit)), pa.int64())})

    df = paged.read_paged(spark, Service(), "id long", "id", 2000, 2000, size=10)
    assert sorted(r["id"] for r in df.collect()) == list(range(4000))
    assert spark.sparkContext.defaultParallelism <= df.rdd.getNumPartitions() <= 400 // 2
