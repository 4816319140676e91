import difflib
import random
import re
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from veridra import session
from veridra.functions import scalars
from veridra.operators import checks, graph, joins, linking, matching, organisations, project, resolve, search, sets
from veridra.sources import files


def test_whole_tokens(spark):
    cases = [("VP40", "VP40-specific antibodies", 1), ("VP40", "xxVP40xx", 0), ("GP", "GPCR signalling", 0), ("1-5D", "1-5DX", 0), ("Ebola virus", "an ebola virus; Ebola  virus", 1), ("VP35(C)", "the VP35(C) site", 1)]
    for term, text, n in cases:
        docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc int, text string")
        got = linking.term_matches(docs, spark.createDataFrame([(term,)], "term string"), "doc", "text", "term").collect()
        assert sum(r["n"] for r in got) == n, (term, text)


def test_term_matches_against_scan(spark):
    rnd = random.Random(2)
    docs = [(i, " ".join(rnd.choice(["ab", "abc", "a-b", "x", "AB"]) for _ in range(rnd.randint(0, 12)))) for i in range(80)]
    terms = ["ab", "a-b", "ab x", "x"]
    want = {(i, t) for i, d in docs for t in terms if re.search(rf"(?<![0-9A-Za-z]){re.escape(t)}(?![0-9A-Za-z])", d, re.I)}
    df = spark.createDataFrame(docs, "doc int, text string")
    got = linking.term_matches(df, spark.createDataFrame([(t,) for t in terms], "term string"), "doc", "text", "term")
    assert {(r["doc"], r["term"]) for r in got.collect()} == want


def test_longest_spans(spark):
    terms = [("Marburg virus disease", "D1", "condition"), ("Marburg virus", "T1", "taxon"), ("virus", "G1", "gene"), ("glycoprotein", "P1", "generic")]
    text = "Marburg virus disease. Marburg virus glycoprotein. A glycoprotein alone."
    got = linking.longest_spans(spark.createDataFrame([(1, text), (2, None)], "doc int, text string"), terms, "doc", "text").collect()
    assert sorted((r["start"], r["entity"]) for r in got) == [(0, "D1"), (0, "T1"), (23, "T1"), (37, "P1")]


def test_grant_numbers(spark):
    df = spark.createDataFrame([("R43 AI066487-01, AI 51292; A1057153",), (None,)], "text string")
    got = [(r["activity"], r["serial"]) for r in linking.grant_numbers(df, "text").collect()]
    assert got == [("R43", "AI066487"), (None, "AI051292"), (None, "AI057153")]


def test_context_gate_drops_ambiguous_hits_without_context(spark):
    hits = spark.createDataFrame([(1, "gene", True), (1, "taxon", False), (2, "gene", True), (2, "gene", False)], "doc int, etype string, ctx boolean")
    assert linking.context_gate(hits, "doc", "etype", "ctx").groupBy("doc").count().orderBy("doc").collect() == [(1, 2), (2, 1)]


def test_closure_survives_cycles(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "d"), ("e", "c")], "child string, parent string")
    got = {(r["node"], r["ancestor"]) for r in graph.closure(e, "child", "parent").collect()}
    assert {("a", "c"), ("e", "b"), ("a", "a")} <= got and ("d", "a") not in got


def test_interval_containment_against_loop(spark):
    rnd = random.Random(1)
    inner = [("c", s, s + rnd.randint(0, 9), i) for i in range(60) for s in [rnd.randint(0, 300)]]
    outer = [("c", s, s + rnd.randint(0, 120), i) for i in range(30) for s in [rnd.randint(0, 300)]]
    want = sorted((a[3], b[3]) for a in inner for b in outer if b[1] <= a[1] and a[2] <= b[2])
    got = joins.interval_containment(spark.createDataFrame(inner, "chrom string, s int, e int, inner_id int"), spark.createDataFrame(outer, "chrom string, s int, e int, outer_id int"), 25)
    assert sorted((r["inner_id"], r["outer_id"]) for r in got.collect()) == want


def test_merge_keeps_unmatched_rows(spark):
    a = spark.createDataFrame([("x", "1", None), ("y", "2", "b")], "k string, p string, q string")
    b = spark.createDataFrame([("x", "9", "c"), ("z", "3", None)], "k string, p string, q string")
    got = resolve.merge_sources(a, b, "k", {"p": "a", "q": "a"}).orderBy("k").collect()
    assert [tuple(r) for r in got] == [("x", "1", "c", "both"), ("y", "2", "b", "a"), ("z", "3", None, "b")]


def test_merge_rows_unions_annotations(spark):
    df = spark.createDataFrame([(1, "k", None, "b"), (2, "k", "n", "a"), (3, "l", "m", None)], "o int, k string, f string, u string")
    got = resolve.merge_rows(df, ["k"], ["f"], ["u"], "o").orderBy("k").collect()
    assert [tuple(r) for r in got] == [("k", "n", "a; b", 2), ("l", "m", "", 1)]


def test_relations(spark):
    cases = [([], [], "none"), ([1], [], "second_empty"), ([], [1], "first_empty"), ([1], [1], "same"), ([1, 2], [1], "narrowed"), ([1], [1, 2], "expanded"), ([1, 2], [2, 3], "shifted"), ([1], [2], "disjoint")]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "a array<int>, b array<int>")
    assert [r[0] for r in df.select(sets.relation(F.col("a"), F.col("b"))).collect()] == [c for _, _, c in cases]


def test_wilson():
    lo, hi = sets.wilson_number(8, 10)
    assert round(lo, 3) == 0.490 and round(hi, 3) == 0.943


def test_multiset_difference(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    b = spark.createDataFrame([(1,), (3,)], "v int")
    assert sorted(tuple(r) for r in sets.multiset_diff(a, b).collect()) == [(1, "first", 1), (2, "first", 1), (3, "second", 1)]


def test_locators_overlap(spark):
    df = spark.createDataFrame([("12, 34 (56)",), ("none",), (None,)], "v string")
    assert [r[0] for r in df.select(matching.locators(F.col("v"))).collect()] == [["12:34", "34:56"], [], None]


def test_rules_of_single_terms(spark):
    text = "Dengue fever. Fever of unknown kind; GP gene here. GP alone\nFEVER"
    rules = {"fever": linking.TermRule(not_before=r"(?i)dengue\s*$"), "gp": linking.TermRule(sentence=r"\bgenes?\b")}
    terms = [("fever", "f", "condition"), ("GP", "g", "gene"), ("unknown", "u", "word")]
    got = linking.longest_spans(spark.createDataFrame([(1, text), (2, "")], "doc int, text string"), terms, "doc", "text", rules=rules).collect()
    assert sorted((r["start"], r["term"]) for r in got) == [(14, "fever"), (23, "unknown"), (37, "GP"), (60, "fever")]


def column(spark, fn, cases, kind="string"):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").select("out").collect()]


def test_names_in_an_assignee_field(spark):
    cases = ["Orbis B.V.,Nordlab A/S", "Weber; Anna,Acme,Inc.", "Ft Kent,Md", "Acme, Inc.", "", None]
    assert column(spark, organisations.organisation_names, cases) == [["Orbis B.V.", "Nordlab A/S"], ["Acme,Inc."], ["Ft Kent"], ["Acme, Inc."], [], None]


def test_spellings_of_an_organisation_share_a_key(spark):
    cases = [
        "Für Univ, Inc.", "The Regents of the University of X & Y", "SCRIPPS RES INST, THE", "GmbH Co Ltd", "USAMRIID", None,
        "The United States of America, as represented by the Secretary of the Army", "Michigan State Department of Health and Human Services",
        "U.S. Dept. of Health & Human Services", "Leland Stanford Junior University",
    ]
    assert column(spark, organisations.organisation_key, cases) == [
        "FUR UNIVERSITY", "UNIVERSITY OF X AND Y", "SCRIPPS RESEARCH INSTITUTE", "", "US ARMY", None, "US ARMY",
        "MICHIGAN STATE DEPARTMENT OF HEALTH AND HUMAN SERVICES", "US DEPARTMENT OF HEALTH AND HUMAN SERVICES", "STANFORD UNIVERSITY",
    ]


def test_organisations_by_a_lexicon_of_the_caller(spark):
    known = organisations.Lexicon(leads=("FRIENDS OF", "FRIENDS OF OLD"), forms=("OY", "A B"), spelled_out={"MUS": "MUSEUM"}, aliases={"NORTH MUSEUM": "MUSEUM OF NORTH"})
    cases = ["Friends of the Old Friends of North Mus. Oy", "North Museum, A.B. oy", "Friends of", "Govermnent of the United States", "City of North", "Goverment Printing", "State of America Goverment, Army", "US"]
    assert column(spark, lambda c: organisations.organisation_key(c, known), cases) == [
        "MUSEUM OF NORTH", "MUSEUM OF NORTH", "", "US GOVERNMENT", "CITY OF NORTH", "GOVERMENT PRINTING", "US ARMY", "US",
    ]
    rows = spark.createDataFrame([("North Mus,Ost Oy", "a", 1), ("North Mus", "b", 1), ("NORTH MUSEUM,Li; Bo", "a", 2), (None, "a", 3)], "field string, role string, ident int")
    found, links = organisations.organisation_links(rows, "field", "role", "ident", known)
    assert sorted((r["org_key"], r["display"], r["spellings"], r["roles"]) for r in found.collect()) == [
        ("MUSEUM OF NORTH", "North Mus", ["NORTH MUSEUM", "North Mus"], ["a", "b"]), ("OST", "Ost Oy", ["Ost Oy"], ["a"]),
    ]
    assert sorted(tuple(r) for r in links.collect()) == [("MUSEUM OF NORTH", "a", 1), ("MUSEUM OF NORTH", "a", 2), ("MUSEUM OF NORTH", "b", 1), ("OST", "a", 1)]


def ratio(a, b):
    short, long = sorted((a, b), key=len)
    return 1.0 if len(short) >= 20 and short in long else difflib.SequenceMatcher(None, a, b).ratio()


def test_no_fuzzy_title_is_lost(spark):
    rnd = random.Random(11)
    base = [" ".join(rnd.choice(["virus", "entry", "study", "of", "a", "cell", "model", "in", "mice"]) for _ in range(rnd.randint(1, 9))) for _ in range(25)]

    def spoiled(t):
        t = list(t)
        for _ in range(rnd.choice([0, 1, 1, 2, 4])):
            i = rnd.randrange(len(t) + 1)
            t[i : i + rnd.randint(0, 1)] = rnd.choice(["x", "q", " ", ""])
        return "".join(t).strip() or "x"

    left = [(i, spoiled(rnd.choice(base)), 2000 + i % 4) for i in range(40)]
    right = [(i, spoiled(rnd.choice(base)) + rnd.choice(["", " and more words behind it"]), 2000 + i % 3) for i in range(40)] + [(99, "erratum " + left[0][1], 2000)]
    a = spark.createDataFrame(left, "l int, title string, cited_year int")
    b = spark.createDataFrame(right, "r int, title string, record_year int")
    for least in (0.7, 0.9):
        want = {(i, j) for i, x, _ in left for j, y, _ in right if round(ratio(x, y), 6) >= least}
        assert {(r["l"], r["r"]) for r in matching.fuzzy_title_pairs(a, b, least).collect()} == want
    want = {(i, j) for i, x, u in left for j, y, v in right if ratio(x, y) >= 0.85 and abs(u - v) <= 1 and not y.startswith("erratum")}
    assert {(r["l"], r["r"]) for r in matching.verified_titles(a, b).collect()} == want
    best = {r["l"]: r["score"] for r in matching.fuzzy_title_join(a, b, 0.9).collect()}
    assert all(abs(best.get(i, 0) - s) < 1e-5 for i, x, _ in left if (s := max(ratio(x, y) for _, y, _ in right)) >= 0.9)


def test_name_rules(spark):
    people = spark.createDataFrame([(1, "doe", "jane", "q"), (2, "doe", "j", ""), (3, "orr", "bo", "")], "l int, last string, first string, middle string")
    authors = spark.createDataFrame([(1, "doe", "jan", "jq"), (2, "doe", "jane", "jx"), (3, "doe", "j", "j"), (4, "orr", "ann", "a")], "r int, last string, forename string, initials string")
    got = {(r["l"], r["r"]): r["method"] for r in matching.name_join(people, authors).collect()}
    assert got == {(1, 1): "forename", (1, 3): "initials", (2, 1): "initials", (2, 2): "initials", (2, 3): "initials"}


def greedy(hits):
    """Spans longest first; one that crosses an accepted span stays only if it is the same span or its partner type."""
    out = []
    for h in sorted(hits, key=lambda h: (h[0] - h[1], h[0])):
        if all(o[:2] == h[:2] or {o[2], h[2]} == {"taxon", "condition"} for o in out if o[0] < h[1] and h[0] < o[1]):
            out.append(h)
    return sorted(out)


def test_spans_against_brute_force():
    rnd = random.Random(6)
    for _ in range(300):
        hits = sorted({(a, a + rnd.randint(1, 8), rnd.choice(["taxon", "condition", "gene"])) for a in [rnd.randint(0, 20) for _ in range(rnd.randint(0, 12))]})
        at = np.array([h[:2] for h in hits], np.int64).reshape(-1, 2)
        kept = linking.chosen_spans(at[:, 0], at[:, 1], [h[2] for h in hits], 40)
        assert sorted(hits[i] for i in kept) == greedy(hits)


def test_a_large_vocabulary_gives_the_same_hits(spark):
    docs = spark.createDataFrame([(1, "Ab ab, a-b x AB ab x", "s"), (2, None, "s"), (3, "ab\\E x", "t")], "doc int, text string, source string")
    terms = spark.createDataFrame([("ab",), ("a-b",), ("ab x",), ("ab\\E",)], "term string")
    args = (docs, terms, "doc", "text", "term", ("source",))
    assert sorted(linking.term_matches(*args).collect()) == sorted(linking.term_matches(*args, sent_letters=0).collect()) != []


def test_closure_of_a_deep_chain(spark):
    e = spark.createDataFrame([(f"{i}", f"{i + 1}") for i in range(70)], "child string, parent string")
    got = {(r["node"], r["ancestor"]): r["hops"] for r in graph.closure(e, "child", "parent").collect()}
    assert len(got) == 71 * 72 // 2 and got["0", "70"] == 70
    with pytest.raises(RuntimeError):
        graph.closure(e, "child", "parent", most_hops=20)


def test_empty_samples_and_zero_vectors(spark):
    df = spark.createDataFrame([(0, 0, [0.0, 0.0]), (3, 3, [1.0, 0.0])], "k int, n int, v array<double>")
    low, high = sets.wilson(F.col("k"), F.col("n"))
    got = df.select(low, high, scalars.cosine(F.col("v"), F.col("v"))).collect()
    assert tuple(got[0]) == (0.0, 0.0, None) and got[1][1] == 1.0 and abs(got[1][2] - 1) < 1e-12


def test_a_shared_folder_is_asked_for(spark):
    class Context:
        master, applicationId = "spark://host", "x"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(_, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch(Session())
    Context.master = "local[2]"
    assert session.scratch(Session()).startswith("/")


def test_document_pages(spark):
    html = """<meta name=description content='A &lt;b&gt;'><h3>Non-Patent Citations (1)</h3><table><tr><td>Doe, <i>A study</i></td><td>1987 2001</td></tr>
    <tr><td>second</td></tr></table><h3>Patent Citations</h3><table><tr><td><b itemprop=publicationNumber>US1</b></td></tr></table><p itemprop=publicationNumber>US2</p><div"""
    pages = spark.createDataFrame([(1, html), (2, None), (3, "<h2>Non-Patent Citations</h2>one<br>two 1799 1999")], "id long, html string")
    got = files.parse_records(pages, "id", "html")
    assert [tuple(r) for r in got.select("id", "abstract", F.transform("numbers", lambda n: n["number"])).orderBy("id").collect()] == [(1, "A <b>", ["US1"]), (2, None, []), (3, None, [])]
    rows = files.section_entries(got, "id", "non-patent citations").orderBy("id", "no").collect()
    assert [(r["id"], r["text"], r["year"]) for r in rows] == [(1, "Doe, A study 1987 2001", 1987), (1, "second", None), (3, "one", None), (3, "two 1799 1999", 1999)]


def test_a_difference_from_the_source_fails(spark):
    a, b = spark.createDataFrame([("x",), ("x",), ("y",)], "k string"), spark.createDataFrame([("x",), ("y",)], "k string")
    assert {tuple(r) for r in graph.agree(a, a, ["k"]).collect()} == {("x", 2, 2), ("y", 1, 1)}
    with pytest.raises(Exception, match="differ from the source"):
        graph.agree(a, b, ["k"]).collect()


def test_an_index_is_built_once_a_version(spark):
    built = []

    def build():
        built.append(1)
        return spark.range(3).toDF("id")

    for version in ("a", "a", "b", "b"):
        assert session.kept(spark, "numbers", version, build).count() == 3
    assert len(built) == 2


def test_a_snapshot_changes_with_its_files(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(5).write.parquet(path)
    first = session.snapshot(spark, [path])
    assert session.snapshot(spark, [path]) == first
    spark.range(5).selectExpr("id + 1 AS id").write.mode("overwrite").parquet(path)
    assert session.snapshot(spark, [path]) != first


def test_search_by_postings_is_substring_search(spark):
    rnd = random.Random(3)
    names = ["".join(rnd.choice("abcn_1 ") for _ in range(rnd.randint(0, 12))) for _ in range(300)] + ["ab", "A", "NATION_1", None]
    rows = spark.createDataFrame(list(enumerate(names)), "id int, name string")
    lists = search.postings(rows, "id", "name")
    for pattern in ("n_1", "abc", "a", "b_", "nation_1", "cab1 ", "zzz"):
        got = {r["id"] for r in search.search(rows, lists, "id", "name", pattern).collect()}
        assert got == {i for i, n in enumerate(names) if n and pattern in n.lower()}, pattern


def test_neighbours_read_their_buckets(spark):
    rnd = random.Random(8)
    links = [(f"n{rnd.randrange(60)}", f"n{rnd.randrange(60)}", "t") for _ in range(70)]
    links += links[:5] + [("n1", "n1", "t")]
    store = graph.adjacency(spark.createDataFrame(links, "a string, b string, k string"), "a", "b", "k", buckets=16)
    near = {}
    for a, b, _ in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = {"n1": 0}
    for hop in (1, 2, 3):
        for x in [n for n, h in want.items() if h == hop - 1]:
            for y in near[x]:
                want.setdefault(y, hop)
    seen = graph.subgraph(store, spark.createDataFrame([("n1",), ("n1",)], "x string"), 3, buckets=16)
    assert {r["node"]: r["hop"] for r in seen.collect()} == want
    got = {(r["src"], r["dst"], r["type"]) for r in graph.induced(store, seen, buckets=16).collect()}
    assert got == {x for x in links if x[0] in want and x[1] in want}
    one = graph.neighbours(store, spark.createDataFrame([("n1",)], "node string"), 16)
    assert "PartitionFilters: [isnotnull(bucket" in (plan := one._jdf.queryExecution().toString()) or "PartitionFilters: [(bucket" in plan


def test_one_scan_a_table(spark):
    df = spark.createDataFrame([(1, "x", 5), (2, "x", None), (None, "y", 5), (1, "z", 7)], "k int, v string, w int")
    reads = []

    def tables(name):
        reads.append(name)
        return df

    got = project.nodes(tables, [project.Node("a", "t", "k", "v", repeats=True), project.Node("b", "t", "v", "v", repeats=True), project.Node("b", "u", "v", "w", where="w > 5")])
    assert sorted(map(tuple, got.collect())) == [("a:1", "a", "x"), ("a:2", "a", "x"), ("b:x", "b", "x"), ("b:y", "b", "y"), ("b:z", "b", "7")] and reads == ["t", "u"]
    reads.clear()
    got = project.edges(tables, [project.Edge("E", "t", ("a", "k"), ("b", "v")), project.Edge("F", "t", ("b", "v"), ("c", "w"), where="w > 5")])
    assert sorted(map(tuple, got.collect())) == [("a:1", "b:x", "E"), ("a:1", "b:z", "E"), ("a:2", "b:x", "E"), ("b:z", "c:7", "F")] and reads == ["t"]


def test_fused_checks(spark):
    a = spark.createDataFrame([(1, None, "x"), (2, 7, "x"), (2, 8, None), (None, 7, None)], "k int, p int, s string")
    b = spark.createDataFrame([(7,), (7,), (9,)], "p int")
    some = [
        checks.Rows("r", "error", "a", "k > 1"), checks.Unique("u", "error", "a", ("k",)), checks.Unique("v", "error", "a", ("k", "s")), checks.Unique("w", "error", "a", ("s",), digest=True),
        checks.Orphans("o", "error", "a", "p", "b", "p"), checks.Orphans("n", "error", "a", "p", "b", "p", nulls=True), checks.Childless("c", "info", "b", "p", "a", "p"), checks.Rows("none", "info", "b", "p < 0"),
    ]
    reads = []

    def tables(name):
        reads.append(name)
        return {"a": a, "b": b}[name]

    got = {r["check"]: (r["n"], r["passed"]) for r in checks.report(tables, some).collect()}
    assert got == {"r": (2, False), "u": (1, False), "v": (0, True), "w": (2, False), "o": (2, False), "n": (1, False), "c": (1, False), "none": (0, True)}
    assert sorted(reads)[:2] == ["a", "a"] and len(reads) == 3  # once each, and for the session
    with pytest.raises(TypeError):
        checks.report(tables, [checks.Check("x", "error")])


def test_places_in_a_hot_group(spark):
    rows = [(None if i % 7 == 0 else "a" if i % 3 else "b", (i * 37) % 101, i) for i in range(400)]
    got = resolve.places(spark.createDataFrame(rows, "g string, v int, i int"), "g", ["v", "i"], "place").collect()
    for g in (None, "a", "b"):
        mine = sorted((r["v"], r["i"], r["place"]) for r in got if r["g"] == g)
        assert [p for _, _, p in mine] == list(range(1, len(mine) + 1))


def test_references_without_a_semicolon_stay(spark):
    from veridra.sources import files

    pages = [(1, "<title>a&amp;b &amp</title>"), (2, "<title>&lt;x&gt; &#39;q&#x27; &l</title>"), (3, "<title>R&D &lt &no; c</title><p>one &amp two")]
    got = files.parse_pages(spark.createDataFrame(pages, "id long, html string"), "id", "html")
    assert {r["id"]: (r["title"], r["words"]) for r in got.collect()} == {1: ("a&b &amp", 0), 2: ("<x> 'q' &l", 0), 3: ("R&D &lt &no; c", 3)}


def test_titles_unlike_are_no_candidates(spark):
    rnd = random.Random(5)
    titles = [" ".join(rnd.choice(["the", "and", "tion", "er", "ou", "an", "nt"]) + rnd.choice(["re", "ing", "th", ""]) for _ in range(9)) for _ in range(120)]
    sides = [spark.createDataFrame([(t, t, str(i).encode()) for i, t in enumerate(titles[n::2])], f"{key} string, title string, key binary") for n, key in ((0, "l"), (1, "r"))]
    assert matching.title_candidates(*sides, 0.85).count() < 60 * 60 // 4


def test_plain_pages_need_no_parser(monkeypatch):
    """Pages of plain markup are read by one pattern a tag, and any page states what the parser alone tells of it."""

    class Whole(files._Record):
        feed = HTMLParser.feed

    def told(kind, page):
        r = kind()
        r.feed(page)
        r.close_entry()
        return r.abstract, r.dates, r.entries, r.numbers

    rnd = random.Random(5)
    pieces = [
        "<p>", "</p>", "<P class='a'>", "<br>", "<br/>", "<br />", "<h2>Patent Citations</h2>", "<h2>", "</h2 >", "<table><tr><td>", "</td></tr>", "</table>", "<td>x</td>", " a &amp; b", "1 < 2", "&lt", "R&D ", " &#39;", "é\n",
        '<meta name="Description" content="x &quot;y&quot; &#39;z&#39;">', "<meta name=description content=>", '<meta name="description" content="">', "<meta name='description' content>", '<time itemprop="d" datetime="1999">', "<time itemprop='d' datetime='2000'/>",
        '<span itemprop="publicationNumber"> US1</span>', "<!-- <p> -->", "<!doctype html>", "<script>if (a < b) '<p>'</script>", "<title>a</title>", '<a b="1"c="2">', "<a b = 'c'>", "<a\tB\n=x>", '<a href="?a=1&copy=2">', "</ p>", "</>", "<", "<b", '<b c="', "</b", "&", "&am", "<svg:x y-z:w='&notin;'>", "<p/ >", "<p /a>", "",
    ]
    for size in [1] * 200 + [3] * 1500 + [9] * 1500:
        page = "".join(rnd.choice(pieces) for _ in range(size))
        assert told(files._Record, page) == told(Whole, page), page
    page = '<h2>Patent Citations</h2><table><tr><td a="&amp;">x &amp; <span itemprop=\'publicationNumber\'>US1</span></td></tr></table>cut <b'
    want = told(Whole, page)
    monkeypatch.setattr(HTMLParser, "feed", None)
    assert told(files._Record, page) == want == (None, {}, [("Patent Citations", True, "x & US1"), ("Patent Citations", False, "cut")], [("Patent Citations", "US1")])


def test_few_bytes_of_titles_are_many_tasks(spark):
    titles = spark.createDataFrame([(f"title of a paper number {i}", str(i).encode()) for i in range(40)], "title string, key binary").coalesce(1)
    for made in (matching._windows(titles), matching._sketched(titles)):
        assert made.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    # the measure stays behind the dealing of pairs, where a filter of a column would move before it
    scores = matching.title_scores(titles, titles, 0.9)
    plan = scores._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("MapInPandas") < plan.index("Repartition")
    assert "EvalPython" not in plan
    assert scores.where("lt = rt AND score = 1").count() == 40


def test_blocks_of_titles_lose_no_pair(spark):
    rnd = random.Random(6)
    words = ["virus", "entry", "of", "a", "cell", "mice"]
    titles = list(dict.fromkeys(" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 60 if i % 9 == 0 else 7))) for i in range(120)))
    a, b = (spark.createDataFrame([(t, t.encode()) for t in titles[n::2]], "title string, key binary") for n in (0, 1))
    got = {(bytes(r["l"]).decode(), bytes(r["r"]).decode()) for r in matching.title_candidates(a, b, 0.8, block=7).collect()}
    want = {(x, y) for x in titles[::2] for y in titles[1::2] if ratio(x, y) >= 0.8}
    assert want <= got


def test_common_letters():
    rnd = random.Random(7)
    for _ in range(200):
        x, y = ("".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 12))) for _ in range(2))
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, c in enumerate(x):
            for j, d in enumerate(y):
                best[i + 1][j + 1] = best[i][j] + 1 if c == d else max(best[i][j + 1], best[i + 1][j])
        assert matching.common_letters(x, y) == best[-1][-1]


def test_prefixes_are_joined_whole(spark):
    from veridra.operators import joins

    docs = spark.createDataFrame([(1, "ab1"), (2, "ab12"), (3, "ab"), (4, "zz9"), (5, "a")], "doc int, prefix string")
    keys = spark.createDataFrame([(1, "ab12", 7), (2, "ab13", 7), (3, "ab2", 8), (4, "ab", 7)], "k int, name string, title int")
    got = lambda **how: sorted((r["doc"], r["k"]) for r in joins.prefix_match(docs, keys, "prefix", "name", 2, **how).collect())
    assert got() == [(1, 1), (1, 2), (2, 1), (3, 1), (3, 2), (3, 3), (3, 4)]
    assert got(one="title") == [(1, 1), (1, 2), (2, 1)]


def test_one_hot_key_is_dealt_over_tasks(spark):
    from pyspark.sql import functions as F

    from veridra.operators import joins

    a, b = (spark.createDataFrame([("x", i) for i in range(n)], f"key string, {name} int") for n, name in ((300, "a"), (20, "b")))
    both = joins.dealt_join(a, b, "key", 16)
    sizes = [r["count"] for r in both.groupBy(F.spark_partition_id()).count().collect()]
    assert both.distinct().count() == sum(sizes) == 6000 and max(sizes) < 2000


def test_awards_beyond_a_million(spark, tmp_path):
    import __spark_entry__ as entry

    spark.createDataFrame([(1, 1_200_000, "R"), (2, 120_000, "A"), (3, 1_000_005, "R"), (4, 5, "N")], "l_orderkey long, l_partkey long, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(120_000,), (5,), (1_000_005,)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    got = entry.queries()["link_paper_grant"](spark, str(tmp_path)).collect()
    assert sorted((r["doc"], r["target"]) for r in got) == [(2, 120_000), (3, 1_000_005)]


def test_antibodies_without_a_place_are_not_joined(spark):
    import __spark_entry__ as entry

    plan = entry.queries()["er_antibodies"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union")


def test_contracts_are_resolved_by_the_beginning_of_their_keys(spark):
    texts = [
        (1, "by HHSN-272-2014-000580, 75n93020c00012."), (2, "HHSN261201500003I"), (3, "HHSN 2722014"), (4, "HHSN272201400058C, R01 AI051292"), (5, None),
        (6, "HHSN272201400058X HHSN272201400058X"), (7, "75N93020C0001"), (8, "HHSN2722014000"),
    ]
    docs = spark.createDataFrame(texts, "doc int, text string")
    awards = [
        (1, "R01AI051292", "R01AI051292", "Trial"), (2, "x", "272201400058C-1", " Trial"), (3, None, "2722 01400058C/2", "trial "), (4, "x", "261201500003I-1", "A"),
        (5, "x", "261201500003I-2", "B"), (6, "x", "75N93020C00012-0", None), (7, "x", "75N93020C00012-1", ""), (8, "x", None, "Trial"), (9, "x", "75N93020C00013", "C"),
    ]
    found = linking.grant_numbers(docs, "text").select("doc", "activity", "serial")
    contracts = linking.contract_numbers(docs, "text").select("doc", "contract")
    got = linking.resolve_grants(found, spark.createDataFrame(awards, "award int, core string, key string, title string"), contracts)
    long, short, new = "HHSN-272-2014-000580", "HHSN272201400058", "75N93020C00012"
    assert sorted(map(tuple, got.collect())) == [
        (1, 2, long), (1, 3, long), (1, 6, new), (1, 7, new), (4, 1, "R01AI051292"), (4, 2, f"{short}C"), (4, 3, f"{short}C"), (6, 2, f"{short}X"), (6, 3, f"{short}X"),
        (8, 2, "HHSN2722014000"), (8, 3, "HHSN2722014000"),
    ]


def test_pages_state_abstract_dates_and_citations(spark):
    html = """<meta name="DC.description" content=""><meta name="DC.description" content=" A &amp;lt;
    b"><time itemprop="filingDate" datetime="2001-02-03"></time><time itemprop="filingDate" datetime="1999-01-01"></time><time itemprop="x">y</time>
    <span itemprop="publicationNumber">US1</span><table><tr itemprop="backwardReferencesOrig"><td><span itemprop="publicationNumber"> US2A1 </span> US3
    <time itemprop="priorityDate" datetime="2000-01-01"></time></td></tr><tr itemprop="backwardReferences"><span itemprop="publicationNumber">US2A1</span><span itemprop="publicationNumber"></span></tr>
    out<tr itemprop="forwardReferences"><span itemprop="publicationNumber">EP4</span></tr><tr><span itemprop="publicationNumber">EP5</span></tr></table>
    <section itemprop="description">One. Funded <i>by</i> x; supported, in whole or in part, by AI1 &amp; co. Two"""
    got = files.parse_pages(spark.createDataFrame([(1, html), (2, None), (3, "<p>a <a>b</a>")], "id long, html string"), "id", "html")
    want = {
        1: ("A < b", {"filingDate": "2001-02-03"}, ["US2A1"], ["EP4"], "Funded by x; supported, in whole or in part, by AI1 & co. Two"),
        2: ("", {}, [], [], ""), 3: ("", {}, [], [], ""),
    }
    rows = got.collect()
    assert {r["id"]: (r["abstract"], r["dates"], r["cites"], r["cited_by"], r["support"]) for r in rows} == want
    assert {r["id"]: (r["links"], r["words"]) for r in rows if r["id"] > 1} == {2: (0, 0), 3: (1, 2)}
