"""Queries of readers and writers: a table goes out in a format and comes back through the operator."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..registry import Tables, query
from ..session import TABLES, scratch
from ..sources import files as S

PART_SQL = "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand FROM part"


def _text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def _part(t: Tables) -> DataFrame:
    return _text(t.part.select("p_partkey", "p_name", "p_brand"))


@query(PART_SQL)
def scan_csv_text(t):
    path = scratch(t.spark)
    _part(t).write.option("header", True).csv(path)
    return S.read_text_csv(t.spark, path, ["p_partkey", "p_name", "p_brand"])


@query(PART_SQL)
def scan_csv_headerless(t):
    path = scratch(t.spark)
    _part(t).write.csv(path)
    return S.read_text_csv(t.spark, path, ["p_partkey", "p_name", "p_brand"], header=False)


@query(PART_SQL)
def scan_tsv(t):
    path = scratch(t.spark)
    _part(t).write.option("header", True).option("sep", "\t").csv(path)
    return S.read_text_csv(t.spark, path, ["p_partkey", "p_name", "p_brand"], sep="\t")


@query(PART_SQL)
def scan_tsv_gz_ddl(t):
    path = scratch(t.spark)
    _part(t).write.option("sep", "\t").option("compression", "gzip").csv(path)
    ddl = "CREATE TABLE `part` (\n `p_partkey` int NOT NULL,\n `p_name` varchar(99),\n `p_brand` varchar(9),\n PRIMARY KEY (`p_partkey`)\n)"
    return S.read_ddl_tsv(t.spark, path, ddl)


@query("SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, 'small' AS size_tag FROM part WHERE p_size < 25 UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_name, 'large' FROM part WHERE p_size >= 25")
def scan_multi_union_tag(t):
    base = scratch(t.spark)
    for tag, cond in (("small", "p_size < 25"), ("large", "p_size >= 25")):
        _text(t.part.where(cond).select("p_partkey", "p_name")).write.option("header", True).csv(f"{base}/{tag}")
    return S.read_tagged(t.spark, [(f"{base}/{k}", {"size_tag": k}) for k in ("small", "large")], names=["p_partkey", "p_name"])


@query("SELECT CAST(r_regionkey AS VARCHAR) AS r_regionkey, r_name, 'present' AS origin FROM region")
def scan_optional(t):
    """A file that is there is read; one that is missing gives no rows, with the same columns."""
    base = scratch(t.spark)
    _text(t.region).write.option("header", True).csv(f"{base}/here.csv")
    names = ["r_regionkey", "r_name"]
    parts = [S.read_optional(t.spark, f"{base}/{n}.csv", names).withColumn("origin", F.lit(o)) for n, o in (("here", "present"), ("none", "missing"))]
    return parts[0].unionByName(parts[1])


@query("SELECT o_orderkey, o_custkey, o_orderstatus AS status FROM orders")
def scan_jsonl_nested(t):
    path = scratch(t.spark)
    t.orders.select("o_orderkey", F.struct("o_custkey", F.col("o_orderstatus").alias("status")).alias("d")).write.json(path)
    df = S.read_json_lines(t.spark, path, "o_orderkey long, d struct<o_custkey:long,status:string>")
    return df.select("o_orderkey", "d.o_custkey", "d.status")


@query("SELECT n_nationkey, n_name, 'nation_a' AS _raw_table FROM nation WHERE n_nationkey < 10 UNION ALL SELECT n_nationkey, n_name, 'nation_b' FROM nation WHERE n_nationkey >= 10")
def scan_concat_tables(t):
    n = t.nation.select("n_nationkey", "n_name")
    return S.concat_tables({"nation_a": n.where("n_nationkey < 10"), "nation_b": n.where("n_nationkey >= 10")})


@query("SELECT p_partkey, p_name FROM part")
def scan_raw_table(t):
    path = scratch(t.spark)
    t.part.select("p_partkey", "p_name").write.parquet(path)
    return t.spark.read.parquet(path)


@query(" UNION ALL ".join(f"SELECT '{n}' AS name, true AS present, CAST(count(*) AS BIGINT) AS rows FROM {n}" for n in TABLES) + " UNION ALL SELECT 'no_such', false, NULL")
def meta_table_exists(t):
    """Which tables are there, and how many rows they have."""
    def one(name: str) -> DataFrame:
        there = S.path_exists(t.spark, f"{t.sf_dir}/{name}.parquet")
        rows = getattr(t, name).agg(F.count("*").alias("rows")) if there else t.spark.range(1).select(F.lit(None).cast("long").alias("rows"))
        return rows.select(F.lit(name).alias("name"), F.lit(there).alias("present"), "rows")

    return reduce(DataFrame.unionByName, map(one, (*TABLES, "no_such")))


TITLE_SQL = "regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"
for _entity, _letter in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "''"), ("&#39;", "''"), ("&amp;", "&")):
    TITLE_SQL = f"replace({TITLE_SQL}, '{_entity}', '{_letter}')"


#: What a page of a document states, by its number: behind <head>, behind <article>, and at the end.
HEAD = '<meta name="DC.description" content=" Page &amp; &#10; {n} "><meta name="DC.description" content="second"><meta name="description" content="other">'
ARTICLE = (
    '<time itemprop="publicationDate" datetime="{day}">a</time><time itemprop="publicationDate" datetime="1900-01-01">b</time><span itemprop="publicationNumber">US0A1</span>'
    '<table><tr itemprop="backwardReferencesOrig"><td><span itemprop="publicationNumber"> US{n}A1</span><time itemprop="filingDate" datetime="1901-01-01">c</time></td></tr>'
    '<tr itemprop="backwardReferences"><td><span itemprop="publicationNumber">US{n}A1</span></td></tr><tr itemprop="backwardReferences"><td><span itemprop="publicationNumber"><b>EP7B1</b></span></td></tr>'
    '<tr itemprop="forwardReferences{of}"><td><span itemprop="publicationNumber">WO{n}A2</span></td></tr><tr itemprop="backwardReferencesFamily"><td><span itemprop="publicationNumber">US9A1</span></td></tr></table>'
    '<time itemprop="{kind}" datetime="{day}">d</time>'
)
END = '<section itemprop="description">No. 1. This was made with {whose} support under <b>AI{n}</b> awarded by R&amp;D. End.</section>'


def _shown(text: str, values: dict[str, str]) -> str:
    """SQL of a text with values in the place of its names."""
    for name, value in values.items():
        text = text.replace(f"{{{name}}}", f"' || {value} || '")
    return f"'{text}'"


SHOWN = {
    "n": "CAST(page_id AS STRING)", "day": "CAST(CAST('2000-01-01' AS DATE) + CAST(page_id % 5000 AS INT) AS STRING)", "of": "CASE WHEN page_id % 3 = 0 THEN 'Orig' ELSE 'Family' END",
    "kind": "CASE WHEN page_id % 2 = 0 THEN 'filingDate' ELSE 'priorityDate' END", "whose": "CASE WHEN page_id % 2 = 0 THEN 'government' ELSE 'private' END",
}
PAGE_SQL = f"replace(replace(html, '<head>', '<head>' || {_shown(HEAD, SHOWN)}), '<article>', '<article>' || {_shown(ARTICLE, SHOWN)}) || {_shown(END, SHOWN)}"


@query(f"""WITH p AS (SELECT page_id, {PAGE_SQL} AS html FROM pages),
w AS (SELECT page_id, replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->|<script>.*?</script>|<style>.*?</style>|<title>.*?</title>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '&nbsp;', ' ') AS text FROM p)
SELECT page_id, trim({TITLE_SQL}) AS title, CAST(len(regexp_extract_all(html, '<a[ >]')) AS BIGINT) AS links, CAST(len(regexp_extract_all(text, '\\S+')) AS BIGINT) AS words,
'Page & ' || page_id AS abstract, {SHOWN["day"]} AS publication_date, CASE WHEN page_id % 2 = 0 THEN {SHOWN["day"]} ELSE '' END AS filing_date, CASE WHEN page_id % 2 = 1 THEN {SHOWN["day"]} ELSE '' END AS priority_date,
'US' || page_id || 'A1;EP7B1' AS cited, CASE WHEN page_id % 3 = 0 THEN 'WO' || page_id || 'A2' ELSE '' END AS cited_by,
CASE WHEN page_id % 2 = 0 THEN 'This was made with government support under AI' || page_id || ' awarded by R&D. End.' ELSE '' END AS support FROM p JOIN w USING (page_id)""")
def scan_html_page(t):
    """Pages, into which a document's statements are written: title, links and words, abstract, first dates, numbers in citation tables, and the statement of support."""
    p = S.parse_pages(t.pages.select("page_id", F.expr(PAGE_SQL).alias("html")), "page_id", "html")
    date = lambda kind, name: F.coalesce(F.col("dates")[kind], F.lit("")).alias(name)
    dates = [date("publicationDate", "publication_date"), date("filingDate", "filing_date"), date("priorityDate", "priority_date")]
    return p.select("page_id", "title", "links", "words", "abstract", *dates, F.array_join("cites", ";").alias("cited"), F.array_join("cited_by", ";").alias("cited_by"), "support")


def _document_pages(t: Tables) -> DataFrame:
    """A page of each order: an abstract, two dates of a kind, numbers inside and outside of the citation table, other citations in rows or in text."""
    k, c = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    rows = F.concat(F.lit("<h2>Non-Patent Citations (2)</h2><table><tr><td>Paper "), k, F.lit(", 1987</td></tr><tr><td>Book</td><td>"), c, F.lit("</td></tr></table>"))
    text = F.concat(F.lit("<h2>Non-Patent Citations</h2><p>Note "), k, F.lit(" of 2003<br>no year</p>"))
    html = F.concat(
        F.lit('<html><head><meta name="DC.description" content="Order &amp; '), k, F.lit('"><meta name="description" content="second"></head><body><time itemprop="priorityDate" datetime="'),
        F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit('">a</time><time itemprop="priorityDate" datetime="1900-01-01">b</time><p><span itemprop="publicationNumber">US0</span></p>'),
        F.lit('<h2>Patent Citations</h2><table><tr><td><span itemprop="publicationNumber"> US'), c, F.lit("</span></td><td>x</td></tr></table>"),
        F.when(F.col("o_orderkey") % 2 == 0, rows).otherwise(text), F.lit("<h2>Similar</h2><table><tr><td>other 1999</td></tr></table><p>cut <b"),
    )
    return S.parse_records(t.orders.select("o_orderkey", html.alias("html")), "o_orderkey", "html")


@query("SELECT o_orderkey, 'Order & ' || o_orderkey AS abstract, strftime(o_orderdate, '%Y-%m-%d') AS priority, 'US' || o_custkey AS cited FROM orders")
def scan_html_record(t):
    """Abstract, first date of a kind, and the numbers in citation tables only."""
    cited = F.transform(F.filter("numbers", lambda n: n["section"].contains("Citations")), lambda n: n["number"])
    return _document_pages(t).select("o_orderkey", "abstract", F.col("dates")["priorityDate"].alias("priority"), F.array_join(cited, ";").alias("cited"))


@query(r"""SELECT o_orderkey, 0::INTEGER AS no, CASE WHEN o_orderkey % 2 = 0 THEN 'Paper ' || o_orderkey || ', 1987' ELSE 'Note ' || o_orderkey || ' of 2003' END AS text,
CASE WHEN regexp_matches(' ' || o_orderkey || ' ', ' (18|19|20)\d\d ') THEN o_orderkey WHEN o_orderkey % 2 = 0 THEN 1987 ELSE 2003 END::INTEGER AS year FROM orders
UNION ALL SELECT o_orderkey, 1, CASE WHEN o_orderkey % 2 = 0 THEN 'Book ' || o_custkey ELSE 'no year' END, CASE WHEN o_orderkey % 2 = 0 AND regexp_matches(' ' || o_custkey || ' ', ' (18|19|20)\d\d ') THEN o_custkey END FROM orders""")
def scan_html_sections(t):
    """Entries below a heading: table rows, or the text where there are none, each with its first year."""
    return S.section_entries(_document_pages(t), "o_orderkey", "Non-Patent Citations")


def _articles(t: Tables) -> DataFrame:
    xml = F.concat(
        F.lit("<A><PMID>"), F.col("o_orderkey").cast("string"), F.lit("</PMID><Title>Order of "), F.col("o_custkey").cast("string"),
        F.lit("</Title><AbstractText>one</AbstractText><AbstractText>two</AbstractText><MeshHeading>M1</MeshHeading><MeshHeading>M2</MeshHeading><GrantList><Grant><GrantID>G"),
        (F.col("o_custkey") % 3).cast("string"), F.lit("</GrantID><Agency>X</Agency></Grant><Grant><GrantID></GrantID><Agency>Y</Agency></Grant></GrantList></A>"),
    )
    return S.article_records(t.orders.select("o_orderkey", xml.alias("xml")), "o_orderkey", "xml")


@query("SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS pmid, 'Order of ' || o_custkey AS title, 'one two' AS abstract, 'M1; M2' AS mesh FROM orders")
def scan_xml_records(t):
    return _articles(t).select("o_orderkey", "pmid", "title", "abstract", "mesh")


@query("SELECT o_orderkey, 'G' || (o_custkey % 3) AS grant_id, 'X' AS agency FROM orders")
def scan_xml_grantlist(t):
    return S.grant_rows(_articles(t), "o_orderkey")


@query("SELECT CAST(3 AS INTEGER) AS columns, CAST(count(*) AS BIGINT) AS rows FROM part")
def sink_replace_raw(t):
    df = t.part.select(F.col("p_partkey").alias("Part Key"), F.col("p_name").alias("Name!"), F.col("p_brand").alias("name"))
    return S.replace_raw(df, scratch(t.spark)).select("columns", "rows")


@query("SELECT p_partkey, CASE WHEN p_size >= 10 THEN p_brand END AS brand FROM part")
def sink_append_core(t):
    path = scratch(t.spark)
    S.append(t.part.select("p_partkey", F.when(F.col("p_size") >= 10, F.col("p_brand")).otherwise(" ").alias("brand")), path)
    return t.spark.read.parquet(path)


@query("SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 'new' ELSE 'old' END AS run FROM orders")
def sink_scoped_replace(t):
    path = scratch(t.spark)
    o = t.orders.select("o_orderkey", "o_orderstatus")
    S.scoped_replace(o.withColumn("run", F.lit("old")), path, "o_orderstatus")
    S.scoped_replace(o.where("o_orderstatus = 'F'").withColumn("run", F.lit("new")), path, "o_orderstatus")
    return t.spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "run")


@query(PART_SQL)
def sink_csv(t):
    path = scratch(t.spark)
    S.write_csv(_part(t), path, ["p_partkey", "p_name", "p_brand"], ["p_partkey"])
    return S.read_text_csv(t.spark, path, ["p_partkey", "p_name", "p_brand"])


@query("SELECT r_regionkey, r_name FROM region")
def sink_json_gz(t):
    path = scratch(t.spark)
    S.write_json_gz(t.region.select("r_regionkey", "r_name"), path, ["r_regionkey"])
    return t.spark.read.schema("r_regionkey int, r_name string").json(path)


@query("SELECT r_regionkey, upper(r_name) AS name FROM region")
def sink_copy_staged_txn(t):
    path = scratch(t.spark)
    t.region.select("r_regionkey", F.lower("r_name").alias("name")).write.parquet(path)
    S.staged(lambda p: t.region.select("r_regionkey", F.upper("r_name").alias("name")).write.parquet(p), t.spark, path)
    return t.spark.read.parquet(path)


@query("SELECT 'good' AS source, 'succeeded' AS status UNION ALL SELECT 'bad', 'failed'")
def sink_batch_status(t):
    log: list[dict] = []
    with S.batch_status(log, "good"):
        t.region.count()
    try:
        with S.batch_status(log, "bad"):
            raise ValueError("no such file")
    except ValueError:
        pass
    return t.spark.createDataFrame([(x["source"], x["status"]) for x in log], "source string, status string")
