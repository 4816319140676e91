"""Queries of the scalar functions: each runs over a whole table, on values picked from a list of cases by the row's key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..registry import Tables, query


def case_of(values: list[str | None], key: str = "o_orderkey") -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (F.col(key) % len(values) + 1).cast("int"))


def case_sql(values: list[str | None], key: str = "o_orderkey") -> str:
    quoted = ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values)
    return f"list_extract([{quoted}], CAST({key} % {len(values)} + 1 AS INTEGER))"


def over_orders(t: Tables, values: list[str | None], **out: Column) -> DataFrame:
    return t.orders.select("o_orderkey", case_of(values).alias("v")).select("o_orderkey", "v", *[c.alias(n) for n, c in out.items()])


def sql_over(values: list[str | None], select: str) -> str:
    return f"WITH s AS (SELECT o_orderkey, {case_sql(values)} AS v FROM orders) SELECT o_orderkey, v, {select} FROM s"


NUMBERS = ["3", " 3.0 ", "-2.7", "", None, "inf", "1e400", "12abc", "1e3", "  ", "0", "42"]
DATES = [
    "2014-08-01", "12-Oct-2014", "2014", "2014-08", "2008-09-26T00:00:00", "2008-09-26T00:00:00Z", "2008-09-26 11:12:13",
    "03/04/2015", "3/4/15", "", None, "2014-2015", "not a date", "2014-13-01", "2008-09-26T00:00:00.123Z",
]
DATE_SQL = """CAST(coalesce(
  CASE WHEN regexp_full_match(trim(v), '\\d{4}-\\d{1,2}-\\d{1,2}([T ]\\d{1,2}:\\d{1,2}:\\d{1,2}(\\.\\d{1,6})?Z?)?') THEN try_strptime(regexp_extract(trim(v), '^(\\d{4}-\\d{1,2}-\\d{1,2})', 1), '%Y-%m-%d') END,
  CASE WHEN regexp_full_match(trim(v), '\\d{1,2}/\\d{1,2}/\\d{4}') THEN try_strptime(trim(v), '%m/%d/%Y') END,
  CASE WHEN regexp_full_match(trim(v), '\\d{1,2}/\\d{1,2}/\\d{2}') THEN try_strptime(trim(v), '%m/%d/%y') END,
  CASE WHEN regexp_full_match(trim(v), '\\d{1,2}-[A-Za-z]{3}-\\d{4}') THEN try_strptime(trim(v), '%d-%b-%Y') END) AS DATE)"""


@query(sql_over(NUMBERS, "nullif(trim(v), '') AS cleaned"))
def fn_blank_to_none(t):
    return over_orders(t, NUMBERS, cleaned=S.blank_to_none(F.col("v")))


@query(sql_over(NUMBERS, "CAST(CASE WHEN abs(try_cast(trim(v) AS DOUBLE)) < 9.2e18 THEN trunc(try_cast(trim(v) AS DOUBLE)) END AS BIGINT) AS n"))
def fn_safe_int(t):
    return over_orders(t, NUMBERS, n=S.safe_int(F.col("v")))


@query(sql_over(FLOATS := [v for v in NUMBERS if v not in ("inf", "1e400")], "try_cast(nullif(trim(v), '') AS DOUBLE) AS x"))
def fn_safe_float(t):
    return over_orders(t, FLOATS, x=S.safe_float(F.col("v")))


@query(sql_over(DATES, f"CAST({DATE_SQL} AS VARCHAR) AS day"))
def fn_safe_date(t):
    return over_orders(t, DATES, day=S.safe_date(F.col("v")).cast("string"))


@query(sql_over(DATES, f"CAST(coalesce(year({DATE_SQL}), try_cast(nullif(regexp_extract(trim(v), '^(\\d{{4}})(-\\d{{2}})?$', 1), '') AS INTEGER)) AS INTEGER) AS y"))
def fn_safe_year(t):
    return over_orders(t, DATES, y=S.safe_year(F.col("v")))


@query(sql_over(DATES, "CASE WHEN regexp_full_match(v, '\\d{4}') THEN CAST(v AS INTEGER) END AS y"))
def filter_pattern_year(t):
    return over_orders(t, DATES, y=S.document_year(F.col("v")))


ACCESSIONS = ["KM034562.1", "KM034562", " AB1.23 ", "X.1.2", "", None, "NC_002549.1"]


@query(sql_over(ACCESSIONS, "regexp_replace(nullif(trim(v), ''), '\\.\\d+$', '') AS base"))
def fn_base_accession(t):
    return over_orders(t, ACCESSIONS, base=S.base_accession(F.col("v")))


DOCUMENTS = ["US20180291088A1", "US 20180291088 A1", "78828615.0", "WO 2015 A", " EP1234567B1 ", "n/a", None, ""]
DOC_RE = "^\\s*([A-Z]{2})\\s*(\\d+)\\s*([A-Z]\\d?)\\s*$"


@query(sql_over(DOCUMENTS, f"CASE WHEN regexp_matches(v, '{DOC_RE}') THEN regexp_extract(v, '{DOC_RE}', 1) || ' ' || regexp_extract(v, '{DOC_RE}', 2) || ' ' || regexp_extract(v, '{DOC_RE}', 3) ELSE nullif(trim(v), '') END AS doc"))
def fn_normalize_document_id(t):
    return over_orders(t, DOCUMENTS, doc=S.normalize_document_id(F.col("v")))


@query(sql_over(DOCUMENTS, "regexp_replace(nullif(trim(v), ''), '\\.0$', '') AS family"))
def fn_family_id(t):
    return over_orders(t, DOCUMENTS, family=S.family_id(F.col("v")))


@query(sql_over(DOCUMENTS, "nullif(regexp_extract(v, '\\s([A-Z]\\d?)$', 1), '') AS kind"))
def fn_kind_code(t):
    return over_orders(t, DOCUMENTS, kind=S.kind_code(F.col("v")))


GRANTS = ["1 U19 AI109762-01", "5R01AI123456-03S1", "U19AI109762", "none", None]


@query(sql_over(GRANTS, "nullif(regexp_extract(regexp_replace(upper(v), '\\s+', '', 'g'), '([A-Z]\\d{2}[A-Z]{2}\\d{6})', 1), '') AS core"))
def fn_core_award_number(t):
    return over_orders(t, GRANTS, core=S.core_award_number(F.col("v")))


@query("SELECT o_orderkey, substr(sha1(o_orderkey || '|' || o_custkey || '|' || o_orderstatus), 1, 16) AS evidence_id FROM orders")
def link_evidence_hash_id(t):
    return t.orders.select("o_orderkey", S.evidence_id(F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")).alias("evidence_id"))


@query("SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS title FROM part")
def fn_norm_title(t):
    return t.part.select("p_partkey", S.norm_title(F.col("p_name")).alias("title"))


@query("SELECT c_custkey, regexp_replace(lower(c_name), '[^a-z]', '', 'g') AS name_key FROM customer")
def fn_name_key(t):
    return t.customer.select("c_custkey", S.name_key(S.ascii_fold(F.col("c_name"))).alias("name_key"))


@query("SELECT p_partkey, array_to_string(list_filter(regexp_split_to_array(lower(p_name), '[^a-z]+'), lambda x: x <> ''), ' ') AS tokens FROM part")
def fn_name_tokens(t):
    return t.part.select("p_partkey", F.array_join(S.name_tokens(F.col("p_name")), " ").alias("tokens"))


PARTIAL = ["2013-01", "2013", "2013-05-06", "", None]


@query(sql_over(PARTIAL, "array_to_string(list_slice(string_split(trim(coalesce(v, '')), '-') || ['01', '01'], 1, 3), '-') AS padded, CASE len(string_split(trim(coalesce(v, '')), '-')) WHEN 1 THEN 'year' WHEN 2 THEN 'month' WHEN 3 THEN 'day' ELSE '' END AS precision"))
def fn_paper_date(t):
    padded, precision = S.paper_date(F.col("v"))
    return over_orders(t, PARTIAL, padded=padded, precision=precision)


@query("SELECT o_orderkey, CAST(make_date(CAST(year(o_orderdate) AS INTEGER) - 1, 10, 1) AS VARCHAR) AS fiscal_start FROM orders")
def fn_fiscal_year_start(t):
    return t.orders.select("o_orderkey", S.fiscal_year_start(F.year("o_orderdate")).cast("string").alias("fiscal_start"))


@query("SELECT l_orderkey, l_linenumber, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def fn_days_between(t):
    both = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate").join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return both.select("l_orderkey", "l_linenumber", F.datediff("l_shipdate", "o_orderdate").alias("days"))


@query("""SELECT 'order' AS kind, o_orderkey AS id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, 'day' AS date_precision, 'ordered' AS basis FROM orders
UNION ALL SELECT 'line', l_orderkey * 10 + l_linenumber, CAST(make_date(CAST(year(l_shipdate) AS INTEGER), 1, 1) AS VARCHAR), 'year', 'ship_year' FROM lineitem""")
def fn_document_date(t):
    a = t.orders.select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").cast("string").alias("day"), F.lit("day").alias("date_precision"), F.lit("ordered").alias("basis"))
    b = t.lineitem.select(F.lit("line").alias("kind"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.make_date(F.year("l_shipdate"), F.lit(1), F.lit(1)).cast("string").alias("day"), F.lit("year").alias("date_precision"), F.lit("ship_year").alias("basis"))
    return a.unionByName(b)


@query(r"""SELECT page_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(html, '<head\b.*?</head>', ' ', 'gis'), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))) AS text_md5 FROM pages""")
def fn_strip_html(t):
    return t.pages.select("page_id", F.md5(S.strip_html(F.col("html"))).alias("text_md5"))


TEXTS = ["Changes in &#946;-cells &gt; 3", "524 \x13 539", "KÃ¼ttner G, HÃ¶hne W", "good text", "   ", None]
CLEAN = ["Changes in β-cells > 3", "524 – 539", "Küttner G, Höhne W", "good text", None, None]


@query(f"SELECT o_orderkey, {case_sql(CLEAN)} AS cleaned FROM orders")
def fn_clean_text_cases(t):
    return t.orders.select("o_orderkey", case_of(TEXTS).alias("v")).select("o_orderkey", S.clean_text(F.col("v")).alias("cleaned"))


@query("SELECT doc_id, md5('> ' || text || ' –') AS cleaned_md5 FROM documents")
def fn_clean_text(t):
    """Whole documents whose UTF-8 was read as single bytes (never, once or twice, by their number), between an entity, a control letter and blanks."""
    once = lambda c: F.decode(F.encode(c, "UTF-8"), "ISO-8859-1")
    n = F.col("doc_id") % 3
    spoilt = F.when(n == 0, F.col("text")).when(n == 1, once(F.col("text"))).otherwise(once(once(F.col("text"))))
    return t.documents.select("doc_id", F.md5(S.clean_text(F.concat(F.lit(" \n &gt; "), spoilt, F.lit(" \x13 ")))).alias("cleaned_md5"))


@query(r"""SELECT doc_id, md5(coalesce(array_to_string(list_filter(list_transform(string_split_regex(text, '\r?\n'), lambda x: trim(regexp_replace(x, '[ \t\x0B\f\r]+', ' ', 'g'))), lambda x: x <> ''), chr(10)), '')) AS text_md5 FROM documents""")
def fn_clean_text_lines(t):
    return t.documents.select("doc_id", F.md5(F.coalesce(S.clean_lines(F.col("text")), F.lit(""))).alias("text_md5"))


CALLS = ["yes (Mayinga)", "no", "partial", "_", None, "YES"]


@query(sql_over(CALLS, "CASE WHEN lower(trim(split_part(v, '(', 1))) IN ('yes','y','true','neutralizing') THEN 'true' WHEN lower(trim(split_part(v, '(', 1))) IN ('no','n','false','non-neutralizing') THEN 'false' END AS neutralizing"))
def fn_parse_neutralizing(t):
    return over_orders(t, CALLS, neutralizing=S.parse_neutralizing(F.col("v")).cast("string"))


@query(sql_over(CALLS, "CASE WHEN lower(trim(v)) NOT IN ('_', 'na', 'n/a') THEN nullif(trim(v), '') END AS cleaned"))
def filter_placeholder(t):
    return over_orders(t, CALLS, cleaned=S.placeholder_to_none(F.col("v"), "_", "NA", "n/a"))


@query("SELECT p_partkey, CASE WHEN p_type LIKE '%STEEL%' THEN 'steel' WHEN p_type LIKE '%BRASS%' THEN 'brass' ELSE 'other' END AS entity FROM part")
def fn_entity_index(t):
    return t.part.select("p_partkey", S.first_rule(F.col("p_type"), [("STEEL", "steel"), ("BRASS", "brass")], "other").alias("entity"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 OR o_orderstatus = 'F' THEN 'high' WHEN o_orderkey % 2 = 0 THEN 'medium' ELSE 'low' END AS confidence FROM orders")
def fn_match_confidence(t):
    method = F.when(F.col("o_orderkey") % 2 == 0, "forename").otherwise("initials")
    return t.orders.select("o_orderkey", S.match_confidence(method, F.col("o_orderkey") % 5 == 0, F.col("o_orderstatus") == "F").alias("confidence"))


@query("SELECT o_orderkey, 'https://example.org/orders/' || o_orderkey || '/' AS url FROM orders")
def fn_url_build(t):
    return t.orders.select("o_orderkey", F.concat(F.lit("https://example.org/orders/"), F.col("o_orderkey").cast("string"), F.lit("/")).alias("url"))


@query("SELECT doc_id, md5(text) AS content_md5 FROM documents")
def fn_md5_file(t):
    return t.documents.select("doc_id", F.md5("text").alias("content_md5"))


@query("""SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 4) AS cosine
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def fn_cosine(t):
    a = t.embeddings.select(F.col("vec_id").alias("a"), F.col("embedding").alias("ea"))
    b = t.embeddings.select(F.col("vec_id").alias("b"), F.col("embedding").alias("eb"))
    return a.join(b, F.col("b") == F.col("a") + 1).select("a", "b", F.round(S.cosine(F.col("ea"), F.col("eb")), 4).alias("cosine"))


@query("""SELECT doc_id, CASE WHEN strpos(text, 'that') > 0 THEN substr(text, greatest(strpos(text, 'that') - 40, 1), strpos(text, 'that') - greatest(strpos(text, 'that') - 40, 1))
|| '[[that]]' || substr(text, strpos(text, 'that') + 4, 40) END AS snippet FROM documents""")
def fn_snippet(t):
    return t.documents.select("doc_id", S.snippet(F.col("text"), F.instr("text", "that"), F.lit(4), 40).alias("snippet"))


@query("SELECT doc_id, CASE WHEN length(text) > 160 THEN substr(text, 1, 159) || '…' ELSE text END AS short FROM documents")
def proj_truncate_text(t):
    return t.documents.select("doc_id", S.truncate_text(F.col("text")).alias("short"))


@query(r"""WITH h AS (SELECT p_partkey, [p_name, ' ' || upper(p_name) || '!', p_brand, '', p_type, 'Unnamed: ' || p_size, '%', p_name || '_'] AS raw FROM part),
c AS (SELECT p_partkey, list_transform(raw, lambda x: coalesce(nullif(trim(regexp_replace(lower(trim(x)), '[^0-9a-z]+', '_', 'g'), '_'), ''), 'col')) AS names FROM h),
n AS (SELECT p_partkey, names, list_transform(names, lambda x, i: len(list_filter(names[1:i], lambda y: y = x))) AS times FROM c)
SELECT p_partkey, array_to_string(list_transform(names, lambda x, i: CASE WHEN times[i] = 1 THEN x ELSE x || '_' || times[i] END), ';') AS cleaned FROM n""")
def fn_clean_columns(t):
    """A header a part, of names that repeat, are blank or differ in marks only."""
    raw = F.array("p_name", F.concat(F.lit(" "), F.upper("p_name"), F.lit("!")), "p_brand", F.lit(""), "p_type", F.concat(F.lit("Unnamed: "), F.col("p_size").cast("string")), F.lit("%"), F.concat("p_name", F.lit("_")))
    return t.part.select("p_partkey", F.array_join(S.clean_header(raw), ";").alias("cleaned"))
