"""Queries that build documents and links from delivered rows, and those of fuzzy and rule-based joins.

Fields that the tables lack (award numbers, statements, names of organisations) are written
from their columns, so that the SQL beside a query can tell the answer another way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import joins as J
from ..operators import linking as L
from ..operators import matching as M
from ..operators import organisations as O
from ..operators import resolve as R
from ..registry import Tables, query
from ..session import stored
from .link_queries import HITS, fields, vocabulary
from .scalar_queries import DOCUMENTS, case_of, sql_over

# ---- documents

TOPICS = ["urgent", "high", "medium", "low", "not specified"]
TOPIC_SQL = ", ".join(f"('{w}')" for w in TOPICS)


@query(f"""WITH a AS (SELECT o_custkey AS award, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS headline, coalesce(arg_min(nullif(o_orderstatus, 'O'), (o_orderdate, o_orderkey)), 'unknown') AS pi,
  CAST(min(year(o_orderdate)) AS INTEGER) AS first_year, CAST(max(year(o_orderdate)) AS INTEGER) AS last_year, CAST(count(*) AS BIGINT) AS records,
  CASE WHEN bool_or(o_orderpriority LIKE '1-%') THEN 'strong' WHEN count(*) FILTER (WHERE o_orderpriority LIKE '2-%') >= 2 THEN 'moderate' WHEN count(*) FILTER (WHERE o_orderpriority LIKE '2-%') = 1 THEN 'weak' END AS tier FROM orders GROUP BY o_custkey)
SELECT a.*, (SELECT string_agg(w, ';' ORDER BY w) FROM (VALUES {TOPIC_SQL}) v(w) WHERE regexp_matches(lower(headline), '(^|[^0-9a-z])' || w || '($|[^0-9a-z])')) AS keywords FROM a""")
def link_build_grants(t):
    """One award: headline of its earliest record, investigator of the earliest record that names one, years, tier, keywords."""
    at, y, p = F.struct("o_orderdate", "o_orderkey"), F.year("o_orderdate"), F.col("o_orderpriority")
    named = F.nullif("o_orderstatus", F.lit("O"))
    awards = t.orders.groupBy(F.col("o_custkey").alias("award")).agg(
        F.min_by("o_orderpriority", at).alias("headline"), F.coalesce(F.min_by(named, F.when(named.isNotNull(), at)), F.lit("unknown")).alias("pi"),
        F.min(y).alias("first_year"), F.max(y).alias("last_year"), F.count("*").alias("records"),
        L.relevance_tier(F.bool_or(p.startswith("1-")), F.count_if(p.startswith("2-"))).alias("tier"),
    )
    words = t.spark.createDataFrame([(w,) for w in TOPICS], "term string")
    found = L.term_matches(awards, words, "award", "headline", "term").groupBy("award").agg(F.array_join(F.array_sort(F.collect_set("term")), ";").alias("keywords"))
    return awards.join(found, "award", "left")


@query("""WITH d AS (SELECT l_partkey, bool_or(l_returnflag = 'R' AND l_discount > 0.08) AS claims, bool_or(l_discount > 0.09) AS scope, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY l_partkey)
SELECT p_partkey, coalesce(CASE WHEN p_size % 4 > 0 THEN p_name END, p_type, 'untitled') AS title, split_part(p_brand, '#', 1) AS section, split_part(p_brand, '#', 2) AS cpc_group,
  CASE WHEN claims THEN 'claims' WHEN scope THEN 'query_scope' ELSE 'related' END AS relation, CAST(CASE WHEN claims THEN 0.7 WHEN scope THEN 0.4 ELSE 0.5 END AS DOUBLE) AS confidence, coalesce(n, 0) AS n
FROM part LEFT JOIN d ON l_partkey = p_partkey""")
def link_build_patents(t):
    """One patent: gaps of its title filled from details, its class split, and how it holds its topic (claims first, then the query's scope)."""
    claims, scope = (F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.08), F.col("l_discount") > 0.09
    hits = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.bool_or(claims).alias("c"), F.bool_or(scope).alias("s"), F.count("*").alias("n"))
    title = F.coalesce(F.when(F.col("p_size") % 4 > 0, F.col("p_name")), "p_type", F.lit("untitled"))
    field = F.when(F.col("c"), "title").when(F.col("s"), "query_scope").otherwise("abstract")
    part = lambda i: F.split_part("p_brand", F.lit("#"), F.lit(i))
    return t.part.join(hits, "p_partkey", "left").select(
        "p_partkey", title.alias("title"), part(1).alias("section"), part(2).alias("cpc_group"), F.when(F.col("c"), "claims").when(F.col("s"), "query_scope").otherwise("related").alias("relation"),
        L.confidence(field, F.lit(False)).alias("confidence"), F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


@query("""WITH cited AS (SELECT doc_id * 2 AS doc_id, 'und' AS lang, quality, 'cited' AS origin FROM labels),
bundle AS (SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN lang END AS lang, CAST(NULL AS BIGINT) AS quality, 'bundle' AS origin FROM documents)
SELECT coalesce(b.doc_id, c.doc_id) AS doc_id, coalesce(b.lang, c.lang) AS lang, coalesce(b.quality, c.quality) AS quality, coalesce(b.origin, c.origin) AS origin FROM bundle b FULL JOIN cited c ON b.doc_id = c.doc_id""")
def link_build_papers(t):
    """The bundle with metadata of cited papers filled in; papers that are only cited are added."""
    cited = t.labels.select((F.col("doc_id") * 2).alias("doc_id"), F.lit("und").alias("lang"), F.col("quality").cast("long").alias("quality"), F.lit("cited").alias("origin"))
    bundle = t.documents.select("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("lang")).alias("lang"), F.lit(None).cast("long").alias("quality"), F.lit("bundle").alias("origin"))
    return R.upsert_coalesce(bundle, cited, "doc_id")


@query("""WITH refs AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN 'part' WHEN 1 THEN 'supplier' WHEN 2 THEN 'nation' ELSE 'part' END AS kind, l_partkey, l_suppkey FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN 'part:' || p_partkey WHEN 1 THEN 'supplier:' || s_suppkey WHEN 2 THEN 'nation:' || n_nationkey END AS entity FROM refs
LEFT JOIN part ON l_linenumber % 4 = 0 AND p_partkey = l_partkey LEFT JOIN supplier ON l_linenumber % 4 = 1 AND s_suppkey = l_suppkey LEFT JOIN nation ON l_linenumber % 4 = 2 AND n_nationkey = l_suppkey % 30""")
def link_paper_entities(t):
    """References by natural id (a number, a name in any case) resolved in one join with all typed lookups; unknown ones stay null."""
    n = F.col("l_linenumber") % 4
    kind = F.when(n == 1, "supplier").when(n == 2, "nation").otherwise("part")
    natural = (
        F.when(n == 0, F.col("l_partkey").cast("string")).when(n == 1, F.concat(F.lit("SUPPLIER#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")))
        .when(n == 2, F.concat(F.lit(" Nation_"), (F.col("l_suppkey") % 30).cast("string"))).otherwise(F.concat(F.lit("peptide "), F.col("l_partkey").cast("string")))
    )
    refs = t.lineitem.select("l_orderkey", "l_linenumber", kind.alias("kind"), F.lower(F.trim(natural)).alias("natural"))
    lookups = [
        t.part.select(F.lit("part").alias("kind"), F.col("p_partkey").cast("string").alias("natural"), F.col("p_partkey").alias("id")),
        t.supplier.select(F.lit("supplier"), F.lower("s_name"), "s_suppkey"), t.nation.select(F.lit("nation"), F.lower("n_name"), "n_nationkey"),
    ]
    known = reduce(DataFrame.union, lookups).groupBy("kind", "natural").agg(F.min("id").alias("id"))
    entity = F.when(F.col("id").isNotNull(), F.concat_ws(":", "kind", F.col("id").cast("string")))
    return refs.join(known, ["kind", "natural"], "left").select("l_orderkey", "l_linenumber", entity.alias("entity"))


# ---- links

#: Claimed keywords of delivered hits (`;` between them), and a name that is no symptom though it holds one.
CLAIMED, MASKED = ["la;that", "idiot;moron;that", "nothing here", "that;of"], "of the"
CLAIM_SQL = "list_extract([" + ", ".join(f"'{c}'" for c in CLAIMED) + "], CAST(doc_id % 4 + 1 AS INTEGER))"
MASK_SQL = f"regexp_replace(regexp_replace(content, '(^|[^0-9a-z]){MASKED}($|[^0-9a-z])', '\\1 \\2', 'g'), '(^|[^0-9a-z]){MASKED}($|[^0-9a-z])', '\\1 \\2', 'g')"


@query(f"""WITH c AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lower(split_part(text, chr(10), 1)) ELSE lower(substr(text, length(split_part(text, chr(10), 1)) + 1)) END AS content, string_split({CLAIM_SQL}, ';') AS terms FROM documents),
e AS (SELECT doc_id, {MASK_SQL} AS content, unnest(terms) AS term, generate_subscripts(terms, 1) AS pos FROM c)
SELECT doc_id, arg_min(term, pos) AS term FROM e WHERE regexp_matches(content, '(^|[^0-9a-z])' || term || '($|[^0-9a-z])') GROUP BY doc_id""")
def link_clinical_recheck(t):
    """Delivered hits looked up again: the first claimed term that stands in the claimed field, outside masked names."""
    field = F.when(F.col("doc_id") % 2 == 0, "title").otherwise("abstract")
    content = F.regexp_replace(F.lower("content"), rf"(?<![0-9a-z]){MASKED}(?![0-9a-z])", " ")
    claims = fields(t).where(F.col("field") == field).select("doc_id", content.alias("content"), F.posexplode(F.split(case_of(CLAIMED, "doc_id"), ";")).alias("pos", "term"))
    found = claims.where(F.regexp_count("content", L.whole_token(F.col("term"))) > 0)
    return found.groupBy("doc_id").agg(F.min_by("term", "pos").alias("term"))


@query("SELECT l_orderkey AS doc, p_partkey AS award FROM (SELECT l_orderkey, l_partkey, string_agg(DISTINCT l_returnflag, ';') AS basis FROM lineitem GROUP BY ALL) JOIN part ON p_partkey = l_partkey WHERE contains(basis, 'R')")
def link_ack(t):
    """Links whose basis, a list of all methods that found them, holds the acknowledged one."""
    basis = t.lineitem.groupBy(F.col("l_orderkey").alias("doc"), F.col("l_partkey").alias("award")).agg(F.array_join(F.array_sort(F.collect_set("l_returnflag")), ";").alias("basis"))
    return basis.where(F.col("basis").contains("R")).join(t.part.select(F.col("p_partkey").alias("award")), "award", "left_semi").select("doc", "award")


KINDS = {
    "order": ("orders", "o_orderkey", ["o_custkey"]), "part": ("part", "p_partkey", ["p_brand", "p_type"]), "customer": ("customer", "c_custkey", ["c_nationkey"]),
    "supplier": ("supplier", "s_suppkey", ["s_nationkey"]), "document": ("documents", "doc_id", ["source", "lang"]), "event": ("events", "event_id", ["user_id", "event_type"]),
}
CITES_SQL = " UNION ALL ".join(
    f"SELECT '{k}' AS kind, CAST(src AS BIGINT) AS src, CAST(dst AS BIGINT) AS dst FROM (SELECT {i} AS src, lag({i}) OVER (PARTITION BY {', '.join(g)} ORDER BY {i}) AS dst FROM {tab}) WHERE dst IS NOT NULL"
    for k, (tab, i, g) in KINDS.items()
)


@query(CITES_SQL)
def link_doc_citations(t):
    """Six kinds of edges between documents of one type: each cites the one before it in its group."""
    parts = []
    for kind, (tab, ident, group) in KINDS.items():
        near = J.consecutive(getattr(t, tab), group, [ident], ident)
        parts.append(near.select(F.lit(kind).alias("kind"), F.col("next_value").cast("long").alias("src"), F.col(ident).cast("long").alias("dst")))
    return reduce(DataFrame.union, parts)


def _serial(key: Column) -> Column:
    """Institute and six digits of a key: AI for the first million, the next two letters for the next (676 in all)."""
    i = (F.floor(key / 1_000_000) + 8) % 676
    letter = lambda x: F.chr((x + 65).cast("long"))
    return F.concat(letter(F.floor(i / 26)), letter(i % 26), F.lpad((key % 1_000_000).cast("string"), 6, "0"))


def _core(key: Column) -> Column:
    return F.concat(F.lit("R01"), _serial(key))


def _awards(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("award"), _core(F.col("c_custkey")).alias("core"))


def _resolved(t: Tables, texts: DataFrame) -> DataFrame:
    """(doc, target) of all awards whose numbers stand in texts (doc, text)."""
    found = L.grant_numbers(texts, "text").select("doc", "activity", "serial").distinct()
    return L.resolve_grants(found, _awards(t)).select("doc", F.col("award").alias("target")).distinct()


@query("SELECT o_orderkey AS doc, c_custkey AS target FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'F'")
def link_grant_patent(t):
    """Awards named in statements of government support; numbers elsewhere in the text don't count."""
    head = F.concat(F.lit("Related work was R01 AI"), F.lpad(F.col("o_orderkey").cast("string"), 6, "0"), F.lit(". "))
    made = F.concat(F.lit("This was made with government support under R01-"), _serial(F.col("o_custkey")), F.lit(" awarded by an institute. End."))
    text = F.concat(head, F.when(F.col("o_orderstatus") == "F", made).otherwise(F.lit("No support is stated.")))
    texts = t.orders.select(F.col("o_orderkey").alias("doc"), M.federal_statement(text).alias("text"))
    return _resolved(t, texts.where("text IS NOT NULL"))


@query("SELECT DISTINCT l_orderkey AS doc, c_custkey AS target FROM lineitem JOIN customer ON c_custkey = l_partkey WHERE l_returnflag <> 'N'")
def link_paper_grant(t):
    """Awards in a paper's grant list (XML): one row a listed grant with a number."""
    number = F.when(F.col("l_returnflag") != "N", F.concat(F.lit("<GrantID>R01 "), _serial(F.col("l_partkey")), F.lit("</GrantID>"))).otherwise(F.lit("<GrantID/>"))
    item = F.concat(F.lit("<Grant>"), number, F.lit("<Agency>NIAID</Agency></Grant>"))
    lists = t.lineitem.select(F.col("l_orderkey").alias("doc"), F.concat(F.lit("<GrantList>"), item, F.lit("</GrantList>")).alias("xml"))
    listed = lists.select("doc", F.explode(F.regexp_extract_all("xml", F.lit("<GrantID>([^<]+)</GrantID>"), F.lit(1))).alias("text"))
    return _resolved(t, listed)


@query("""WITH a AS (SELECT c_custkey % 1000 AS ref, min(c_custkey) AS target FROM customer GROUP BY 1 HAVING count(*) = 1)
SELECT DISTINCT o_orderkey AS doc, target FROM orders JOIN a ON ref = (o_custkey * 7) % 1000 WHERE target <> o_custkey""")
def link_grant_in_text(t):
    """A core number in another award's text, where it belongs to one award only."""
    text = F.concat(F.lit("continues award "), _core(F.col("o_custkey") * 7 % 1000), F.lit(", see there"))
    found = L.grant_numbers(t.orders.select(F.col("o_orderkey").alias("doc"), "o_custkey", text.alias("text")), "text")
    awards = t.customer.select(F.col("c_custkey").alias("target"), _core(F.col("c_custkey") % 1000).alias("core"))
    single = awards.groupBy("core").agg(F.min("target").alias("target"), F.count("*").alias("n")).where("n = 1")
    both = found.withColumn("core", F.concat("activity", "serial")).join(single, "core")
    return both.where(F.col("target") != F.col("o_custkey")).select("doc", "target").distinct()


PRODUCTS = [("P1", "idiot"), ("P1", "moron"), ("P1", "that"), ("P2", "la"), ("P2", "thing"), ("P2", "token")]
PRODUCT_SQL = ", ".join(f"('{a}', '{b}')" for a, b in PRODUCTS)


@query(f"""WITH d AS (SELECT 'document' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'page', page_id, html FROM pages UNION ALL SELECT 'passage', item_id, text FROM benchmark),
p AS (SELECT kind, id, ' ' || regexp_replace(lower(text), '[^0-9a-z]', ' ', 'g') || ' ' AS padded FROM d),
h AS (SELECT kind, id, product, term, strpos(padded, ' ' || term || ' ') AS place FROM p, (VALUES {PRODUCT_SQL}) v(product, term))
SELECT kind, id, product, arg_min(term, place) AS term FROM h WHERE place > 0 GROUP BY kind, id, product""")
def link_countermeasure(t):
    """Products named in three kinds of documents; of a product's names the one that stands first is kept."""
    docs = t.documents.select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text").union(t.pages.select(F.lit("page"), "page_id", "html")).union(t.benchmark.select(F.lit("passage"), "item_id", "text"))
    names = t.spark.createDataFrame(PRODUCTS, "product string, term string")
    found = L.term_matches(docs, names, "id", "text", "term", carry=("kind",)).join(F.broadcast(names), "term")
    return found.groupBy("kind", "id", "product").agg(F.min_by("term", "at").alias("term"))


@query("""WITH d AS (SELECT l_orderkey, l_linenumber, o_orderdate, CASE l_linenumber % 4 WHEN 0 THEN strftime(l_shipdate, '%Y-%m-%d') WHEN 1 THEN strftime(l_shipdate, '%d %b %Y') WHEN 2 THEN strftime(l_shipdate, '%Y-13-%d') END AS v FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN regexp_full_match(v, '\\d{4}-\\d{2}-\\d{2}') THEN TRY_CAST(v AS DATE) END, CAST(o_orderdate AS DATE)) AS online FROM d""")
def link_online_date(t):
    """A delivered date text replaces the known date only if it has the right form and is a date."""
    n, ship = F.col("l_linenumber") % 4, F.col("l_shipdate")
    text = F.when(n == 0, F.date_format(ship, "yyyy-MM-dd")).when(n == 1, F.date_format(ship, "dd MMM yyyy")).when(n == 2, F.concat(F.date_format(ship, "yyyy"), F.lit("-13-"), F.date_format(ship, "dd")))
    d = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("v", text)
    valid = F.when(F.col("v").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col("v").try_cast("date"))
    return d.select("l_orderkey", "l_linenumber", F.coalesce(valid, F.to_date("o_orderdate")).alias("online"))


#: term, and the words one of which must follow it ('' for none).
CASED = [("IS", ""), ("that", ""), ("In", ""), ("A", "the|and|of|in")]


@query("""SELECT doc_id, term FROM documents, (VALUES ('IS', '(^|[^0-9A-Za-z])IS($|[^0-9A-Za-z])'), ('that', '(?i)(^|[^0-9a-z])that($|[^0-9a-z])'), ('In', '(?i)(^|[^0-9a-z])in($|[^0-9a-z])'),
('A', '(^|[^0-9A-Za-z])A\\s+(the|and|of|in)($|[^0-9A-Za-z])')) v(term, pattern) WHERE regexp_matches(text, pattern)""")
def link_case_rule(t):
    """Short upper-case terms and single letters are taken in that case only; a single letter needs one of its following words."""
    rules = [F.when(F.regexp_count("text", L.cased_pattern(term, follow)) > 0, F.lit(term)) for term, follow in CASED]
    return t.documents.select("doc_id", F.explode(F.array_compact(F.array(*rules))).alias("term"))


@query(f"WITH {HITS} SELECT doc_id, field, term FROM hits WHERE etype IN ('taxon', 'condition')")
def link_record_staging(t):
    """Hits of the types that are staged, field by field, with the vocabulary from its table."""
    staged = vocabulary(t).where(F.col("etype").isin("taxon", "condition"))
    return L.term_matches(fields(t), staged, "doc_id", "content", "term", carry=("field",)).select("doc_id", "field", "term")


@query("""WITH v AS (SELECT DISTINCT trim(regexp_replace(lower(regexp_extract(text, '^[^ ]+ [^ ]+')), '[^a-z0-9 ]', ' ', 'g')) AS term FROM benchmark),
d AS (SELECT doc_id, 'title' AS field, ' ' || regexp_replace(lower(split_part(text, chr(10), 1)), '[^a-z0-9 ]', ' ', 'g') || ' ' AS body FROM documents
  UNION ALL SELECT doc_id, 'abstract', ' ' || regexp_replace(lower(substr(text, length(split_part(text, chr(10), 1)) + 1)), '[^a-z0-9 ]', ' ', 'g') || ' ' FROM documents)
SELECT doc_id, term, max(field) AS location FROM d, v WHERE length(term) >= 3 AND contains(body, ' ' || term || ' ') GROUP BY doc_id, term""")
def link_patent_simple(t):
    """Terms of three letters or more on normalised text; a hit in the title outranks one in the abstract."""
    plain = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9 ]", " ")
    terms = t.benchmark.select(F.trim(plain(F.regexp_extract("text", "^[^ ]+ [^ ]+", 0))).alias("term")).where(F.length("term") >= 3)
    found = L.term_matches(fields(t).withColumn("content", plain("content")), terms, "doc_id", "content", "term", carry=("field",))
    return found.groupBy("doc_id", "term").agg(F.max("field").alias("location"))


@query("""WITH v AS (SELECT 'taxon' AS kind, lower(n_name) AS term, CAST(n_regionkey AS VARCHAR) AS ref FROM nation UNION SELECT 'antibody', 's' || s_suppkey, NULL FROM supplier
  UNION SELECT 'antibody', lower(s_name), NULL FROM supplier WHERE s_suppkey % 2 = 0 UNION SELECT 'gene', lower(p_brand || '/' || p_type), lower(p_brand) FROM part UNION SELECT 'extra', 'widget', NULL),
taxa AS (SELECT CAST(n_regionkey AS VARCHAR) AS ref, min(n_nationkey) AS id FROM nation GROUP BY 1), names AS (SELECT lower(s_name) AS name, min(s_suppkey) AS id FROM supplier GROUP BY 1),
alias AS (SELECT 's' || s_suppkey AS name, min(s_suppkey) AS id FROM supplier GROUP BY 1), sym AS (SELECT lower(p_brand || '/' || p_type) AS name, min(p_partkey) AS id FROM part WHERE p_size > 45 GROUP BY 1),
can AS (SELECT lower(p_brand) AS name, min(p_partkey) AS id FROM part WHERE p_size > 45 GROUP BY 1)
SELECT kind, term, CASE kind WHEN 'taxon' THEN taxa.id WHEN 'antibody' THEN coalesce(names.id, alias.id) WHEN 'gene' THEN coalesce(sym.id, can.id) END AS entity_id
FROM v LEFT JOIN taxa ON kind = 'taxon' AND taxa.ref = v.ref LEFT JOIN names ON kind = 'antibody' AND names.name = term LEFT JOIN alias ON kind = 'antibody' AND alias.name = term
LEFT JOIN sym ON kind = 'gene' AND sym.name = term LEFT JOIN can ON kind = 'gene' AND can.name = v.ref""")
def link_vocab_resolve(t):
    """Terms to entities by kind: a taxon by stable id (first loaded), an antibody by name, then alias, a gene by symbol, then by a sibling of its canonical name."""
    gene = F.lower(F.concat_ws("/", "p_brand", "p_type"))
    none = F.lit(None).cast("string")
    v = [
        t.nation.select(F.lit("taxon").alias("kind"), F.lower("n_name").alias("term"), F.col("n_regionkey").cast("string").alias("ref")),
        t.supplier.select(F.lit("antibody"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string")), none),
        t.supplier.where("s_suppkey % 2 = 0").select(F.lit("antibody"), F.lower("s_name"), none), t.part.select(F.lit("gene"), gene, F.lower("p_brand")),
        t.spark.createDataFrame([("extra", "widget", None)], "kind string, term string, ref string"),
    ]
    known = t.part.where("p_size > 45")
    #: kind, how well the key is trusted (0 first), key, id
    keys = [
        t.nation.select(F.lit("taxon").alias("kind"), F.lit(1).alias("trust"), F.col("n_regionkey").cast("string").alias("name"), F.col("n_nationkey").alias("id")),
        t.supplier.select(F.lit("antibody"), F.lit(0), F.lower("s_name"), "s_suppkey"), t.supplier.select(F.lit("antibody"), F.lit(0), F.concat(F.lit("s"), F.col("s_suppkey").cast("string")), "s_suppkey"),
        known.select(F.lit("gene"), F.lit(0), gene, "p_partkey"), known.select(F.lit("gene"), F.lit(1), F.lower("p_brand"), "p_partkey"),
    ]
    terms = reduce(DataFrame.union, v).distinct()
    index = reduce(DataFrame.union, keys).groupBy("kind", "trust", "name").agg(F.min("id").alias("id"))
    tries = terms.select("kind", "term", F.explode(F.array(F.struct(F.lit(0).alias("trust"), F.col("term").alias("name")), F.struct(F.lit(1).alias("trust"), F.col("ref").alias("name")))).alias("k"))
    found = tries.select("kind", "term", "k.trust", "k.name").join(index, ["kind", "trust", "name"], "left")
    return found.groupBy("kind", "term").agg(F.min_by("id", F.when(F.col("id").isNotNull(), F.col("trust"))).alias("entity_id"))


# ---- joins


@query("""WITH i AS (SELECT l_orderkey * 10 + l_linenumber AS inner_id, l_suppkey AS chrom, l_partkey AS s, l_partkey + CAST(l_quantity AS BIGINT) % 10 AS e FROM lineitem),
o AS (SELECT p_partkey AS outer_id, p_partkey % 10 + 1 AS chrom, p_partkey - 20 AS s, p_partkey + p_size AS e, p_size % 2 = 0 AS cds FROM part WHERE p_partkey > 20)
SELECT inner_id, arg_min(outer_id, (NOT cds, outer_id)) AS outer_id FROM i JOIN o ON i.chrom = o.chrom AND o.s <= i.s AND i.e <= o.e GROUP BY inner_id""")
def join_interval_containment(t):
    """The gene that contains a domain: one whose coding part does is preferred, then the first."""
    inner = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("inner_id"), F.col("l_suppkey").alias("chrom"), F.col("l_partkey").alias("s"), (F.col("l_partkey") + F.col("l_quantity").cast("long") % 10).alias("e"))
    outer = t.part.where("p_partkey > 20").select(F.col("p_partkey").alias("outer_id"), (F.col("p_partkey") % 10 + 1).alias("chrom"), (F.col("p_partkey") - 20).alias("s"), (F.col("p_partkey") + F.col("p_size")).alias("e"))
    coding = t.part.select(F.col("p_partkey").alias("outer_id"), (F.col("p_size") % 2 != 0).alias("other"))
    both = J.interval_containment(inner, outer, 64).join(coding, "outer_id")
    return both.groupBy("inner_id").agg(F.min_by("outer_id", F.struct("other", "outer_id")).alias("outer_id"))


@query("""WITH p AS (SELECT DISTINCT o_custkey AS doc, substr('Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0'), 1, 16 + CAST(o_custkey % 3 AS INTEGER)) AS prefix FROM orders),
m AS (SELECT doc, c_custkey, c_nationkey // 13 AS title FROM p JOIN customer ON starts_with(c_name, prefix)), g AS (SELECT doc FROM m GROUP BY doc HAVING count(DISTINCT title) = 1)
SELECT doc, c_custkey FROM m WHERE doc IN (SELECT doc FROM g)""")
def join_prefix_startswith(t):
    """Keys that start with a cited number; valid only if all that do share one title."""
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    docs = t.orders.select(F.col("o_custkey").alias("doc"), F.substr(name, F.lit(1), (16 + F.col("o_custkey") % 3).cast("int")).alias("prefix")).distinct()
    keys = t.customer.select("c_custkey", "c_name", F.floor(F.col("c_nationkey") / 13).alias("title"))
    return J.prefix_match(docs, keys, "prefix", "c_name", 12, "title").select("doc", "c_custkey")


def _titles(t: Tables, odd: int, out: str) -> DataFrame:
    """Distinct first sentences of half of the documents, each with its smallest id; stored, as a text is only read for its first sentence."""
    title = S.norm_title(F.substring_index("text", ".", 1))
    d = t.documents.select("doc_id", title.alias("title")).where((F.pmod("doc_id", F.lit(2)) == odd) & (F.col("title") != ""))
    return stored(d.groupBy("title").agg(F.min("doc_id").alias(out)))


@query()
def join_fuzzy_title(t):
    """First sentences of documents matched to those of others. SQL has no such ratio; tests compare with brute force."""
    return M.fuzzy_title_join(_titles(t, 1, "l"), _titles(t, 0, "r"), 0.90)


@query()
def join_fuzzy_verified(t):
    """The same at a lower ratio, with years a year apart at most and no errata; tests compare with brute force."""
    cited = _titles(t, 1, "l").withColumn("cited_year", 2000 + F.col("l") % 7)
    return M.verified_titles(cited, _titles(t, 0, "r").withColumn("record_year", 2000 + F.col("r") % 7), 0.85)


@query("""WITH p AS (SELECT min(p_partkey) AS l, split_part(p_name, ' ', 2) AS last, split_part(p_name, ' ', 1) AS first, CASE WHEN p_size % 3 > 0 THEN lower(substr(p_type, 1, 1)) ELSE '' END AS middle FROM part GROUP BY ALL),
a AS (SELECT min(p_partkey) AS r, split_part(p_name, ' ', 2) AS last, CASE p_size % 3 WHEN 0 THEN split_part(p_name, ' ', 1) WHEN 1 THEN substr(p_name, 1, 1) ELSE substr(p_name, 1, 2) END AS forename,
  substr(p_name, 1, 1) || CASE WHEN p_size % 2 = 0 THEN lower(substr(p_type, 1, 1)) ELSE '' END AS initials FROM part WHERE p_size < 20 GROUP BY ALL),
m AS (SELECT l, r, length(first) > 1 AND length(forename) > 1 AS both_full, starts_with(first, forename) OR starts_with(forename, first) AS agree, initials[1] = first[1] AS initial, middle = '' OR length(initials) < 2 OR middle = initials[2] AS mid FROM p JOIN a USING (last))
SELECT l, r, CASE WHEN both_full THEN 'forename' ELSE 'initials' END AS method FROM m WHERE mid AND ((both_full AND agree) OR (NOT both_full AND initial))""")
def join_name_match(t):
    """People and authors with one last name whose first names, initials and middle initials are compatible."""
    word = lambda i: F.split_part("p_name", F.lit(" "), F.lit(i))
    m, n = F.lower(F.substring("p_type", 1, 1)), F.col("p_size")
    people = t.part.groupBy(word(2).alias("last"), word(1).alias("first"), F.when(n % 3 > 0, m).otherwise("").alias("middle")).agg(F.min("p_partkey").alias("l"))
    forename = F.when(n % 3 == 0, word(1)).when(n % 3 == 1, F.substring("p_name", 1, 1)).otherwise(F.substring("p_name", 1, 2))
    initials = F.concat(F.substring("p_name", 1, 1), F.when(n % 2 == 0, m).otherwise(""))
    authors = t.part.where("p_size < 20").groupBy(word(2).alias("last"), forename.alias("forename"), initials.alias("initials")).agg(F.min("p_partkey").alias("r"))
    return M.name_join(people, authors)


# ---- resolution


@query("SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN (SELECT r_name FROM region WHERE r_regionkey = 1) ON true")
def er_reference_features(t):
    """Rows of one reference, named on each; without the reference its name is null."""
    one = t.region.where("r_regionkey = 1").agg(F.min("r_name").alias("r_name"))
    return t.nation.select("n_nationkey", "n_name").crossJoin(F.broadcast(one))


@query("""WITH k AS (SELECT *, CASE WHEN l_discount > 0 THEN l_partkey % 50 || '|' || l_suppkey % 5 || '|' || l_linenumber || '|' || l_returnflag || '|' || l_linestatus || '|' || year(l_shipdate) || '|' || (l_quantity > 25)
  ELSE 'row|' || l_orderkey || '|' || l_linenumber || '|||||' END AS key FROM lineitem)
SELECT key, arg_min(l_orderkey, l_orderkey * 10 + l_linenumber) AS l_orderkey, string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), '; ' ORDER BY CAST(l_suppkey AS VARCHAR)) AS suppliers, string_agg(DISTINCT CAST(l_partkey AS VARCHAR), '; ' ORDER BY CAST(l_partkey AS VARCHAR)) AS parts, CAST(count(*) AS BIGINT) AS n_rows FROM k GROUP BY key""")
def er_merge_features(t):
    """Features merged by a physical key of seven columns; a row whose place is unresolved keeps a key of its own. Identifiers of all rows stay."""
    own = F.concat_ws("|", (F.col("l_partkey") % 50).cast("string"), (F.col("l_suppkey") % 5).cast("string"), F.col("l_linenumber").cast("string"), "l_returnflag", "l_linestatus", F.year("l_shipdate").cast("string"), (F.col("l_quantity") > 25).cast("string"))
    alone = F.concat(F.lit("row|"), F.col("l_orderkey").cast("string"), F.lit("|"), F.col("l_linenumber").cast("string"), F.lit("|||||"))
    rows = t.lineitem.select(
        F.when(F.col("l_discount") > 0, own).otherwise(alone).alias("key"), "l_orderkey", F.col("l_suppkey").cast("string").alias("suppliers"), F.col("l_partkey").cast("string").alias("parts"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("no")
    )
    return R.merge_rows(rows, ["key"], ["l_orderkey"], ["suppliers", "parts"], "no")


@query("""WITH u AS (SELECT p_name || p_brand AS label, min(p_partkey) AS id FROM part GROUP BY 1 HAVING count(*) = 1)
SELECT p_partkey, coalesce(n_nationkey, u.id) AS parent FROM part LEFT JOIN nation ON n_nationkey = p_size LEFT JOIN u ON u.label = p_name || 'Brand#' || (p_size - 24)""")
def er_taxon_parent_guard(t):
    """A parent id stays only if it is known; otherwise a name that one row alone has is looked up."""
    single = t.part.groupBy(F.concat("p_name", "p_brand").alias("label")).agg(F.min("p_partkey").alias("id"), F.count("*").alias("n")).where("n = 1").drop("n")
    label = F.concat(F.col("p_name"), F.lit("Brand#"), (F.col("p_size") - 24).cast("string"))
    rows = t.part.select("p_partkey", F.col("p_size").alias("n_nationkey"), label.alias("label"))
    known = rows.join(t.nation.select("n_nationkey", F.col("n_nationkey").alias("known")), "n_nationkey", "left").join(single, "label", "left")
    return known.select("p_partkey", F.coalesce("known", "id").alias("parent"))


@query("""SELECT l_orderkey, l_linenumber, 'mab ' || l_partkey AS name, CASE WHEN l_suppkey % 3 > 0 THEN 's' || l_suppkey END AS alias, CASE l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false END AS neutralizing,
CASE WHEN l_discount > 0.05 THEN l_partkey END AS epitope FROM lineitem""")
def er_antibodies(t):
    """Antibodies with their epitope links: placeholders count as blank, and an epitope is only made where a location is given; the link stays either way."""
    alias = F.when(F.col("l_suppkey") % 3 > 0, F.concat(F.lit(" s"), F.col("l_suppkey").cast("string"))).otherwise("_")
    called = F.when(F.col("l_returnflag") == "R", "yes (in vitro)").when(F.col("l_returnflag") == "A", "No").otherwise("_")
    place = F.when(F.col("l_discount") > 0.05, F.col("l_partkey").cast("string")).otherwise("_")
    sheet = t.lineitem.select("l_orderkey", "l_linenumber", F.concat(F.lit("mab "), F.col("l_partkey").cast("string")).alias("name"), alias.alias("alias"), called.alias("called"), place.alias("place"))
    clean = lambda c: S.placeholder_to_none(F.col(c), "_", "NA", "n/a")
    antibodies = sheet.select("l_orderkey", "l_linenumber", "name", F.trim(clean("alias")).alias("alias"), S.parse_neutralizing(clean("called")).alias("neutralizing"), clean("place").alias("place"))
    epitopes = antibodies.select("place").where("place IS NOT NULL").distinct().withColumn("epitope", F.col("place").cast("long"))
    columns = ["l_orderkey", "l_linenumber", "name", "alias", "neutralizing", "epitope"]
    # rows without a place find nothing, and would all go to one task of a join
    linked = antibodies.where("place IS NOT NULL").join(epitopes, "place", "left").select(*columns)
    return linked.union(antibodies.where("place IS NULL").withColumn("epitope", F.lit(None).cast("long")).select(*columns))


@query("""SELECT p_partkey AS epitope, p_name AS peptide, 'T cell' AS assay_type, coalesce(CASE WHEN p_size % 2 = 0 THEN 'HLA-' || p_brand END, 'MHC-' || p_type) AS mhc_allele,
array_to_string(list_filter([CASE WHEN p_size % 4 < 2 THEN 'ELISpot' END, CASE WHEN p_size % 4 IN (1, 3) THEN 'Chromium release' END], lambda x: x IS NOT NULL), ';') AS method, CAST(NULL AS VARCHAR) AS outcome FROM part WHERE p_size % 7 > 0""")
def er_ctl(t):
    """T-cell assays of rows that name a peptide: the allele from either column, methods from the free text, no outcome."""
    n = F.col("p_size")
    text = F.when(n % 4 == 0, "EliSpot, IFNg").when(n % 4 == 1, "elispot and 51Cr release").when(n % 4 == 3, "Cr release").otherwise("proliferation")
    sheet = t.part.select(
        F.col("p_partkey").alias("epitope"), F.when(n % 7 > 0, F.col("p_name")).otherwise("_").alias("peptide"),
        F.when(n % 2 == 0, F.concat(F.lit("HLA-"), F.col("p_brand"))).otherwise(" ").alias("hla"), F.concat(F.lit("MHC-"), F.col("p_type")).alias("mhc"), text.alias("assay"),
    )
    methods = S.parse_methods(F.col("assay"), [(r"(?i)elispot", "ELISpot"), (r"(?i)cr release", "Chromium release")])
    clean = lambda c: S.placeholder_to_none(F.col(c), "_")
    return sheet.where(clean("peptide").isNotNull()).select(
        "epitope", "peptide", F.lit("T cell").alias("assay_type"), F.coalesce(clean("hla"), clean("mhc")).alias("mhc_allele"), F.array_join(methods, ";").alias("method"), F.lit(None).cast("string").alias("outcome"))


def _assignees(t: Tables) -> DataFrame:
    """Fields as delivered: several names joined by bare commas, a person, a place, spellings that differ by row."""
    n = F.col("c_custkey")
    research = F.concat(F.when(n % 2 == 0, "The ").otherwise(""), F.initcap("c_mktsegment"), F.when(n % 3 == 0, " Res. Inst., Inc.").otherwise(" Research Institute,Inc."))
    school = F.concat(F.when(n % 5 == 0, "The Regents of the ").otherwise(""), F.lit("Univ. of "), "n_name", F.when(n % 7 == 0, ",Smith; John").otherwise(",Md"))
    army = F.when(n % 4 == 0, ",The United States of America, as represented by the Secretary of the Army").otherwise("")
    home = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return t.customer.join(home, "c_nationkey").select("c_custkey", F.concat(research, F.lit(","), school, army).alias("field"))


ASSIGNEES = """named AS (SELECT c_custkey, c_mktsegment || ' RESEARCH INSTITUTE' AS a, 'UNIVERSITY OF ' || replace(n_name, '_', ' ') AS b, CASE WHEN c_custkey % 4 = 0 THEN 'US ARMY' END AS c FROM customer JOIN nation ON c_nationkey = n_nationkey),
keys AS (SELECT c_custkey, unnest([a, b, c]) AS org FROM named), orgs AS (SELECT DISTINCT c_custkey, org FROM keys WHERE org IS NOT NULL)"""


@query("SELECT c_custkey, CAST(2 + CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS INTEGER) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey")
def er_org_split(t):
    """How many organisations a field names: legal forms stay with their name, persons and places go."""
    return _assignees(t).select("c_custkey", F.size(O.organisation_names(F.col("field"))).alias("n"))


@query(f"WITH {ASSIGNEES} SELECT c_custkey, org FROM orgs")
def er_org_normalize(t):
    """All spellings of one organisation get one key: preambles, abbreviations, legal forms, federal agencies."""
    rows = _assignees(t)
    named = O.organisation_fields(rows, "field").select("field", F.col("org_key").alias("org")).distinct()
    return rows.join(named, "field").select("c_custkey", "org").distinct()


@query(f"""WITH {ASSIGNEES}, all_roles AS (SELECT org, 'patent' AS role, c_custkey AS id FROM orgs UNION ALL SELECT 'UNIVERSITY OF ' || replace(n_name, '_', ' '), 'grant', s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT org AS org_key, string_agg(DISTINCT role, ';' ORDER BY role) AS roles, CAST(count(DISTINCT role || ':' || id) AS BIGINT) AS links FROM all_roles GROUP BY org""")
def er_org_build(t):
    """Organisations of patents and grants together, by key, with their roles and links."""
    home = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    grants = t.supplier.join(home, "s_nationkey").select(F.concat(F.lit("UNIVERSITY OF "), "n_name").alias("field"), F.lit("grant").alias("role"), F.col("s_suppkey").alias("ident"))
    rows = _assignees(t).select("field", F.lit("patent").alias("role"), F.col("c_custkey").alias("ident")).union(grants)
    organisations, links = O.organisation_links(rows, "field", "role", "ident")
    n = links.groupBy("org_key").agg(F.count("*").alias("links"))
    return organisations.join(n, "org_key").select("org_key", F.array_join("roles", ";").alias("roles"), "links")


@query("SELECT p_partkey, split_part(p_name, ' ', 1) || ' ' || split_part(p_name, ' ', 2) AS name FROM part")
def er_name_canonical(t):
    """`Last; First` becomes `First Last`; `et al.` goes."""
    word = lambda i: F.split_part("p_name", F.lit(" "), F.lit(i))
    turned = F.concat(word(2), F.lit("; "), word(1), F.when(F.col("p_size") % 2 == 0, " et al.").otherwise(""))
    given = F.when(F.col("p_size") % 3 > 0, turned).otherwise(F.concat(F.col("p_name"), F.lit(" et al")))
    return t.part.select("p_partkey", S.person_name(given).alias("name"))


@query("SELECT c_custkey, c_nationkey - c_nationkey % 2 AS node, n_regionkey AS genus FROM customer JOIN nation ON n_nationkey = c_nationkey - c_nationkey % 2")
def er_taxon_collapse(t):
    """Legacy ids (here the odd ones) to the current node, and its genus, by one table of nodes."""
    moved = t.nation.select(F.col("n_nationkey").alias("legacy"), (F.col("n_nationkey") - F.col("n_nationkey") % 2).alias("node"))
    genus = t.nation.select(F.col("n_nationkey").alias("node"), F.col("n_regionkey").alias("genus"))
    return t.customer.join(moved, F.col("c_nationkey") == F.col("legacy")).join(genus, "node").select("c_custkey", "node", "genus")


@query("""SELECT md5(concat_ws('|', s_name, p_name, o_orderstatus, c_name, l_quantity > 25, l_returnflag)) AS row_key, CAST(count(*) AS BIGINT) AS n FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def cmp_snapshot_normalize(t):
    """Rows of a build without numbers that a rebuild may deal anew: each reference becomes its natural key, row numbers go."""
    d = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left").join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    d = d.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"), "left").join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    key = F.md5(F.concat_ws("|", "s_name", "p_name", "o_orderstatus", "c_name", (F.col("l_quantity") > 25).cast("string"), "l_returnflag"))
    return d.groupBy(key.alias("row_key")).agg(F.count("*").alias("n"))


@query(sql_over(DOCUMENTS, r"array_to_string(list_sort(list_distinct(list_filter([v, regexp_replace(v, '\s+', '', 'g'), nullif(regexp_extract(regexp_replace(v, '\s+', '', 'g'), '^([A-Z]{2}\d+)', 1), '')], lambda x: x IS NOT NULL))), '|') AS variants"))
def fn_patent_variants(t):
    """All spellings of a document number: as given, compact, and without its kind code."""
    compact = S.compact_id(F.col("v"))
    bare = F.nullif(F.regexp_extract(compact, r"^([A-Z]{2}\d+)", 1), F.lit(""))
    every = F.array_sort(F.array_distinct(F.array_compact(F.array(F.col("v"), compact, bare))))
    return t.orders.select("o_orderkey", case_of(DOCUMENTS).alias("v")).select("o_orderkey", "v", F.array_join(every, "|").alias("variants"))


# ---- scalar functions over delivered fields


PROJECT_SQL = "CASE o_orderkey % 4 WHEN 0 THEN '5R01AI' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') || '-01' WHEN 1 THEN '26120150' || lpad(CAST(o_custkey % 100 AS VARCHAR), 4, '0') || 'I-0-' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') || '-1' WHEN 2 THEN '75N930' || o_custkey || '-0-0-1' END"
CORE_SQL = "CASE o_orderkey % 4 WHEN 0 THEN 'R01AI' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') WHEN 1 THEN '26120150' || lpad(CAST(o_custkey % 100 AS VARCHAR), 4, '0') END"


def _projects(t: Tables) -> DataFrame:
    n, c = F.col("o_orderkey") % 4, F.col("o_custkey")
    pad = lambda x, k: F.lpad(x.cast("string"), k, "0")
    contract = F.concat(F.lit("26120150"), pad(c % 100, 4))
    project = (
        F.when(n == 0, F.concat(F.lit("5R01AI"), pad(c, 6), F.lit("-01"))).when(n == 1, F.concat(contract, F.lit("I-0-"), pad(F.col("o_orderkey"), 8), F.lit("-1")))
        .when(n == 2, F.concat(F.lit("75N930"), c.cast("string"), F.lit("-0-0-1")))
    )
    core = F.when(n == 0, F.concat(F.lit("R01AI"), pad(c, 6))).when(n == 1, contract)
    activity = F.when(n == 0, "R01").when(n == 1, "N01").when(n == 2, "N43").otherwise("Y01")
    return t.orders.select("o_orderkey", project.alias("project"), core.alias("core"), activity.alias("activity"))


@query(f"""WITH s AS (SELECT o_orderkey, {PROJECT_SQL} AS v, {CORE_SQL} AS core FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 4 IN (1, 2) THEN regexp_replace(v, '-[^-]*$', '') ELSE core END AS award FROM s""")
def fn_award_key(t):
    """Task orders of one contract are awards of their own; other records go by their core number."""
    return _projects(t).select("o_orderkey", S.award_key(F.col("core"), F.col("project"), F.col("activity")).alias("award"))


@query(f"""WITH s AS (SELECT o_orderkey, {PROJECT_SQL} AS v, {CORE_SQL} AS core FROM orders), p AS (SELECT *, string_split(coalesce(v, core, CAST(o_orderkey AS VARCHAR)), '-') AS parts FROM s)
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN core WHEN coalesce(parts[3], '') IN ('', '0', '00000000') THEN parts[1] ELSE parts[1] || '-' || parts[3] END AS award FROM p""")
def fn_award_key_staging(t):
    return _projects(t).select("o_orderkey", S.award_key_staging(F.col("core"), F.col("project"), F.col("o_orderkey")).alias("award"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 7 > 0 THEN c_mktsegment || ' ' || c_nationkey END AS pi FROM customer""")
def fn_contact_pi(t):
    """The flat column, else the contact in a JSON list; a list that can't be read names nobody."""
    n = F.col("c_custkey")
    person = lambda name, contact: F.struct(name.alias("full_name"), F.lit(contact).alias("is_contact_pi"))
    people = F.to_json(F.array(person(F.col("c_name"), False), person(F.concat(F.lit(" "), F.concat_ws(" ", "c_mktsegment", F.col("c_nationkey").cast("string"))), True)))
    d = t.customer.select("c_custkey", F.when(n % 3 == 0, F.concat(F.lit(" "), F.col("c_name"), F.lit(" "))).otherwise("").alias("flat"), F.when(n % 7 > 0, people).otherwise("[broken").alias("people"))
    return d.select("c_custkey", S.contact_pi(F.col("flat"), F.col("people")).alias("pi"))


@query("""SELECT p_partkey, concat_ws(';', CASE WHEN p_type NOT IN ('SMALL', 'LARGE') THEN p_type END, CASE split_part(p_name, ' ', 2) WHEN 'gear' THEN 'GEARS' WHEN 'bolt' THEN 'BOLTS' END) AS found,
CASE WHEN split_part(p_name, ' ', 2) IN ('gear', 'bolt') THEN '' ELSE p_name END AS unmatched FROM part""")
def fn_parse_symptoms(t):
    """Phrases of a list looked up with and without their qualifiers; what is unknown is reported as it stands."""
    kinds = {k.lower(): k for k in ("MEDIUM", "STANDARD", "PROMO", "ECONOMY")} | {"gear": "GEARS", "bolt": "BOLTS"}
    field = F.concat(F.when(F.col("p_type").isin("SMALL", "LARGE"), "").otherwise(F.concat(F.initcap("p_type"), F.lit(", "))), "p_name")
    found, rest = S.parse_phrases(F.col("v"), kinds, ("small", "large", "new", "old", "hot", "cold", "red", "blue"))
    return t.part.select("p_partkey", field.alias("v")).select("p_partkey", F.array_join(found, ";").alias("found"), F.array_join(rest, ";").alias("unmatched"))


@query("""SELECT doc_id, array_to_string(list_filter([CASE WHEN regexp_matches(text, '(?i)idiot') THEN 'abuse' END, CASE WHEN regexp_matches(text, '(?i)licen[cs]e') THEN 'licence' END,
CASE WHEN regexp_matches(text, 'token = ') THEN 'secret' END, CASE WHEN regexp_matches(text, '@') THEN 'mail' END], lambda x: x IS NOT NULL), ';') AS methods FROM documents""")
def fn_parse_methods(t):
    patterns = [("(?i)idiot", "abuse"), ("(?i)licen[cs]e", "licence"), ("token = ", "secret"), ("@", "mail")]
    return t.documents.select("doc_id", F.array_join(S.parse_methods(F.col("text"), patterns), ";").alias("methods"))


@query("SELECT event_id, CASE event_type WHEN 'error' THEN 'Error' WHEN 'signup' THEN 'Sign-up' WHEN 'click' THEN 'Click' END AS assay FROM events")
def fn_match_assay(t):
    index = S.dictionary({"error": "Error", "signup": "Sign-up", "click": "Click"})
    given = F.concat(F.lit(" "), F.upper("event_type"))
    return t.events.select("event_id", F.try_element_at(index, F.lower(F.trim(given))).alias("assay"))


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name || ' of the ' || lower(p_type) || ' kind' ELSE 'On ' || p_name || 's and their many uses' END AS best,
CAST(CASE WHEN p_size % 2 = 0 THEN 1 ELSE 3 END AS INTEGER) AS n FROM part""")
def fn_title_segments(t):
    """What may be a citation's title: its quoted text, else its sentences, the longest first."""
    quoted = F.concat(F.lit('Doe J, Roe K. "'), "p_name", F.lit(" of the "), F.lower("p_type"), F.lit(' kind" Nature 12, 345 (1999)'))
    plain = F.concat(F.lit("Doe JA, Roe K. On "), "p_name", F.lit("s and their many uses. J. of Things; 12, 345 (1999)"))
    d = t.part.select("p_partkey", M.title_segments(F.when(F.col("p_size") % 2 == 0, quoted).otherwise(plain)).alias("s"))
    return d.select("p_partkey", F.get("s", F.lit(0)).alias("best"), F.size("s").alias("n"))


@query()
def fn_locator_extract(t):
    """Overlapping matches, which SQL's patterns can't give; tests compare with brute force."""
    cited = F.concat_ws(" ", "p_name", F.col("p_size").cast("string"), F.lit(","), F.col("p_partkey").cast("string"), F.lit("(1999)"))
    return t.part.select("p_partkey", F.array_join(M.locators(cited), "|").alias("found"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'This was made with government support under AI' || o_custkey || '.' WHEN o_orderstatus = 'O' THEN 'The work was federally sponsored' END AS statement FROM orders""")
def fn_federal_statement(t):
    made = F.concat(F.lit("We thank all. This was made with government support under AI"), F.col("o_custkey").cast("string"), F.lit(". More."))
    text = F.when(F.col("o_orderstatus") == "F", made).when(F.col("o_orderstatus") == "O", "The work was federally sponsored").otherwise("None.")
    return t.orders.select("o_orderkey", M.federal_statement(text).alias("statement"))


CONTEXT = {"that": "taxon", "thing": "generic", "la": "generic", "of": "generic"}
CONTEXT_SQL = ", ".join(f"('{w}', '{k}')" for w, k in CONTEXT.items())


@query(f"""WITH w AS (SELECT doc_id, text, unnest(string_split(regexp_replace(lower(text), '[^0-9a-z]', ' ', 'g'), ' ')) AS term, generate_subscripts(string_split(regexp_replace(lower(text), '[^0-9a-z]', ' ', 'g'), ' '), 1) AS i FROM documents),
p AS (SELECT doc_id, text, term, CAST(sum(length(term) + 1) OVER (PARTITION BY doc_id ORDER BY i) - length(term) - 1 AS BIGINT) AS start FROM w),
s AS (SELECT doc_id, term, kind, start, start + length(term) AS "end", length(regexp_replace(substr(text, 1, start), '[^.!?;
]', '', 'g')) AS sentence FROM p JOIN (VALUES {CONTEXT_SQL}) v(term, kind) USING (term))
SELECT doc_id, start, term FROM s WHERE kind = 'generic' AND EXISTS (SELECT 1 FROM s x WHERE x.kind = 'taxon' AND x.doc_id = s.doc_id AND x.sentence = s.sentence AND (abs(x.start - s.start) <= 80 OR abs(x."end" - s."end") <= 80))""")
def link_window_context(t):
    """Generic terms that stand in one sentence with an organism, within 80 letters of it."""
    terms = [(w, w, k) for w, k in CONTEXT.items()]
    found = L.longest_spans(t.documents, terms, "doc_id", "text", window=80)
    return found.where(F.col("type") == "generic").select("doc_id", "start", "term")


@query(r"""WITH w AS (SELECT doc_id, text, unnest(string_split(regexp_replace(lower(text), '[^0-9a-z]', ' ', 'g'), ' ')) AS term, generate_subscripts(string_split(regexp_replace(lower(text), '[^0-9a-z]', ' ', 'g'), ' '), 1) AS i FROM documents),
p AS (SELECT doc_id, text, term, CAST(sum(length(term) + 1) OVER (PARTITION BY doc_id ORDER BY i) - length(term) - 1 AS BIGINT) AS start FROM w),
s AS (SELECT doc_id, term, text, start, regexp_extract(substr(text, 1, start), '[^.!?;
]*$') || regexp_extract(substr(text, start + 1), '^[^.!?;
]*') AS sentence FROM p WHERE term IN ('la', 'of'))
SELECT doc_id, start, term FROM s WHERE (term = 'la' AND regexp_matches(sentence, '(?i)(?:le|un)')) OR (term = 'of' AND NOT regexp_matches(substr(text, greatest(1, start - 19), least(start, 20)), '(?i)and'))""")
def link_term_rules(t):
    """Terms with rules of their own: one needs a word in its sentence, one must not follow a word closely."""
    rules = {"la": L.TermRule(sentence=r"(?ia)(?:le|un)"), "of": L.TermRule(not_before=r"(?ia)and")}
    return L.longest_spans(t.documents, [("la", "la", "word"), ("of", "of", "word")], "doc_id", "text", rules=rules).select("doc_id", "start", "term")
