"""Queries of term matching and of links with support."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import joins as J
from ..operators import linking as L
from ..registry import Tables, query

#: A small vocabulary of words that occur in the documents: term, entity, type, term type, needs context.
VOCABULARY = [
    ("that", "T1", "taxon", "name", False), ("the and", "T2", "taxon", "name", False), ("of the", "G1", "gene", "db_gene_label", True),
    ("thing", "G2", "gene", "symbol", False), ("idiot", "C1", "condition", "common_alias", False), ("moron", "C1", "condition", "name", False),
    ("la", "G3", "gene", "symbol", True), ("token", "A1", "assay", "name", False), ("555", "A2", "assay", "old_alias", True),
]
VALUES = ", ".join(f"('{a}', '{b}', '{c}', '{d}', {str(e).lower()})" for a, b, c, d, e in VOCABULARY)
#: The rest of the vocabulary comes from a table: the first three words of each passage.
THREE = "^[A-Za-z]+ [A-Za-z]+ [A-Za-z]+"
TYPES = [("taxon", "name"), ("gene", "db_gene_label"), ("condition", "common_alias")]
TITLE = "split_part(text, chr(10), 1)"
BODY = "substr(text, length(split_part(text, chr(10), 1)) + 1)"
#: Hits in SQL: whole tokens, ignoring case, in title (first line) and abstract (the rest).
HITS = f"""vocab AS (SELECT * FROM (VALUES {VALUES}) v(term, entity, etype, ttype, ctx) UNION
  SELECT term, 'B' || min(item_id), CASE min(item_id) % 3 WHEN 0 THEN 'taxon' WHEN 1 THEN 'gene' ELSE 'condition' END,
    CASE min(item_id) % 3 WHEN 0 THEN 'name' WHEN 1 THEN 'db_gene_label' ELSE 'common_alias' END, min(item_id) % 2 = 0
  FROM (SELECT item_id, lower(regexp_extract(text, '{THREE}')) AS term FROM benchmark) WHERE term <> '' GROUP BY term),
docs AS (SELECT doc_id, source, lang, 'title' AS field, lower({TITLE}) AS text FROM documents
  UNION ALL SELECT doc_id, source, lang, 'abstract', lower({BODY}) FROM documents),
hits AS (SELECT doc_id, source, lang, field, term, entity, etype, ttype, ctx FROM docs, vocab
  WHERE contains(text, term) AND regexp_matches(text, '(^|[^0-9a-z])' || term || '($|[^0-9a-z])'))"""
CONF = "CAST(round(CASE field WHEN 'title' THEN 0.7 ELSE 0.5 END * CASE WHEN ctx THEN 0.5 ELSE 1.0 END, 2) AS DOUBLE)"


def vocabulary(t: Tables) -> DataFrame:
    fixed = t.spark.createDataFrame(VOCABULARY, "term string, entity string, etype string, ttype string, ctx boolean")
    terms = t.benchmark.select("item_id", F.lower(F.regexp_extract("text", THREE, 0)).alias("term")).where("term <> ''")
    n = F.min("item_id")
    kind = lambda i: F.when(n % 3 == 0, TYPES[0][i]).when(n % 3 == 1, TYPES[1][i]).otherwise(TYPES[2][i])
    own = terms.groupBy("term").agg(
        F.concat(F.lit("B"), n.cast("string")).alias("entity"), kind(0).alias("etype"), kind(1).alias("ttype"), (n % 2 == 0).alias("ctx")
    )
    return fixed.union(own).distinct()


def fields(t: Tables) -> DataFrame:
    """One row per document and field: title (its first line) and abstract (the rest)."""
    return _title_body(t).select("doc_id", "source", "lang", F.col("title"), F.col("body").alias("abstract")).unpivot(
        ["doc_id", "source", "lang"], ["title", "abstract"], "field", "content"
    )


def hits(t: Tables) -> DataFrame:
    """One row per document, field and term, with the vocabulary's columns and the document's source."""
    words = vocabulary(t)
    found = L.term_matches(fields(t), words, "doc_id", "content", "term", carry=("source", "lang", "field"))
    return found.join(words, "term")


def scored(t: Tables) -> DataFrame:
    return hits(t).withColumn("confidence", L.confidence(F.col("field"), F.col("ctx")))


@query(f"WITH {HITS} SELECT doc_id, field, term, entity, {CONF} AS confidence, CASE WHEN ttype = 'db_gene_label' THEN 'gene_label' WHEN ttype LIKE '%alias' THEN 'synonym' ELSE 'keyword' END AS method FROM hits")
def link_keyword_match(t):
    return scored(t).select("doc_id", "field", "term", "entity", "confidence", L.match_method(F.col("ttype")).alias("method"))


@query(f"WITH {HITS} SELECT doc_id, field, term FROM hits")
def join_term_contains(t):
    return hits(t).select("doc_id", "field", "term")


@query(f"WITH {HITS} SELECT doc_id, field, term, entity FROM hits h WHERE NOT ctx OR EXISTS (SELECT 1 FROM hits x WHERE x.doc_id = h.doc_id AND x.etype = 'taxon')")
def link_context_gate(t):
    return L.context_gate(hits(t), "doc_id", "etype", "ctx").select("doc_id", "field", "term", "entity")


@query(f"WITH {HITS} SELECT doc_id, entity, max({CONF}) AS confidence, min(source) AS source, CAST(count(*) AS BIGINT) AS n_support FROM hits GROUP BY doc_id, entity")
def link_collapse_max(t):
    return L.collapse_links(scored(t), ["doc_id", "entity"], "confidence", ["source", "term"])


@query(f"""WITH {HITS} SELECT doc_id, entity, max({CONF}) AS confidence, string_agg(DISTINCT term, ';' ORDER BY term) AS keywords, bool_and(ctx) AS requires_context FROM hits GROUP BY doc_id, entity""")
def link_collapse_edges(t):
    return scored(t).groupBy("doc_id", "entity").agg(
        F.max("confidence").alias("confidence"), F.array_join(F.array_sort(F.collect_set("term")), ";").alias("keywords"), F.bool_and("ctx").alias("requires_context")
    )


@query(f"""WITH {HITS}, m AS (SELECT doc_id, entity, CASE WHEN ttype = 'db_gene_label' THEN 'gene_label' WHEN ttype LIKE '%alias' THEN 'synonym' ELSE 'keyword' END AS method FROM hits)
SELECT doc_id, entity, CASE min(CASE method WHEN 'gene_label' THEN 1 WHEN 'keyword' THEN 2 ELSE 3 END) WHEN 1 THEN 'gene_label' WHEN 2 THEN 'keyword' ELSE 'synonym' END AS method FROM m GROUP BY doc_id, entity""")
def link_method_priority(t):
    m = hits(t).withColumn("method", L.match_method(F.col("ttype")))
    return L.best_by_priority(m, ["doc_id", "entity"], "method", ["gene_label", "keyword", "synonym"])


@query(f"WITH {HITS} SELECT entity, etype, CAST(count(DISTINCT doc_id) AS BIGINT) AS documents, CAST(count(DISTINCT source) AS BIGINT) AS sources FROM hits GROUP BY entity, etype")
def agg_coverage(t):
    return hits(t).groupBy("entity", "etype").agg(F.countDistinct("doc_id").alias("documents"), F.countDistinct("source").alias("sources"))


@query(f"WITH {HITS} SELECT doc_id, max({CONF}) AS confidence, CAST(count(DISTINCT entity) AS BIGINT) AS n FROM hits GROUP BY doc_id ORDER BY confidence DESC, n DESC, doc_id LIMIT 100")
def topk_order_limit(t):
    g = scored(t).groupBy("doc_id").agg(F.max("confidence").alias("confidence"), F.countDistinct("entity").alias("n"))
    return g.orderBy(F.desc("confidence"), F.desc("n"), "doc_id").limit(100)


def _title_body(t: Tables) -> DataFrame:
    d = t.documents.withColumn("title", F.split_part("text", F.lit("\n"), F.lit(1)))
    return d.withColumn("body", F.substr("text", F.length("title") + 1, F.length("text")))


@query(f"SELECT doc_id FROM documents WHERE regexp_matches({TITLE}, '(?i)that') OR len(regexp_extract_all({BODY}, '(?i)that')) >= 2")
def filter_relevance_doc(t):
    d = _title_body(t)
    return d.where(F.col("title").rlike("(?i)that") | (F.regexp_count("body", F.lit("(?i)that")) >= 2)).select("doc_id")


@query(f"""WITH g AS (SELECT source, lang, bool_or(regexp_matches({TITLE}, '(?i)worthless')) AS t, sum(len(regexp_extract_all({BODY}, '(?i)worthless'))) AS n FROM documents GROUP BY source, lang)
SELECT source, lang, CASE WHEN t THEN 'strong' WHEN n >= 2 THEN 'moderate' WHEN n = 1 THEN 'weak' END AS tier FROM g""")
def agg_relevance_tier(t):
    g = _title_body(t).groupBy("source", "lang").agg(
        F.bool_or(F.col("title").rlike("(?i)worthless")).alias("t"), F.sum(F.regexp_count("body", F.lit("(?i)worthless"))).alias("n")
    )
    return g.select("source", "lang", L.relevance_tier(F.col("t"), F.col("n")).alias("tier"))


@query(f"""WITH g AS (SELECT source, lang, bool_or(regexp_matches({TITLE}, '(?i)worthless')) AS t, max(len(regexp_extract_all({BODY}, '(?i)worthless'))) AS n FROM documents GROUP BY source, lang)
SELECT source, lang, CASE WHEN t THEN 'strong' WHEN n >= 2 THEN 'moderate' ELSE 'weak' END AS tier FROM g""")
def agg_relevance_tier_staging(t):
    g = _title_body(t).groupBy("source", "lang").agg(
        F.bool_or(F.col("title").rlike("(?i)worthless")).alias("t"), F.max(F.regexp_count("body", F.lit("(?i)worthless"))).alias("n")
    )
    return g.select("source", "lang", F.coalesce(L.relevance_tier(F.col("t"), F.col("n")), F.lit("weak")).alias("tier"))


SENTENCES = ["Funded by R43 AI066487-01 and AI 51292.", "K08-AI079381; A1057153", "no number", None, "ZIA AI005081 and U19AI109762"]
FOUND = [[("R43", "AI066487"), (None, "AI051292")], [("K08", "AI079381"), (None, "AI057153")], [], [], [("ZIA", "AI005081"), ("U19", "AI109762")]]
FOUND_SQL = ", ".join(f"({i}, {'NULL' if a is None else repr(a)}, '{s}')" for i, row in enumerate(FOUND) for a, s in row)


def _numbers(t: Tables) -> DataFrame:
    text = F.element_at(F.array(*[F.lit(s).cast("string") for s in SENTENCES]), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return L.grant_numbers(t.orders.select(F.col("o_orderkey").alias("doc"), text.alias("text")), "text").select("doc", "activity", "serial")


@query(f"SELECT o_orderkey AS doc, activity, serial FROM orders JOIN (VALUES {FOUND_SQL}) v(i, activity, serial) ON o_orderkey % 5 = i")
def link_grant_numbers(t):
    return _numbers(t)


CONTRACTS = [
    "Contract hhsn272201400058c paid.", "HHSN-2722-0140-00580 (misprinted) and 75N93020C00012", "Under HHSN261201500003I, an umbrella", "HHSN 27220140 only",
    "75N93020C0001", None, "HHSN2722014000 and HHSN272201400058C",
]
#: award, core number, key, title; the last five are contracts, cut by task orders.
AWARDS = [
    (1, "R43AI066487", "R43AI066487", "One"), (2, "R44AI066487", "R44AI066487", "One"), (3, "R01AI051292", "R01AI051292", "Two"), (4, "U19AI109762", "U19AI109762", "Three"),
    (5, "26120150000", "261201500003I-0-26100008-1", "Assays of a virus"), (6, "26120150000", "261201500003I-0-26100012-1", "Another"),
    (7, "27220140005", "272201400058C-1-0-1", "Trial "), (8, "27220140005", "2722-01400058C-P1", "trial"), (9, "75N93020C00", "75n93020c00012-0-1", None),
]
AWARDS_SQL = ", ".join(f"({n}, '{core}', '{key}', {'NULL' if title is None else repr(title)})" for n, core, key, title in AWARDS)
CONTRACTS_SQL = ", ".join(f"({i}, {'NULL' if s is None else repr(s)})" for i, s in enumerate(CONTRACTS))


@query(f"""WITH f AS (SELECT o_orderkey AS doc, activity, serial FROM orders JOIN (VALUES {FOUND_SQL}) v(i, activity, serial) ON o_orderkey % 5 = i),
a(award, core, key, title) AS (VALUES {AWARDS_SQL}),
b AS (SELECT *, bool_or(coalesce(core = activity || serial, false)) OVER (PARTITION BY doc, activity, serial) AS any_exact FROM f JOIN a ON right(core, 8) = serial AND length(core) = 11 AND core NOT LIKE '2%'),
c AS (SELECT i, trim(contract) AS contract, regexp_replace(concat(regexp_extract(contract, '{L.CONTRACT}', 1), regexp_extract(contract, '{L.CONTRACT}', 2)), '[^0-9A-Z]', '', 'g') AS number
  FROM (SELECT i, unnest(regexp_extract_all(upper(s), '{L.CONTRACT}')) AS contract FROM (VALUES {CONTRACTS_SQL}) v(i, s))),
k AS (SELECT award, regexp_replace(upper(key), '[^0-9A-Z]', '', 'g') AS key, lower(trim(coalesce(title, ''))) AS title FROM a WHERE NOT regexp_matches(core, '^([A-Z][0-9]{{2}}|Z[A-Z0-9]{{2}})[A-Z]{{2}}[0-9]{{6}}$')),
m AS (SELECT DISTINCT contract, award, title FROM c JOIN k ON starts_with(key, CASE WHEN regexp_matches(number, '^[0-9]{{12}}') THEN number[:12] ELSE number END) WHERE length(number) >= 9),
g AS (SELECT contract FROM m GROUP BY contract HAVING count(DISTINCT title) = 1)
SELECT doc, award, coalesce(activity, '') || serial AS matched FROM b WHERE NOT any_exact OR core = activity || serial
UNION SELECT o_orderkey, award, contract FROM orders JOIN c ON o_orderkey % {len(CONTRACTS)} = i JOIN m USING (contract) WHERE contract IN (SELECT contract FROM g)""")
def link_grant_resolve(t):
    """Awards that a text's grant numbers name, and those of the contracts it cites."""
    awards = t.spark.createDataFrame(AWARDS, "award int, core string, key string, title string")
    text = F.element_at(F.array(*[F.lit(s).cast("string") for s in CONTRACTS]), (F.col("o_orderkey") % len(CONTRACTS) + 1).cast("int"))
    contracts = L.contract_numbers(t.orders.select(F.col("o_orderkey").alias("doc"), text.alias("text")), "text").select("doc", "contract")
    return L.resolve_grants(_numbers(t), awards, contracts)


@query(f"""WITH {HITS}, n AS (SELECT doc_id, entity, etype, 'document:' || doc_id || '|' || etype || ':' || entity || '|mentions' AS link_key FROM hits GROUP BY doc_id, entity, etype)
SELECT link_key, doc_id, CASE WHEN doc_id % 7 = 0 THEN 'accepted' WHEN doc_id % 11 = 0 THEN 'rejected' END AS decision FROM n""")
def link_apply_reviews(t):
    key = F.concat(F.lit("document:"), F.col("doc_id").cast("string"), F.lit("|"), F.col("etype"), F.lit(":"), F.col("entity"), F.lit("|mentions"))
    links = hits(t).select("doc_id", key.alias("link_key")).distinct()
    decision = F.when(F.col("doc_id") % 7 == 0, "accepted").when(F.col("doc_id") % 11 == 0, "rejected")
    reviews = links.select("link_key", decision.alias("decision")).where("decision is not null")
    return links.join(reviews, "link_key", "left").select("link_key", "doc_id", "decision")


@query(f"WITH {HITS} SELECT DISTINCT doc_id, 'document:' || doc_id || '|' || etype || ':' || entity || '|mentions' AS link_key FROM hits")
def link_natural_key(t):
    key = F.concat(F.lit("document:"), F.col("doc_id").cast("string"), F.lit("|"), F.col("etype"), F.lit(":"), F.col("entity"), F.lit("|mentions"))
    return hits(t).select("doc_id", key.alias("link_key")).distinct()


@query(f"WITH {HITS} SELECT doc_id, field, term, CASE WHEN ctx AND lang <> 'en' THEN 'review' WHEN etype = 'condition' THEN 'likely' WHEN ctx THEN 'weak' ELSE 'keep' END AS verdict FROM hits")
def link_review_rules(t):
    verdict = F.when(F.col("ctx") & (F.col("lang") != "en"), "review").when(F.col("etype") == "condition", "likely").when(F.col("ctx"), "weak").otherwise("keep")
    return hits(t).select("doc_id", "field", "term", verdict.alias("verdict"))


@query(f"""WITH {HITS} SELECT source, etype, string_agg(DISTINCT entity, ';' ORDER BY entity) AS entities, CAST(count(DISTINCT entity) AS BIGINT) AS n FROM hits GROUP BY source, etype""")
def agg_support_rollup(t):
    g = hits(t).groupBy("source", "etype").agg(F.array_sort(F.collect_set("entity")).alias("e"))
    return g.select("source", "etype", F.array_join("e", ";").alias("entities"), F.size("e").cast("long").alias("n"))


@query()
def link_longest_span(t):
    """Greedy and sequential within a text, so SQL can't express it; tests compare with brute force."""
    terms = [(a, b, "generic" if e else c) for a, b, c, _, e in VOCABULARY]
    return L.longest_spans(t.documents, terms, "doc_id", "text")


