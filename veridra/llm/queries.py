"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import additive, bpe, chat, codes, counts, dart, ego, langid, lines, packing, pii, toxicity, whitening

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op2_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return additive.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, top=20)


def op3_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, lines removed, and the MD5 of what is left."""
    out = lines.drop_boilerplate(_table(spark, sf_dir, "documents"), min_sites=5, min_chars=20, short_sites=10)
    return out.select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), F.md5("text").alias("kept_md5")
    )


OP3_SQL = """
WITH lines AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents
), each AS (
  SELECT doc_id, source, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM lines
), kept AS (
  SELECT doc_id, source, pos, line, trim(line, ' ') AS t FROM each
), spread AS (
  SELECT t, count(DISTINCT source) AS sites, min((doc_id, pos)) AS first
  FROM kept WHERE t <> '' GROUP BY t HAVING count(DISTINCT source) >= CASE WHEN length(t) >= 20 THEN 5 ELSE 10 END
), marked AS (
  SELECT k.doc_id, k.pos, k.line, (s.t IS NOT NULL AND (k.doc_id, k.pos) <> s.first) AS gone
  FROM kept k LEFT JOIN spread s ON k.t = s.t
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_removed,
       md5(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_md5
FROM marked GROUP BY doc_id
"""


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: counts of base kinds, their digest, all spans, secrets, everything found, and the MD5 of the safe text."""
    out = pii.sanitise(_table(spark, sf_dir, "documents"))
    counts = [pii.kind_count(F.col("_base"), k).alias(f"n_{k}") for k in pii.KINDS]
    return out.select(
        "doc_id", *counts, F.sha2(pii.listed(F.col("_base")), 256).alias("base_sha256"),
        pii.listed(F.col("_spans")).alias("spans"),
        pii.kind_count(F.col("_spans"), "secret").alias("n_secret"), F.size("_spans").cast("long").alias("n_found"), F.md5("_clean").alias("clean_md5"),
    )


def op5_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart.near_duplicates(_table(spark, sf_dir, "documents"), least=0.8, width=5)


def op6_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat.rotate(_table(spark, sf_dir, "conversations"))
    return out.withColumn("rendered", F.md5("rendered")).withColumnRenamed("rendered", "rendered_md5")


OP6_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) - 1 AS seq
  FROM conversations
), people AS (
  SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'
), roles AS (
  SELECT t.*, p.perspective,
         CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS chat_role
  FROM t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), parts AS (
  SELECT *, CASE WHEN chat_role = 'user' THEN speaker END AS name,
         '<|im_start|>' || chat_role || CASE WHEN chat_role = 'user' THEN ' name=' || speaker ELSE '' END || chr(10) AS prefix
  FROM roles
), full_text AS (
  SELECT *, prefix || text || '<|im_end|>' || chr(10) AS rendered FROM parts
), placed AS (
  SELECT *, CAST(sum(length(rendered)) OVER (PARTITION BY conv_id, perspective ORDER BY seq) AS BIGINT) AS "end" FROM full_text
)
SELECT conv_id, perspective, turn, seq, chat_role, name, md5(rendered) AS rendered_md5,
       "end" - length(rendered) AS start, "end",
       CASE WHEN chat_role = 'assistant' THEN "end" - length(rendered) + length(prefix) ELSE "end" - length(rendered) END AS mask_start,
       CASE WHEN chat_role = 'assistant' THEN "end" - 1 ELSE "end" - length(rendered) END AS mask_end,
       chat_role = 'assistant' AS learn
FROM placed
"""


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return bpe.encode_decode(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN, with_ids=False)


def op8_ego(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ego.near_duplicates(_table(spark, sf_dir, "embeddings"), least=0.9)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain: poor quality first, then toxicity."""
    categories = {"poor": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), categories)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path(BYTE_BPE), size=2048, end_id=0, with_ids=False)


def op11_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE), limit=4096)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), components=32)


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector: code, error, error of its label, and the digest of the codebooks."""
    out, books = codes.compress(_table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)
    return out.withColumn("codebooks_sha256", F.lit(codes.digest(books)))


QUERIES = {
    "op1_language": op1_language,
    "op2_additive": op2_additive,
    "op3_line_spread": op3_line_spread,
    "op4_pii": op4_pii,
    "op5_dart_minhash": op5_dart_minhash,
    "op6_perspectives": op6_perspectives,
    "op7_bpe": op7_bpe,
    "op8_ego": op8_ego,
    "op9_toxicity": op9_toxicity,
    "op10_packing": op10_packing,
    "op11_counts": op11_counts,
    "op12_whitening": op12_whitening,
    "op13_codes": op13_codes,
}
ORACLES: dict[str, str] = {"op3_line_spread": OP3_SQL, "op6_perspectives": OP6_SQL}
