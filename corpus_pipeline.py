"""A corpus from documents to packed sequences: five stages, each over all that the one before kept.

Stages take (spark, docs, sf_dir) and return a DataFrame; each is written as Parquet and
read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veridra.llm import dart, langid, lines, packing, pii
from veridra.llm.common import small_batches, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found; texts without letters go. lang takes the prediction."""
    small_batches(spark)
    found = langid.identify(docs, carry=("text", "source", "n_chars")).where(F.col("lang_pred") != "und")
    return found.withColumnRenamed("lang_pred", "lang").select(*COLUMNS)


def line_spread(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go but for their first occurrence; a document that had text and has none left goes too."""
    out = lines.drop_boilerplate(docs, min_sites=5, min_chars=20, short_sites=10)
    out = out.where((F.col("_n_removed") == 0) | (F.trim("text") != ""))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: that with the smallest id, a null id last.

    Texts are compared row by row, whatever their ids: rows with a null id take part, and
    rows that share an id but not the text are apart. Of equal rows one stays. Rows of
    equal id and text meet in one task.
    """
    small_batches(spark)
    row = F.xxhash64("doc_id", F.col("doc_id").isNull(), "text", F.col("text").isNull())
    docs = docs.withColumn("_row", row)
    ids = docs.select(F.col("_row").alias("_kept"), "doc_id").distinct()
    classes = dart.near_duplicates(docs, id_col="_row").select(F.col("_row").alias("_kept"), "class_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_kept"))
    kept = stored(ids.join(classes, "_kept").groupBy("class_id").agg(first.alias("f")).select(F.col("f._kept").alias("_row")))
    return docs.join(kept.hint("merge"), "_row", "left_semi").dropDuplicates(["_row"]).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data and revealing terms replaced."""
    out = pii.sanitise(docs).withColumn("text", F.col("_clean"))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids and their places in sequences of 2048."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), size=2048, end_id=0, with_ids=False)


STAGES = [
    ("language ID", language),
    ("line dedup", line_spread),
    ("MinHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("best-fit packing", best_fit),
]

#: MinHash classes and bin completion can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
