"""Search within names by postings: which rows hold each run of three letters, and an exact recheck.

A name that holds a pattern holds all its runs of three letters, so rows that are in the posting
lists of all of them are the only candidates. Lists are stored in buckets of the run, sorted by it;
a search reads the buckets of its runs and no names but the candidates'.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch

GRAM, BUCKETS = 3, 64


def _grams(text: Column) -> Column:
    """Distinct runs of GRAM letters; a shorter text is one run."""
    each = F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - GRAM + 1, F.lit(1))), lambda i: F.substr(text, i, F.lit(GRAM)))
    return F.array_distinct(each)


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def postings(rows: DataFrame, ident: str, text: str) -> DataFrame:
    """(bucket, gram, id): stored; texts are compared in lower case; null and empty ones are in no list."""
    each = rows.where(F.length(text) > 0).select(F.explode(_grams(F.lower(text))).alias("gram"), F.col(ident).alias("id"))
    path = scratch(rows.sparkSession)
    dealt = each.withColumn("bucket", _bucket(F.col("gram"))).repartition("bucket", F.pmod(F.xxhash64("id"), F.lit(8))).sortWithinPartitions("bucket", "gram")
    dealt.write.partitionBy("bucket").parquet(path)
    kind = rows.schema[ident].dataType.simpleString()
    return rows.sparkSession.read.schema(f"gram string, id {kind}, bucket int").parquet(path)


def candidates(lists: DataFrame, pattern: str) -> DataFrame:
    """(id) of rows that may hold a pattern: those in all its lists. A pattern shorter than a run is looked for within the runs."""
    p = pattern.lower()
    if len(p) < GRAM:
        return lists.where(F.col("gram").contains(p)).select("id").distinct()
    runs = sorted({p[i : i + GRAM] for i in range(len(p) - GRAM + 1)})
    spark = lists.sparkSession
    # as many numbers as the pattern has runs
    buckets = [r[0] for r in spark.createDataFrame([(r,) for r in runs], "gram string").select(_bucket(F.col("gram"))).distinct().collect()]
    mine = lists.where(F.col("bucket").isin(buckets) & F.col("gram").isin(runs))
    return mine.groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") == len(runs)).select("id")


def search(rows: DataFrame, lists: DataFrame, ident: str, text: str, pattern: str) -> DataFrame:
    """Rows whose text holds the pattern, in lower case: candidates by postings, each checked."""
    found = candidates(lists, pattern).withColumnRenamed("id", ident)
    return rows.join(found, ident, "left_semi").where(F.lower(text).contains(pattern.lower()))
