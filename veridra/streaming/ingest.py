"""Incremental ingest by Structured Streaming: a restart takes what is new, and nothing twice.

Delivered files are a stream. Its checkpoint holds which files were taken; each micro-batch is
written to a folder of its own, named by its number, beside and then swapped in. A batch that was
written but not yet committed when the driver died is written again under the same number, so it
takes effect once. The table is the union of the batches, of which the latest row of a key counts;
old batches can be folded into one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "_batch"


def _files(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def _swap(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Write df beside a folder and put it in its place; a hidden name keeps readers from what is not done."""
    parent = path.rpartition("/")[0]
    fresh = f"{parent}/_new-{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    fs, target = _files(spark, path)
    fs.delete(target, True)
    fs.rename(_files(spark, fresh)[1], target)


def batches(spark: SparkSession, target: str, schema: str) -> DataFrame:
    """All rows that were taken, with the number of their batch; no rows if there is no batch yet."""
    fs, path = _files(spark, target)
    found = [f.getPath() for f in fs.listStatus(path)] if fs.exists(path) else []
    folders = [f.toString() for f in found if f.getName().startswith(f"{BATCH}=")]
    if not folders:
        return spark.createDataFrame([], f"{schema}, {BATCH} long")
    return spark.read.schema(f"{schema}, {BATCH} long").option("basePath", target).parquet(*folders)


def current(spark: SparkSession, target: str, schema: str, key: list[str]) -> DataFrame:
    """The table: the row of each key that came in the latest batch (within one, the first by all columns)."""
    rows = batches(spark, target, schema)
    rest = [c for c in rows.columns if c not in (*key, BATCH)]
    last = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(BATCH, *rest)).alias("_r")) if rest else rows.select(*key).distinct()
    columns = [c for c in rows.columns if c != BATCH]
    return last.select(*[F.col(c) if c in key else F.col(f"_r.{c}").alias(c) for c in columns])


def take(
    spark: SparkSession, source: str, target: str, checkpoint: str, schema: str, key: list[str],
    fetch: Callable[[DataFrame], DataFrame] | None = None, fetched: str | None = None, files_a_batch: int = 1_000, skip_known: bool = False,
) -> None:
    """Take all files of `source` (Parquet) that no earlier run took.

    Rows may be sent through `fetch` first (a frame to a frame of schema `fetched`, say by mapInArrow over
    ids). skip_known leaves out keys that an earlier batch has, so that an id is fetched once however
    often it is delivered; rows that fetch leaves out are not known and come again when they are delivered again.
    Rows with a null in the key are dropped.
    """
    out_schema = fetched or schema

    def merge(batch: DataFrame, number: int) -> None:
        rows = batch.dropna(subset=key)
        if skip_known:
            known = batches(spark, target, out_schema).where(F.col(BATCH) != number).select(*key)
            rows = rows.dropDuplicates(key).join(known, key, "left_anti")
        _swap(spark, fetch(rows) if fetch else rows, f"{target}/{BATCH}={number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(source)
    done = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    done.awaitTermination()


def fold(spark: SparkSession, target: str, schema: str, key: list[str]) -> None:
    """Fold all batches into the latest one. Readers that listed them before still find the folded rows' keys once:
    the latest batch is swapped first, then the older ones go."""
    rows = batches(spark, target, schema)
    last = rows.agg(F.max(BATCH)).first()[0]
    if last is None:
        return
    _swap(spark, current(spark, target, schema, key), f"{target}/{BATCH}={last}")
    fs, path = _files(spark, target)
    for s in fs.listStatus(path):
        name = s.getPath().getName()
        if name.startswith(f"{BATCH}=") and int(name.split("=")[1]) < last:
            fs.delete(s.getPath(), True)

