"""What several operators share: scratch tables, exact ranks, connected components."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A group of equal keys is dealt over this many rows a salt at most, on average.
ROWS_PER_SALT = 50_000


#: Folders of local sessions that set none, by application.
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a local session (one machine) gets a temporary folder that goes with
    the process; any other session gets an error, as executors couldn't see such a folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = folder = tempfile.mkdtemp(prefix="spark-veridra-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return _LOCAL[context.applicationId]


#: Texts of an Arrow batch: of Spark's 10,000 long ones, Python and the JVM would each hold a copy.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches from now on in this session, unless it has chosen a size of its own."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """df with columns c0, c1, ... and where each name went: no name of a caller can clash with one of ours."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), {n: f"c{i}" for i, n in enumerate(df.columns)}


def stored(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, key: str, order: list[str], n_rows: int, out: str = "rank") -> DataFrame:
    """Number the rows of each key from 0, without ever bringing one key's rows to one task.

    Each key is dealt over salts; rows are numbered within (key, salt), and a table of
    counts with one row per (key, salt) gives every salt its first number. The numbers are
    a permutation of 0..count-1 of a key; `order` makes them repeatable.
    """
    salts = max(8, n_rows // ROWS_PER_SALT + 1)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    counts = salted.groupBy(key, "_salt").agg(F.count("*").alias("_n"))
    firsts = counts.select(
        key, "_salt",
        (F.sum("_n").over(Window.partitionBy(key).orderBy("_salt")) - F.col("_n")).alias("_first"),
    )
    numbered = salted.withColumn(
        "_i", F.row_number().over(Window.partitionBy(key, "_salt").orderBy(*order)) - 1
    )
    return (
        numbered.join(firsts, [key, "_salt"])
        .withColumn(out, (F.col("_first") + F.col("_i")).cast("long"))
        .drop("_salt", "_i", "_first")
    )


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge list; component is its smallest node.

    Alternates the large-star and small-star steps, each a groupBy and a join, so the
    number of edges never grows; stops when a round changes nothing. Self edges and
    repeats are ignored. Every round is written to the shared folder.
    """
    e = (
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    e = stored(e)
    before = None
    for _ in range(rounds):
        # large star: every larger neighbour of a node is linked to the node's smallest one
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = (
            both.join(least, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        # small star: a node and its smaller neighbours are linked to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        e = stored(small)
        now = tuple(
            e.agg(
                F.count("*"),
                F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1_000_000_007))),
                F.count_if(F.col("u") < F.col("v")),
            ).first()
        )
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    stars = e.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    roots = stars.select(F.col("component").alias("node")).distinct()
    return stars.unionByName(roots.withColumn("component", F.col("node")))
