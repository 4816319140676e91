"""Session helper and table readers."""

from __future__ import annotations

import atexit
import hashlib
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def local_session(cpus: int | None = None, memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster passes its own session instead."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName("veridra")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the star-schema or corpus tables, read with column pruning and pushdown intact."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LOCAL: dict[str, str] = {}


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share, under spark.checkpoint.dir.

    Where that is unset, a local session gets a temporary folder that goes with the process,
    and any other session an error, as executors couldn't see such a folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not base:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if context.applicationId not in _LOCAL:
            _LOCAL[context.applicationId] = folder = tempfile.mkdtemp(prefix="spark-veridra-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        base = _LOCAL[context.applicationId]
    return f"{base}/veridra-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """df, written to a scratch folder and read again: cuts lineage and survives lost executors."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks(df: DataFrame) -> int:
    """Tasks for work that is larger than its rows say; a number of its own, so that small partitions are not put together."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def snapshot(spark: SparkSession, paths: list[str]) -> str:
    """What the files under some paths are now: a digest of their names, sizes and times, whichever store they are in."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for path in paths:
        top = jvm.org.apache.hadoop.fs.Path(path)
        files = top.getFileSystem(conf).listFiles(top, True)
        while files.hasNext():
            f = files.next()
            found.append(f"{f.getPath()}\t{f.getLen()}\t{f.getModificationTime()}")
    return hashlib.md5("\n".join(sorted(found)).encode()).hexdigest()


_KEPT: dict[tuple[str, str], tuple[str, DataFrame]] = {}


def kept(spark: SparkSession, name: str, version: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What build returns (a stored frame), kept for this application under a name until the version changes."""
    at = (spark.sparkContext.applicationId, name)
    if at not in _KEPT or _KEPT[at][0] != version:
        _KEPT[at] = version, build()
    return _KEPT[at][1]


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, so that they need no installed copy."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).parent
    path = Path(tempfile.mkdtemp(prefix="spark-veridra-")) / "veridra.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    spark.sparkContext.addPyFile(str(path))
    _SHIPPED.add(app)
