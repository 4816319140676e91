"""Set comparison, agreement and multiset difference."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored


def relation(a: Column, b: Column) -> Column:
    """How set b relates to set a: same, narrowed, expanded, shifted, disjoint, or one of them empty."""
    shared = F.size(F.array_intersect(a, b))
    only_a, only_b = F.size(F.array_except(a, b)), F.size(F.array_except(b, a))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), "none").when(F.size(b) == 0, "second_empty").when(F.size(a) == 0, "first_empty")
        .when((only_a == 0) & (only_b == 0), "same").when(only_b == 0, "narrowed").when(only_a == 0, "expanded")
        .when(shared > 0, "shifted").otherwise("disjoint")
    )


def jaccard(a: Column, b: Column, digits: int = 3) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.round(F.size(F.array_intersect(a, b)) / union, digits))


def flow(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both sets with `side`: shared, first_only or second_only."""
    left = a.select(*keys).distinct().withColumn("_a", F.lit(True))
    right = b.select(*keys).distinct().withColumn("_b", F.lit(True))
    side = F.when(F.col("_a") & F.col("_b"), "shared").when(F.col("_a"), "first_only").otherwise("second_only")
    return left.join(right, keys, "full").select(*keys, side.alias("side"))


def multiset_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one side has more often: columns, `side` and `n`. Order never matters."""
    cols = a.columns
    both = a.select(*cols, F.lit(1).alias("_w")).unionByName(b.select(*cols, F.lit(-1).alias("_w")))
    net = both.groupBy(*cols).agg(F.sum("_w").alias("_net")).where("_net <> 0")
    return net.withColumn("side", F.when(F.col("_net") > 0, "first").otherwise("second")).withColumn("n", F.abs("_net")).drop("_net")


def _leaves(tables: dict[str, DataFrame], leaves: int) -> DataFrame:
    """(tab, leaf, n, total, mix): the rows of every table by a hash of them, each leaf with sums that no order of rows changes."""
    parts = []
    for name, df in tables.items():
        row = F.struct(*df.columns)
        h = df.select(F.xxhash64(row).alias("h"), F.xxhash64(F.lit(7), row).alias("g"))
        parts.append(h.select(F.lit(name).alias("tab"), F.pmod("h", F.lit(leaves)).cast("int").alias("leaf"), "h", "g"))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy("tab", "leaf").agg(F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("total"), F.bit_xor("g").alias("mix"))


def compare_builds(this: dict[str, DataFrame], other: dict[str, DataFrame], leaves: int = 1_024, samples: int = 3) -> DataFrame:
    """(tab, verdict, rows_this, rows_other, only_this, only_other, sample_this, sample_other) of every table of two builds.

    verdict is `same`, `differs` or `one side only`. Tables are multisets of rows: order and files do not matter,
    repeats do. Rows are compared by leaf digests first, one number of each row and none of its text; only rows of
    leaves that differ are compared in full. Samples are the first columns of the smallest rows that one side lacks, joined by commas.
    Both sides' columns must agree by name. Equal digests of other rows are one in 2^128 or so.
    """
    a, b = _leaves(this, leaves), _leaves(other, leaves)
    side = lambda df, x: df.select("tab", "leaf", *[F.col(c).alias(f"{c}_{x}") for c in ("n", "total", "mix")])
    both = stored(side(a, "a").join(side(b, "b"), ["tab", "leaf"], "full"))
    unlike = ~(F.col("n_a").eqNullSafe(F.col("n_b")) & F.col("total_a").eqNullSafe(F.col("total_b")) & F.col("mix_a").eqNullSafe(F.col("mix_b")))
    # at most `leaves` numbers a table
    open_leaves: dict[str, list[int]] = {}
    for r in both.where(unlike).select("tab", "leaf").collect():
        open_leaves.setdefault(r["tab"], []).append(r["leaf"])
    counts = both.groupBy("tab").agg(F.coalesce(F.sum("n_a"), F.lit(0)).alias("rows_this"), F.coalesce(F.sum("n_b"), F.lit(0)).alias("rows_other"))
    told = []
    for name, some in open_leaves.items():
        if name not in this or name not in other:
            continue
        columns = this[name].columns
        narrow = lambda df: df.select(*columns).where(F.pmod(F.xxhash64(F.struct(*columns)), F.lit(leaves)).isin(some))  # noqa: B023, E731
        diff = stored(multiset_diff(narrow(this[name]), narrow(other[name])))
        n = lambda s: F.coalesce(F.sum(F.when(F.col("side") == s, F.col("n"))), F.lit(0))
        least = {s: [str(r[0]) for r in diff.where(F.col("side") == s).orderBy(*columns).limit(samples).select(columns[0]).collect()] for s in ("first", "second")}
        told.append(diff.agg(n("first").alias("only_this"), n("second").alias("only_other")).select(
            F.lit(name).alias("tab"), "only_this", "only_other", F.lit(",".join(least["first"])).alias("sample_this"), F.lit(",".join(least["second"])).alias("sample_other")))
    spark = both.sparkSession
    told.append(spark.createDataFrame([], "tab string, only_this long, only_other long, sample_this string, sample_other string"))
    names = spark.createDataFrame([(n, n in this and n in other) for n in {**this, **other}], "tab string, shared boolean")
    out = names.join(counts, "tab", "left").join(reduce(DataFrame.unionByName, told), "tab", "left").fillna(0, ["rows_this", "rows_other"])
    verdict = F.when(~F.col("shared"), "one side only").when(F.col("only_this").isNull(), "same").otherwise("differs")
    lacking = lambda c, rows: F.when(F.col("shared"), F.coalesce(c, F.lit(0))).otherwise(F.col(rows)).alias(c)
    return out.select("tab", verdict.alias("verdict"), "rows_this", "rows_other", lacking("only_this", "rows_this"), lacking("only_other", "rows_other"), F.coalesce("sample_this", F.lit("")).alias("sample_this"), F.coalesce("sample_other", F.lit("")).alias("sample_other"))


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Bounds of the Wilson interval of k in n, within [0, 1]; both 0 for an empty sample."""
    some = F.nullif(n, F.lit(0))
    p = k / some
    mid = (p + z * z / (2 * some)) / (1 + z * z / some)
    half = z / (1 + z * z / some) * F.sqrt(p * (1 - p) / some + z * z / (4 * some * some))
    low, high = F.greatest(mid - half, F.lit(0.0)), F.least(mid + half, F.lit(1.0))
    return F.when(n > 0, low).otherwise(0.0), F.when(n > 0, high).otherwise(0.0)


def wilson_number(k: int, n: int, z: float = 1.96) -> tuple[float, float]:
    """The same for two numbers (used in tests)."""
    if not n:
        return 0.0, 0.0
    p = k / n
    mid = (p + z * z / (2 * n)) / (1 + z * z / n)
    half = z / (1 + z * z / n) * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return max(0.0, mid - half), min(1.0, mid + half)
