"""Join shapes that come up in entity and document linking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lookup(df: DataFrame, dim: DataFrame, key: str, reason: str) -> DataFrame:
    """Left lookup; `unmatched` names why a row found nothing."""
    hit = dim.withColumn("_hit", F.lit(True))
    out = df.join(hit, key, "left")
    return out.withColumn("unmatched", F.when(F.col(key).isNull(), "blank key").when(F.col("_hit").isNull(), reason)).drop("_hit")


def fallback(df: DataFrame, dim: DataFrame, keys: list[str], dim_key: str, value: str, out: str) -> DataFrame:
    """The dimension's value under the first of several keys that finds one. dim_key must be unique."""
    got = df
    for i, k in enumerate(keys):
        side = dim.select(F.col(dim_key).alias(f"_k{i}"), F.col(value).alias(f"_v{i}"))
        got = got.join(side, F.col(k) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
    tries = [f"_v{i}" for i in range(len(keys))]
    return got.withColumn(out, F.coalesce(*tries)).drop(*tries)


def first_of_list(df: DataFrame, dim: DataFrame, list_col: str, dim_key: str, row: str, sep: str = "|") -> DataFrame:
    """For each row the first listed id that the dimension knows: (row, dim_key)."""
    ids = df.select(row, F.posexplode(F.split(list_col, "[" + sep + "]")).alias("pos", "_id")).withColumn("_id", F.trim("_id"))
    known = ids.join(dim.select(F.col(dim_key).alias("_id")).distinct(), "_id", "left_semi")
    return known.groupBy(row).agg(F.min_by("_id", "pos").alias(dim_key))


def interval_containment(inner: DataFrame, outer: DataFrame, width: int) -> DataFrame:
    """Pairs where inner [s, e] lies in outer [s, e] of the same `chrom`.

    inner: chrom, s, e, inner_id; outer: chrom, s, e, outer_id. Outer intervals are cut
    into buckets of `width`, so this is an equi-join with a residual filter, not a
    product; an inner interval is looked up in the bucket of its start.
    """
    wide = outer.withColumn("bucket", F.explode(F.sequence((F.col("s") / width).cast("long"), (F.col("e") / width).cast("long"))))
    wide = wide.select("chrom", "bucket", "outer_id", F.col("s").alias("os"), F.col("e").alias("oe"))
    at = inner.withColumn("bucket", (F.col("s") / width).cast("long"))
    return at.join(wide, ["chrom", "bucket"]).where((F.col("os") <= F.col("s")) & (F.col("e") <= F.col("oe"))).drop("bucket")


def _beginnings(df: DataFrame, dim: DataFrame, prefix: str, key: str, size: int) -> DataFrame:
    """dim with `_p`, once for each length of df's prefixes: the beginning of its key that is so long."""
    lengths = df.select(F.length(prefix).alias("_n")).where(F.col("_n") >= size).distinct()
    return dim.join(F.broadcast(lengths), F.length(key) >= F.col("_n")).withColumn("_p", F.substr(key, F.lit(1), F.col("_n"))).drop("_n")


def prefix_match(df: DataFrame, dim: DataFrame, prefix: str, key: str, size: int, one: str | None = None) -> DataFrame:
    """Pairs where dim.key starts with df.prefix; prefixes hold at least `size` letters.

    Whole prefixes are joined, so that no pair is made that does not match. With `one`, only prefixes
    count whose matches all have one value of that column of dim; that is told before pairs are made.
    """
    right = _beginnings(df, dim, prefix, key, size)
    left = df.withColumn("_p", F.col(prefix))
    if one:
        low, high = F.min(one), F.max(one)
        left = left.join(right.groupBy("_p").agg(low.alias("_lo"), high.alias("_hi")).where(F.col("_lo").eqNullSafe(F.col("_hi"))).select("_p"), "_p", "left_semi")
    return left.join(right, "_p").drop("_p")


def dealt_join(left: DataFrame, right: DataFrame, key: str, shares: int = 64) -> DataFrame:
    """left.join(right, key) for few keys of many rows: each left row is in one share of its key, each right row in all, and shares are dealt over tasks."""
    spark = left.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)
    a = left.withColumn("_share", F.pmod(F.xxhash64(*left.columns), F.lit(shares)).cast("int"))
    b = right.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    # a number of partitions of its own: small rows that make many pairs are not put together
    a, b = (x.repartition(n, key, "_share") for x in (a, b))
    return a.join(b.hint("merge"), [key, "_share"]).drop("_share")


def listed(df: DataFrame, keys: list[str], value: str, most: int = 256, ranges: int = 64) -> DataFrame:
    """(keys, range, values): values of each key as lists, one for each of at most `ranges` ranges of values, cut so that a list has about `most`.

    Values of a lower range are less than those of a higher one.
    """
    n = df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    cuts = min(-(-n // most), ranges)
    place = F.lit(0)
    if cuts > 1:
        ends = df.agg(F.percentile_approx(value, [i / cuts for i in range(1, cuts)], 10_000)).first()[0]
        place = F.size(F.filter(F.array(*map(F.lit, sorted(set(ends)))), lambda end: end < F.col(value)))
    return df.groupBy(*keys, place.alias("range")).agg(F.collect_list(value).alias("values"))


def unambiguous(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Rows of groups whose rows all have one value."""
    w = Window.partitionBy(*by)
    return df.withColumn("_lo", F.min(value).over(w)).withColumn("_hi", F.max(value).over(w)).where(F.col("_lo").eqNullSafe(F.col("_hi"))).drop("_lo", "_hi")


def orphans(refs: DataFrame, targets: dict[str, DataFrame], kind: str, ident: str) -> DataFrame:
    """References (kind, ident) whose target is missing; targets maps a kind to a table of ids."""
    known = None
    for k, ids in targets.items():
        part = ids.select(F.lit(k).alias(kind), ids[ids.columns[0]].cast("string").alias(ident))
        known = part if known is None else known.unionByName(part)
    return refs.join(known, [kind, ident], "left_anti")


def consecutive(df: DataFrame, group: list[str], order: list[str], value: str) -> DataFrame:
    """(group, value, next_value) of neighbours in a group's order."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("next_value", F.lead(value).over(w)).where(F.col("next_value").isNotNull()).select(*group, value, "next_value")


def undirected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Edges given in either direction, once each, smaller end first; self edges go."""
    return edges.where(F.col(a) != F.col(b)).select(F.least(a, b).alias(a), F.greatest(a, b).alias(b)).distinct()


def token_overlap(a: Column, b: Column) -> Column:
    """At least half of the distinct tokens of a are in b."""
    a = F.array_distinct(a)
    return (F.size(a) > 0) & (F.size(F.array_intersect(a, b)) * 2 >= F.size(a))
