"""Entity resolution: picking fields, merging sources, folding duplicates, assigning ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored


def pick_field(candidates: list[tuple[str, Column]]) -> tuple[Column, Column]:
    """(value, source) of the first candidate that is not null."""
    value = F.coalesce(*[c for _, c in candidates])
    source = F.coalesce(*[F.when(c.isNotNull(), F.lit(s)) for s, c in candidates])
    return value, source


def field_provenance(df: DataFrame, entity: str, fields: dict[str, list[tuple[str, Column]]]) -> DataFrame:
    """(entity, field, source): which source each field of an entity came from."""
    won = F.array(*[F.struct(F.lit(f).alias("field"), pick_field(c)[1].alias("source")) for f, c in fields.items()])
    return df.select(entity, F.explode(won).alias("w")).where("w.source is not null").select(entity, "w.field", "w.source")


def merge_sources(a: DataFrame, b: DataFrame, key: str, prefer: dict[str, str]) -> DataFrame:
    """Full outer merge on a key that is unique in either side; prefer says, for each column, whose value comes first.

    Adds `sources` (a, b or both). Rows without a partner stay.
    """
    left = a.select(F.col(key), *[F.col(c).alias(f"_a_{c}") for c in prefer], F.lit(True).alias("_in_a"))
    right = b.select(F.col(key), *[F.col(c).alias(f"_b_{c}") for c in prefer], F.lit(True).alias("_in_b"))
    both = left.join(right, key, "full")
    cols = [F.coalesce(f"_{first}_{c}", f"_{'b' if first == 'a' else 'a'}_{c}").alias(c) for c, first in prefer.items()]
    sources = F.when(F.col("_in_a") & F.col("_in_b"), "both").when(F.col("_in_a"), "a").otherwise("b")
    return both.select(key, *cols, sources.alias("sources"))


def canonical(df: DataFrame, group: str, ident: str, order: list[Column]) -> DataFrame:
    """(ident, canonical) for the ids of a group that fold into its best one."""
    best = F.first(ident).over(Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return df.select(F.col(ident), best.alias("canonical")).where(F.col(ident) != F.col("canonical")).distinct()


def merge_rows(df: DataFrame, key: list[str], first: list[str], union: list[str], order: str) -> DataFrame:
    """One row per key: `first` columns from the first row in order that has one, `union`
    columns as sorted distinct values joined by `; `."""
    firsts = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in first]
    unions = [F.array_join(F.array_sort(F.collect_set(c)), "; ").alias(c) for c in union]
    return df.groupBy(*key).agg(*firsts, *unions, F.count("*").alias("n_rows"))


def exact_dedupe(df: DataFrame) -> DataFrame:
    """(rows, kept, dropped) of dropping identical rows."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return groups.agg(F.sum("_n").alias("rows"), F.count("*").alias("kept"), (F.sum("_n") - F.count("*")).alias("dropped"))


def first_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def number_entities(df: DataFrame, key: list[str], order: str, out: str) -> DataFrame:
    """One row per key with ids from 1 in order of first appearance.

    The keys are ranked by a global sort; the running number comes from per-partition counts.
    """
    firsts = df.groupBy(*key).agg(F.min(order).alias("_at"))
    # written before it is used twice: what a partition holds must not change between the two
    parts = stored(firsts.repartitionByRange("_at", *key).withColumn("_p", F.spark_partition_id()))
    sizes = parts.groupBy("_p").agg(F.count("*").alias("_n"))
    before = sizes.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_b"))
    within = Window.partitionBy("_p").orderBy("_at", *key)
    parts = parts.withColumn("_i", F.row_number().over(within)).join(F.broadcast(before), "_p")
    return parts.withColumn(out, (F.col("_b") + F.col("_i")).cast("long")).drop("_p", "_i", "_b", "_at")


def places(df: DataFrame, group: str, order: list[str], out: str) -> DataFrame:
    """df with each row's place (from 1) in its group's order, however many rows a group has.

    Rows are sorted by ranges over all groups; a group that spans partitions goes on counting
    after what the partitions before hold of it. Null groups are one group.
    """
    parts = stored(df.repartitionByRange(group, *order).withColumn("_p", F.spark_partition_id()))
    sizes = parts.groupBy(group, "_p").agg(F.count("*").alias("_n"))
    before = sizes.select(F.col(group).alias("_g"), F.col("_p").alias("_q"), (F.sum("_n").over(Window.partitionBy(group).orderBy("_p")) - F.col("_n")).alias("_b"))
    own = parts.withColumn("_i", F.row_number().over(Window.partitionBy(group, "_p").orderBy(*order)))
    both = own.join(before, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_p") == F.col("_q")))
    return both.withColumn(out, (F.col("_b") + F.col("_i")).cast("long")).drop("_p", "_q", "_g", "_i", "_b")


def assign_by_label(df: DataFrame, label: str, fallback: str, index: DataFrame, name: str, value: str) -> DataFrame:
    """The index value of the label, else of the fallback, with the basis; names match trimmed and case-insensitively."""
    norm = lambda c: F.lower(F.trim(F.col(c)))
    idx = index.select(F.lower(F.trim(F.col(name))).alias("_n"), F.col(value).alias("_v"))
    out = df.join(idx.select(F.col("_n").alias("_n1"), F.col("_v").alias("_v1")), norm(label) == F.col("_n1"), "left")
    out = out.join(idx.select(F.col("_n").alias("_n2"), F.col("_v").alias("_v2")), norm(fallback) == F.col("_n2"), "left")
    basis = F.when(F.col("_v1").isNotNull(), "label").when(F.col("_v2").isNotNull(), "fallback")
    return out.withColumn(value, F.coalesce("_v1", "_v2")).withColumn("basis", basis).drop("_n1", "_v1", "_n2", "_v2")


def upsert_coalesce(old: DataFrame, new: DataFrame, key: str, keep_old: bool = True) -> DataFrame:
    """Rows of both by key; where both have a row, each column's old value wins unless null (or the new one's)."""
    cols = [c for c in old.columns if c != key]
    o = old.select(key, *[F.col(c).alias(f"_o_{c}") for c in cols])
    n = new.select(key, *[F.col(c).alias(f"_n_{c}") for c in cols])
    pick = lambda c: F.coalesce(*([f"_o_{c}", f"_n_{c}"] if keep_old else [f"_n_{c}", f"_o_{c}"])).alias(c)
    return o.join(n, key, "full").select(key, *[pick(c) for c in cols])


def merge_owned(runs: list[tuple[str, DataFrame]], key: str, takes_over: dict[str, set[str]]) -> DataFrame:
    """(key, owner, fields): one row per key after runs of producers, in their order.

    A run is a producer's whole delivery: (producer, frame of key and fields), of the same fields in
    every run. A row that is there keeps its fields and has its nulls filled; its owner stays too, unless
    the producer that delivers it takes rows over from that owner. A producer that no longer delivers a
    row it owns takes it away, with what others filled in; rows that others own it can't take away. A later
    run may bring the row again. Rows that repeat a key within a run are one, of the smallest values.

    All runs meet in one grouping by key, which holds one entry a run for a key; nulls in the key are left out.
    """
    fields = [c for c in runs[0][1].columns if c != key]
    each = [df.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.min(c).alias(c) for c in fields]).withColumn("_run", F.lit(i)) for i, (_, df) in enumerate(runs)]
    rows = reduce(DataFrame.unionByName, each)
    entries = F.collect_list(F.struct("_run", F.struct(*fields).alias("_row")))
    gathered = rows.groupBy(key).agg(F.map_from_entries(entries).alias("_rows"))
    none = F.array().cast("array<string>")
    order = F.array(*[
        F.struct(F.lit(i).alias("run"), F.lit(p).alias("by"), (F.array(*map(F.lit, sorted(takes_over[p]))) if takes_over.get(p) else none).alias("over"))
        for i, (p, _) in enumerate(runs)
    ])
    kinds = {f.name: f.dataType for f in runs[0][1].schema.fields}
    absent = F.struct(F.lit(None).cast("string").alias("owner"), *[F.lit(None).cast(kinds[c]).alias(c) for c in fields])

    def step(state: Column, run: Column) -> Column:
        row = F.try_element_at("_rows", run["run"])
        owner = F.when(state["owner"].isNull() | F.array_contains(run["over"], state["owner"]), run["by"]).otherwise(state["owner"])
        taken = F.struct(owner.alias("owner"), *[F.coalesce(state[c], row[c]).alias(c) for c in fields])
        return F.when(row.isNotNull(), taken).when(state["owner"] == run["by"], absent).otherwise(state)

    return gathered.select(key, F.aggregate(order, absent, step).alias("_s")).where("_s.owner IS NOT NULL").select(key, "_s.*")


def expand_dataset(old: DataFrame, new: DataFrame, key: str, ident: str, width: int = 4, prefix: str = "NEW_") -> DataFrame:
    """old plus the rows of new whose key old lacks, with ids that continue after the largest."""
    fresh = new.join(old.select(key), key, "left_anti")
    last = F.regexp_extract(F.col(ident), r"(\d+)$", 1).cast("long")
    start = old.agg(F.max(last)).first()[0] or 0
    numbered = number_entities(fresh, [key], key, "_no")
    fresh = fresh.join(numbered, key).withColumn(ident, F.concat(F.lit(prefix), F.lpad((F.col("_no") + start).cast("string"), width, "0"))).drop("_no")
    return old.unionByName(fresh.select(*old.columns))
