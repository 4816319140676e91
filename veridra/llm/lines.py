"""Cross-site boilerplate lines, found by the spread of distinct sites that carry a line.

Every line hash aggregates a HyperLogLog sketch of its sites; sketches merge map-side and
again after the shuffle, so a line that stands on a third of all pages is one row a task.
A line whose estimate lies within three standard errors of the threshold is counted exactly;
beyond them the sketch decides. Of a boilerplate line the first occurrence stays and the others go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, stored

#: A line of more than this share of all lines is hot; fewer lines than one over it can be.
HOT = 1 / 1000


def _without(lines: Column, gone: Column) -> Column:
    """The lines whose positions (from 0) aren't in `gone`, which ascends."""
    def run(i: Column) -> Column:
        before = F.when(i == 0, F.lit(-1)).otherwise(F.get(gone, i - 1))
        until = F.when(i == F.size(gone), F.size(lines)).otherwise(F.get(gone, i))
        return F.slice(lines, before + 2, until - before - 1)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), run))


def _met(lines: DataFrame, keys: DataFrame, hot: DataFrame) -> DataFrame:
    """lines joined to keys (hash, hot, ...), which has each hash once. Keys of hot lines, at most 1,000 whatever
    the size, are sent to where their lines are; the others meet by sorting, and no hot line (hot: hash) is sent to them."""
    common = F.broadcast(keys.where("hot").drop("hot"))
    rare = lines.join(F.broadcast(hot), "hash", "left_anti").join(keys.where("NOT hot").drop("hot").hint("merge"), "hash")
    return lines.join(common, "hash").unionByName(rare)


def drop_boilerplate(
    docs: DataFrame, min_sites: int = 5, min_chars: int = 20, lg_k: int = 12, keep_first: bool = True,
    short_sites: int | None = None,
    id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
) -> DataFrame:
    """docs with boilerplate lines removed from text_col, plus `_n_lines` and `_n_removed`.

    A line is what stands between line feeds, without outer spaces; it is
    boilerplate if at least min_sites distinct sites carry it (null sites are not counted).
    A line shorter than min_chars, but not blank, needs short_sites; where that is None,
    such lines never count. keep_first leaves the occurrence with the smallest
    (id, position). A null text stays null with no lines; an empty text is one empty line.
    Rows that repeat an id and text are treated alike; rows with an equal id and another
    text are separate; null ids are ids like any other. Other columns pass through, but for any named like the two new ones.
    """
    docs, names = numbered(docs)
    text, ident = F.col(names[text_col]), names[id_col]
    key = F.xxhash64(ident, text)
    lines = (
        docs.where(text.isNotNull())
        .select(
            key.alias("row"), F.col(ident).alias("id"), F.col(names[site_col]).cast("string").alias("site"),
            F.posexplode(F.split(text, "\n")).alias("pos", "line"),
        )
        .withColumn("line", F.trim("line"))
        .where(F.length("line") >= (min_chars if short_sites is None else 1))
        .select(
            "row", "id", "site", "pos", F.unhex(F.md5("line")).alias("hash"),
            F.when(F.length("line") < min_chars, short_sites).otherwise(min_sites).alias("least"),
        )
    )
    lines = stored(lines)
    spread = lines.groupBy("hash").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites"),
        F.min(F.struct("id", "row", "pos")).alias("first"), F.max("least").alias("least"), (F.count("*") > HOT * lines.count()).alias("hot"),
    )
    margin = F.greatest(F.lit(1.0), 3 * 1.04 / 2 ** (lg_k / 2) * F.col("least"))
    spread = stored(spread.where((F.col("sites") >= F.col("least") - margin) | F.col("hot")))
    hot = spread.where("hot").select("hash")
    spread = spread.where(F.col("sites") >= F.col("least") - margin)
    near = spread.where(F.col("sites") <= F.col("least") + margin)
    exact = (
        _met(lines.select("hash", "site"), near.select("hash", "hot"), hot)
        .select("hash", "site").distinct()
        .groupBy("hash").agg(F.count("site").alias("exact"))
    )
    boilerplate = spread.where(F.col("sites") > F.col("least") + margin).select("hash", "first", "hot").unionByName(
        near.join(exact, "hash").where(F.col("exact") >= F.col("least")).select("hash", "first", "hot")
    )
    # one plan at any size: one that turns at some size can't be foreseen from small runs
    hits = _met(lines, stored(boilerplate), hot)
    if keep_first:
        first = F.col("first")
        hits = hits.where(~((F.col("row") == first["row"]) & F.col("id").eqNullSafe(first["id"]) & (F.col("pos") == first["pos"])))
    gone = hits.groupBy("row", "id").agg(F.array_sort(F.collect_set("pos")).alias("_gone"))
    gone = stored(gone.select(F.col("row").alias("_row"), F.col("id").alias("_id"), "_gone"))
    out = docs.withColumn("_key", key).join(
        gone.hint("merge"), (F.col("_key") == F.col("_row")) & F.col(ident).eqNullSafe(F.col("_id")), "left"
    )
    all_lines = F.split(text, "\n")
    kept = F.when(F.col("_gone").isNull(), text).otherwise(F.array_join(_without(all_lines, F.col("_gone")), "\n"))
    return out.select(
        *[kept.alias(n) if n == text_col else F.col(c).alias(n) for n, c in names.items() if n not in ("_n_lines", "_n_removed")],
        F.coalesce(F.size(all_lines), F.lit(0)).cast("long").alias("_n_lines"),
        F.coalesce(F.when(F.col("_gone").isNotNull(), F.size("_gone")), F.lit(0)).cast("long").alias("_n_removed"),
    )
