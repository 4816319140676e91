"""Multi-party chat formatting with perspective rotation.

Every participant of a dialogue gets a rendering of it in which that speaker is the
assistant and the others are named users; a mask marks the letters the model learns from.
The rendering is one row a turn with its place in the rendered dialogue, so a dialogue of
any length is never gathered in one row or task: places are running sums, made from sums
over runs of consecutive turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

HEAD, SEP, TAIL = "<|im_start|>", "\n", "<|im_end|>\n"
#: Turns that a run holds, about; runs are the unit of the partial sums.
RUN = 1024


def rotate(
    turns: DataFrame, system: str = "system", conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per dialogue, participant and turn: conv_col, perspective, turn_col, seq,
    chat_role, name, rendered, start, end, mask_start, mask_end, learn.

    Participants are the distinct speakers (role_col) of a dialogue but `system`, whose
    turns keep the role system everywhere. rendered is head, role (with ` name=<speaker>`
    for users), text and tail; start and end are its letters' place in the dialogue's
    rendering, mask_start and mask_end those of the text and the end mark that the assistant learns
    (both equal start for other turns). Turns are ordered by turn number (nulls first),
    speaker and text; repeated turns are kept, in any order among equals. A null speaker is
    the speaker `unknown`, a null text is empty. A dialogue without participants (system
    turns only) gives no rows. Rows with a null dialogue id form one dialogue. Other columns
    are dropped. An empty table gives no rows.
    """
    spark = turns.sparkSession
    t = turns.select(
        F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("unknown")).alias("speaker"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    # consecutive turns of all dialogues, cut where a partition ends: a long dialogue spans several.
    # Rows are numbered in that order; rows that could change places are equal
    order = ["conv", "turn", "speaker", "text"]
    parts = max(spark.sparkContext.defaultParallelism, t.count() // (RUN * 64) + 1)
    t = t.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    t = stored(t.withColumns({"_at": F.monotonically_increasing_id(), "_part": F.spark_partition_id()}))

    def same(a: str, b: str) -> Column:
        return F.col(a).eqNullSafe(F.col(b))

    # from here on lengths only; the texts come in again with the last join
    runs = t.groupBy("conv", "_part").agg(F.count("*").alias("n"), F.min("_at").alias("low"))
    runs = runs.withColumn("seq0", F.sum("n").over(Window.partitionBy("conv").orderBy("_part")) - F.col("n"))
    people = t.where(F.col("speaker") != system).select(F.col("conv").alias("c1"), F.col("speaker").alias("perspective")).distinct()
    # by run, not by dialogue: the turns of a long one meet its people in many tasks
    seats = runs.join(people, same("conv", "c1")).select(F.col("conv").alias("c0"), F.col("_part").alias("p0"), "low", "seq0", "perspective")
    turn = t.select("conv", "_part", "_at", "speaker", F.length("text").alias("letters"))
    seen = turn.join(seats, same("conv", "c0") & (F.col("_part") == F.col("p0"))).drop("c0", "p0")

    def told(speaker: Column, perspective: Column) -> tuple[Column, Column, Column]:
        """Role, name and what stands before the text of a turn."""
        role = F.when(speaker == system, "system").when(speaker == perspective, "assistant").otherwise("user")
        name = F.when(role == "user", speaker)
        return role, name, F.concat(F.lit(HEAD), role, F.coalesce(F.concat(F.lit(" name="), name), F.lit("")), F.lit(SEP))

    size = F.length(told(F.col("speaker"), F.col("perspective"))[2]) + F.col("letters") + len(TAIL)
    seen = seen.select("conv", "_part", "_at", "perspective", (F.col("seq0") + F.col("_at") - F.col("low")).cast("long").alias("seq"), size.cast("long").alias("size"))
    sums = seen.groupBy("conv", "perspective", "_part").agg(F.sum("size").alias("s"))
    starts = sums.withColumn(
        "start0", F.sum("s").over(Window.partitionBy("conv", "perspective").orderBy("_part")) - F.col("s")
    ).select(F.col("conv").alias("c2"), F.col("perspective").alias("v2"), F.col("_part").alias("p2"), "start0")
    run = Window.partitionBy("conv", "perspective", "_part").orderBy("seq")
    placed = seen.withColumn("_upto", F.sum("size").over(run)).join(
        starts, same("conv", "c2") & (F.col("perspective") == F.col("v2")) & (F.col("_part") == F.col("p2"))
    )
    end = F.col("start0") + F.col("_upto")
    placed = placed.select(F.col("_at").alias("_of"), "perspective", "seq", (end - F.col("size")).cast("long").alias("start"), end.cast("long").alias("end"))
    out = t.join(placed, F.col("_at") == F.col("_of"))
    role, name, prefix = told(F.col("speaker"), F.col("perspective"))
    learn = role == "assistant"

    def masked(at: Column) -> Column:
        return F.when(learn, at).otherwise(F.col("start")).cast("long")

    return out.select(
        F.col("conv").alias(conv_col), "perspective", F.col("turn").alias(turn_col), "seq", role.alias("chat_role"), name.alias("name"),
        F.concat(prefix, "text", F.lit(TAIL)).alias("rendered"), "start", "end", masked(F.col("start") + F.length(prefix)).alias("mask_start"),
        masked(F.col("end") - 1).alias("mask_end"), learn.alias("learn"),
    )
