"""Reading vectors: which take part, and blocks of them as matrices."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id long, vec) of rows with an id and a vector that is not empty, not zero, and without
    null or non-finite components; vec is array<float> if it was, else array<double>."""
    vec = F.col(f"`{vec_col}`")
    if df.schema[vec_col].dataType.simpleString() != "array<float>":
        vec = vec.cast("array<double>")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        df.select(F.col(f"`{id_col}`").cast("long").alias("id"), vec.alias("vec"))
        .where(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0))
        .where(~bad & F.exists("vec", lambda x: x != 0.0))
    )


def matrix(column) -> np.ndarray:
    """Rows of an Arrow list column as a matrix of doubles (all of one length)."""
    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


def finite(df: DataFrame, id_col: str, vec_col: str, *others: str) -> DataFrame:
    """(id, vec, others) of rows whose vector is not null or empty and has no null or non-finite
    component; zero vectors and null ids stay. vec is array<float> if it was, else array<double>."""
    vec = F.col(f"`{vec_col}`")
    if df.schema[vec_col].dataType.simpleString() != "array<float>":
        vec = vec.cast("array<double>")
    rows = df.select(F.col(f"`{id_col}`").alias("id"), vec.alias("vec"), *(F.col(f"`{c}`").alias(n) for n, c in zip("abc", others, strict=False)))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("vec").isNotNull() & (F.size("vec") > 0) & ~bad)


def most_common_size(rows: DataFrame) -> tuple[int, int]:
    """(length of a vector, rows of it): the length that most rows have, the longer on ties; (0, 0) of no rows."""
    top = rows.groupBy(F.size("vec").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    return (top["size"], top["n"]) if top else (0, 0)
