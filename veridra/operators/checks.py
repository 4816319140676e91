"""Quality checks of many tables in one pass: each table is scanned once, and all keys meet in one shuffle.

A row states what it is evidence of: that a row check fails, that a key is defined in a domain, or
that a key is used there. What is stated is counted by (check, key) where the rows are, and merged
once. So thirty checks cost what the largest of them would: no join, no second scan. A domain is a
check of its own, so no two checks share a group; a key that a third of all rows use is one row a task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """A check by name and severity (error, warning, info)."""

    name: str
    severity: str


@dataclass(frozen=True)
class Rows(Check):
    """Rows of a table for which a condition holds are bad."""

    table: str
    bad: str


@dataclass(frozen=True)
class Unique(Check):
    """Keys that more than one row of a table has are bad, once each. A null is a key like any other.

    `digest`: long texts are told apart by their MD5, so that they need not travel.
    """

    table: str
    key: tuple[str, ...]
    digest: bool = False


@dataclass(frozen=True)
class Orphans(Check):
    """Rows of a table whose key no row of another has are bad; a null key is an orphan unless `nulls` lets it pass."""

    table: str
    key: str
    parent: str
    parent_key: str
    nulls: bool = False


@dataclass(frozen=True)
class Childless(Check):
    """Rows of a table whose key no row of another uses are bad."""

    table: str
    key: str
    child: str
    child_key: str


def _key(*columns: str) -> Column:
    """A key as text: of one column its value, of several all, told apart from each other and from nulls."""
    return F.col(columns[0]).cast("string") if len(columns) == 1 else F.to_json(F.struct(*columns))


def evidence(checks: Sequence[Check]) -> dict[str, list[tuple[int, Column, str, Column]]]:
    """By table: (number of the check, key, role, condition) of what its rows state."""
    out: dict[str, list[tuple[int, Column, str, Column]]] = {}

    def add(table: str, at: int, key: Column, role: str, where: Column) -> None:
        out.setdefault(table, []).append((at, key, role, where))

    always = F.lit(True)
    for at, c in enumerate(checks):
        if isinstance(c, Rows):
            add(c.table, at, F.lit(None).cast("string"), "bad", F.coalesce(F.expr(c.bad), F.lit(False)))
        elif isinstance(c, Unique):
            add(c.table, at, F.md5(_key(*c.key)) if c.digest else _key(*c.key), "uses", always)
        elif isinstance(c, Orphans):
            add(c.table, at, _key(c.key), "uses", F.col(c.key).isNotNull() if c.nulls else always)
            add(c.parent, at, _key(c.parent_key), "defines", F.col(c.parent_key).isNotNull())
        elif isinstance(c, Childless):
            add(c.table, at, _key(c.key), "uses", always)
            add(c.child, at, _key(c.child_key), "defines", F.col(c.child_key).isNotNull())
        else:
            raise TypeError(f"no such check: {c}")
    return out


def report(tables: Callable[[str], DataFrame], checks: Sequence[Check]) -> DataFrame:
    """(check, severity, n, passed): the number of bad rows (or keys, for Unique) of every check."""
    stated = []
    for table, some in evidence(checks).items():
        one = F.lit(1).cast("long")
        rows = [
            F.when(where, F.struct(F.lit(at).alias("at"), key.alias("key"), (one if role != "defines" else one - 1).alias("uses"), (one if role == "defines" else one - 1).alias("defines")))
            for at, key, role, where in some
        ]
        stated.append(tables(table).select(F.inline(F.array_compact(F.array(*rows)))))
    merged = reduce(DataFrame.unionByName, stated).groupBy("at", "key").agg(F.sum("uses").alias("uses"), F.sum("defines").alias("defines"))
    unique = F.col("at").isin(*[i for i, c in enumerate(checks) if isinstance(c, Unique)])
    rows = F.col("at").isin(*[i for i, c in enumerate(checks) if isinstance(c, Rows)])
    # a key that is defined once a distinct row at least has no orphans; a null is never defined
    bad = F.when(unique, (F.col("uses") > 1).cast("long")).when(rows | (F.col("defines") == 0), F.col("uses")).otherwise(0)
    counted = merged.groupBy("at").agg(F.sum(bad).alias("n"))
    named = tables(checks[0].table).sparkSession.createDataFrame([(i, c.name, c.severity) for i, c in enumerate(checks)], "at int, check string, severity string")
    n = F.coalesce("n", F.lit(0)).cast("long")
    return named.join(counted, "at", "left").select("check", "severity", n.alias("n"), (n == 0).alias("passed"))


def sql(check: Check) -> str:
    """Plain SQL that counts the bad rows of a check, as a second opinion."""
    if isinstance(check, Rows):
        return f"SELECT count(*) FROM {check.table} WHERE {check.bad}"
    if isinstance(check, Unique):
        return f"SELECT count(*) FROM (SELECT 1 FROM {check.table} GROUP BY {', '.join(check.key)} HAVING count(*) > 1)"
    if isinstance(check, Orphans):
        nulls = f" AND {check.key} IS NOT NULL" if check.nulls else ""
        return f"SELECT count(*) FROM {check.table} c WHERE NOT EXISTS (SELECT 1 FROM {check.parent} p WHERE p.{check.parent_key} = c.{check.key}){nulls}"
    return f"SELECT count(*) FROM {check.table} p WHERE NOT EXISTS (SELECT 1 FROM {check.child} c WHERE c.{check.child_key} = p.{check.key})"
