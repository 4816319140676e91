"""Nodes and edges from a list of projections: each table is scanned once, however many it is the source of.

Where edges repeat, the pairs of keys that seldom do are one scan and those that often do another.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Node:
    """Rows of a table that are nodes of a label. `repeats`: several rows may be one node."""

    label: str
    table: str
    key: str
    name: str
    where: str | None = None
    repeats: bool = False


@dataclass(frozen=True)
class Edge:
    """Rows of a table that link two nodes, each a label and the column of its key. `repeats`: several rows may be one edge.

    `seldom`: few rows are an edge that another row is, so that a task would hold all its rows to find them; they are told apart after the shuffle alone.
    """

    type: str
    table: str
    src: tuple[str, str]
    dst: tuple[str, str]
    where: str | None = None
    repeats: bool = False
    seldom: bool = False


def ident(label: str, key: str) -> Column:
    """The id of a node: its label and key; null where the key is."""
    return F.concat(F.lit(f"{label}:"), F.col(key).cast("string"))


def _by_table(specs: Sequence[Node] | Sequence[Edge]) -> dict[str, list]:
    out: dict[str, list] = {}
    for s in specs:
        out.setdefault(s.table, []).append(s)
    return out


def _inlined(df: DataFrame, specs: Sequence[Node] | Sequence[Edge], made: Callable, key: list[str]) -> DataFrame:
    """A row for each spec that holds for a row of df."""
    each = []
    for s in specs:
        row, there = made(s)
        each.append(F.when(there & (F.expr(s.where) if s.where else F.lit(True)), row))
    # nulls are left out after `inline`: array_compact would keep Spark from compiling the array
    return df.select(F.inline(F.array(*each))).where(F.col(key[0]).isNotNull())


def _merged(df: DataFrame, key: list[str]) -> DataFrame:
    """Each key once, the other columns the smallest of its rows."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(*[F.min(c).alias(c) for c in rest]).select(*df.columns) if rest else df.distinct()


def _united(parts: list[DataFrame], kind: str, kinds: list[str], key: list[str]) -> DataFrame:
    """All parts; a label or type of several specs may still repeat."""
    out = reduce(DataFrame.unionByName, parts)
    shared = sorted(k for k, n in Counter(kinds).items() if n > 1)
    if not shared:
        return out
    among = F.col(kind).isin(*shared)
    return out.where(~among).unionByName(_merged(out.where(among), key))


def nodes(tables: Callable[[str], DataFrame], specs: Sequence[Node]) -> DataFrame:
    """(id, label, name) of all specs; rows without a key are none. Of rows that are one node the smallest name counts."""

    def made(s: Node) -> tuple[Column, Column]:
        return F.struct(ident(s.label, s.key).alias("id"), F.lit(s.label).alias("label"), F.col(s.name).cast("string").alias("name")), F.col(s.key).isNotNull()

    key, parts = ["id", "label"], []
    for table, some in _by_table(specs).items():
        part = _inlined(tables(table), some, made, key)
        parts.append(_merged(part, key) if any(s.repeats for s in some) else part)
    return _united(parts, "label", [s.label for s in specs], key)


#: Types between the same two columns that travel as bits of one number.
BITS = 62


def _bare(df: DataFrame, columns: list[str]) -> str:
    """The type that keys of some columns have in common: whole numbers, or the texts that they are in ids."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    return "bigint" if all(isinstance(df.select(c).schema[0].dataType, whole) for c in columns) else "string"


def _pairs(specs: Sequence[Edge]) -> list[list[Edge]]:
    """Specs between the same two columns, in groups of at most BITS types."""
    by_pair: dict[tuple, list[Edge]] = {}
    for s in specs:
        by_pair.setdefault((s.src, s.dst), []).append(s)
    return [x[i : i + BITS] for x in by_pair.values() for i in range(0, len(x), BITS)]


def _once(df: DataFrame, pairs: list[list[Edge]], combine: bool) -> DataFrame:
    """(src, dst, type) of some pairs of keys, each once: bare keys are shuffled, with their types as bits, and ids are made of what is left.

    `combine`: a task puts its own repeats together before the shuffle. It holds its distinct rows then, so it is for pairs that often repeat.
    """
    first, second = (_bare(df, [end(x[0])[1] for x in pairs]) for end in (lambda s: s.src, lambda s: s.dst))

    def bits(specs: list[Edge]) -> Column:
        held = [F.when(F.expr(s.where), F.lit(1 << k)).otherwise(F.lit(0)) if s.where else F.lit(1 << k) for k, s in enumerate(specs)]
        return reduce(Column.__add__, [x.cast("bigint") for x in held])

    each = [
        F.struct(F.lit(i).alias("pair"), F.col(x[0].src[1]).cast(first).alias("a"), F.col(x[0].dst[1]).cast(second).alias("b"), bits(x).alias("types"))
        for i, x in enumerate(pairs)
    ]
    rows = df.select(F.inline(F.array(*each))).where("a IS NOT NULL AND b IS NOT NULL AND types <> 0")
    key = ["pair", "a", "b"]
    found = (rows if combine else rows.repartition(*key)).groupBy(*key).agg(F.bit_or("types").alias("types"))

    def of_pair(values: list[str | None]) -> Column:
        return F.array(*[F.lit(v).cast("string") for v in values])[F.col("pair")]

    slots = [
        F.when(F.col("types").bitwiseAND(F.lit(1 << k)) != 0, of_pair([x[k].type if k < len(x) else None for x in pairs]))
        for k in range(max(map(len, pairs)))
    ]
    src = F.concat(of_pair([f"{x[0].src[0]}:" for x in pairs]), F.col("a").cast("string"))
    dst = F.concat(of_pair([f"{x[0].dst[0]}:" for x in pairs]), F.col("b").cast("string"))
    return found.select(src.alias("src"), dst.alias("dst"), F.explode(F.array(*slots)).alias("type")).where("type IS NOT NULL")


def edges(tables: Callable[[str], DataFrame], specs: Sequence[Edge], once: bool = True) -> DataFrame:
    """(src, dst, type) of all specs, each edge once unless repeats do not matter; rows without one of the keys are none."""

    def made(s: Edge) -> tuple[Column, Column]:
        row = F.struct(ident(*s.src).alias("src"), ident(*s.dst).alias("dst"), F.lit(s.type).alias("type"))
        return row, F.col(s.src[1]).isNotNull() & F.col(s.dst[1]).isNotNull()

    key, parts = ["src", "dst", "type"], []
    for table, some in _by_table(specs).items():
        df = tables(table)
        if not once or not any(s.repeats for s in some):
            parts.append(_inlined(df, some, made, key))
            continue
        often = {(s.src, s.dst) for s in some if s.repeats and not s.seldom}
        for combine in (False, True):
            if pairs := _pairs([s for s in some if ((s.src, s.dst) in often) == combine]):
                parts.append(_once(df, pairs, combine))
    return _united(parts, "type", [s.type for s in specs] if once else [], key)
