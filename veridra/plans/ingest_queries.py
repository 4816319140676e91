"""Queries of ingest and delivery: a paged service, deliveries over time, runs of producers, workbooks, pages, whole builds compared."""

from __future__ import annotations

import io
import zipfile
from bisect import bisect_right
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import accumulate
from typing import Any
from xml.sax.saxutils import escape

import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import resolve as R
from ..operators import sets as X
from ..registry import Tables, query
from ..session import scratch
from ..sources import paged, pages, sheets
from ..streaming import ingest

RECORD = "o_orderkey long, o_custkey long, o_totalprice double"


@dataclass
class Year:
    """Row groups of a year in order of key, the first and last key of each, and how many records stand before it; one more number than groups."""

    groups: list[ds.ParquetFileFragment]
    first: list[int]
    last: list[int]
    before: list[int]


@lru_cache(maxsize=4)
def _years(path: str) -> dict[int, Year]:
    """The row groups below a folder, listed once a process."""
    found: dict[int, list[tuple]] = {}
    for f in ds.dataset(path, partitioning="hive").get_fragments():
        year = ds.get_partition_keys(f.partition_expression)["year"]
        for part in f.split_by_row_group() if year is not None else ():
            (group,) = part.row_groups
            if group.num_rows:
                ends = group.statistics["o_orderkey"]
                found.setdefault(year, []).append((ends["min"], ends["max"], group.num_rows, part))
    out = {}
    for year, groups in found.items():
        groups.sort(key=lambda g: g[:2])
        out[year] = Year([g[3] for g in groups], [g[0] for g in groups], [g[1] for g in groups], [0, *accumulate(g[2] for g in groups)])
    return out


@lru_cache(maxsize=4)
def _group(path: str, year: int, n: int) -> pa.Table:
    """One row group; pages that are asked for one after another share it."""
    return _years(path)[year].groups[n].to_table(columns=["o_orderkey", "o_custkey", "o_totalprice"], use_threads=False)


@dataclass
class Shelf:
    """A service over a folder of records by year, each year's files in order of key. Every fourth page is busy when it is first asked for."""

    path: str
    counts: dict[int, int]
    asked: set = field(default_factory=set)

    def upto(self, year: int, key: int | None) -> int:
        """Records of a year whose key is no greater; only the row group that the key stands in is read."""
        y = _years(self.path).get(year)
        if y is None or key is None:
            return 0 if y is None else y.before[-1]
        n = bisect_right(y.first, key) - 1
        if n < 0 or key >= y.last[n]:
            return y.before[n + 1]
        return y.before[n] + bisect_right(_group(self.path, year, n).column("o_orderkey").to_numpy(), key)

    def count(self, low: int, high: int, after: int | None = None, most: int | None = None) -> int:
        if most is None:
            return sum(n for y, n in self.counts.items() if y is not None and low <= y <= high)
        return sum(self.upto(y, most) - self.upto(y, after) for y in range(low, high + 1))

    def page(self, low: int, high: int, limit: int, offset: int = 0, after: Any = None, most: int | None = None) -> pa.RecordBatch:
        if offset // limit % 4 == 3 and (low, offset) not in self.asked:
            self.asked.add((low, offset))
            raise paged.Busy
        found, years = [], _years(self.path)
        for y in sorted(y for y in years if low <= y <= high):
            start = 0 if after is None else self.upto(y, after)
            end = self.upto(y, most)
            at, end, offset = start + offset, min(end, start + offset + limit), max(0, offset - (end - start))
            limit -= max(0, end - at)
            while at < end:
                n = bisect_right(years[y].before, at) - 1
                part = _group(self.path, y, n).slice(at - years[y].before[n], end - at)
                found.append(part)
                at += part.num_rows
        table = pa.concat_tables(found).combine_chunks() if found else pa.table({"o_orderkey": pa.array([], pa.int64()), "o_custkey": pa.array([], pa.int64()), "o_totalprice": pa.array([], pa.float64())})
        batches = table.to_batches()
        return batches[0] if batches else pa.RecordBatch.from_pylist([], schema=table.schema)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def scan_api_paged(t):
    """Orders behind a service that serves 500 records a page and no more than 15,000 a range of years."""
    rows = t.orders.select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("double").alias("o_totalprice"), F.year("o_orderdate").alias("year"))
    path = scratch(t.spark)
    # small row groups, as a page is a small part of one
    held = rows.repartitionByRange("year", "o_orderkey").sortWithinPartitions("year", "o_orderkey")
    held.write.partitionBy("year").option("parquet.block.size", 1 << 20).parquet(path)
    # one number a year
    counts = {r["year"]: r["n"] for r in rows.groupBy("year").agg(F.count("*").alias("n")).collect()}
    years = [y for y in counts if y is not None]
    ends = rows.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    keys = None if ends[0] is None else (ends[0], ends[1])
    return paged.read_paged(t.spark, Shelf(path, counts), RECORD, "o_orderkey", min(years, default=1990), max(years, default=1990), pause=0.01, keys=keys)


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def scan_checkpointed(t):
    """Orders in three deliveries, the second of which corrects the first; one run between them breaks off and is taken up again."""
    base = scratch(t.spark)
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    third = F.col("o_orderkey") % 3

    def deliver(df: DataFrame) -> None:
        df.write.mode("append").parquet(f"{base}/in")

    def run(fetch=None) -> None:
        ingest.take(t.spark, f"{base}/in", f"{base}/table", f"{base}/checkpoint", schema, ["o_orderkey"], fetch=fetch)

    def broken(_: DataFrame) -> DataFrame:
        raise ConnectionError("the service went away")

    deliver(rows.where(third == 0).withColumn("o_orderstatus", F.lit("?")))
    run()
    deliver(rows.where(third < 2))
    try:
        run(broken)
    except Exception as e:  # the stream wraps what its batch raised
        if "the service went away" not in str(e):
            raise
    deliver(rows.where(third == 2))
    run()
    return ingest.current(t.spark, f"{base}/table", schema, ["o_orderkey"])


@query("""WITH d AS (SELECT p_partkey AS k, p_partkey % 2 = 0 AS a, p_partkey % 3 = 0 AS b, p_partkey % 4 = 0 AS c, p_partkey % 5 = 0 AS e, p_name, p_brand, p_size FROM part),
first AS (SELECT *, CASE WHEN b THEN 'grants' WHEN a THEN 'patents' END AS o1 FROM d), second AS (SELECT *, CASE WHEN o1 = 'patents' AND NOT c THEN NULL ELSE coalesce(o1, CASE WHEN c THEN 'patents' END) END AS o2 FROM first),
last AS (SELECT *, CASE WHEN e AND (o2 IS NULL OR o2 = 'patents') THEN 'bundle' ELSE o2 END AS owner FROM second)
SELECT k, owner, CASE WHEN o2 IS NULL THEN upper(p_name) WHEN o1 IS NULL THEN p_name WHEN a OR c THEN p_name WHEN e THEN upper(p_name) END AS title,
  CASE WHEN o2 = 'grants' THEN p_size WHEN o2 IS NOT NULL THEN NULL END AS year, CASE WHEN e THEN p_brand END AS journal FROM last WHERE owner IS NOT NULL""")
def sink_upsert_coalesce(t):
    """Papers that patents, grants and a bundle deliver in turn: grants take over from patents, the bundle too; patents later cite fewer."""
    k, none = F.col("p_partkey"), F.lit(None)

    def run(every: int, title, year, journal) -> DataFrame:
        return t.part.where(k % every == 0).select(k.alias("k"), title.cast("string").alias("title"), year.cast("int").alias("year"), journal.cast("string").alias("journal"))

    patents, name = lambda n: run(n, F.col("p_name"), none, none), F.upper("p_name")
    runs = [("patents", patents(2)), ("grants", run(3, none, F.col("p_size"), none)), ("patents", patents(4)), ("bundle", run(5, name, none, F.col("p_brand")))]
    return R.merge_owned(runs, "k", {"grants": {"patents"}, "bundle": {"patents"}})


def _workbook(names: list[str], rows: list[list[str]], title: str) -> bytes:
    """A small workbook: a title above the header, every second text shared and the others in place."""
    strings: list[str] = []

    def cell(at: str, v: str) -> str:
        if len(v) % 2:
            return f'<c r="{at}" t="inlineStr"><is><t>{escape(v)}</t></is></c>'
        if v not in strings:
            strings.append(v)
        return f'<c r="{at}" t="s"><v>{strings.index(v)}</v></c>'

    lines = [[title], [], names, *rows]
    body = "".join(f'<row r="{i}">{"".join(cell(f"{chr(65 + j)}{i}", v) for j, v in enumerate(line) if v)}</row>' for i, line in enumerate(lines, 1))
    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    links = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook {space} xmlns:r="{links}"><sheets><sheet name="Notes" sheetId="1" r:id="rId1"/><sheet name="All Data" sheetId="2" r:id="rId2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{links}/worksheet" Target="worksheets/notes.xml"/><Relationship Id="rId2" Type="{links}/worksheet" Target="worksheets/data.xml"/></Relationships>')
        z.writestr("xl/worksheets/notes.xml", f'<worksheet {space}><sheetData/></worksheet>')
        z.writestr("xl/worksheets/data.xml", f"<worksheet {space}><sheetData>{body}</sheetData></worksheet>")
        z.writestr("xl/sharedStrings.xml", f"<sst {space}>{''.join(f'<si><t>{escape(x)}</t></si>' for x in strings)}</sst>")
    return out.getvalue()


def _write_workbooks(rows: DataFrame, by: str, folder: str) -> None:
    """One workbook for each value of a column, each written by the task that has its rows."""
    spark = rows.sparkSession
    names = [c for c in rows.columns if c != by]

    def run(pdf):
        import pandas as pd

        text = pdf[names].fillna("").astype(str).values.tolist()
        return pd.DataFrame([(str(pdf[by].iloc[0]), _workbook(names, text, "A title & notes"))], columns=["name", "content"])

    # Spark has no writer of whole files; a workbook here is a few rows, and they go to the store one by one
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for r in rows.groupBy(by).applyInPandas(run, "name string, content binary").toLocalIterator():
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{r['name']}.xlsx")
        out = path.getFileSystem(conf).create(path, True)
        out.write(r["content"])
        out.close()


@query("SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def scan_excel(t):
    """Nations in one workbook a region, under a title: read back by sheet name and header row."""
    folder = scratch(t.spark)
    rows = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").cast("string").alias("n_nationkey"), "n_name", "r_name", "n_regionkey")
    _write_workbooks(rows, "n_regionkey", folder)
    return sheets.read_sheet(t.spark, f"{folder}/*.xlsx", "All Data", header=2).select("n_nationkey", "n_name", "r_name")


PAGE = f"<!DOCTYPE html><title>Brands</title><script>const rows = {pages.MARK};</script>"


@query("SELECT p_brand, '</script> ' || min(p_name) AS note, CAST(count(*) AS BIGINT) AS parts, CASE WHEN min(p_size) > 1 THEN min(p_size) END AS least FROM part GROUP BY p_brand")
def sink_html_embed(t):
    """A page of the brands, whose notes would end its script; read back out of the page."""
    path = f"{scratch(t.spark)}.html"
    least = F.min("p_size")
    brands = t.part.groupBy("p_brand").agg(F.concat(F.lit("</script> "), F.min("p_name")).alias("note"), F.count("*").alias("parts"), F.when(least > 1, least).alias("least"))
    pages.write_page(brands, PAGE, path, ["p_brand"])
    return pages.read_page(t.spark, path, PAGE, "p_brand string, note string, parts long, least int")


@query("""SELECT 'part' AS tab, 'same' AS verdict, CAST(count(*) AS BIGINT) AS rows_this, CAST(count(*) AS BIGINT) AS rows_other, CAST(0 AS BIGINT) AS only_this, CAST(0 AS BIGINT) AS only_other, '' AS sample_this, '' AS sample_other FROM part
UNION ALL SELECT 'supplier', 'same', count(*), count(*), 0, 0, '', '' FROM supplier UNION ALL SELECT 'region', 'one side only', count(*), 0, count(*), 0, '', '' FROM region UNION ALL SELECT 'nation', 'one side only', 0, count(*), 0, count(*), '', '' FROM nation
UNION ALL SELECT 'customer', 'differs', count(*), count(*) FILTER (WHERE c_custkey % 10 <> 0), count(*) FILTER (WHERE c_custkey % 10 = 0), 0, array_to_string(list_slice(list_sort(list(c_custkey) FILTER (WHERE c_custkey % 10 = 0)), 1, 3), ','), '' FROM customer
UNION ALL SELECT 'orders', 'differs', count(*), count(*) + count(*) FILTER (WHERE o_orderkey % 100 = 7), count(*) FILTER (WHERE o_orderkey % 50 = 1), count(*) FILTER (WHERE o_orderkey % 50 = 1) + count(*) FILTER (WHERE o_orderkey % 100 = 7),
  array_to_string(list_slice(list_sort(list(o_orderkey) FILTER (WHERE o_orderkey % 50 = 1)), 1, 3), ','), array_to_string(list_slice(list_sort(list(o_orderkey) FILTER (WHERE o_orderkey % 50 = 1 OR o_orderkey % 100 = 7)), 1, 3), ',') FROM orders""")
def cmp_builds(t):
    """Two builds of six tables: rows lost, changed and doubled, a table on one side only, and tables that only lie in another order."""
    k = F.col("o_orderkey")
    changed = t.orders.withColumn("o_orderstatus", F.when(k % 50 == 1, "?").otherwise(F.col("o_orderstatus")))
    this = {"part": t.part, "supplier": t.supplier, "customer": t.customer, "orders": t.orders, "region": t.region}
    other = {"part": t.part.orderBy(F.desc("p_partkey")), "supplier": t.supplier.repartition(3), "customer": t.customer.where("c_custkey % 10 <> 0"), "orders": changed.union(t.orders.where(k % 100 == 7)), "nation": t.nation}
    return X.compare_builds(this, other)
