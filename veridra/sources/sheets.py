"""Workbooks: sheets read from the archive's XML, all values as text.

A workbook is an archive; its members are rows of a table, so several workbooks, and the strings
and the sheet of one, are read by different tasks. Cells that name a shared string by number are
joined to the strings. Cells are streamed out of the XML and never held as a tree.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
CELLS_A_BATCH = 50_000


def column_number(reference: str) -> int:
    """The number, from 0, of the column that a cell reference begins with: A1 is 0, AB7 is 27."""
    n = 0
    for c in re.match(r"[A-Z]+", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _member(book: zipfile.ZipFile, sheet: str) -> str:
    """The archive member of a sheet."""
    ids = {s.get("name"): s.get(LINK) for s in ElementTree.parse(book.open("xl/workbook.xml")).iter(f"{MAIN}sheet")}
    targets = {r.get("Id"): r.get("Target") for r in ElementTree.parse(book.open("xl/_rels/workbook.xml.rels")).getroot()}
    if sheet not in ids:
        raise ValueError(f"no sheet {sheet!r}; there are {sorted(ids)}")
    target = targets[ids[sheet]]
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _text(element) -> str:
    """All text of an element's runs, but no phonetic guides."""
    return "".join(t.text or "" for child in element if child.tag != f"{MAIN}rPh" for t in child.iter(f"{MAIN}t")) or "".join(t.text or "" for t in element.findall(f"{MAIN}t"))


def _strings(book: zipfile.ZipFile) -> Iterator[tuple]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return
    n = 0
    for _, e in ElementTree.iterparse(book.open("xl/sharedStrings.xml")):
        if e.tag == f"{MAIN}si":
            yield n, _text(e)
            n += 1
            e.clear()


def _cells(book: zipfile.ZipFile, sheet: str) -> Iterator[tuple]:
    """(row from 0, column from 0, kind, value) of every cell that is not blank; kind is `shared` or `text`."""
    for _, row in ElementTree.iterparse(book.open(_member(book, sheet))):
        if row.tag != f"{MAIN}row":
            continue
        for c in row.iter(f"{MAIN}c"):
            inline, value = c.find(f"{MAIN}is"), c.find(f"{MAIN}v")
            text = _text(inline) if inline is not None else value.text if value is not None else None
            if text:
                kind = "shared" if c.get("t") == "s" else "text"
                shown = {"1": "TRUE", "0": "FALSE"}.get(text, text) if c.get("t") == "b" else text
                yield int(row.get("r")) - 1, column_number(c.get("r")), kind, shown
        row.clear()


def read_sheet(spark: SparkSession, path: str, sheet: str, header: int = 0) -> DataFrame:
    """One row for each row of a sheet below row number `header` (from 0), which names the columns; `_file`, `_row` and text columns.

    Blank cells are empty text; rows without any value are left out, and so are columns without a name. path
    may name several workbooks of the same columns. Names that repeat get a number.
    """
    books = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")

    def parts(of):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for file, content in zip(pdf["file"], pdf["content"], strict=True):
                    some = []
                    with zipfile.ZipFile(io.BytesIO(content)) as book:
                        for x in of(book):
                            some.append((file, *x))
                            if len(some) == CELLS_A_BATCH:
                                yield pd.DataFrame(some)
                                some = []
                    if some:
                        yield pd.DataFrame(some)

        return run

    strings = books.mapInPandas(parts(_strings), "file string, no long, string string")
    cells = books.mapInPandas(parts(lambda book: _cells(book, sheet)), "file string, row long, col int, kind string, value string")
    number = F.when(F.col("kind") == "shared", F.col("value").cast("long"))
    named = strings.select(F.col("file").alias("_f"), "no", "string")
    cells = cells.join(named, (F.col("file") == F.col("_f")) & (number == F.col("no")), "left").select("file", "row", "col", F.coalesce("string", F.when(F.col("kind") == "text", F.col("value")), F.lit("")).alias("value"))
    # as many names as the sheet has columns
    names: dict[int, str] = {}
    for r in cells.where(F.col("row") == header).groupBy("col").agg(F.min("value").alias("value")).orderBy("col").collect():
        taken = sum(n == r["value"] or re.fullmatch(re.escape(r["value"]) + r"_\d+", n) is not None for n in names.values())
        names[r["col"]] = r["value"] if not taken else f"{r['value']}_{taken + 1}"
    below = cells.where((F.col("row") > header) & F.col("col").isin(list(names)))
    pick = [F.coalesce(F.max(F.when(F.col("col") == c, F.col("value"))), F.lit("")).alias(n) for c, n in names.items()]
    return below.groupBy(F.col("file").alias("_file"), F.col("row").alias("_row")).agg(F.lit(0).alias("_"), *pick).drop("_")
