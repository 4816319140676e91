"""Paged reading, incremental ingest, owned rows, workbooks and pages."""

import io
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from veridra.operators import resolve, sets
from veridra.plans.ingest_queries import _workbook
from veridra.sources import paged, pages, sheets
from veridra.streaming import ingest


def memory(rows, window, fails=0):
    """A service over a list of (year, id); of a class that is sent whole, as workers don't import tests."""

    class Memory:
        def __init__(self):
            self.rows, self.fails = sorted(rows), fails

        def count(self, low, high):
            return sum(low <= y <= high for y, _ in self.rows)

        def page(self, low, high, limit, offset=0, after=None):
            if self.fails:
                self.fails -= 1
                raise paged.Busy
            if offset + limit > window and after is None and low != high:
                raise AssertionError("beyond the window")
            mine = [r for r in self.rows if low <= r[0] <= high and (after is None or r[1] > after)]
            return pa.RecordBatch.from_pylist([{"id": i, "year": y} for y, i in mine[offset : offset + limit]], pa.schema({"id": pa.int64(), "year": pa.int64()}))

    return Memory()


ROWS = [(2000 + i % 5, i) for i in range(200)] + [(2007, 1000 + i) for i in range(130)]


def test_pages_hold_every_record_once(spark):
    for window, size in ((1000, 7), (100, 10), (40, 10)):
        got = paged.read_paged(spark, memory(ROWS, window), "id long, year long", "id", 1990, 2010, size=size, window=window, pause=0.0)
        assert sorted((r["year"], r["id"]) for r in got.collect()) == sorted(ROWS)
    parts = paged.plan(memory(ROWS, 40), 1990, 2010, 10, 40)
    assert [p for p in parts if p.offset is None] == [paged.Page(2007, 2007, 10, None)]
    assert paged.read_paged(spark, memory([], 40), "id long, year long", "id", 1990, 2010).collect() == []


def test_a_busy_service_is_asked_again():
    service = memory(ROWS, 1000, fails=3)
    assert paged.patiently(lambda: service.page(2007, 2007, 5), 5, 0.0).num_rows == 5
    service.fails = 3
    with pytest.raises(paged.Busy):
        paged.patiently(lambda: service.page(2007, 2007, 5), 3, 0.0)


SCHEMA = "id long, v string"


def rows(df):
    return sorted((r["id"], r["v"]) for r in df.collect())


def test_a_restart_takes_only_what_is_new(spark, tmp_path):
    src, table, check = (f"{tmp_path}/{n}" for n in ("in", "table", "checkpoint"))
    seen = []

    def deliver(*some):
        spark.createDataFrame(some, SCHEMA).coalesce(1).write.mode("append").parquet(src)

    def run(**how):
        ingest.take(spark, src, table, check, SCHEMA, ["id"], fetch=lambda df: (seen.append(df.count()), df)[1], **how)

    assert ingest.current(spark, table, SCHEMA, ["id"]).collect() == []
    deliver((1, "a"), (2, "b"), (None, "x"))
    run()
    run()
    assert seen == [2] and rows(ingest.current(spark, table, SCHEMA, ["id"])) == [(1, "a"), (2, "b")]
    deliver((2, "B"), (3, "c"))
    # the driver dies after the batch was written and before it was committed
    swap = ingest._swap

    def dying(*a):
        swap(*a)
        raise RuntimeError("killed")

    ingest._swap = dying
    try:
        with pytest.raises(Exception, match="killed"):
            run()
    finally:
        ingest._swap = swap
    assert rows(ingest.batches(spark, table, SCHEMA)) == [(1, "a"), (2, "B"), (2, "b"), (3, "c")]
    run()
    assert rows(ingest.batches(spark, table, SCHEMA)) == [(1, "a"), (2, "B"), (2, "b"), (3, "c")] and seen == [2, 2, 2]
    assert rows(ingest.current(spark, table, SCHEMA, ["id"])) == [(1, "a"), (2, "B"), (3, "c")]
    ingest.fold(spark, table, SCHEMA, ["id"])
    assert rows(ingest.batches(spark, table, SCHEMA)) == [(1, "a"), (2, "B"), (3, "c")]
    deliver((3, "again"), (4, "d"), (4, "d"))
    run(skip_known=True)
    assert seen[-1] == 1 and rows(ingest.current(spark, table, SCHEMA, ["id"])) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]


def test_owned_rows(spark):
    def run(*some):
        return spark.createDataFrame(some, "k int, a string, b int")

    runs = [
        ("low", run((1, None, 1), (2, "x", None), (3, "y", 3), (None, "z", 0))), ("high", run((1, "h", 9), (4, "h", None))),
        ("low", run((1, "late", None), (3, "new", None))), ("high", run((3, None, 8))), ("low", run((2, "back", 2), (2, "back", 2), (4, None, 4))),
    ]
    got = sorted(tuple(r) for r in resolve.merge_owned(runs, "k", {"high": {"low"}}).collect())
    # 1 was taken over and then dropped by its new owner; 2 came back; 3 was handed over; 4 went with its owner and came from the other
    assert got == [(2, "low", "back", 2), (3, "high", "y", 3), (4, "low", None, 4)]


def test_builds_are_compared_as_multisets(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(3, "z"), (1, "x"), (2, None), (5, "n")], "k int, v string")
    got = {r["tab"]: tuple(r)[1:] for r in sets.compare_builds({"t": a, "u": a, "e": a.limit(0), "gone": b}, {"t": b, "u": a.orderBy("k"), "e": a.limit(0)}, leaves=4).collect()}
    assert got == {"t": ("differs", 4, 4, 1, 1, "1", "5"), "u": ("same", 4, 4, 0, 0, "", ""), "e": ("same", 0, 0, 0, 0, "", ""), "gone": ("one side only", 4, 0, 4, 0, "", "")}


def test_sheets(spark, tmp_path):
    names = ["id", "name", "name", "", "long one"]
    lines = [["1", "a & b", "", "lost", "é"], ["", "", "", "", ""], ["2", "same", "same", "", " x "]]
    for n in ("p", "q"):
        (tmp_path / f"{n}.xlsx").write_bytes(_workbook(names, lines, "title"))
    got = sheets.read_sheet(spark, f"{tmp_path}/*.xlsx", "All Data", header=2)
    assert got.columns == ["_file", "_row", "id", "name", "name_2", "long one"]
    assert sorted(tuple(r)[2:] for r in got.collect()) == [("1", "a & b", "", "é")] * 2 + [("2", "same", "same", " x ")] * 2
    assert sheets.read_sheet(spark, f"{tmp_path}/p.xlsx", "Notes").collect() == []
    with pytest.raises(Exception, match="no sheet"):
        sheets.read_sheet(spark, f"{tmp_path}/p.xlsx", "Else").collect()
    assert sheets.column_number("A1") == 0 and sheets.column_number("AB7") == 27
    with zipfile.ZipFile(io.BytesIO(_workbook(["n"], [["1"]], "t"))) as book:
        assert [c[3] for c in sheets._cells(book, "All Data")] == ["t", "n", "1"]


def test_pages(spark, tmp_path):
    page, path = f"<p>Ä</p><script>x = {pages.MARK}</script>", f"{tmp_path}/page.html"
    df = spark.createDataFrame([(2, "</script><b>"), (1, 'q" \n</'), (3, None)], "i int, s string")
    size = pages.write_page(df, page, path, ["i"])
    text = (tmp_path / "page.html").read_text(encoding="utf-8")
    assert len(text.encode()) <= size and text.count("</script>") == 1 and " " not in text and text.index('"i":1') < text.index('"i":2')
    back = pages.read_page(spark, path, page, "i int, s string")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    pages.write_page(df.limit(0), page, path, ["i"])
    assert pages.read_page(spark, path, page, "i int, s string").collect() == []
    with pytest.raises(ValueError, match="more than 50"):
        pages.write_page(df, page, path, ["i"], most_bytes=50)
    with pytest.raises(ValueError, match="needs one"):
        pages.write_page(df, "<p>", path, ["i"])
