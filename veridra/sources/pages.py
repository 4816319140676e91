"""Rows inside a page: JSON that a browser can read, in order, of a size that is checked first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "/*rows*/"


def write_page(df: DataFrame, template: str, path: str, order: list[str], most_bytes: int = 50_000_000) -> int:
    """Write a page: the template with df's rows, as a JSON array in order, in the place of its mark; returns the page's bytes.

    `</` is escaped, so that no value ends the script that it stands in; so are the two line ends that JSON allows
    and scripts do not. A page of more than most_bytes is an error before anything is written. Rows come partition
    by partition, so the driver holds one at a time.
    """
    if template.count(MARK) != 1:
        raise ValueError(f"the page needs one {MARK}")
    text = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    for bad, good in (("</", "<\\/"), ("\u2028", "\\u2028"), ("\u2029", "\\u2029")):
        text = F.replace(text, F.lit(bad), F.lit(good))
    rows = df.orderBy(*order).select(text.alias("row"))
    head, tail = template.split(MARK)
    size = rows.agg(F.coalesce(F.sum(F.octet_length("row") + 1), F.lit(0))).first()[0] + len(template.encode())
    if size > most_bytes:
        raise ValueError(f"the page would have {size} bytes, more than {most_bytes}")
    spark = df.sparkSession
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place, True)
    try:
        out.write(bytearray((head + "[").encode()))
        for n, r in enumerate(rows.toLocalIterator()):
            out.write(bytearray(f"{',' if n else ''}{r['row']}".encode()))
        out.write(bytearray(("]" + tail).encode()))
    finally:
        out.close()
    return size


def read_page(spark: SparkSession, path: str, template: str, schema: str) -> DataFrame:
    """The rows of a page that was made from a template."""
    head, tail = template.split(MARK)
    page = spark.read.text(path, wholetext=True)
    rows = F.substring("value", len(head) + 1, 2**31 - 1)
    rows = F.substr(rows, F.lit(1), F.length(rows) - len(tail))
    return page.select(F.explode(F.from_json(rows, f"array<struct<{schema}>>")).alias("r")).select("r.*")
