import datetime as dt

import pytest
from pyspark.sql import functions as F

from veridra.functions import scalars as S


def values(spark, fn, cases):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_safe_date(spark):
    cases = ["2014-08-01", "12-Oct-2014", "2014", "2014-08", "2008-09-26T00:00:00", "2008-09-26T00:00:00.000Z", "2014-02-30", ""]
    assert values(spark, S.safe_date, cases) == [dt.date(2014, 8, 1), dt.date(2014, 10, 12), None, None, dt.date(2008, 9, 26), dt.date(2008, 9, 26), None, None]


def test_safe_year_and_int(spark):
    assert values(spark, S.safe_year, ["2014", "2014-08", "2014-2015", "", "12-Oct-2014"]) == [2014, 2014, None, None, 2014]
    assert values(spark, S.safe_int, ["inf", "1e400", "3.0", " -2.5 ", "x"]) == [None, None, 3, -2, None]


def test_clean_text(spark):
    cases = ["Changes in &#946;-cells &gt; 3", "524 \x13 539", "KÃ¼ttner G, HÃ¶hne W", "good text", "  "]
    assert values(spark, S.clean_text, cases) == ["Changes in β-cells > 3", "524 – 539", "Küttner G, Höhne W", "good text", None]


def test_identifiers(spark):
    assert values(spark, S.base_accession, ["KM034562.1", "KM034562"]) == ["KM034562", "KM034562"]
    assert values(spark, S.normalize_document_id, ["US20180291088A1", "US 20180291088 A1", "other "]) == ["US 20180291088 A1"] * 2 + ["other"]
    assert values(spark, S.family_id, ["78828615.0", "7"]) == ["78828615", "7"]


def test_award_keys_keep_task_orders_apart(spark):
    rows = [("R01AI123456", "5R01AI123456-01", "R01"), ("26120150000", "261201500003I-0-26100013-1", "N01"), ("26120150000", "261201500003I-0-26100033-1", "N01")]
    df = spark.createDataFrame(rows, "c string, p string, a string")
    got = [r[0] for r in df.select(S.award_key(F.col("c"), F.col("p"), F.col("a"))).collect()]
    assert got == ["R01AI123456", "261201500003I-0-26100013", "261201500003I-0-26100033"]


def test_symptoms_report_unknown_fragments(spark):
    index = {"fever": "Fever", "high fever": "Fever", "diarrhorea": "Diarrhea"}
    df = spark.createDataFrame([("Fever, severe diarrhorea and odd thing",)], "v string")
    found, rest = S.parse_phrases(F.col("v"), index, ("severe",))
    assert list(df.select(found, rest).first()) == [["Fever", "Diarrhea"], ["odd thing"]]


@pytest.mark.parametrize("raw, want", [(["A b!", "a  B", "", "Unnamed: 3"], ["a_b", "a_b_2", "col", "unnamed_3"])])
def test_clean_columns(raw, want):
    assert S.clean_columns(raw) == want


def test_neutralizing(spark):
    assert values(spark, S.parse_neutralizing, ["yes (Mayinga)", "partial", "_", "no"]) == [True, None, None, False]
