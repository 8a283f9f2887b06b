"""Inputs as users have them, and runs away from the repository."""

import datetime as dt
import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from fundloom import session
from fundloom.functions import text
from fundloom.operators import scoring
from fundloom.sources import factors, filings, readers

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_spread_of_a_row_with_a_missing_prediction(spark):
    df = spark.createDataFrame([(0.1, None), (0.1, 0.3)], "a double, b double")
    got = [tuple(r)[2:] for r in scoring.prediction_spread(df, ["a", "b"]).orderBy("b").collect()]
    assert got[0] == (None, None, None)
    assert got[1] == (pytest.approx(0.1), 0.1, 0.3)


@pytest.mark.parametrize("indent", [None, 2])
def test_json_arrays_in_any_layout(spark, tmp_path, indent):
    path = tmp_path / "funds.json"
    path.write_text("\n" + json.dumps([{"id": "a", "x": 1.5}, {"id": "b", "x": None}], indent=indent))
    rows = readers.scan_by_extension(spark, str(path), "id string, x double").collect()
    assert [(r.id, r.x) for r in rows] == [("a", 1.5), ("b", None)]
    path.write_text('{"id": "a", "x": 1.5}\n{"id": "b"}\n')
    assert readers.scan_by_extension(spark, str(path)).count() == 2


def test_csv_without_schema_is_typed(spark, tmp_path):
    path = tmp_path / "funds.csv"
    path.write_text("id,x,n\na,1.5,3\nb,,4\n")
    assert [t for _, t in readers.scan_by_extension(spark, str(path)).dtypes] == ["string", "double", "int"]


def test_prose_that_names_a_factor_is_no_header(spark, tmp_path):
    path = tmp_path / "mom.txt"
    path.write_text("The Momentum factor (Mom), monthly\n\n,Mom\n199601, 1.25\n199602, -0.5\n")
    rows = factors.scan_factor_text(spark, str(path), ["MOM"]).orderBy("month_end").collect()
    assert [(r.month_end, r.MOM) for r in rows] == [(dt.date(1996, 1, 31), 1.25), (dt.date(1996, 2, 29), -0.5)]
    with pytest.raises(Exception, match="no column SMB"):
        factors.scan_factor_text(spark, str(path), ["MOM", "SMB"]).collect()


MONTH = "<MonthlyTotalReturn1>0.5</MonthlyTotalReturn1>"
WRAPPED = (
    '<?xml version="1.0"?><!-- a comment --><Filing><Head><ReportPeriod>2024-03-31</ReportPeriod></Head><Funds><Wrapper>'
    f"<Series><Class kind='a'><ClassId>A</ClassId>{MONTH}</Class></Series></Wrapper>"
    f"<Class><ClassId>B</ClassId>{MONTH}</Class></Funds></Filing>"
)


def test_elements_at_any_depth_and_unreadable_filings(spark):
    bodies = [WRAPPED, WRAPPED.replace("</Wrapper>", ""), "<NPORT-P/>"]
    docs = spark.createDataFrame(list(enumerate(bodies)), "doc_id int, body string")
    rows = filings.scan_filings_xml_elements(docs).collect()
    assert sorted((r.doc_id, r.class_id, str(r.month_end)) for r in rows) == [
        (0, "A", "2024-02-29"), (0, "B", "2024-02-29"),
    ]
    assert [r.doc_id for r in filings.unreadable(docs).collect()] == [1]


def test_attributes_at_any_depth_with_a_plain_period(spark):
    body = (
        "<x><ReportPeriod>2024-06-30</ReportPeriod><y><z><monthlyTotReturn classId='A' rtn1='1' rtn2='2' rtn3='3'/></z>"
        "<mon3Flow sales='9' redemption='8' reinvestment='7'/></y><totAssets>5</totAssets></x>"
    )
    rows = filings.scan_filings_xml_attributes(spark.createDataFrame([(0, body)], "doc_id int, body string"))
    got = [(str(r.month_end), r["return"], r.sales, r.total_investments) for r in rows.orderBy("month_end").collect()]
    assert got == [("2024-04-30", 0.01, 0, 5), ("2024-05-31", 0.02, 0, 5), ("2024-06-30", 0.03, 9, 5)]


def test_every_class_gets_the_fund_level_values(spark):
    df = spark.createDataFrame([(list("ABCDEFG"), [0.01], [0.2])], "c array<string>, r array<double>, t array<double>")
    records = text.prospectus_records(F.col("c"), F.col("r"), F.col("t")).alias("all")
    some = text.prospectus_records(F.col("c"), F.col("r"), F.col("t"), most=5).alias("some")
    row = df.select(records, some).first()
    assert [r.class_id for r in row["all"]] == list("ABCDEFG") and len(row["some"]) == 5
    assert {r.net_expense_ratio for r in row["all"]} == {0.01}


RUN = """
import sys
sys.path.insert(0, {root!r})
from fundloom.catalog import all_queries
from fundloom.session import local_session, shared_root, STAGING
spark = local_session(2, 2)
spark.sparkContext.setLogLevel("ERROR")
print("ROWS", all_queries()["class_month_panel"](spark, {sf!r}).count())
print("STAGED", f"{{shared_root(spark)}}/{{STAGING}}/{{spark.sparkContext.applicationId}}")
"""


def test_runs_from_another_folder_and_leaves_nothing_behind(sf_dir, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", RUN.format(root=ROOT, sf=sf_dir)], cwd=tmp_path, env=env, capture_output=True, text=True
    )
    said = dict(line.split(" ", 1) for line in done.stdout.splitlines() if line.startswith(("ROWS", "STAGED")))
    assert int(said["ROWS"]) > 0, done.stderr[-2000:]
    assert not os.path.exists(said["STAGED"].removeprefix("file:").strip())


def test_a_cluster_must_name_its_shared_folder(spark, monkeypatch):
    class Unset:
        @staticmethod
        def get(key, default=None):
            return default

    class Session:
        conf = Unset

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(Session)
