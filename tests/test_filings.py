import datetime as dt

import pytest
from pyspark.sql import functions as F

from fundloom.functions import text as T
from fundloom.operators import timeseries
from fundloom.sources import factors as S, filings, ixbrl, managers

ELEMENT = """<?xml version="1.0" encoding="UTF-8"?>
<NPORT-P><ReportPeriod>{period}</ReportPeriod><Series><SeriesId>S7</SeriesId><Class><ClassId>K1</ClassId>
{months}<CashNotReported>250</CashNotReported><TotalInvestments>8750</TotalInvestments></Class></Series></NPORT-P>"""
#: return, sales, reinvestment, redemptions of each month
MONTHS = [(0.031, 640, 16, 128), (-0.012, 90, 0, 450), (0.0075, 300, 25, 75), (0.002, 0, 5, 0)]


def element_document(period="2021-07-31", skip=None):
    months = "".join(
        f"<MonthlyTotalReturn{k}>{r}</MonthlyTotalReturn{k}><SalesFlowMon{k}>{s}</SalesFlowMon{k}>"
        f"<ReinvestmentFlowMon{k}>{i}</ReinvestmentFlowMon{k}><RedemptionFlowMon{k}>{o}</RedemptionFlowMon{k}>"
        for k, (r, s, i, o) in enumerate(MONTHS, 1)
        if k != skip
    )
    return ELEMENT.format(period=period, months=months)


def documents(spark, *bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "doc_id bigint, body string")


def test_element_filing(spark):
    got = filings.scan_filings_xml_elements(documents(spark, element_document()))
    rows = timeseries.net_flow(got).orderBy("month_end").collect()
    ends = [dt.date(2021, 3, 31), dt.date(2021, 4, 30), dt.date(2021, 5, 31), dt.date(2021, 6, 30)]
    assert [r["month_end"] for r in rows] == ends  # the last of n returns is dated a month before the period
    assert [r["return"] for r in rows] == [m[0] for m in MONTHS]
    assert [r["net_flow"] for r in rows] == [s + i - o for _, s, i, o in MONTHS]
    tna = timeseries.tna_roll_forward(timeseries.net_flow(got)).collect()
    assert {r["tna"] for r in tna} == {9000.0}


def test_element_months_stop_at_the_first_missing_one_and_mid_month_periods(spark):
    got = filings.scan_filings_xml_elements(
        documents(spark, element_document("2024-03-15", skip=2), "<NPORT-P><broken")
    ).collect()
    assert [(r["doc_id"], r["month_end"], r["return"]) for r in got] == [(0, dt.date(2024, 2, 29), 0.031)]


def one_class(name, value, inner=""):
    return f"<Class><ClassId>{name}</ClassId>{inner}<MonthlyTotalReturn1>{value}</MonthlyTotalReturn1></Class>"


def test_only_elements_count_as_classes(spark):
    """Comments, CDATA and processing instructions are no elements; a class in a class is one of its own."""
    head, foot = "<N><ReportPeriod>2022-01-31</ReportPeriod>", "</N>"
    docs = documents(
        spark,
        f"{head}<!-- {one_class('OLD', 9)} --><Note><![CDATA[{one_class('QUOTED', 9)}]]></Note>{one_class('A', 0.1)}{foot}",
        f"{head}{one_class('OUTER', 0.2, inner='<Part>' + one_class('INNER', 0.3) + '</Part>')}{foot}",
        f"{head}<?x {one_class('PI', 9)}?><Class><Sub><ClassId>DEEP</ClassId></Sub><MonthlyTotalReturn1>0.4</MonthlyTotalReturn1></Class>{foot}",
        f"{head}{one_class('BAD', 'x')}{one_class('GOOD', 0.5)}{foot}",
        f"{head}<Class/><Class><ClassId>&lt;E&gt;</ClassId><MonthlyTotalReturn1> 0.6 </MonthlyTotalReturn1></Class>{foot}",
        None,
    )
    got = filings.scan_filings_xml_elements(docs).collect()
    assert sorted((r["doc_id"], str(r["class_id"]), r["return"]) for r in got) == [
        (0, "A", 0.1), (1, "INNER", 0.3), (1, "OUTER", 0.2), (2, "None", 0.4), (4, "<E>", 0.6),
    ]
    # a number that cannot be read makes its filing unreadable as a whole
    assert sorted(r["doc_id"] for r in filings.unreadable(docs).collect()) == [3, 5]
    rows, log = filings.read_filings(docs)
    assert sorted(map(str, rows.collect())) == sorted(map(str, got)) and sorted(r[:] for r in log.collect()) == [(3,), (5,)]


def test_only_elements_count_in_attribute_filings(spark):
    quoted = '<monthlyTotReturn classId="OLD" rtn1="9"/>'
    doc = attribute_document(f'<!-- {quoted} --><a><![CDATA[{quoted}]]></a><b><c><monthlyTotReturn classId="A" rtn1="2"/></c></b>')
    got = filings.scan_filings_xml_attributes(documents(spark, doc)).collect()
    assert [(r["class_id"], r["return"]) for r in got] == [("A", 0.02)]


ATTRIBUTE = """<edgarSubmission xmlns="http://www.sec.gov/edgar/nport"><formData><genInfo>{period}</genInfo><fundInfo>
<totAssets>{assets}</totAssets><returnInfo><monthlyTotReturns>{classes}</monthlyTotReturns></returnInfo>
<mon1Flow redemption="1" reinvestment="N/A" sales="10"/><mon3Flow redemption="3" reinvestment="2" sales="30"/>
</fundInfo></formData></edgarSubmission>"""


def attribute_document(classes, period="<repPdEnd>2024-03-31</repPdEnd>", assets="7"):
    return ATTRIBUTE.format(period=period, assets=assets, classes=classes)


def test_attribute_filing(spark):
    doc = attribute_document(
        '<monthlyTotReturn classId="A" rtn1="1.5" rtn2="N/A" rtn3="-60"/>'
        '<monthlyTotReturn rtn1="1" rtn2="1" rtn3="1"/><monthlyTotReturn classId="B" rtn1="1" rtn2="2" rtn3="x"/>'
    )
    no_period = attribute_document('<monthlyTotReturn classId="A" rtn1="1"/>', period="")
    rows = filings.scan_filings_xml_attributes(documents(spark, doc, no_period)).orderBy("class_id", "month_end").collect()
    assert {r["doc_id"] for r in rows} == {0}
    a = [r for r in rows if r["class_id"] == "A"]
    # the middle return is N/A, so the last one is dated by its new place, with the second month's flows
    assert [r["month_end"] for r in a] == [dt.date(2024, 2, 29), dt.date(2024, 3, 31)]
    assert [r["return"] for r in a] == [0.015, -0.6]
    assert [(r["sales"], r["reinvest"], r["redemptions"]) for r in a] == [(10, 0, 1), (0, 0, 0)]
    assert [r["is_extreme"] for r in a] == [False, True]
    b = [r["return"] for r in rows if r["class_id"] == "B"]
    assert b == [0.01, 0.02, 0.0]  # unreadable text counts as 0
    assert {(r["total_investments"], r["cash"]) for r in rows} == {(7.0, 0.0)}


def test_factor_text(spark, tmp_path):
    path = tmp_path / "ff.csv"
    path.write_text(
        "Prose 2 lines\n\n,Mkt-RF,SMB,HML,RMW,CMA,RF\n196307,   -0.39,  -0.41,-0.97, 0.68,-1.18, 0.27\n"
        "196308, 5.07, -99.99, 1.80, 0.36,-0.35, 0.25\n\n Annual Factors: January-December\n,Mkt-RF\n  1964,12.54\n"
    )
    five = S.scan_factor_text(spark, str(path), S.FIVE).orderBy("month_end")
    rows = five.collect()
    assert [r["month_end"] for r in rows] == [dt.date(1963, 7, 31), dt.date(1963, 8, 31)]
    assert rows[0]["MKT_RF"] == -0.39 and rows[1]["RF"] == 0.25
    mom = spark.createDataFrame([(dt.date(1963, 8, 31), 1.0)], "month_end date, MOM double")
    kept = S.build_factor_panel(five, mom).orderBy("month_end").collect()
    assert kept[1]["SMB"] == pytest.approx(-0.9999) and kept[0]["MOM"] is None
    nulled = S.build_factor_panel(five, mom, missing_to_null=True).orderBy("month_end").collect()
    assert nulled[1]["SMB"] is None and nulled[1]["MOM"] == pytest.approx(0.01)


def test_tenure_and_inception(spark):
    text = (
        "Jane has managed the fund since March 2012. John joined the firm in 2030. Appointed in 1965. "
        "Inception: Foo 3, 2001. The fund began operations on Sep 9, 1999 and was established on JANUARY 5, 1990."
    )
    row = spark.createDataFrame([(text, dt.date(2020, 6, 30))], "t string, d date").select(
        T.manager_tenure("t", "d").alias("tenure"), T.inception_date("t").alias("start")
    ).first()
    assert row["tenure"] == 8.0
    assert row["start"] == dt.date(1990, 1, 5)  # the phrase listed earlier wins over the earlier place


@pytest.mark.parametrize(
    "text, value",
    [("45 bps", 0.0045), ("0.45 %", 0.0045), ("12.5%", 0.125), ("0.3", 0.3), ("7", 0.07), ("none", None),
     ("5 % or 20 BPS", 0.002), (None, None)],
)
def test_percent_from_text(spark, text, value):
    got = spark.createDataFrame([(text,)], "t string").select(T.percent_from_text("t")).first()[0]
    assert got == (None if value is None else pytest.approx(value))


def test_no_tagged_value_falls_back_to_the_first_label_then_to_the_text(spark):
    docs = documents(
        spark,
        '<xbrl><ix:nonFraction name="NetExpenseRatio" contextRef="">0.5%</ix:nonFraction>'
        '<ix:nonFraction name="netexpenseratio">0.9%</ix:nonFraction> Portfolio turnover of 20 %</xbrl>',
        "<xbrl>nothing</xbrl>",
    )
    got = ixbrl.extract_records(docs).collect()
    assert [(r["doc_id"], r["context_ref"]) for r in got] == [(0, "fund_level")]
    assert got[0]["net_expense_ratio"] == pytest.approx(0.005)
    assert got[0]["turnover_pct"] == pytest.approx(0.2)


def test_index_uses_the_array_position(spark):
    body = (
        '{"filings":{"recent":{"form":["497","485BPOS","NPORT-P"],"accessionNumber":["a-1","a-2","a-3"],'
        '"primaryDocument":["x","y","z"],"filingDate":["2021-05-01","2020-01-01","2022-02-02"]}}}'
    )
    df = spark.createDataFrame([("1", body)], "cik string, body string")
    hit = filings.latest_prospectus_by_tier(df).first()
    assert (hit["accession"], hit["min_year"]) == ("a-2", 2020)  # listed last among the forms, not newest
    found = filings.scan_filing_index(df, "2022-02-02").collect()
    assert [r["accession"] for r in found] == ["a-3"]


def test_quarters(spark):
    got = spark.range(1).select(
        F.explode(filings.quarters_available(F.lit("2019-08-02").cast("date"), F.lit("2020-01-01").cast("date")))
    ).collect()
    assert [r[0] for r in got] == ["2019q3", "2019q4", "2020q1"]
    df = spark.createDataFrame([("2019q3",), ("2019q4",)], "quarter string")
    # the third quarter is taken to end on the first of September
    kept = filings.quarter_overlap_filter(df, start="2019-09-02").collect()
    assert [r[0] for r in kept] == ["2019q4"]


def test_manager_records_of_the_latest_document(spark):
    registrants = spark.createDataFrame(
        [("7", ["S1", "S2"], ["A", "B"]), ("8", [], None), ("9", ["S9"], ["Z"])], "cik string, series_ids array<string>, class_ids array<string>"
    )
    docs = spark.createDataFrame(
        [("0000000007", dt.date(2019, 5, 1), 1, "managed the fund since 2001. commenced operations on May 1, 2010"),
         ("7", dt.date(2021, 5, 1), 2, "Jane has managed the fund since March 2012. commenced operations on May 1, 2011"),
         ("8", dt.date(2020, 1, 1), 3, None), ("8", None, 4, "managed the fund since 1999")],
        "cik string, filing_date date, accession long, body string",
    )
    got = managers.manager_records(registrants, docs).collect()
    seven = [r for r in got if r["cik"] == "0000000007"]
    assert sorted((r["series_id"], r["class_id"]) for r in seven) == [("S1", "A"), ("S1", "B"), ("S2", "A"), ("S2", "B")]
    assert {(r["manager_tenure"], str(r["inception_date"]), str(r["asof"])) for r in seven} == {(9.0, "2011-05-01", "2021-05-01")}
    assert {round(r["fund_age"], 2) for r in seven} == {10.0}
    assert [r[:7] for r in got if r["cik"] != "0000000007"] == [("0000000008", None, None, None, None, None, dt.date(2020, 1, 1))]
