"""Scans, sinks and calendar sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from fundloom.catalog.registry import d, i, over, query, r, view
from fundloom.functions.scalars import quarter_key
from fundloom.operators import coverage, joins, timeseries
from fundloom.plans import views
from fundloom.session import materialize, staging_path
from fundloom.sources import factors as factor_source, filings, readers, sinks

NARROW = ["l_suppkey", "l_shipdate", "l_discount", "l_tax"]


@query(
    "scan_parquet_projected",
    f"SELECT l_suppkey, {d('l_shipdate')}, {r('l_discount')}, {r('l_tax')} FROM lineitem",
)
def scan_parquet_projected(spark, sf):
    return readers.scan_parquet_projected(spark, f"{sf}/lineitem.parquet", NARROW)


def _raw_returns(spark, sf) -> DataFrame:
    """Returns with float-like ids, mixed date spellings and unreadable numbers."""
    spelling = F.when(F.month("Date") % 3 == 0, F.date_format("Date", "yyyy-MM-dd")).when(
        F.month("Date") % 3 == 1, F.date_format("Date", "yyyyMMdd")
    ).otherwise(F.date_format("Date", "yyyyMM"))
    return views.returns(spark, sf).select(
        F.concat("fundno", F.when(F.year("Date") % 2 == 0, F.lit(".0")).otherwise(F.lit(""))).alias("fundno"),
        F.coalesce(F.col("mret").cast("string"), F.lit("C")).alias("mret"),
        F.year("Date").alias("year"),
        F.month("Date").alias("month"),
        spelling.alias("Date"),
    )


@query(
    "scan_hive_returns",
    over(["returns"], f"""SELECT fundno, {d('"Date"', 'Date')}, {r('mret')} FROM returns
      WHERE "Date" BETWEEN DATE '1996-03-01' AND DATE '2000-06-30'"""),
)
def scan_hive_returns(spark, sf):
    path = sinks.sink_parquet_partitioned(_raw_returns(spark, sf), staging_path(spark, "returns"))
    return readers.scan_hive_returns(spark, path, "1996-03-01", "2000-06-30")


@query(
    "scan_csv_typed",
    """SELECT CAST(o_custkey AS VARCHAR) AS fundno, strftime(o_orderdate, '%Y%m') AS "Date",
      round(o_totalprice, 2) AS mret FROM orders""",
    digits=2,
)
def scan_csv_typed(spark, sf):
    raw = views.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("fundno"),
        F.date_format("o_orderdate", "yyyyMM").alias("Date"),
        F.col("o_totalprice").alias("mret"),
    )
    path = sinks.sink_by_format(raw, staging_path(spark, "returns.csv"), "csv")
    return readers.scan_csv_typed(spark, path, "fundno string, Date string, mret double")


@query(
    "scan_by_extension",
    over(["panel"], f"""SELECT fmt, class_id, {d('month_end')}, {r('total_investments', digits=4)} FROM panel,
      (SELECT unnest(['parquet', 'csv', 'json', 'array', 'typed']) AS fmt)"""),
    digits=4,
)
def scan_by_extension(spark, sf):
    """All formats, JSON both by lines and as one pretty-printed array per series, CSV with and without schema."""
    panel = materialize(views.panel(spark, sf).select("class_id", "series_id", "month_end", "total_investments"))
    rows = panel.drop("series_id")
    schema = "class_id string, month_end date, total_investments double"
    parts = []
    for fmt in ("parquet", "csv", "json"):
        path = sinks.sink_by_format(rows, staging_path(spark, f"panel.{fmt}"), fmt)
        parts.append(readers.scan_by_extension(spark, path, schema).withColumn("fmt", F.lit(fmt)))
        if fmt == "csv":
            parts.append(readers.scan_by_extension(spark, path).withColumn("fmt", F.lit("typed")))
    record = F.to_json(F.struct("class_id", "month_end", "total_investments"), {"pretty": "true"})
    listed = panel.groupBy("series_id").agg(F.array_join(F.collect_list(record), ",\n").alias("records"))
    path = staging_path(spark, "panel.json")
    arrays = listed.select(F.concat(F.lit("[\n"), "records", F.lit("\n]")).alias("value"), "series_id")
    arrays.write.partitionBy("series_id").text(path)
    read = readers.scan_by_extension(spark, path, schema).drop("series_id")
    parts.append(read.withColumn("fmt", F.lit("array")))
    return reduce(DataFrame.unionByName, parts)


def _element_documents(spark, sf) -> DataFrame:
    """One document per series and year: each class with its months in order (twelve at most)."""
    def tag(name: str, value) -> Column:
        return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))

    def numbered(name: str, value) -> Column:
        text = value.cast("string")
        return F.when(
            value.isNotNull(),
            F.concat(F.lit(f"<{name}"), F.col("no"), F.lit(">"), text, F.lit(f"</{name}"), F.col("no"), F.lit(">")),
        ).otherwise(F.lit(""))

    year = F.year("month_end")
    by_month = Window.partitionBy("class_id", year).orderBy("month_end")
    month_xml = F.concat(
        numbered("MonthlyTotalReturn", F.col("return")),
        numbered("SalesFlowMon", F.col("sales")),
        numbered("ReinvestmentFlowMon", F.col("reinvest")),
        numbered("RedemptionFlowMon", F.col("redemptions")),
    )
    classes = (
        views.panel(spark, sf)
        .withColumn("year", year)
        .withColumn("no", F.row_number().over(by_month))
        .withColumn("xml", month_xml)
        .groupBy("series_id", "class_id", "year")
        .agg(
            F.sort_array(F.collect_list(F.struct("no", "xml"))).alias("months"),
            F.max_by("total_investments", "month_end").alias("tna"),
            F.max_by("cash", "month_end").alias("cash"),
        )
    )
    cash = F.when(F.col("cash").isNotNull(), tag("CashNotReported", F.col("cash").cast("string")))
    # what was filed before stands in a comment, and a note quotes it: both are text
    old = "<Class><ClassId>OLD</ClassId><MonthlyTotalReturn1>9</MonthlyTotalReturn1></Class>"
    body = F.concat(
        F.lit(f"<NPORT-P><!-- {old} --><Note><![CDATA[{old}]]></Note>"),
        tag("ReportPeriod", F.concat(F.col("year").cast("string"), F.lit("-12-31"))),
        F.lit("<Series>"),
        tag("SeriesId", F.col("series_id")),
        F.lit("<Class>"),
        tag("ClassId", F.col("class_id")),
        F.array_join("months.xml", ""),
        F.coalesce(cash, F.lit("")),
        tag("TotalInvestments", F.col("tna").cast("string")),
        F.lit("</Class></Series></NPORT-P>"),
    )
    return classes.select(body.alias("body"))


@query(
    "scan_filings_xml_elements",
    over(
        ["panel"],
        f"""SELECT class_id, {d('''CAST(last_day(CAST(make_date(yr, 12, 1) - to_months(CAST(n_kept + 1 - no AS INTEGER)) AS DATE)) AS DATE)''', 'month_end')},
          {r('"return"', 'return', 8)}, {r('coalesce(sales, 0)', 'sales', 4)},
          {r('coalesce(reinvest, 0)', 'reinvest', 4)}, {r('coalesce(redemptions, 0)', 'redemptions', 4)},
          {r('tna', 'total_investments', 4)}, {r('last_cash', 'cash', 4)}
        FROM (SELECT *, count(*) OVER (PARTITION BY class_id, yr) AS n_kept FROM kept)""",
        {
            "numbered": """SELECT *, year(month_end) AS yr,
              row_number() OVER (PARTITION BY class_id, year(month_end) ORDER BY month_end) AS no,
              first(total_investments) OVER (PARTITION BY class_id, year(month_end) ORDER BY month_end DESC) AS tna,
              first(cash) OVER (PARTITION BY class_id, year(month_end) ORDER BY month_end DESC) AS last_cash
              FROM panel""",
            "kept": """SELECT * FROM (SELECT *, min(CASE WHEN "return" IS NULL THEN no END)
              OVER (PARTITION BY class_id, yr) AS stop FROM numbered) WHERE stop IS NULL OR no < stop""",
        },
    ),
    digits={"*": 4, "return": 8},
)
def scan_filings_xml_elements(spark, sf):
    return filings.scan_filings_xml_elements(_element_documents(spark, sf))


def _attribute_documents(spark, sf) -> DataFrame:
    """One document per series and quarter with the returns of its classes and the fund's flows.

    A class contributes three numbers to a document, and the flows of the quarter are fund sums.
    """
    quarter_end = F.last_day(F.add_months(F.trunc("month_end", "quarter"), 2))
    slot = (F.month("month_end") - 1) % 3 + 1
    by_class = (
        views.panel(spark, sf)
        .withColumns({"quarter_end": quarter_end, "slot": slot})
        .groupBy("class_id", "quarter_end")
        .agg(
            *[
                F.coalesce(
                    F.max(F.when(F.col("slot") == k, (F.col("return") * 100).cast("string"))), F.lit("N/A")
                ).alias(f"r{k}")
                for k in (1, 2, 3)
            ],
            *[
                F.max(F.when(F.col("slot") == k, F.col(c))).alias(f"{c}{k}")
                for k in (1, 2, 3)
                for c in ("sales", "redemptions", "reinvest")
            ],
            F.max_by("total_investments", "month_end").alias("tna"),
        )
    )

    def attr(name: str, value) -> Column:
        return F.concat(F.lit(f' {name}="'), F.coalesce(value.cast("string"), F.lit("N/A")), F.lit('"'))

    flows = F.concat(
        *[
            F.concat(
                F.lit(f"<mon{k}Flow"),
                attr("redemption", F.col(f"redemptions{k}")),
                attr("reinvestment", F.col(f"reinvest{k}")),
                attr("sales", F.col(f"sales{k}")),
                F.lit("/>"),
            )
            for k in (1, 2, 3)
        ]
    )
    body = F.concat(
        F.lit('<edgarSubmission xmlns="http://www.sec.gov/edgar/nport"><formData><genInfo><repPdEnd>'),
        F.date_format("quarter_end", "yyyy-MM-dd"),
        F.lit("</repPdEnd></genInfo><fundInfo><totAssets>"),
        F.col("tna").cast("string"),
        F.lit("</totAssets><returnInfo><monthlyTotReturns><monthlyTotReturn"),
        attr("classId", F.col("class_id")),
        *[attr(f"rtn{k}", F.col(f"r{k}")) for k in (1, 2, 3)],
        F.lit("/></monthlyTotReturns></returnInfo>"),
        flows,
        F.lit("</fundInfo></formData></edgarSubmission>"),
    )
    return by_class.select(body.alias("body"))


_SLOTS = ", ".join(
    f"max(CASE WHEN slot = {k} THEN {c} END) AS {n}{k}"
    for k in (1, 2, 3)
    for c, n in (('"return"', "r"), ("sales", "s"), ("redemptions", "o"), ("reinvest", "i"))
)


@query(
    "scan_filings_xml_attributes",
    over(
        ["panel"],
        f"""SELECT class_id, {d('CAST(last_day(CAST(quarter_end - to_months(CAST(n - j AS INTEGER)) AS DATE)) AS DATE)', 'month_end')},
          {r('ret', 'return', 8)}, {r('coalesce(sales, 0)', 'sales', 4)},
          {r('coalesce(reinvest, 0)', 'reinvest', 4)}, {r('coalesce(redemptions, 0)', 'redemptions', 4)},
          {r('tna', 'total_investments', 4)}, 0.0::DOUBLE AS cash, abs(ret) > 0.5 AS is_extreme
        FROM dated""",
        {
            "quarters": f"""SELECT class_id, quarter_end, arg_max(total_investments, month_end) AS tna, {_SLOTS}
              FROM (SELECT *, CAST(last_day(CAST(date_trunc('quarter', month_end) + INTERVAL 2 MONTH AS DATE)) AS DATE)
                AS quarter_end, (month(month_end) - 1) % 3 + 1 AS slot FROM panel) GROUP BY 1, 2""",
            "stated": " UNION ALL ".join(
                f"SELECT class_id, quarter_end, tna, {k} AS slot, r{k} AS ret FROM quarters WHERE r{k} IS NOT NULL"
                for k in (1, 2, 3)
            ),
            "placed": """SELECT *, row_number() OVER (PARTITION BY class_id, quarter_end ORDER BY slot) AS j,
              count(*) OVER (PARTITION BY class_id, quarter_end) AS n FROM stated""",
            "dated": """SELECT p.*, CASE j WHEN 1 THEN s1 WHEN 2 THEN s2 ELSE s3 END AS sales,
              CASE j WHEN 1 THEN o1 WHEN 2 THEN o2 ELSE o3 END AS redemptions,
              CASE j WHEN 1 THEN i1 WHEN 2 THEN i2 ELSE i3 END AS reinvest
              FROM placed p JOIN quarters q USING (class_id, quarter_end)""",
        },
    ),
    digits={"*": 4, "return": 8},
)
def scan_filings_xml_attributes(spark, sf):
    return filings.scan_filings_xml_attributes(_attribute_documents(spark, sf))


@query(
    "scan_bulk_num_sub",
    f"""SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, 'C' || l_partkey AS class_id,
      'S' || l_suppkey AS series_id, {d('o_orderdate + INTERVAL 60 DAY', 'filing_date')},
      {d('o_orderdate', 'period')}, 'MonthlyReturn' || (l_linenumber % 4 + 1) AS tag,
      {r('l_discount / 100', 'return', 8)},
      {i('CASE l_linenumber % 4 WHEN 3 THEN NULL ELSE -(l_linenumber % 4) END', 'month_offset')},
      {d('''CAST(last_day(CAST(date_trunc('month', o_orderdate)
        - to_months(CAST(CASE l_linenumber % 4 WHEN 3 THEN 0 ELSE l_linenumber % 4 END AS INTEGER)) AS DATE)) AS DATE)''', 'month_end')}
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_returnflag <> 'A' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey < 15)""",
    digits=8,
)
def scan_bulk_num_sub(spark, sf):
    """Bulk tables written from line items and orders, other tags among them, then read back."""
    tag = F.concat(F.lit("MonthlyReturn"), (F.col("l_linenumber") % 4 + 1).cast("string"))
    numbers = views.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("adsh"),
        F.when(F.col("l_returnflag") == "A", F.lit("NetAssets")).otherwise(tag).alias("tag"),
        F.col("l_discount").cast("string").alias("value"),
        F.concat(F.lit("C"), F.col("l_partkey").cast("string")).alias("instance"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("series"),
    )
    submissions = views.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("adsh"),
        F.col("o_custkey").alias("cik"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("period"),
        F.date_format(F.date_add("o_orderdate", 60), "yyyyMMdd").alias("filed"),
    )
    paths = []
    for df, name in ((numbers, "num"), (submissions, "sub")):
        path = staging_path(spark, name)
        df.write.option("sep", "\t").option("header", True).csv(path)
        paths.append(path)
    targets = views.table(spark, sf, "customer").where("c_nationkey < 15").select(
        F.col("c_custkey").cast("string").alias("cik")
    )
    return filings.scan_bulk_num_sub(spark, *paths, ciks=targets)


def _factor_files(spark, sf, columns, momentum: bool = False):
    path = staging_path(spark, "momentum" if momentum else "factors")
    factor_source.factor_file_text(views.factors(spark, sf), columns).coalesce(1).write.text(path)
    return factor_source.scan_factor_text(spark, path, columns)


@query(
    "scan_factor_text",
    over(["factors"], f"SELECT {d('month_end')}, " + ", ".join(
        r(f"coalesce({c} * 100, -99.99)", c, 8) for c in factor_source.FIVE) + " FROM factors"),
    digits=8,
)
def scan_factor_text(spark, sf):
    return _factor_files(spark, sf, factor_source.FIVE)


@query(
    "build_factor_panel",
    over(["factors"], f"SELECT {d('month_end')}, " + ", ".join(
        r(c, c, 10) for c in factor_source.MONTHLY) + " FROM factors"),
    digits=10,
)
def build_factor_panel(spark, sf):
    five = _factor_files(spark, sf, factor_source.FIVE)
    momentum = _factor_files(spark, sf, ["MOM"], momentum=True)
    return factor_source.build_factor_panel(five, momentum, missing_to_null=True)


def index_documents(spark, sf) -> DataFrame:
    """A filing index per customer: parallel arrays of 1 to 9 filings, built from the row's own values."""
    key = F.col("c_custkey")
    at = F.sequence(F.lit(0), F.pmod(key, F.lit(9)).cast("int"))
    forms = ["NPORT-P", "485BPOS", "NPORT-P/A", "497", "10-K", "N-1A", "nport-p", "N-CEN"]

    def each(make) -> Column:
        return F.transform(at, lambda j: make(key + j))

    def date(k):
        day = F.date_add(F.lit("1991-01-15").cast("date"), F.pmod(k * 397, F.lit(12500)).cast("int"))
        return F.date_format(day, "yyyy-MM-dd")

    form_list = F.array(*[F.lit(f) for f in forms])
    recent = F.struct(
        each(lambda k: F.get(form_list, F.pmod(k, F.lit(len(forms))).cast("int"))).alias("form"),
        each(lambda k: F.concat(F.lpad(key.cast("string"), 10, "0"), F.lit("-20-"), k.cast("string"))).alias(
            "accessionNumber"
        ),
        each(lambda k: F.concat(F.lit("xslFormNPORT-P_X01/doc"), k.cast("string"), F.lit(".xml"))).alias(
            "primaryDocument"
        ),
        each(date).alias("filingDate"),
    )
    body = F.to_json(F.struct(F.struct(recent.alias("recent")).alias("filings")))
    return views.table(spark, sf, "customer").select(
        F.lpad(key.cast("string"), 10, "0").alias("cik"), body.alias("body")
    )


view(
    "index_rows",
    """SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, j AS position,
      ['NPORT-P', '485BPOS', 'NPORT-P/A', '497', '10-K', 'N-1A', 'nport-p', 'N-CEN'][(c_custkey + j) % 8 + 1] AS form,
      lpad(CAST(c_custkey AS VARCHAR), 10, '0') || '-20-' || (c_custkey + j) AS accession,
      'xslFormNPORT-P_X01/doc' || (c_custkey + j) || '.xml' AS primary_doc,
      strftime(DATE '1991-01-15' + CAST((c_custkey + j) * 397 % 12500 AS INTEGER), '%Y-%m-%d') AS filing_date
    FROM (SELECT c_custkey, unnest(range(0, c_custkey % 9 + 1)) AS j FROM customer)""",
)


@query(
    "scan_filing_index",
    over(["index_rows"], """SELECT cik, accession, primary_doc, filing_date FROM index_rows
      WHERE starts_with(upper(form), 'NPORT-P') AND filing_date >= '2001-06-30'"""),
)
def scan_filing_index(spark, sf):
    return filings.scan_filing_index(index_documents(spark, sf), "2001-06-30")


@query(
    "latest_prospectus_by_tier",
    over(
        ["index_rows"],
        f"""SELECT cik, {i('min_year')}, form, accession, primary_doc, filing_date FROM (
          SELECT *, row_number() OVER (PARTITION BY cik ORDER BY min_year DESC, position DESC) AS pick FROM (
            SELECT *, CASE WHEN y >= 2020 THEN 2020 WHEN y >= 2015 THEN 2015 WHEN y >= 2010 THEN 2010
              WHEN y >= 2005 THEN 2005 WHEN y >= 1990 THEN 1990 END AS min_year
            FROM (SELECT *, CAST(filing_date[1:4] AS INTEGER) AS y FROM index_rows)
            WHERE form IN ({", ".join(f"'{f}'" for f in filings.PROSPECTUS_FORMS)})) WHERE min_year IS NOT NULL)
        WHERE pick = 1""",
    ),
)
def latest_prospectus_by_tier(spark, sf):
    return filings.latest_prospectus_by_tier(index_documents(spark, sf))


def _registrants(spark, sf) -> DataFrame:
    """Registrants with the lists of their series and classes, from the columns of one row each."""
    key = F.col("c_custkey")
    series = F.transform(
        F.sequence(F.lit(0), F.pmod(key, F.lit(4)).cast("int")),
        lambda j: F.concat(F.lit("S"), (key * 10 + j).cast("string")),
    )
    return views.table(spark, sf, "customer").select(
        F.col("c_name").alias("name"),
        key.cast("string").alias("cik"),
        F.when(key % 5 != 0, series).otherwise(F.array().cast("array<string>")).alias("series_ids"),
        F.array().cast("array<string>").alias("class_ids"),
    )


@query(
    "registrants_flatten",
    """SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, 'S' || (c_custkey * 10 + j) AS series_id
    FROM (SELECT c_custkey, unnest(range(0, c_custkey % 4 + 1)) AS j FROM customer) WHERE c_custkey % 5 <> 0""",
)
def registrants_flatten(spark, sf):
    return joins.registrants_flatten(_registrants(spark, sf))


def quarters(spark, sf) -> DataFrame:
    span = views.table(spark, sf, "orders").agg(
        F.min("o_orderdate").cast("date").alias("first"), F.max("o_orderdate").cast("date").alias("last")
    )
    return span.select(F.explode(filings.quarters_available(F.col("first"), F.col("last"))).alias("quarter"))


view(
    "quarters",
    """SELECT year(q) || 'q' || quarter(q) AS quarter FROM (SELECT unnest(generate_series(
      date_trunc('quarter', min(o_orderdate)), date_trunc('quarter', max(o_orderdate)), INTERVAL 3 MONTH)) AS q
    FROM orders)""",
)


@query("quarters_available", over(["quarters"], "SELECT quarter FROM quarters"))
def quarters_available(spark, sf):
    return quarters(spark, sf)


@query(
    "quarter_overlap_filter",
    over(["quarters"], """SELECT quarter FROM (SELECT quarter,
        make_date(y, (q - 1) * 3 + 1, 1) AS opens,
        CASE WHEN q < 4 THEN make_date(y, q * 3, 1) ELSE make_date(y, 12, 31) END AS closes
      FROM (SELECT quarter, CAST(quarter[1:4] AS BIGINT) AS y, CAST(quarter[-1:] AS BIGINT) AS q FROM quarters))
      WHERE closes >= DATE '1996-06-02' AND opens <= DATE '1999-12-15'"""),
)
def quarter_overlap_filter(spark, sf):
    return filings.quarter_overlap_filter(quarters(spark, sf), "1996-06-02", "1999-12-15")


_PANEL_OUT = f"""class_id, {d('month_end')}, {r('"return"', 'return', 6)}, {r('total_investments', digits=4)}"""


def _narrow(spark, sf):
    return views.panel(spark, sf).select("class_id", "month_end", "return", "total_investments")


@query("sink_parquet", over(["panel"], f"SELECT {_PANEL_OUT} FROM panel"), digits={"*": 4, "return": 6})
def sink_parquet(spark, sf):
    return spark.read.parquet(sinks.sink_parquet(_narrow(spark, sf), staging_path(spark, "panel")))


@query(
    "sink_parquet_partitioned",
    over(["panel"], f"SELECT {_PANEL_OUT}, {i('year(month_end)', 'year')}, {i('month(month_end)', 'month')} FROM panel"),
    digits={"*": 4, "return": 6},
)
def sink_parquet_partitioned(spark, sf):
    dated = _narrow(spark, sf).withColumns({"year": F.year("month_end"), "month": F.month("month_end")})
    return spark.read.parquet(
        sinks.sink_parquet_partitioned(dated, staging_path(spark, "panel"))
    )


@query(
    "sink_by_format",
    over(["panel"], f"SELECT fmt, {_PANEL_OUT} FROM panel, (SELECT unnest(['parquet', 'csv', 'json']) AS fmt)"),
    digits={"*": 4, "return": 6},
)
def sink_by_format(spark, sf):
    schema = "class_id string, month_end date, `return` double, total_investments double"
    parts = []
    for fmt in ("parquet", "csv", "json"):
        path = sinks.sink_by_format(_narrow(spark, sf), staging_path(spark, f"panel-{fmt}"), fmt)
        reader = spark.read.schema(schema).option("header", True)
        parts.append(reader.format(fmt).load(path).withColumn("fmt", F.lit(fmt)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "sink_db_metadata",
    over(["filings"], f"""SELECT count(*) AS total_records, count(DISTINCT class_id) AS unique_classes,
      {d('min(month_end)', 'min_month')}, {d('max(month_end)', 'max_month')},
      array_to_string(list_sort(list(DISTINCT year(report_period) || 'q' || quarter(report_period))), ',')
        AS quarters_processed FROM filings"""),
)
def sink_db_metadata(spark, sf):
    db = views.filings(spark, sf)
    path = sinks.sink_parquet(coverage.database_metadata(db, quarter_key("report_period")), staging_path(spark, "metadata"))
    return spark.read.parquet(path)


@query(
    "extended_history_start",
    over(["panel"], f"""SELECT class_id, {d('month_end')} FROM panel
      WHERE month_end >= DATE '1999-01-31' - INTERVAL 14 MONTH"""),
)
def extended_history_start(spark, sf):
    return timeseries.extended_history(views.panel(spark, sf), "1999-01-31", 14).select("class_id", "month_end")

