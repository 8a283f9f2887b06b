"""Filing documents to class-month rows: two XML styles, the filing index, and bulk tables."""

from __future__ import annotations

from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from fundloom.functions.scalars import (
    extreme_return, month_end_shift, pad_registrant_id, pct_to_decimal, quarter_key,
    safe_float_default, tag_month_offset, to_numeric_or_null,
)
from fundloom.session import materialize

MAX_MONTHS = 12  # fixed value: monthly elements per class

_CLASS = "struct<ClassId:string,{months},CashNotReported:double,TotalInvestments:double>".format(
    months=",".join(
        f"{name}{i}:double"
        for i in range(1, MAX_MONTHS + 1)
        for name in ("MonthlyTotalReturn", "SalesFlowMon", "ReinvestmentFlowMon", "RedemptionFlowMon")
    )
)
ELEMENT_SCHEMA = f"ReportPeriod array<string>, Class array<{_CLASS}>"

_FLOW = "struct<_sales:string,_redemption:string,_reinvestment:string>"
ATTRIBUTE_SCHEMA = (
    "repPdEnd array<string>, ReportPeriod array<string>, totAssets array<string>, "
    "monthlyTotReturn array<struct<_classId:string,_rtn1:string,_rtn2:string,_rtn3:string>>, "
    f"mon1Flow array<{_FLOW}>, mon2Flow array<{_FLOW}>, mon3Flow array<{_FLOW}>"
)

INDEX_SCHEMA = (
    "filings struct<recent:struct<form:array<string>,accessionNumber:array<string>,"
    "primaryDocument:array<string>,filingDate:array<string>>>"
)

# Forms that carry expense ratios and turnover, and the years tried in turn.
PROSPECTUS_FORMS = [
    "485BPOS", "485APOS", "485BXT", "485A24F", "N-1A", "N-1A/A", "N-CEN", "N-CEN/A", "497", "497/A",
]
YEAR_TIERS = [2020, 2015, 2010, 2005, 1990]


def _nodes(root: ElementTree.Element, field: T.StructField) -> list:
    """What the elements of a field's name hold, at any depth and in document order: their text, or for a struct the
    texts of their own children and, with a leading `_`, their attributes. Names count without a namespace."""
    found = [e for e in root.iter() if isinstance(e.tag, str) and e.tag.rpartition("}")[2] == field.name]
    item = field.dataType.elementType
    if not isinstance(item, T.StructType):
        return [e.text for e in found]
    rows = []
    for element in found:
        children: dict[str, str] = {}
        for child in element:
            if isinstance(child.tag, str):
                children.setdefault(child.tag.rpartition("}")[2], child.text or "")
        children |= {f"_{k.rpartition('}')[2]}": v for k, v in element.attrib.items()}
        row = {}
        for f in item:
            text = children.get(f.name)
            number = isinstance(f.dataType, T.DoubleType)
            row[f.name] = (float(text) if text and text.strip() else None) if number else text
        rows.append(row)
    return rows


def _parsed(documents: DataFrame, schema: str) -> DataFrame:
    """Documents with their parsed content `x`: for each field of the schema an array of what the elements of its
    name hold. It is null for a document that is no XML or has text where a number stands.

    The built-in reader binds elements to one place in the document; here they may stand anywhere, also inside one
    another, and what is in comments or quoted as CDATA is text. Documents are parsed in Arrow batches. Rows without
    content are dropped only after their arrays are exploded (in the outer form), as a filter here would make the
    parser run a second time.
    """
    fields = T.StructType.fromDDL(schema)
    arrow = to_arrow_type(fields)

    @F.arrow_udf(fields)
    def parse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = []
            for body in batch:
                try:
                    root = ElementTree.fromstring(body.as_py() or b"")
                    found.append({f.name: _nodes(root, f) for f in fields})
                except (ElementTree.ParseError, ValueError, LookupError):
                    found.append(None)
            yield pa.array(found, arrow)

    keys = [c for c in documents.columns if c != "body"]
    return documents.select(*keys, parse(F.col("body").cast("binary")).alias("x"))


def unreadable(documents: DataFrame) -> DataFrame:
    """The keys of the documents that no parser can read, for the log."""
    keys = [c for c in documents.columns if c != "body"]
    return _parsed(documents, ELEMENT_SCHEMA).where(F.col("x").isNull()).select(*keys)


def read_filings(documents: DataFrame, style: str = "elements") -> tuple[DataFrame, DataFrame]:
    """The rows of a landing of filings and the keys of those that cannot be read, for the log.

    Documents are parsed once; both results come from the stored parse. `style` is `elements` or `attributes`.
    """
    schema, rows = {
        "elements": (ELEMENT_SCHEMA, element_rows),
        "attributes": (ATTRIBUTE_SCHEMA, attribute_rows),
    }[style]
    parsed = materialize(_parsed(documents, schema))
    return rows(parsed), parsed.where(F.col("x").isNull()).drop("x")


def scan_filings_xml_elements(documents: DataFrame) -> DataFrame:
    """Element-style filings to up to twelve months per class; see `element_rows`."""
    return element_rows(_parsed(documents, ELEMENT_SCHEMA))


def scan_filings_xml_attributes(documents: DataFrame) -> DataFrame:
    """Attribute-style filings to up to three months per class; see `attribute_rows`."""
    return attribute_rows(_parsed(documents, ATTRIBUTE_SCHEMA))


def element_rows(parsed: DataFrame) -> DataFrame:
    """Element-style filings to up to twelve months per class.

    Classes and the period may stand at any depth, also a class inside a class, which has values of its own. Months
    stop at the first missing return; absent flows are 0, absent assets and cash null. The j-th of n returns belongs
    to the month end n - j months before the report period.
    """
    keys = [c for c in parsed.columns if c != "x"]
    per_class = parsed.select(
        *keys, F.to_date(F.get("x.ReportPeriod", 0)).alias("report_period"), F.explode_outer("x.Class").alias("c")
    ).where(F.col("c").isNotNull())

    def of(name: str, i: int) -> Column:
        return F.col(f"c.{name}{i}")

    def flow(name: str, i: int) -> Column:
        return F.coalesce(of(name, i), F.lit(0.0))

    months = F.array(
        *[
            F.struct(
                of("MonthlyTotalReturn", i).alias("return"),
                flow("SalesFlowMon", i).alias("sales"),
                flow("ReinvestmentFlowMon", i).alias("reinvest"),
                flow("RedemptionFlowMon", i).alias("redemptions"),
            )
            for i in range(1, MAX_MONTHS + 1)
        ]
    )
    gap = F.array_position(F.transform(F.col("months"), lambda m: m["return"].isNull()), True)
    known = F.when(gap > 0, F.slice(F.col("months"), 1, gap.cast("int") - 1)).otherwise(F.col("months"))
    listed = per_class.withColumn("months", months).withColumn("months", known)
    rows = listed.select(
        *keys, "c", "report_period", F.size("months").alias("n"),
        F.posexplode_outer("months").alias("j", "m"),
    ).where(F.col("j").isNotNull())
    return rows.select(
        *keys,
        F.col("c.ClassId").alias("class_id"),
        month_end_shift("report_period", F.col("j") - F.col("n")).alias("month_end"),
        "m.*",
        F.col("c.TotalInvestments").alias("total_investments"),
        F.col("c.CashNotReported").alias("cash"),
    )


def attribute_rows(parsed: DataFrame) -> DataFrame:
    """Attribute-style filings to up to three months per class.

    N/A returns are dropped before the remaining ones are dated, oldest first, up to the report period;
    the flows, which are those of the fund, are matched by position. Elements may stand at any depth, and a
    plain report period stands in for one that is missing. Unknown assets and cash count as 0.
    """
    keys = [c for c in parsed.columns if c != "x"]

    def first(name: str) -> Column:
        return F.get(F.col(f"x.{name}"), 0)

    parsed = parsed.select(
        *keys,
        F.to_date(F.coalesce(first("repPdEnd"), first("ReportPeriod"))).alias("report_period"),
        safe_float_default(first("totAssets")).alias("total_investments"),
        F.array(
            *[
                F.named_struct(
                    *[
                        part
                        for a, n in (("sales", "sales"), ("redemption", "redemptions"), ("reinvestment", "reinvest"))
                        for part in (
                            F.lit(n),
                            F.coalesce(safe_float_default(first(f"mon{k}Flow")[f"_{a}"]), F.lit(0.0)),
                        )
                    ]
                )
                for k in (1, 2, 3)
            ]
        ).alias("flows"),
        F.explode_outer("x.monthlyTotReturn").alias("r"),
    )
    stated = F.filter(
        F.array("r._rtn1", "r._rtn2", "r._rtn3"),
        lambda v: v.isNotNull() & ~F.upper(v).isin("N/A", "NULL", ""),
    )
    # a document without period and a class without id have no returns to explode
    dated = F.col("report_period").isNotNull() & (F.col("r._classId") != "")
    returns = F.when(dated, F.transform(stated, lambda v: pct_to_decimal(safe_float_default(v))))
    rows = parsed.withColumn("returns", returns).select(
        *keys, "r", "report_period", "total_investments", "flows", F.size("returns").alias("n"),
        F.posexplode_outer("returns").alias("j", "return"),
    ).where(F.col("j").isNotNull())
    return rows.select(
        *keys,
        F.col("r._classId").alias("class_id"),
        month_end_shift("report_period", F.col("j") + 1 - F.col("n")).alias("month_end"),
        "return",
        *[F.col("flows")[F.col("j")][c].alias(c) for c in ("sales", "reinvest", "redemptions")],
        "total_investments",
        F.lit(0.0).alias("cash"),
        extreme_return("return").alias("is_extreme"),
    )


def _index_rows(indexes: DataFrame) -> DataFrame:
    keys = [c for c in indexes.columns if c != "body"]
    recent = F.from_json("body", INDEX_SCHEMA)["filings"]["recent"]
    zipped = F.arrays_zip("r.form", "r.accessionNumber", "r.primaryDocument", "r.filingDate")
    return (
        indexes.select(*keys, recent.alias("r"))
        .select(*keys, F.posexplode_outer(zipped).alias("position", "f"))
        .where(F.col("position").isNotNull())
        .select(
            *keys, "position", F.col("f.form").alias("form"),
            F.col("f.accessionNumber").alias("accession"),
            F.col("f.primaryDocument").alias("primary_doc"),
            F.col("f.filingDate").alias("filing_date"),
        )
    )


def scan_filing_index(indexes: DataFrame, since: str, prefix: str = "NPORT-P") -> DataFrame:
    """Filings of a form family filed since a date (compared as text)."""
    rows = _index_rows(indexes)
    wanted = F.upper("form").startswith(prefix) & (F.col("filing_date") >= since)
    return rows.where(wanted).drop("position", "form")


def latest_prospectus_by_tier(indexes: DataFrame) -> DataFrame:
    """Per registrant the prospectus-family filing listed last, from 2020 on, else from 2015 on, ..."""
    year = F.substring("filing_date", 1, 4).try_cast("int")
    tier = F.coalesce(*[F.when(year >= y, F.lit(y)) for y in YEAR_TIERS])
    rows = _index_rows(indexes).where(F.col("form").isin(PROSPECTUS_FORMS))
    ranked = rows.withColumn("min_year", tier).where(F.col("min_year").isNotNull())
    best = ranked.groupBy("cik").agg(
        F.max_by(
            F.struct("min_year", "form", "accession", "primary_doc", "filing_date"),
            F.struct("min_year", "position"),
        ).alias("hit")
    )
    return best.select("cik", "hit.*")


BULK_SUB = "adsh string, cik bigint, period string, filed string"
BULK_NUM = "adsh string, tag string, value string, instance string, series string"
RETURN_TAG = "(?i)MonthlyReturn|monthlyTotReturn"  # fixed value


def scan_bulk_num_sub(
    spark: SparkSession,
    num_path: str,
    sub_path: str,
    ciks: DataFrame | None = None,
    series: DataFrame | None = None,
    classes: DataFrame | None = None,
) -> DataFrame:
    """Monthly returns from the tab-separated bulk tables, dated by the month their tag names.

    Targets are one-column tables (`cik`, `series_id`, `class_id`); all that are given apply, and
    registrant ids are compared zero-padded.
    """
    tsv = spark.read.option("sep", "\t").option("header", True)
    numbers = tsv.schema(BULK_NUM).csv(num_path).where(F.col("tag").rlike(RETURN_TAG))
    submissions = tsv.schema(BULK_SUB).csv(sub_path)
    joined = numbers.join(submissions, "adsh", "left")
    period = F.to_date("period", "yyyyMMdd")
    rows = joined.select(
        pad_registrant_id("cik").alias("cik"),
        F.coalesce("instance", F.lit("")).alias("class_id"),
        F.coalesce("series", F.lit("")).alias("series_id"),
        F.to_date("filed", "yyyyMMdd").alias("filing_date"),
        period.alias("period"),
        "tag",
        pct_to_decimal(to_numeric_or_null("value")).alias("return"),
        tag_month_offset("tag").alias("month_offset"),
        month_end_shift(period, F.coalesce(tag_month_offset("tag"), F.lit(0))).alias("month_end"),
    )
    for targets, key in ((ciks, "cik"), (series, "series_id"), (classes, "class_id")):
        if targets is not None:
            wanted = targets.select(pad_registrant_id(key).alias(key) if key == "cik" else F.col(key))
            rows = rows.join(wanted.distinct(), key, "left_semi")
    return rows


def quarters_available(first: Column, last: Column) -> Column:
    """All quarter keys from the quarter of `first` to that of `last`."""
    starts = F.sequence(F.trunc(first, "quarter"), F.trunc(last, "quarter"), F.expr("interval 3 months"))
    return F.transform(starts, quarter_key)


def quarter_overlap_filter(quarters: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Quarters whose approximate span meets the request; the span ends with the first day of the last
    month, in the fourth quarter with 31 December."""
    year = F.substring("quarter", 1, 4).cast("int")
    q = F.substring("quarter", -1, 1).cast("int")
    opens = F.make_date(year, (q - 1) * 3 + 1, F.lit(1))
    closes = F.when(q < 4, F.make_date(year, q * 3, F.lit(1))).otherwise(
        F.make_date(year, F.lit(12), F.lit(31))
    )
    if start is not None:
        quarters = quarters.where(closes >= F.lit(start).cast("date"))
    if end is not None:
        quarters = quarters.where(opens <= F.lit(end).cast("date"))
    return quarters
