"""Scalar coercions and calendar arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Spellings that mean "no number" (compared in upper case).
NO_NUMBER = ["N/A", "NA", "", "NULL", "NONE"]

# Fixed value: what counts as a written decimal number.
_DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def col(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def null_double() -> Column:
    return F.lit(None).cast("double")


def nan_to_null(c: str | Column) -> Column:
    """Spark aggregates propagate NaN, so measures use NULL for missing."""
    c = col(c)
    return F.when(~F.isnan(c), c)


def to_numeric_or_null(c: str | Column) -> Column:
    text = F.trim(col(c).cast("string"))
    bare = F.regexp_replace(F.lower(text), r"^[+-]", "")
    infinite = bare.isin("inf", "infinity")
    sign = F.when(text.startswith("-"), F.lit(-1.0)).otherwise(F.lit(1.0))
    return F.when(text.rlike(_DECIMAL), text.try_cast("double")).when(
        infinite, sign * F.lit(float("inf"))
    )


def safe_float_default(c: str | Column, default: float = 0.0) -> Column:
    text = col(c).cast("string")
    return F.when(F.upper(text).isin(NO_NUMBER), F.lit(default)).otherwise(
        F.coalesce(to_numeric_or_null(text), F.lit(default))
    )


def pct_to_decimal(c: str | Column) -> Column:
    return col(c) / F.lit(100.0)


def strip_float_suffix(c: str | Column) -> Column:
    return F.regexp_replace(col(c).cast("string"), r"\.0$", "")


def coerce_month_start(c: str | Column) -> Column:
    """First of month from YYYY-MM-DD, YYYYMMDD or YYYYMM; anything else is null."""
    digits = F.replace(col(c).cast("string"), F.lit("-"), F.lit(""))
    day = F.try_to_date(F.substring(digits, 1, 8), "yyyyMMdd")
    month = F.try_to_date(F.concat(F.substring(digits, 1, 6), F.lit("01")), "yyyyMMdd")
    return F.trunc(F.coalesce(F.when(F.length(digits) >= 8, day), month), "MM")


def yyyymm(c: str | Column) -> Column:
    return F.substring(col(c).cast("string"), 1, 6)


def yyyymm_to_month_end(c: str | Column) -> Column:
    return F.last_day(F.try_to_date(F.concat(yyyymm(c), F.lit("01")), "yyyyMMdd"))


def split_composite_key(c: str | Column) -> tuple[Column, Column]:
    parts = F.split(col(c).cast("string"), "[._]")
    return F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2))


def pad_registrant_id(c: str | Column) -> Column:
    return F.lpad(unpad_registrant_id(c), 10, "0")


def unpad_registrant_id(c: str | Column) -> Column:
    return col(c).try_cast("bigint").cast("string")


def month_end_shift(d: str | Column, months: int | Column) -> Column:
    """Month end of the month `months` away; for 0 the date rolls forward to its own month end."""
    return F.last_day(F.add_months(col(d), months))


def quarter_key(d: str | Column) -> Column:
    d = col(d)
    return F.concat(F.year(d).cast("string"), F.lit("q"), F.quarter(d).cast("string"))


def tag_month_offset(tag: str | Column) -> Column:
    """Trailing 1/2/3 of a monthly-return tag counts months back; other tags have no offset."""
    tag = col(tag)
    return (
        F.when(tag.contains("MonthlyReturn1"), F.lit(0))
        .when(tag.contains("MonthlyReturn2"), F.lit(-1))
        .when(tag.contains("MonthlyReturn3"), F.lit(-2))
    )


def months_spanned(first: Column, last: Column) -> Column:
    """Whole calendar months between two dates, ignoring the day."""
    return (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first)


def extreme_return(c: str | Column, limit: float = 0.5) -> Column:
    return F.abs(col(c)) > F.lit(limit)


def document_url_key(cik: Column, accession: Column, primary_doc: Column) -> Column:
    """Archive key of a filing: plain accession and document name without its display prefix."""
    return F.concat_ws(
        "/",
        unpad_registrant_id(cik),
        F.replace(accession, F.lit("-"), F.lit("")),
        F.regexp_replace(primary_doc, r"^xslFormNPORT-P_X01/", ""),
    )
