"""Regular-expression extraction over document text.

The patterns use Unicode character classes, as the texts come in several languages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from fundloom.functions.scalars import col

# Phrases that date a manager's start.
TENURE_PATTERNS = [
    r"(?:since|Since)\s+(\d{4})",
    r"has\s+(?:managed|been\s+(?:managing|the\s+portfolio\s+manager))[^.]{0,100}since\s+(?:\w+\s+)?(\d{4})",
    r"Portfolio\s+Manager[^.]{0,50}since\s+(?:\w+\s+)?(\d{4})",
    r"joined[^.]{0,100}(?:in|since)\s+(?:\w+\s+)?(\d{4})",
    r"appointed[^.]{0,100}(?:in|since)\s+(?:\w+\s+)?(\d{4})",
]
EARLIEST_START = 1970

# Phrases that date a fund's start, in order of preference.
INCEPTION_PATTERNS = [
    r"commenced\s+operations[^.]{0,50}(?:on|in)\s+(\w+\s+\d{1,2},?\s+\d{4})",
    r"inception[^:]{0,20}:?\s*(\w+\s+\d{1,2},?\s+\d{4})",
    r"established[^.]{0,50}(?:on|in)?\s+(\w+\s+\d{1,2},?\s+\d{4})",
    r"(?:fund|portfolio)\s+began\s+operations[^.]{0,50}(\w+\s+\d{1,2},?\s+\d{4})",
]
INCEPTION_FORMATS = ["MMMM d yyyy", "MMM d yyyy"]

# Prospectus phrases for expense ratios, turnover and share classes.
EXPENSE_PATTERNS = [
    r"(?i)(?:net\s+)?expense\s+ratio.*?(\d+\.\d{1,3})%",
    r"(?i)annual\s+fund\s+operating\s+expenses.*?(\d+\.\d{1,3})%",
    r"(?i)total\s+annual\s+fund\s+operating\s+expenses.*?(\d+\.\d{1,3})%",
]
TURNOVER_PATTERNS = [
    r"(?i)portfolio\s+turnover\s+rate.*?(\d+)%",
    r"(?i)turnover\s+rate.*?(\d+)%",
]
CLASS_PATTERNS = [
    r"\b([A-Z]{4,5}X?)\)",
    r"Fund\s+([A-Z]+)\s+Shares",
    r"([A-Z]+)\s+Shares",
    r"Class\s+([A-Z]+)",
]
CLASS_LENGTHS = (2, 6)

# Single-number phrases used when no tagged fact was found.
FALLBACK_EXPENSE = r"net\s+expense\s+ratio[^%\d]{0,40}(\d+(?:\.\d+)?)\s*%"
FALLBACK_TURNOVER = r"portfolio\s+turnover[^%\d]{0,40}(\d+(?:\.\d+)?)\s*%"

_UNICODE = "(?U)"
_ANY_CASE = "(?Ui)"


def find_all(c: Column, pattern: str, flags: str = _UNICODE, group: int = 1) -> Column:
    return F.regexp_extract_all(c, F.lit(flags + pattern), group)


def find_first(c: Column, pattern: str, flags: str = _UNICODE) -> Column:
    """First captured group, null when there is no match."""
    found = F.regexp_extract(c, flags + pattern, 1)
    return F.when(found != "", found)


def percent_from_text(c: str | Column) -> Column:
    """'N bps' to N/10000, else 'N %' to N/100, else a bare N as it is below 1 and N/100 from there."""
    text = F.trim(col(c))
    number = r"(\d+(?:\.\d+)?)"
    points = find_first(text, number + r"\s*bps", _ANY_CASE).try_cast("double")
    percent = find_first(text, number + r"\s*%").try_cast("double")
    bare = find_first(text, number).try_cast("double")
    return F.coalesce(
        points / 10000.0,
        percent / 100.0,
        F.when(bare < 1.0, bare).otherwise(bare / 100.0),
    )


def manager_tenure(text: str | Column, filing_date: str | Column) -> Column:
    """Years from the latest plausible start year to the filing year; null without one."""
    filed = F.year(col(filing_date))
    years = F.concat(*[find_all(col(text), p, _ANY_CASE) for p in TENURE_PATTERNS])
    plausible = F.filter(
        F.transform(years, lambda y: y.try_cast("int")),
        lambda y: y.between(F.lit(EARLIEST_START), filed),
    )
    return (filed - F.array_max(plausible)).cast("double")


def inception_date(text: str | Column) -> Column:
    """First mention, pattern after pattern, that is a readable month, day and year."""
    mentions = F.concat(*[find_all(col(text), p, _ANY_CASE) for p in INCEPTION_PATTERNS])

    def readable(m: Column) -> Column:
        plain = F.initcap(F.regexp_replace(F.replace(m, F.lit(","), F.lit("")), r"\s+", " "))
        return F.coalesce(*[F.try_to_date(plain, f) for f in INCEPTION_FORMATS])

    dates = F.filter(F.transform(mentions, readable), lambda d: d.isNotNull())
    return F.try_element_at(dates, F.lit(1))


def fund_age_years(filing_date: Column, inception: Column) -> Column:
    return F.datediff(filing_date, inception) / F.lit(365.25)


# The substrings by which a document's kind is told.
def is_html(c: str | Column) -> Column:
    c = col(c)
    return F.lower(c).contains("<html>") | c.contains("<TYPE>")


def is_xbrl(c: str | Column) -> Column:
    c = col(c)
    return F.lower(c).contains("xbrl") | c.contains("contextRef")


def _percents(text: Column, patterns: Sequence[str]) -> Column:
    found = F.concat(*[find_all(text, p) for p in patterns])
    return F.transform(found, lambda v: v.try_cast("double") / 100.0)


def share_classes(text: str | Column) -> Column:
    """Share-class tokens of a prospectus in order of first appearance, pattern after pattern."""
    low, high = CLASS_LENGTHS
    named = F.concat(*[find_all(col(text), p) for p in CLASS_PATTERNS])
    return F.array_distinct(F.filter(named, lambda m: F.length(m).between(low, high)))


def expense_ratios(text: str | Column) -> Column:
    return _percents(col(text), EXPENSE_PATTERNS)


def turnover_rates(text: str | Column) -> Column:
    return _percents(col(text), TURNOVER_PATTERNS)


def prospectus_records(classes: Column, ratios: Column, turns: Column, most: int | None = None) -> Column:
    """Array of (class_id, context_ref, net_expense_ratio, turnover_pct) from what a prospectus names.

    As many classes as ratios are paired by position; otherwise the first ratio and turnover are given to
    every class, or to the first `most`. The arguments should be plain columns, as each is used for every class.
    """
    paired = F.size(classes) == F.size(ratios)

    def record(name: Column, at: Column) -> Column:
        return F.struct(
            name.alias("class_id"),
            F.when(paired, F.concat(F.lit("html_class_"), at.cast("string")))
            .otherwise(F.lit("html_fund_level"))
            .alias("context_ref"),
            F.get(ratios, F.when(paired, at).otherwise(F.lit(0))).alias("net_expense_ratio"),
            F.get(turns, F.when(paired, at).otherwise(F.lit(0))).alias("turnover_pct"),
        )

    chosen = classes if most is None else F.when(paired, classes).otherwise(F.slice(classes, 1, most))
    has_values = (F.size(ratios) > 0) | (F.size(turns) > 0)
    return F.when(has_values, F.transform(chosen, record))
