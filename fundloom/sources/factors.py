"""Factor text files to a monthly factor panel. A file holds one line per calendar month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fundloom.functions.scalars import pct_to_decimal, to_numeric_or_null, yyyymm_to_month_end

FIVE = ["MKT_RF", "SMB", "HML", "RMW", "CMA", "RF"]
MONTHLY = [*FIVE, "MOM"]
# Column titles that differ from our names, and the line that ends the monthly part.
TITLES = {"MKT_RF": "Mkt-RF", "MOM": "Mom"}
END_OF_MONTHS = "Annual Factors:"
MISSING = [-99.99, -999.0]


def scan_factor_text(spark: SparkSession, path: str, factors: Sequence[str]) -> DataFrame:
    """Month end and percent values of the named factors.

    The monthly part starts at the first line whose trimmed first six characters are digits and ends before
    the annual part; the header is the first line that has the title of the first factor as one of its
    comma-separated fields. A title that the header lacks fails the job.
    """
    title = TITLES.get(factors[0], factors[0])
    lines = F.split("value", r"\r?\n")
    numbered = spark.read.text(path, wholetext=True).select(lines.alias("lines"))

    def first_at(test) -> Column:
        return F.array_position(F.transform("lines", lambda x: F.coalesce(test(x), F.lit(False))), True)

    starts = first_at(lambda x: F.substring(F.trim(x), 1, 6).rlike(r"^\d{1,6}$"))
    def fields(line: Column) -> Column:
        return F.transform(F.split(line, ","), lambda t: F.replace(F.trim(t), F.lit(" "), F.lit("")))

    def is_header(line: Column) -> Column:
        return line.contains(",") & F.array_contains(fields(line), title)

    header = F.get(F.filter("lines", is_header), F.lit(0))
    monthly = numbered.select(
        fields(header).alias("titles"),
        F.slice("lines", starts.cast("int"), F.size("lines")).alias("lines"),
    )
    ends = first_at(lambda x: F.trim(x).startswith(END_OF_MONTHS))
    part = F.when(ends > 0, F.slice("lines", 1, ends.cast("int") - 1)).otherwise(F.col("lines"))
    rows = monthly.select("titles", F.explode(part).alias("line")).select(
        "titles", F.split("line", ",").alias("v")
    )

    def value(name: str) -> Column:
        wanted = TITLES.get(name, name)
        at = F.coalesce(F.array_position("titles", wanted), F.lit(0))
        missing = F.raise_error(F.lit(f"no column {wanted} in the factor file")).cast("string")
        return to_numeric_or_null(F.when(at > 0, F.try_element_at("v", at.cast("int"))).otherwise(missing))

    return rows.select(
        yyyymm_to_month_end(F.trim(F.col("v")[0])).alias("month_end"),
        *[value(f).alias(f) for f in factors],
    ).where(F.col("month_end").isNotNull())


def build_factor_panel(five: DataFrame, momentum: DataFrame, missing_to_null: bool = False) -> DataFrame:
    """Five factors left-joined with momentum, as fractions."""
    panel = five.join(F.broadcast(momentum.select("month_end", "MOM")), "month_end", "left")

    def fraction(c: str) -> Column:
        known = F.when(~F.col(c).isin(MISSING), F.col(c)) if missing_to_null else F.col(c)
        return pct_to_decimal(known)

    return panel.withColumns({c: fraction(c) for c in MONTHLY})


def factor_file_text(factors: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The published text form of a factor series: one line per month below a header, in one row."""
    titles = ",".join(["", *[TITLES.get(c, c) for c in columns]])
    line = F.concat_ws(
        ",",
        F.date_format("month_end", "yyyyMM"),
        *[F.format_string("%.8f", F.coalesce(F.col(c) * 100, F.lit(MISSING[0]))) for c in columns],
    )
    named = " and ".join(TITLES.get(c, c) for c in columns)
    intro = [f"Monthly returns in percent, the {named} factors among them (Momentum is Mom).", "", titles]
    tail = ["", f" {END_OF_MONTHS} January-December", titles, "  1995,1.00", "  1996,2.00"]
    listed = F.sort_array(F.collect_list(line))
    text = F.concat(F.array(*[F.lit(x) for x in intro]), listed, F.array(*[F.lit(x) for x in tail]))
    return factors.agg(F.array_join(text, "\n").alias("value"))
