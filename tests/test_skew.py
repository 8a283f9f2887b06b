"""Keys that hold a third of all rows give the same results as small ones."""

import datetime as dt

from pyspark.sql import functions as F

from fundloom.operators import dedup, profile
from fundloom.sources import readers


def skewed(spark, n=30000):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500))
    return spark.range(n).select(
        F.lit("0000000001").alias("cik"),
        key.alias("class_id"),
        F.lit(dt.date(2000, 1, 31)).alias("month_end"),
        F.date_add(F.lit(dt.date(2000, 1, 1)), (F.col("id") % 97).cast("int")).alias("filing_date"),
        F.col("id").alias("accession"),
        (F.col("id") % 11).cast("double").alias("return"),
    )


def test_latest_filing_of_a_hot_key(spark):
    rows = skewed(spark).toPandas().sort_values(["filing_date", "accession"]).groupby("class_id").last()
    got = dedup.dedup_latest_filing(skewed(spark)).toPandas().set_index("class_id")
    assert len(got) == len(rows)
    assert got.accession.to_dict() == rows.accession.to_dict()


def test_duplicate_report_and_discrepancies_count_every_row(spark):
    assert dedup.duplicate_summary(skewed(spark)).first()["max_multiplicity"] == 10000
    hot = dedup.restatement_discrepancies(skewed(spark)).where("class_id = 'hot'").first()
    assert (hot["n_filings"], hot["n_values"], hot["spread"]) == (10000, 11, 10.0)


def test_top_values_see_the_hot_value_once(spark):
    got = profile.top_values(skewed(spark).select("class_id"), 3).orderBy("place").collect()
    assert (got[0]["value"], got[0]["n"], len(got)) == ("hot", 10000, 3)


def test_nan_measures_become_null_at_ingest(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(3).select(F.when(F.col("id") == 1, F.lit(float("nan"))).otherwise(1.0).alias("x"), "id").write.parquet(path)
    out = readers.scan_parquet_projected(spark, path, ["x"])
    assert out.columns == ["x"] and out.agg(F.avg("x")).first()[0] == 1.0
