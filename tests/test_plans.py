"""What the physical plans must look like to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from fundloom.catalog import all_queries
from fundloom.sources import readers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"\bExchange (?:hash|range|round|Single)", plan(df)))


def test_class_windows_share_one_shuffle_and_sort(spark, sf_dir):
    text = plan(all_queries()["panel_flows"](spark, sf_dir))
    assert len(re.findall(r"Exchange hashpartitioning\(class_id", text)) == 1
    assert len(re.findall(r"Sort \[class_id", text)) == 1


def test_panel_job_shuffles_the_panel_by_class_once_for_its_windows(spark, sf_dir):
    text = plan(all_queries()["class_month_panel"](spark, sf_dir))
    windows = re.findall(r"Exchange hashpartitioning\(class_id#\d+, \d+\)", text)
    assert "CartesianProduct" not in text
    assert len(windows) <= 1 + 3  # the windows, and at most one per small side table


def test_scans_prune_columns_and_push_filters(spark, sf_dir):
    text = plan(all_queries()["scan_parquet_projected"](spark, sf_dir))
    assert "l_extendedprice" not in text.split("ReadSchema")[1]
    late = readers.scan_parquet_projected(spark, f"{sf_dir}/lineitem.parquet", ["l_suppkey", "l_shipdate"])
    text = plan(late.where(F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp")))
    assert "GreaterThanOrEqual(l_shipdate" in text


def test_partition_filters_prune_months(spark, sf_dir):
    text = plan(all_queries()["scan_hive_returns"](spark, sf_dir))
    assert re.search(r"PartitionFilters: \[[^\]]*year", text)


def test_top_values_limits_before_the_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in plan(all_queries()["top_values"](spark, sf_dir))


@pytest.mark.parametrize(
    "name", ["coverage_by_fund", "dedup_latest_filing", "rank_and_decile", "top_quantile_weights", "join_factors"]
)
def test_no_all_pairs_joins(spark, sf_dir, name):
    assert "CartesianProduct" not in plan(all_queries()[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["rolling_factor_regression", "class_month_panel"])
def test_windows_are_solved_once(spark, sf_dir, name):
    assert plan(all_queries()[name](spark, sf_dir)).count("ArrowEvalPython") == 1


@pytest.mark.parametrize("name", ["scan_filings_xml_elements", "scan_filings_xml_attributes"])
def test_documents_are_parsed_once(spark, sf_dir, name):
    assert plan(all_queries()[name](spark, sf_dir)).count("ArrowEvalPython") == 1


def test_stored_returns_are_looked_up_by_pushed_filters(spark, sf_dir):
    text = plan(all_queries()["lookup_fund_returns"](spark, sf_dir))
    assert re.search(r"PartitionFilters: \[[^\]]*year", text)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(cik,0000000003\)", text)


@pytest.mark.parametrize(
    "name", ["value_added", "rolling_factor_regression", "join_pred_actual_inner", "merge_returns_prefer_db"]
)
def test_line_items_are_scanned_once(spark, sf_dir, name):
    text = plan(all_queries()[name](spark, sf_dir))
    assert text.count("lineitem.parquet") <= 1


def test_one_fund_is_filtered_in_the_scan(spark, sf_dir):
    text = plan(all_queries()["filter_single_fund"](spark, sf_dir))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(class_id,C000000004\)", text)
