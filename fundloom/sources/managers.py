"""Manager tenure and fund age of registrants from the text of their latest prospectus."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fundloom.functions import text as T
from fundloom.functions.scalars import pad_registrant_id


def manager_records(registrants: DataFrame, documents: DataFrame) -> DataFrame:
    """A row for each series and class of a registrant that has a document: cik, series_id, class_id, manager_tenure,
    fund_age, inception_date, asof and record, as the panel job takes them.

    `registrants` has cik, series_ids and class_ids (empty or null lists count as one unknown entry), `documents` has
    cik, filing_date, accession and body. A registrant's latest document counts, by filing date, then accession. What
    its text does not tell is null. `record` orders the rows of a registrant. Texts are read where they lie; only what
    is found in them is shuffled.
    """
    started = T.inception_date("body")
    found = documents.select(
        pad_registrant_id("cik").alias("cik"),
        "filing_date",
        "accession",
        T.manager_tenure("body", "filing_date").alias("manager_tenure"),
        started.alias("inception_date"),
    )
    facts = F.struct("manager_tenure", "inception_date", F.col("filing_date").alias("asof"))
    latest = found.where(F.col("filing_date").isNotNull()).groupBy("cik").agg(
        F.max_by(facts, F.struct("filing_date", "accession")).alias("f")
    )
    listed = registrants.select(pad_registrant_id("cik").alias("cik"), "series_ids", "class_ids")
    rows = listed.join(latest, "cik").select("cik", F.posexplode_outer("series_ids").alias("_s", "series_id"), "class_ids", "f.*")
    rows = rows.select(
        "cik", "series_id", F.posexplode_outer("class_ids").alias("_c", "class_id"), "_s",
        "manager_tenure", "inception_date", "asof",
    )
    record = F.struct(F.coalesce("_s", F.lit(0)).alias("series"), F.coalesce("_c", F.lit(0)).alias("class"))
    return rows.select(
        "cik", "series_id", "class_id", "manager_tenure",
        T.fund_age_years(F.col("asof"), F.col("inception_date")).alias("fund_age"),
        "inception_date", "asof", record.alias("record"),
    )
