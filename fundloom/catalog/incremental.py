"""The incremental update as a stream of landed files."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundloom.catalog.registry import d, over, query, r
from fundloom.plans import views
from fundloom.session import staging_path
from fundloom.streaming import incremental


@query(
    "incremental_stream",
    over(["filings"], f"""SELECT cik, class_id, {d('month_end')}, {d('filing_date')}, accession, {r('"return"', 'return', 10)}
      FROM filings QUALIFY row_number() OVER (PARTITION BY cik, class_id, filings.month_end
        ORDER BY filings.filing_date DESC, accession DESC) = 1"""),
    digits=10,
)
def incremental_stream(spark, sf):
    """Filings of two priorities land one after the other, and each landing is merged when it is there."""
    filed = views.filings(spark, sf).select(*incremental.COLUMNS, (F.col("position") <= 3).alias("early"))
    landing, root, progress = (staging_path(spark, n) for n in ("landing", "returns_db", "progress"))
    for early in (True, False):
        part = filed.where(F.col("early") if early else ~F.col("early")).drop("early")
        part.write.parquet(f"{landing}/early={early}")
        incremental.stream_quarters(spark, landing, root, progress).awaitTermination()
    db = incremental.read_returns_database(spark, root)
    return db.select("cik", "class_id", "month_end", "filing_date", "accession", "return")
