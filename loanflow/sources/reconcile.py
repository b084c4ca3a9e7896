"""Row-count reconciliation of raw, Bronze and Silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def reconcile_counts(raw, bronze, silver, spark: SparkSession | None = None) -> DataFrame:
    """One row: raw_count, bronze_count, silver_count, consistent.

    Each argument is a DataFrame or an already known row count (for example one
    observed while the data was written).  Frame counts are scalar subqueries,
    so the scans run as independent jobs and nothing is joined.  With three known
    counts the session is asked for.
    """
    frames = [x for x in (raw, bronze, silver) if isinstance(x, DataFrame)]
    if not frames and spark is None:
        raise ValueError("three known counts need the session")

    def count_of(x):
        return x.select(F.count(F.lit(1))).scalar() if isinstance(x, DataFrame) else F.lit(int(x)).cast("long")

    counts = {"raw_count": count_of(raw), "bronze_count": count_of(bronze), "silver_count": count_of(silver)}
    one = (spark or frames[0].sparkSession).range(1)
    out = one.select(*[c.alias(n) for n, c in counts.items()])
    return out.withColumn(
        "consistent",
        (F.col("raw_count") == F.col("bronze_count")) & (F.col("bronze_count") == F.col("silver_count")),
    )
