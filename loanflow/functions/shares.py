"""Percent-of-total columns without a cross join or a one-partition window.

The total is a scalar subquery (``DataFrame.scalar()``): Spark runs it once as
its own small job and substitutes the value, so the grouped rows never move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percent(part: Column, total: Column, digits: int = 6) -> Column:
    """part / total * 100, 0 when the total is 0 or NULL."""
    return F.round(F.coalesce(F.try_divide(part.cast("double") * F.lit(100.0), total.cast("double")), F.lit(0.0)), digits)


def with_share(counts: DataFrame, count_col: str = "count", out: str = "pct", total: Column | None = None) -> DataFrame:
    """Add ``out`` = count / total * 100. ``total`` defaults to the sum of ``count_col`` over the frame."""
    if total is None:
        total = counts.select(F.sum(count_col)).scalar()
    return counts.withColumn(out, percent(F.col(count_col), total))


def row_total(df: DataFrame) -> Column:
    """Row count of ``df`` as a scalar-subquery column."""
    return df.select(F.count(F.lit(1))).scalar()
