"""Null handling and null/balance profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanflow.functions.shares import percent
from loanflow.operators.columns import numeric_columns, string_columns
from loanflow.schema import IMBALANCE_RATIO, LABEL, NULL_HIGH_PCT, NUMERIC_FILL, STRING_FILL


def fill_numeric(df: DataFrame, value=NUMERIC_FILL, subset=None) -> DataFrame:
    """NULL and NaN -> ``value`` in all numeric columns (``na.fill`` replaces NaN too)."""
    cols = numeric_columns(df) if subset is None else subset
    return df.na.fill(value, subset=cols) if cols else df


def fill_string(df: DataFrame, value: str = STRING_FILL, subset=None) -> DataFrame:
    """NULL -> ``value`` in all string columns."""
    cols = string_columns(df) if subset is None else subset
    return df.na.fill(value, subset=cols) if cols else df


def null_counts(df: DataFrame, columns) -> DataFrame:
    """Wide form: one row, one null count per column, plus the row count ``n_rows``; a single scan."""
    aggs = [F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in columns]
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *aggs)


def null_profile(df: DataFrame, columns) -> DataFrame:
    """Long form per column: null_count, null_pct and severity ('high' > 5 %, 'low' > 0, else 'clean')."""
    wide = null_counts(df, columns)
    long = wide.unpivot("n_rows", list(columns), "column_name", "null_count")
    pct = percent(F.col("null_count"), F.col("n_rows"))
    return long.select(
        "column_name",
        F.col("null_count").cast("long").alias("null_count"),
        pct.alias("null_pct"),
        F.when(pct > NULL_HIGH_PCT, "high").when(pct > 0, "low").otherwise("clean").alias("severity"),
    )


def class_balance(df: DataFrame, label: str = LABEL, ratio_limit: float = IMBALANCE_RATIO) -> DataFrame:
    """One row: n0, n1, ratio n0/n1 (NULL if n1 = 0) and whether ratio > limit or < 1/limit."""
    agg = df.agg(
        F.count(F.when(F.col(label) == 0, F.lit(1))).alias("n0"),
        F.count(F.when(F.col(label) == 1, F.lit(1))).alias("n1"),
    )
    ratio = F.try_divide(F.col("n0").cast("double"), F.col("n1").cast("double"))
    return agg.select(
        "n0", "n1", F.round(ratio, 6).alias("ratio"),
        F.coalesce((ratio > ratio_limit) | (ratio < 1.0 / ratio_limit), F.lit(False)).alias("imbalanced"),
    )
