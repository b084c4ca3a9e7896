"""Derived and conditional columns: risk flags, guarded ratio, label, audit stamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanflow.schema import (
    CHARGED_OFF_TEXT,
    DEFAULT_STATUSES,
    HIGH_RISK_GRADES,
    LABEL,
    PROCESSING_TS,
)


def fico_average(low: Column, high: Column) -> Column:
    return (low + high) / F.lit(2)


def guarded_ratio(num: Column, den: Column) -> Column:
    """num / den only where den > 0; NULL for zero, negative or NULL den (the guard runs before the division)."""
    return F.when(den > 0, num / den)


def high_risk(grade: Column) -> Column:
    """grade in D..G; never NULL."""
    return F.coalesce(grade.isin(*HIGH_RISK_GRADES), F.lit(False))


def charged_off(status: Column) -> Column:
    """status contains 'Charged Off'; never NULL."""
    return F.coalesce(status.contains(CHARGED_OFF_TEXT), F.lit(False))


def default_label(status: Column) -> Column:
    """1 for the three default statuses, else 0 (NULL and in-progress loans included)."""
    return F.when(status.isin(*DEFAULT_STATUSES), F.lit(1)).otherwise(F.lit(0))


def with_derived(df: DataFrame) -> DataFrame:
    """fico_avg, loan_to_income_ratio, is_high_risk, is_charged_off in one projection."""
    return df.withColumns({
        "fico_avg": fico_average(F.col("fico_range_low"), F.col("fico_range_high")),
        "loan_to_income_ratio": guarded_ratio(F.col("loan_amnt"), F.col("annual_inc")),
        "is_high_risk": high_risk(F.col("grade")),
        "is_charged_off": charged_off(F.col("loan_status")),
    })


def with_processing_time(df: DataFrame) -> DataFrame:
    """Audit stamp; constant within one query / one micro-batch."""
    return df.withColumn(PROCESSING_TS, F.current_timestamp())


def with_label(df: DataFrame, status: str = "loan_status") -> DataFrame:
    return df.withColumn(LABEL, default_label(F.col(status)))
