"""Schema-driven column selection (drop lists, feature whitelists, type lookups, previews)."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from loanflow.schema import (
    CATEGORICAL_FEATURES,
    GOLD_DROP_COLUMNS,
    LABEL,
    LEAKAGE_COLUMNS,
    NUMERIC_FEATURES,
    existing,
)


def drop_existing(df: DataFrame, columns, keep=()) -> DataFrame:
    """Drop the listed columns that exist (missing names are ignored), except those in ``keep``."""
    return df.drop(*[c for c in existing(df, columns) if c not in set(keep)])


def drop_sparse_columns(df: DataFrame, keep=()) -> DataFrame:
    return drop_existing(df, GOLD_DROP_COLUMNS, keep)


def drop_leakage_columns(df: DataFrame, keep=()) -> DataFrame:
    return drop_existing(df, LEAKAGE_COLUMNS, keep)


def select_features(df: DataFrame, numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES,
                    label: str = LABEL, keep=()) -> DataFrame:
    """Existing numeric features, then categorical ones, in list order, then the label (and ``keep`` columns first)."""
    cols = [c for c in keep if c in df.columns] + existing(df, numeric) + existing(df, categorical) + [label]
    return df.select(*cols)


def columns_of(df: DataFrame, kind) -> list[str]:
    """Names of the columns whose type is an instance of ``kind`` (e.g. NumericType, StringType)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kind)]


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_of(df, NumericType)


def string_columns(df: DataFrame) -> list[str]:
    return columns_of(df, StringType)


def type_name(dt) -> str:
    """Short type name: DoubleType() -> 'Double'."""
    return type(dt).__name__.removesuffix("Type")


def schema_profile(df: DataFrame) -> DataFrame:
    """Columns per data type, most frequent first (metadata only: no data is read)."""
    counts = Counter(type_name(f.dataType) for f in df.schema.fields)
    rows = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))
    spark = df.sparkSession
    return spark.createDataFrame(rows, "data_type string, n_columns long")


def first_existing(df: DataFrame, names) -> str | None:
    """First name of ``names`` present in the frame, or None."""
    return next((c for c in names if c in df.columns), None)


def preview(df: DataFrame, columns, n: int, order_by=None) -> DataFrame:
    """First ``n`` rows of the preferred columns that exist (first six columns if none do).

    With ``order_by`` the rows are the first ``n`` in that order (a distributed top-k),
    which makes the preview deterministic.
    """
    cols = existing(df, columns) or df.columns[:6]
    out = df
    if order_by is not None:
        keys = [order_by] if isinstance(order_by, str) else list(order_by)
        out = out.orderBy(*[F.col(k).asc_nulls_last() for k in keys])
    return out.select(*cols).limit(n)
