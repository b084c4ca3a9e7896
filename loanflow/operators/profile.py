"""Single-pass table profiles: shape, distributions, top values, summary statistics.

Scale notes
-----------
* Every grouped count is a HashAggregate with a map-side partial step, so a hot
  value (say a third of all rows) costs one partial row per input partition.
* Grouped counts are computed once and checkpointed (``materialize``); totals
  for shares are scalar subqueries over that small frame, so the source is
  scanned once (no cross join, no global window, no second pass).
* Top-k per column is two-staged: rank within (column, hash bucket of value),
  keep k per bucket, then rank the <= k * buckets survivors per column.  No
  task ever holds all distinct values of a high-cardinality column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanflow.functions.shares import percent, with_share
from loanflow.schema import LABEL, existing
from loanflow.session import materialize

TOPK_BUCKETS = 64


def table_shape(df: DataFrame) -> DataFrame:
    """One row: n_rows and n_columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("long"))


def distribution(df: DataFrame, col: str = LABEL) -> DataFrame:
    """Rows per value of ``col`` with percent of all rows, ordered by value."""
    counts = materialize(df.groupBy(col).agg(F.count(F.lit(1)).alias("count")))
    return with_share(counts).orderBy(col)


def top_values(df: DataFrame, col: str, k: int) -> DataFrame:
    """The ``k`` most frequent values of ``col`` (ties: value ascending) with count and percent.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each partition keeps its k best.
    """
    counts = materialize(df.groupBy(col).agg(F.count(F.lit(1)).alias("count")))
    top = counts.orderBy(F.desc("count"), F.col(col).asc_nulls_first()).limit(k)
    return top.withColumn("pct", percent(F.col("count"), counts.select(F.sum("count")).scalar()))


def _unpivot_text(df: DataFrame, columns) -> DataFrame:
    """(column_name, value) per row and column, values as text; one narrow Expand."""
    cols = list(columns)
    return df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], cols, "column_name", "value")


def topk_bucket_count(df: DataFrame, buckets: int | None = None) -> int:
    """Hash buckets per group for stage 1: at least ``TOPK_BUCKETS``, more on a wider shuffle."""
    if buckets:
        return int(buckets)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    return max(TOPK_BUCKETS, parts)


def top_k_per_group(counts: DataFrame, group: str, value: str, k: int, count_col: str = "count",
                    buckets: int | None = None) -> DataFrame:
    """Top ``k`` rows per ``group`` by count desc, value asc, with ``rank`` 1..k.

    Stage 1 keeps k per (group, hash(value) % buckets); stage 2 ranks the
    survivors per group.  Exact: a global top-k row is top-k in its bucket.
    The bucket count follows the shuffle width, so a column with billions of
    distinct values is spread over as many sort tasks as the cluster runs, and
    stage 2 sees at most k x buckets rows per group.
    """
    buckets = topk_bucket_count(counts, buckets)
    order = [F.desc(count_col), F.col(value).asc_nulls_first()]
    bucket = F.pmod(F.xxhash64(F.col(value)), F.lit(buckets))
    w1 = Window.partitionBy(group, bucket.alias("_b")).orderBy(*order)
    stage1 = counts.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= k).drop("_r")
    w2 = Window.partitionBy(group).orderBy(*order)
    return stage1.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k)


def categorical_profile(df: DataFrame, columns, k: int = 10) -> DataFrame:
    """For each column: its k most frequent values, count and percent of all rows - one scan for all columns."""
    cols = existing(df, columns)
    long = _unpivot_text(df, cols)
    counts = materialize(long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count")))
    # every column's counts add up to the row count
    totals = counts.groupBy("column_name").agg(F.sum("count").alias("_rows"))
    top = top_k_per_group(counts, "column_name", "value", k).join(totals, "column_name")
    return top.withColumn("pct", percent(F.col("count"), F.col("_rows"))).select(
        "column_name", "rank", "value", "count", "pct")


def dominant_values(df: DataFrame, columns) -> DataFrame:
    """Most frequent value of each column and its percent (rank 1 of the categorical profile)."""
    return categorical_profile(df, columns, k=1).drop("rank")


STATS = ("count", "mean", "stddev", "min", "max")


def describe_long(df: DataFrame, columns, digits: int = 6) -> DataFrame:
    """count, mean, sample stddev, min, max per column as typed doubles, long form; one aggregate."""
    cols = existing(df, columns)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).cast("double").alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 *[F.round(F.col(f"{c}__{s}"), digits).alias(s) for s in STATS])
        for c in cols
    ])
    return wide.select(F.inline(rows)).withColumn("count", F.col("count").cast("long"))


def count_by_time(df: DataFrame, col: str) -> DataFrame:
    """Rows per value of a time column, in time order."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(col)
