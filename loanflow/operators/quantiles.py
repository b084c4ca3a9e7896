"""Exact quantiles (linear interpolation), quantile clipping and equal-width histograms.

Spark's exact ``percentile`` buffers every value of a group in one task; here
values are first collapsed to (value, count), then ranked with the bucketed
running total of ``loanflow.operators.ordered``, and the two neighbours of each
rank are picked in a single aggregate.  Same definition as pandas'
``quantile`` (linear) and DuckDB's ``quantile_cont``: h = (n - 1) p,
q = x[floor h] + (h - floor h) (x[ceil h] - x[floor h]).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanflow.operators.ordered import running_totals
from loanflow.session import materialize


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(v, n): each distinct non-NULL, non-NaN value of ``col`` as a double with its row count, checkpointed.

    Map-side combined, so a value that holds a third of all rows is one row per
    partition before the shuffle.  Quantiles and histograms both read this frame.
    """
    v = F.col(col).cast("double")
    values = df.select(v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    return materialize(values.groupBy("v").agg(F.count(F.lit(1)).alias("n")))


def quantile_frame(df: DataFrame | None, col: str, probs, names=None, n_buckets: int | None = None,
                   counts: DataFrame | None = None) -> DataFrame:
    """One row, one column per probability: the exact linear-interpolated quantiles of the non-NULL values.

    Pass ``counts`` (from ``value_counts``) to reuse value counts already computed.
    """
    names = list(names or [f"q{i}" for i in range(len(probs))])
    distinct = counts if counts is not None else value_counts(df, col)
    cum = running_totals(distinct, "v", ["n"], n_buckets=n_buckets)
    total = distinct.select(F.sum("n")).scalar()
    aggs = []
    for p, name in zip(probs, names):
        h = (total - F.lit(1)).cast("double") * F.lit(float(p))
        r_lo, r_hi = F.floor(h), F.ceil(h)
        start, end = F.col("cum_n") - F.col("n"), F.col("cum_n")  # ranks [start, end)

        def at(r: Column) -> Column:
            return F.max(F.when((start <= r) & (r < end), F.col("v")))

        aggs += [at(r_lo).alias(f"{name}__lo"), at(r_hi).alias(f"{name}__hi"), F.max(h - r_lo).alias(f"{name}__f")]
    picked = cum.agg(*aggs)
    return picked.select(*[
        (F.col(f"{n}__lo") + F.col(f"{n}__f") * (F.col(f"{n}__hi") - F.col(f"{n}__lo"))).alias(n) for n in names
    ])


def quantile_bounds(df: DataFrame | None, col: str, lo: float = 0.01, hi: float = 0.99,
                    counts: DataFrame | None = None) -> tuple[Column, Column]:
    """(q_lo, q_hi) as literal columns.

    The bounds are one row of two doubles, fetched with one small job; using
    them as literals keeps the full input plan out of every later expression
    (a scalar subquery would re-plan it at each use).
    """
    src = None if counts is not None else df.select(col)
    row = quantile_frame(src, col, [lo, hi], ["q_lo", "q_hi"], counts=counts).first()
    if row is None or row["q_lo"] is None:
        return F.lit(None).cast("double"), F.lit(None).cast("double")
    return F.lit(float(row["q_lo"])), F.lit(float(row["q_hi"]))


def clip_quantiles(df: DataFrame, col: str, lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """Rows whose non-NULL ``col`` lies within [q_lo, q_hi]."""
    q_lo, q_hi = quantile_bounds(df, col, lo, hi)
    x = F.col(col).cast("double")
    return df.where(x.isNotNull() & ~F.isnan(x) & (x >= q_lo) & (x <= q_hi))


def histogram(df: DataFrame, col: str, bins: int = 40, lo: float = 0.01, hi: float = 0.99,
              digits: int = 6) -> DataFrame:
    """Equal-width histogram of ``col`` over its [q_lo, q_hi] range: (bin, bin_lo, bin_hi, count), all bins.

    Full data, not a sample.  The input is read once: its (value, count) table
    gives both the exact quantile bounds and the bin counts (a bin's count is the
    sum of the counts of the distinct values in it).
    """
    counts = value_counts(df, col)
    q_lo, q_hi = quantile_bounds(None, col, lo, hi, counts=counts)
    width = (q_hi - q_lo) / F.lit(float(bins))
    x = F.col("v")
    kept = counts.where((x >= q_lo) & (x <= q_hi))
    idx = F.when(width > 0, F.least(F.floor((x - q_lo) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    binned = kept.groupBy(idx.cast("long").alias("bin")).agg(F.sum("n").alias("count"))
    spark = df.sparkSession
    all_bins = spark.range(bins).withColumnRenamed("id", "bin")
    edges = all_bins.select(
        "bin",
        F.round(q_lo + F.col("bin") * width, digits).alias("bin_lo"),
        F.round(q_lo + (F.col("bin") + 1) * width, digits).alias("bin_hi"),
    )
    return (edges.join(binned, "bin", "left")
            .select("bin", "bin_lo", "bin_hi", F.coalesce("count", F.lit(0).cast("long")).alias("count")))
