"""Sampling, train/test splitting and EXCEPT DISTINCT.

The default split decides per row from a hash of its key: row-local (no
shuffle, no caching), stable under task retries and re-runs, disjoint and
complete.  The reference's own split (Bernoulli sample per label, then
``subtract``) is kept as ``sample_and_subtract`` for parity; it depends on
partitioning and loses rows equal to a train row (EXCEPT is DISTINCT).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanflow.schema import LABEL

SPLIT = "split"


def hash_share(key: Column, seed: int = 42) -> Column:
    """The first 32 bits of md5('<seed>:<key>'), as a long from 0 to 2^32 - 1."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def hash_split(df: DataFrame, key: str, frac: float = 0.8, seed: int = 42, out: str = SPLIT) -> DataFrame:
    """Add ``out`` = 'train' for about ``frac`` of the keys, else 'test'.  ``frac`` counts in steps of 2^-32; a NULL key has no hash and goes to 'test'."""
    return df.withColumn(out, F.when(hash_share(F.col(key), seed) < F.lit(int(round(frac * 2**32))), "train").otherwise("test"))


def split_report(df: DataFrame, split: str = SPLIT, label: str = LABEL) -> DataFrame:
    """Rows per (split, label): one grouped aggregate for both sets."""
    return df.groupBy(split, label).agg(F.count(F.lit(1)).alias("count")).orderBy(split, label)


def except_distinct(df: DataFrame, other: DataFrame) -> DataFrame:
    """Distinct rows of ``df`` that are not in ``other`` (null-safe), i.e. EXCEPT DISTINCT.

    Same result as ``df.subtract(other)``, planned as one aggregation: both sides
    are tagged, unioned and grouped by every column (grouping is NULL-safe and
    normalises NaN / -0.0 as EXCEPT does).  One shuffle instead of a join's two
    plus a distinct, and the map-side partial aggregate collapses copies of a
    hot row before anything moves.
    """
    cols = df.columns
    left = df.select(*cols, F.lit(1).alias("_in_left"), F.lit(0).alias("_in_right"))
    right = other.select(*cols, F.lit(0).alias("_in_left"), F.lit(1).alias("_in_right"))
    seen = left.unionByName(right).groupBy(*cols).agg(F.max("_in_left").alias("_l"), F.max("_in_right").alias("_r"))
    return seen.where((F.col("_l") == 1) & (F.col("_r") == 0)).select(*cols)


def stratified_sample(df: DataFrame, col: str = LABEL, fractions=None, seed: int = 42) -> DataFrame:
    """Bernoulli sample with a fraction per value of ``col`` (result depends on partitioning)."""
    return df.sampleBy(col, fractions or {0: 0.8, 1: 0.8}, seed)


def uniform_sample(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Bernoulli sample of the rows; for previews, never inside a metric."""
    return df.sample(fraction=fraction, seed=seed)


def sample_and_subtract(df: DataFrame, col: str = LABEL, fractions=None, seed: int = 42):
    """The reference's split: train = sampleBy, test = df EXCEPT DISTINCT train.

    ``train`` is checkpointed to the shared checkpoint folder so ``test`` sees
    exactly the same sample even when a lost executor forces a recompute.
    """
    from loanflow.session import checkpoint_root

    checkpoint_root(df.sparkSession)
    train = stratified_sample(df, col, fractions, seed).checkpoint()
    return train, except_distinct(df, train)
