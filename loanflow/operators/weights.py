"""Class weights: weight(c) = total / (n_classes x count(c))."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanflow.schema import LABEL, WEIGHT
from loanflow.session import materialize
from loanflow.sources.files import stage_table

def class_weights(df: DataFrame, label: str = LABEL, counts: DataFrame | None = None) -> DataFrame:
    """(label, count, weight) per class.

    One grouped aggregate, checkpointed; total and class count are scalar
    subqueries over that small frame.  Pass ``counts`` (label, count) to reuse
    counts that are already computed.
    """
    if counts is None:
        counts = materialize(df.groupBy(label).agg(F.count(F.lit(1)).alias("count")))
    total = counts.select(F.sum("count")).scalar()
    n_classes = counts.select(F.count(F.lit(1))).scalar()
    return counts.withColumn("weight", total.cast("double") / (n_classes * F.col("count")).cast("double"))


def with_class_weight(df: DataFrame, label: str = LABEL, out: str = WEIGHT) -> DataFrame:
    """Attach the class weight to every row, for any number of classes.

    The class table is written first, so Spark knows its size: it broadcasts a small one, and
    for a large one the join's hot labels are split by adaptive execution.
    Rows whose label is NULL get a NULL weight.
    """
    table = stage_table(class_weights(df, label).select(F.col(label).alias("_class"), F.col("weight").alias(out)), "class-weights")
    joined = df.drop(out).join(table, F.col(label) == F.col("_class"), "left")
    return joined.select(*[c for c in df.columns if c != out], out)


def distinct_pairs(df: DataFrame, cols) -> DataFrame:
    """Distinct combinations of ``cols``, ordered by them."""
    return df.select(*cols).distinct().orderBy(*cols)
