"""Feature stages: category indexing, one-hot, assembling, scaling, the full pipeline.

Multi-column ``StringIndexer``/``OneHotEncoder`` fit all categorical columns
in one pass instead of one job per column.  Fitting aggregates (value counts,
column moments) with tree-aggregation; transforming is row-local.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanflow.schema import CATEGORICAL_FEATURES, LABEL, NUMERIC_FEATURES, WEIGHT, existing
from loanflow.operators.split import SPLIT
from loanflow.sources.files import stage_table


def indexer(cols) -> StringIndexer:
    """Frequency order (ties alphabetical); NULL/unseen -> index n_labels."""
    return StringIndexer(inputCols=list(cols), outputCols=[f"{c}_idx" for c in cols],
                         handleInvalid="keep", stringOrderType="frequencyDesc")


def fit_index(df: DataFrame, cols):
    return indexer(cols).fit(df)


def index_categories(df: DataFrame, cols) -> DataFrame:
    return fit_index(df, cols).transform(df)


def label_ranks(df: DataFrame, cols) -> DataFrame:
    """Stored (column_name, value, n, idx): the labels of every column, ranked by frequency (ties alphabetical), as a table.

    The same indexes as ``fit_index`` (text is ordered by its bytes), but the labels never visit the driver.  All
    columns are counted in one scan.  The counted labels are dealt by range of (column, frequency, label), so each task
    holds a bounded run of the order however many labels share a frequency; a label's index is its place in its
    task plus the column's labels in the tasks before, from a table of one row per task and column.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols])
    counts = df.select(F.inline(pairs)).where("value IS NOT NULL").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    # stored with its task number: a rerun could draw the borders anew
    dealt = stage_table(counts.repartitionByRange("column_name", F.desc("n"), "value").withColumn("task", F.spark_partition_id()), "label-counts")
    before = Window.partitionBy("column_name").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("column_name", "task").agg(F.count(F.lit(1)).alias("labels"))
    offsets = offsets.select("column_name", "task", F.coalesce(F.sum("labels").over(before), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy("column_name", "task").orderBy(F.desc("n"), "value"))
    ranked = dealt.withColumn("place", place).join(offsets, ["column_name", "task"])
    return stage_table(ranked.select("column_name", "value", "n", (F.col("first") + F.col("place") - 1).cast("double").alias("idx")), "label-ranks")


def index_by_table(df: DataFrame, cols, ranks: DataFrame) -> DataFrame:
    """Add ``<c>_idx`` from a table of ``label_ranks``; NULL and unseen labels get the number of labels, as ``index_categories`` gives them.

    One join per column on the label.  Spark broadcasts a small column's labels by their size; a large one is shuffled, and
    adaptive execution splits a hot label.
    """
    sizes = {r["column_name"]: r["size"] for r in ranks.groupBy("column_name").agg(F.count(F.lit(1)).alias("size")).collect()}
    out = df
    for c in cols:
        labels = ranks.where(F.col("column_name") == c).select(F.col("value").alias(f"_{c}_label"), F.col("idx").alias(f"_{c}_found"))
        out = out.join(labels, F.col(c).cast("string") == F.col(f"_{c}_label"), "left")
        out = out.withColumn(f"{c}_idx", F.coalesce(f"_{c}_found", F.lit(float(sizes.get(c, 0))))).drop(f"_{c}_label", f"_{c}_found")
    return out


def encoder(cols) -> OneHotEncoder:
    """Index -> sparse one-hot of size n_labels (the 'keep' slot is dropped: unseen = all zeros)."""
    return OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_ohe" for c in cols])


def one_hot(df: DataFrame, cols) -> DataFrame:
    """``<c>_idx`` columns -> ``<c>_ohe`` vectors."""
    return encoder(cols).fit(df).transform(df)


def assembler(cols, out: str) -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep")


def assemble(df: DataFrame, cols, out: str) -> DataFrame:
    """Columns -> one vector; NULL kept as NaN."""
    return assembler(cols, out).transform(df)


def scaler(vec_col: str, out: str) -> StandardScaler:
    return StandardScaler(inputCol=vec_col, outputCol=out, withMean=True, withStd=True)


def scale(df: DataFrame, vec_col: str, out: str) -> DataFrame:
    """z-score with mean and sample standard deviation; zero-variance slots -> 0."""
    return scaler(vec_col, out).fit(df).transform(df)


def feature_pipeline(numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES) -> Pipeline:
    """index -> one-hot -> assemble numeric -> scale -> assemble all into ``features``."""
    numeric, categorical = list(numeric), list(categorical)
    stages = []
    if categorical:
        stages += [indexer(categorical), encoder(categorical)]
    stages += [assembler(numeric, "numeric_vec"), scaler("numeric_vec", "numeric_scaled"),
               assembler(["numeric_scaled"] + [f"{c}_ohe" for c in categorical], "features")]
    return Pipeline(stages=stages)


def featurize(df: DataFrame, fit_on: str = "train", split: str = SPLIT, keep=(LABEL, WEIGHT)):
    """Fit the feature pipeline and transform every row; returns (frame, PipelineModel).

    ``fit_on='train'`` fits on rows whose ``split`` is 'train' (no test statistics leak
    into scaling and indexing); ``fit_on='all'`` fits on every row, as the reference does.
    """
    numeric, categorical = existing(df, NUMERIC_FEATURES), existing(df, CATEGORICAL_FEATURES)
    fit_rows = df.where(F.col(split) == "train") if fit_on == "train" else df
    model = feature_pipeline(numeric, categorical).fit(fit_rows)
    out_cols = ["features"] + [c for c in keep if c in df.columns]
    if split in df.columns:
        out_cols.append(split)
    return model.transform(df).select(*out_cols), model


def as_array(col: str):
    """Vector column -> array<double> (for comparison and export)."""
    return vector_to_array(F.col(col))
