"""Named queries over the driver's tables: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query builds its input from the given tables (``loanflow.fixtures``), runs
the library operator on all rows, and returns a frame whose columns are
aliased exactly like the DuckDB oracle in ``loanflow.checks.oracles``.  Audit
timestamps (``current_timestamp``) are dropped from compared outputs; vectors
are returned as arrays or scalars.  Queries that write (sinks, streams) use a
fresh folder below the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanflow import fixtures as fx
from loanflow.functions.cleaning import blank_to_null, cast_numeric, parse_month_date, parse_percent
from loanflow.functions.derived import with_derived, with_label
from loanflow.functions.shares import with_share
from loanflow.operators import columns as cols_op
from loanflow.operators import encode, evaluate, nulls, profile, quantiles, split, weights
from loanflow.operators.models import (
    make_classifier,
    top_importances,
    train_and_evaluate,
)
from loanflow.plans.gold import silver_to_gold
from loanflow.plans.silver import bronze_to_silver
from loanflow.schema import (
    AUDIT_COLUMNS,
    BRONZE_SCHEMA,
    CATEGORICAL_FEATURES,
    DATE_COLUMNS,
    DESCRIBE_COLUMNS,
    INGESTION_TS,
    LABEL,
    LOAN_COLUMNS,
    NUMERIC_COLUMNS,
    NUMERIC_FEATURES,
    PERCENT_COLUMNS,
    PREVIEW_COLUMNS,
    PROFILE_CATEGORICALS,
    WEIGHT,
    existing,
)
from loanflow.session import scratch_path
from loanflow.sources import files
from loanflow.sources.messages import MESSAGE_CODEC, SourceConfig, decode_messages, message_text, publish, with_backfill_metadata

REGISTRY: dict = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def no_audit(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in AUDIT_COLUMNS if c in df.columns])


# -- layer builders shared by many queries ----------------------------------------------

def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_backfill_metadata(fx.loan_bronze(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_to_silver(bronze(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str, keep=()) -> DataFrame:
    return silver_to_gold(silver(spark, sf_dir), keep=keep)


def features(spark: SparkSession, sf_dir: str, keep=("id",)) -> DataFrame:
    g = gold(spark, sf_dir, keep=keep)
    return cols_op.select_features(cols_op.drop_leakage_columns(g, keep=keep), keep=keep)


def staged_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features written once as a compact table: a fit pass and the transform after it read this,
    not the raw rows twice."""
    return files.stage_table(features(spark, sf_dir), "features")


def weighted_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features with class weight and split, staged once: fitting passes read the compact table."""
    return split.hash_split(weights.with_class_weight(staged_features(spark, sf_dir)), "id")


# ======================================================================================
# A: sources and sinks
# ======================================================================================

@query("csv_scan")
def q_csv_scan(spark, sf_dir):
    path = scratch_path(spark, "csv")
    files.write_loans_csv(fx.loan_bronze(spark, sf_dir), path)
    return files.read_loans_csv(spark, path)


@query("csv_scan_parallel")
def q_csv_scan_parallel(spark, sf_dir):
    """The CSV of ``csv_scan``, each file cut into splits of 256 KB whatever its quoted line feeds."""
    from loanflow.sources.csv_records import read_loans_csv_parallel

    path = scratch_path(spark, "csv")
    files.write_loans_csv(fx.loan_bronze(spark, sf_dir), path)
    return read_loans_csv_parallel(spark, path, split_bytes=256 << 10)


@query("table_scan")
def q_table_scan(spark, sf_dir):
    path = scratch_path(spark, "bronze")
    files.write_table(bronze(spark, sf_dir), path)
    return no_audit(files.read_table(spark, path))


@query("table_overwrite")
def q_table_overwrite(spark, sf_dir):
    path = scratch_path(spark, "gold")
    g = no_audit(gold(spark, sf_dir))
    files.write_table(g, path)
    files.write_table(g, path)  # idempotent: a second overwrite leaves the same table
    return files.read_table(spark, path)


@query("versioned_overwrite")
def q_versioned_overwrite(spark, sf_dir):
    """A table replaced as a whole: an overwrite that fails half-way leaves the version before, the next one replaces it."""
    from pyspark.errors import PySparkException

    from loanflow.sources.versions import read_version, write_version

    path = scratch_path(spark, "gold")
    g = no_audit(gold(spark, sf_dir))
    write_version(g.where(F.col(LABEL) == 1).select("loan_status", LABEL), path)
    try:
        write_version(g.withColumn("broken", F.when(F.col(LABEL) == 0, F.raise_error(F.lit("half-way")).cast("int"))), path)
    except PySparkException:
        before = read_version(spark, path)
    write_version(g, path)
    return (read_version(spark, path).withColumn("version", F.lit("last")).select("version", "loan_status", LABEL, "loan_amnt")
            .unionByName(before.withColumn("version", F.lit("before")), allowMissingColumns=True))


@query("optional_scan")
def q_optional_scan(spark, sf_dir):
    """A missing path and a folder that is no table give the fallback, a written table gives itself."""
    fallback = no_audit(gold(spark, sf_dir)).select("loan_status", "loan_amnt", LABEL)
    root = scratch_path(spark, "optional")
    files.write_table(fallback.where(F.col(LABEL) == 1), f"{root}/written")
    fallback.select("loan_status").write.text(f"{root}/broken")
    return reduce(DataFrame.unionByName, [
        files.read_or_else(spark, f"{root}/{case}", fallback).withColumn("case", F.lit(case))
        for case in ("missing", "written", "broken")])


@query("table_ready")
def q_table_ready(spark, sf_dir):
    path = scratch_path(spark, "ready")
    empty = files.table_ready(spark, path + "/none")
    files.write_table(no_audit(gold(spark, sf_dir)), path)
    ready = files.table_ready(spark, path)
    n = files.read_table(spark, path).agg(F.count(F.lit(1)).alias("n_rows"))
    return n.select(F.lit(ready).alias("ready"), F.lit(empty).alias("ready_before"), "n_rows")


@query("publish_json")
def q_publish_json(spark, sf_dir):
    """Rows published as messages, read back and decoded; every message has its own partition and offset."""
    path = scratch_path(spark, "published")
    # raw rows are a table where they are published: building them and their JSON in one projection is too much for one method
    publish(files.stage_table(fx.loan_bronze(spark, sf_dir), "raw"), fx.MESSAGE_TOPIC, path=path)
    return decode_messages(files.read_table(spark, path), stamp=False).select(*LOAN_COLUMNS)


@query("json_decode")
def q_json_decode(spark, sf_dir):
    return decode_messages(fx.messages(spark, sf_dir), stamp=False)


@query("backfill_metadata")
def q_backfill_metadata(spark, sf_dir):
    return no_audit(bronze(spark, sf_dir))


@query("count_reconcile")
def q_count_reconcile(spark, sf_dir):
    from loanflow.sources.reconcile import reconcile_counts

    # three written tables, as a backfill leaves them: each is counted by itself
    raw = files.stage_table(fx.loan_bronze(spark, sf_dir), "raw")
    b = files.stage_table(with_backfill_metadata(raw), "bronze")
    return reconcile_counts(raw, b, files.stage_table(bronze_to_silver(b), "silver"))


@query("model_save_load")
def q_model_save_load(spark, sf_dir):
    df = weighted_split(spark, sf_dir)
    _, model = encode.featurize(df, fit_on="train", keep=("id", LABEL))
    path = scratch_path(spark, "pipeline")
    files.save_pipeline(model, path)
    reloaded = files.load_pipeline(path)
    # both models transform the same rows in one row-local pass: no join on id, no shuffle
    first = model.transform(df).select(*df.columns, F.col("features").alias("features_fitted"))
    both = reloaded.transform(first).select("id", LABEL, "features_fitted", F.col("features").alias("features_reloaded"))
    same = F.aggregate(F.zip_with(encode.as_array("features_fitted"), encode.as_array("features_reloaded"),
                                  lambda a, b: F.abs(a - b)), F.lit(0.0), lambda acc, x: F.greatest(acc, x))
    return both.select("id", LABEL, (same < 1e-12).alias("same_features"))


# ======================================================================================
# B: projections and schema-driven selection
# ======================================================================================

@query("project_cast_rename")
def q_project_cast_rename(spark, sf_dir):
    return message_text(fx.messages(spark, sf_dir))


@query("struct_expand")
def q_struct_expand(spark, sf_dir):
    return decode_messages(fx.messages(spark, sf_dir), stamp=False).select(*LOAN_COLUMNS)


@query("drop_sparse_columns")
def q_drop_sparse_columns(spark, sf_dir):
    return no_audit(cols_op.drop_sparse_columns(silver(spark, sf_dir)))


@query("drop_leakage_columns")
def q_drop_leakage_columns(spark, sf_dir):
    # Gold is a table in the reference: its columns are built once at their full width, and the drop reads the table
    return no_audit(cols_op.drop_leakage_columns(files.stage_table(gold(spark, sf_dir), "gold")))


@query("select_features")
def q_select_features(spark, sf_dir):
    return cols_op.select_features(cols_op.drop_leakage_columns(gold(spark, sf_dir)))


@query("sample_rows_projection")
def q_sample_rows_projection(spark, sf_dir):
    return cols_op.preview(gold(spark, sf_dir, keep=["id"]), PREVIEW_COLUMNS, 10, order_by="id")


# ======================================================================================
# C: predicates, conditionals, null handling
# ======================================================================================

@query("blank_to_null")
def q_blank_to_null(spark, sf_dir):
    return blank_to_null(fx.loan_bronze(spark, sf_dir))


def _silver_cols(spark, sf_dir, columns):
    return silver(spark, sf_dir).select("id", *columns)


@query("default_label")
def q_default_label(spark, sf_dir):
    return with_label(silver(spark, sf_dir)).select("id", "loan_status", LABEL)


@query("high_risk_flag")
def q_high_risk_flag(spark, sf_dir):
    return _silver_cols(spark, sf_dir, ["grade", "is_high_risk"])


@query("charged_off_flag")
def q_charged_off_flag(spark, sf_dir):
    return _silver_cols(spark, sf_dir, ["loan_status", "is_charged_off"])


@query("guarded_ratio")
def q_guarded_ratio(spark, sf_dir):
    return _silver_cols(spark, sf_dir, ["loan_amnt", "annual_inc", "loan_to_income_ratio"])


@query("fill_numeric")
def q_fill_numeric(spark, sf_dir):
    s = silver(spark, sf_dir)
    numeric = cols_op.numeric_columns(s)
    return nulls.fill_numeric(s).select("id", *numeric)


@query("fill_string")
def q_fill_string(spark, sf_dir):
    s = silver(spark, sf_dir)
    strings = cols_op.string_columns(s)
    return nulls.fill_string(s).select(*strings)


@query("null_profile")
def q_null_profile(spark, sf_dir):
    s = silver(spark, sf_dir)
    return nulls.null_profile(s, existing(s, DESCRIBE_COLUMNS) + ["revol_util", "mort_acc", "emp_length"])


@query("imbalance_flag")
def q_imbalance_flag(spark, sf_dir):
    return nulls.class_balance(gold(spark, sf_dir))


@query("quantile_clip")
def q_quantile_clip(spark, sf_dir):
    return quantiles.clip_quantiles(gold(spark, sf_dir, keep=["id"]), "loan_amnt").select("id", "loan_amnt")


# ======================================================================================
# D: scalar functions
# ======================================================================================

def _blanked(spark, sf_dir):
    return blank_to_null(fx.loan_bronze(spark, sf_dir))


@query("parse_percent")
def q_parse_percent(spark, sf_dir):
    return parse_percent(_blanked(spark, sf_dir)).select("id", *PERCENT_COLUMNS)


@query("cast_numeric")
def q_cast_numeric(spark, sf_dir):
    return cast_numeric(_blanked(spark, sf_dir)).select("id", *NUMERIC_COLUMNS)


@query("parse_month_date")
def q_parse_month_date(spark, sf_dir):
    return parse_month_date(_blanked(spark, sf_dir)).select("id", *DATE_COLUMNS)


@query("fico_average")
def q_fico_average(spark, sf_dir):
    typed = cast_numeric(_blanked(spark, sf_dir))
    return with_derived(parse_percent(typed)).select("id", "fico_range_low", "fico_range_high", "fico_avg")


@query("share_percent")
def q_share_percent(spark, sf_dir):
    counts = gold(spark, sf_dir).groupBy("grade").agg(F.count(F.lit(1)).alias("count"))
    return with_share(counts)


# ======================================================================================
# E: aggregations
# ======================================================================================

@query("row_count")
def q_row_count(spark, sf_dir):
    return profile.table_shape(gold(spark, sf_dir))


@query("label_distribution")
def q_label_distribution(spark, sf_dir):
    return profile.distribution(gold(spark, sf_dir), LABEL)


@query("status_topk")
def q_status_topk(spark, sf_dir):
    return profile.top_values(gold(spark, sf_dir), "loan_status", 15)


@query("categorical_topk")
def q_categorical_topk(spark, sf_dir):
    return profile.categorical_profile(gold(spark, sf_dir), PROFILE_CATEGORICALS, 10)


@query("dominant_value")
def q_dominant_value(spark, sf_dir):
    return profile.dominant_values(gold(spark, sf_dir), PROFILE_CATEGORICALS)


@query("describe_numeric")
def q_describe_numeric(spark, sf_dir):
    return profile.describe_long(gold(spark, sf_dir), DESCRIBE_COLUMNS)


@query("null_counts")
def q_null_counts(spark, sf_dir):
    s = silver(spark, sf_dir)
    return nulls.null_counts(s, existing(s, DESCRIBE_COLUMNS))


@query("class_weights")
def q_class_weights(spark, sf_dir):
    w = weights.class_weights(features(spark, sf_dir))
    return w.withColumn("weight", F.round("weight", 6))


@query("with_class_weight")
def q_with_class_weight(spark, sf_dir):
    w = weights.with_class_weight(features(spark, sf_dir))
    return w.withColumn(WEIGHT, F.round(WEIGHT, 6))


@query("distinct_pairs")
def q_distinct_pairs(spark, sf_dir):
    w = weights.with_class_weight(features(spark, sf_dir))
    return weights.distinct_pairs(w.withColumn(WEIGHT, F.round(WEIGHT, 6)), [LABEL, WEIGHT])


@query("time_series_count")
def q_time_series_count(spark, sf_dir):
    g = gold(spark, sf_dir)
    return profile.count_by_time(g, cols_op.first_existing(g, ["issue_d", "issue_date", "earliest_cr_line"]))


@query("histogram")
def q_histogram(spark, sf_dir):
    return quantiles.histogram(gold(spark, sf_dir), "loan_amnt", bins=40)


@query("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(fx.scored(spark, sf_dir))


# ======================================================================================
# F, G, H: ranking, set operations, sampling and splitting
# ======================================================================================

@query("model_leaderboard")
def q_model_leaderboard(spark, sf_dir):
    return evaluate.leaderboard(evaluate.metrics_by_model(fx.scored(spark, sf_dir)), trees=["m2"])


@query("except_distinct")
def q_except_distinct(spark, sf_dir):
    df = weighted_split(spark, sf_dir)
    every = df.drop("id", "split")
    train = df.where(F.col("split") == "train").drop("id", "split")
    return split.except_distinct(every, train).withColumn(WEIGHT, F.round(WEIGHT, 6))


@query("train_test_split")
def q_train_test_split(spark, sf_dir):
    return split.hash_split(features(spark, sf_dir), "id").select("id", LABEL, "split")


@query("split_report")
def q_split_report(spark, sf_dir):
    return split.split_report(split.hash_split(features(spark, sf_dir), "id"))


def _share_ok(n: str, of: str, share: float):
    """Sampled rows lie within six standard deviations (and one row) of the asked share."""
    total = F.col(of).cast("double")
    return F.abs(F.col(n) - total * share) <= 6 * F.sqrt(total * share * (1 - share)) + 1


def _sample_report(every: DataFrame, sample: DataFrame, by: list, share: float) -> DataFrame:
    """Per group: all rows, whether every distinct sampled row is one of them, whether the share is as asked."""
    key = every.columns
    both = (every.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("s"))
            .unionByName(sample.groupBy(*key).agg(F.lit(0).cast("long").alias("n"), F.count(F.lit(1)).alias("s"))))
    rows = both.groupBy(*key).agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    out = rows.groupBy(*by).agg(F.sum("n").alias("n_rows"), F.sum("s").alias("_s"), F.every(F.col("s") <= F.col("n")).alias("subset"))
    return out.select(*by, "n_rows", "subset", _share_ok("_s", "n_rows", share).alias("share_ok"))


@query("stratified_sample")
def q_stratified_sample(spark, sf_dir):
    f = staged_features(spark, sf_dir)
    sample = files.stage_table(split.stratified_sample(f, LABEL, {0: 0.8, 1: 0.8}, 42), "sample")
    return _sample_report(f, sample, [LABEL], 0.8)


@query("stratified_sample_rows")
def q_stratified_sample_rows(spark, sf_dir):
    """The sampled rows themselves: about four fifths of each label."""
    return split.stratified_sample(staged_features(spark, sf_dir), LABEL, {0: 0.8, 1: 0.8}, 42)


@query("split_parity_rows")
def q_split_parity_rows(spark, sf_dir):
    """Train and test of the reference order, row by row, with their feature vectors as arrays."""
    from loanflow.plans.ml_ready import gold_to_ml_ready

    train, test, _ = gold_to_ml_ready(gold(spark, sf_dir, keep=["id"]), key="id", parity=True)
    return (train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
            .select("split", LABEL, WEIGHT, encode.as_array("features").alias("features")))


@query("uniform_sample_rows")
def q_uniform_sample_rows(spark, sf_dir):
    """The sampled rows themselves: about a fifth of the preview columns' rows."""
    return split.uniform_sample(files.stage_table(gold(spark, sf_dir).select(*PREVIEW_COLUMNS), "preview"), 0.2, 42)


@query("split_parity")
def q_split_parity(spark, sf_dir):
    """The reference order on feature vectors: fit on all rows, Bernoulli train, test = all EXCEPT DISTINCT train."""
    from loanflow.plans.ml_ready import gold_to_ml_ready

    train, test, _ = gold_to_ml_ready(gold(spark, sf_dir, keep=["id"]), key="id", parity=True)
    both = train.withColumn("in_train", F.lit(1)).unionByName(test.withColumn("in_train", F.lit(0)))
    rows = both.groupBy("features", LABEL, WEIGHT).agg(F.sum("in_train").alias("t"), F.count(F.lit(1)).alias("n"))
    out = rows.groupBy(LABEL).agg(
        F.count(F.lit(1)).alias("n_distinct"), F.count(F.when(F.col("t") > 0, 1)).alias("_t"),
        F.every((F.col("t") == 0) | (F.col("t") == F.col("n"))).alias("disjoint"),
        F.every((F.col("t") > 0) | (F.col("n") == 1)).alias("test_distinct"))
    return out.select(LABEL, "n_distinct", "disjoint", "test_distinct",
                      (F.col("_t") >= F.col("n_distinct") * 0.5).alias("train_is_larger"))


@query("uniform_sample")
def q_uniform_sample(spark, sf_dir):
    g = files.stage_table(gold(spark, sf_dir).select(*PREVIEW_COLUMNS), "preview")
    sample = files.stage_table(split.uniform_sample(g, 0.2, 42), "sample")
    return _sample_report(g, sample, [], 0.2)


# ======================================================================================
# I: feature engineering (compared as scalars, never as vectors)
# ======================================================================================

def _fitted(spark, sf_dir, fit_on="all"):
    df = weighted_split(spark, sf_dir)
    model = encode.feature_pipeline(existing(df, NUMERIC_FEATURES), existing(df, CATEGORICAL_FEATURES)).fit(
        df if fit_on == "all" else df.where(F.col("split") == "train"))
    return model.transform(df)


@query("string_index")
def q_string_index(spark, sf_dir):
    f = staged_features(spark, sf_dir)
    cats = existing(f, CATEGORICAL_FEATURES)
    indexed = encode.index_categories(f, cats)
    # one scan and one shuffle for all columns: (column, value, index) per row and column, then distinct
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"),
                               F.col(f"{c}_idx").alias("idx")) for c in cats])
    return indexed.select(F.inline(pairs)).distinct()


@query("string_index_table")
def q_string_index_table(spark, sf_dir):
    """The indexes of ``string_index`` from ranked label tables, joined to the rows."""
    f = staged_features(spark, sf_dir)
    cats = existing(f, CATEGORICAL_FEATURES)
    indexed = encode.index_by_table(f, cats, encode.label_ranks(f, cats))
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"),
                               F.col(f"{c}_idx").alias("idx")) for c in cats])
    return indexed.select(F.inline(pairs)).distinct()


@query("one_hot")
def q_one_hot(spark, sf_dir):
    f = staged_features(spark, sf_dir)
    cats = existing(f, CATEGORICAL_FEATURES)
    enc = encode.one_hot(encode.index_categories(f, cats), cats)
    # one scan and one shuffle for all columns, as in string_index
    structs = []
    for c in cats:
        arr = encode.as_array(f"{c}_ohe")
        structs.append(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"), F.size(arr).alias("size"),
                                (F.array_position(arr, F.lit(1.0)) - 1).alias("active")))
    return enc.select(F.inline(F.array(*structs))).distinct()


@query("assemble_numeric")
def q_assemble_numeric(spark, sf_dir):
    f = features(spark, sf_dir)
    nums = existing(f, NUMERIC_FEATURES)
    vec = encode.assemble(f, nums, "numeric_vec")
    return vec.select("id", F.posexplode(encode.as_array("numeric_vec")).alias("slot", "value"))


@query("standard_scale")
def q_standard_scale(spark, sf_dir):
    f = staged_features(spark, sf_dir)
    nums = existing(f, NUMERIC_FEATURES)
    scaled = encode.scale(encode.assemble(f, nums, "numeric_vec"), "numeric_vec", "numeric_scaled")
    exploded = scaled.select("id", F.posexplode(encode.as_array("numeric_scaled")).alias("slot", "value"))
    return exploded.withColumn("value", F.round("value", 6))


@query("assemble_features")
def q_assemble_features(spark, sf_dir):
    """Every non-zero slot of every vector."""
    slots = _fitted(spark, sf_dir).select("id", F.posexplode(encode.as_array("features")).alias("slot", "value"))
    return slots.withColumn("value", F.round("value", 6)).where(F.col("value") != 0)


def _slot_sum(slots: str = "slots"):
    """Sum of value x (slot + 1): differs when a value is wrong or stands in the wrong slot."""
    weighted = F.transform(F.col(slots), lambda x, i: x * (i + 1))
    return F.round(F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x), 4)


@query("feature_pipeline")
def q_feature_pipeline(spark, sf_dir):
    ready, _ = encode.featurize(weighted_split(spark, sf_dir), fit_on="train", keep=("id", LABEL, WEIGHT))
    return ready.withColumn("slots", encode.as_array("features")).select(
        "id", LABEL, F.round(WEIGHT, 6).alias(WEIGHT), "split", F.size("slots").alias("n_slots"), _slot_sum().alias("slot_sum"))


# ======================================================================================
# J: models and evaluation
# ======================================================================================

def _train_test(spark, sf_dir):
    from loanflow.plans.ml_ready import gold_to_ml_ready

    return gold_to_ml_ready(gold(spark, sf_dir, keep=["id"]), key="id")


def trained(spark, sf_dir, name: str) -> DataFrame:
    """The metrics row of one classifier, trained and evaluated on the hash split."""
    train, test, _ = _train_test(spark, sf_dir)
    train, test = train.cache(), test.cache()
    try:
        _, _, metrics, _ = train_and_evaluate(make_classifier(name), name, train, test)
    finally:
        # the metrics frame reads the checkpointed evaluation cells, not train/test: free the caches
        train.unpersist()
        test.unpersist()
    return metrics.withColumnRenamed("model", "model_name")


def _checked(metrics: DataFrame) -> DataFrame:
    """What any right metrics row satisfies, whatever the optimizer's path: all test rows are in the matrix,
    accuracy follows from it and equals the weighted recall, and the model ranks better than chance but not perfectly."""
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    accuracy = (F.col("tn") + F.col("tp")) / n
    return metrics.select(
        "model_name", n.alias("n_test"), (F.col("fn") + F.col("tp")).alias("n_positive"),
        (F.abs(F.col("accuracy") - accuracy) < 1e-5).alias("accuracy_ok"),
        (F.col("recall") == F.col("accuracy")).alias("recall_is_accuracy"),
        F.col("auc").between(0.5, 0.9999).alias("auc_ok"), (F.col("train_seconds") > 0).alias("timed"))


for _name, _key in [("LogisticRegression", "train_logistic_regression"), ("LinearSVC", "train_linear_svc"),
                    ("DecisionTree", "train_decision_tree"), ("RandomForest", "train_random_forest"),
                    ("GBTClassifier", "train_gbt")]:
    query(_key)(lambda spark, sf_dir, name=_name: _checked(trained(spark, sf_dir, name)))
    # accuracy, precision, recall, F1, AUC and the matrix, as the run gives them
    query(_key.replace("train_", "metrics_"))(lambda spark, sf_dir, name=_name: trained(spark, sf_dir, name))


@query("train_and_evaluate")
def q_train_and_evaluate(spark, sf_dir):
    """Scored rows, metrics and importances of one run: rows per label, checked against the metrics row."""
    train, test, _ = _train_test(spark, sf_dir)
    _, scored, metrics, importances = train_and_evaluate(make_classifier("DecisionTree"), "DecisionTree", train, test)
    total = importances.agg(F.round(F.sum("importance"), 6).alias("importance_sum"), F.count(F.lit(1)).alias("n_slots"))
    return (scored.groupBy("model", "label")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.every(F.col("prediction").isin(0.0, 1.0)).alias("binary"),
                 F.count(F.when(F.col("prediction") == 1, 1)).alias("_p"))
            .join(F.broadcast(metrics.select("model", "tn", "fp", "fn", "tp")), "model")
            .join(F.broadcast(total))  # one row
            .select(F.col("model").alias("model_name"), "label", "n_rows", "binary",
                    (F.col("_p") == F.when(F.col("label") == 1, F.col("tp")).otherwise(F.col("fp"))).alias("in_matrix"),
                    "importance_sum", "n_slots"))


@query("scored_rows")
def q_scored_rows(spark, sf_dir):
    """Every test row with its label, scores and prediction from one trained model."""
    train, test, _ = _train_test(spark, sf_dir)
    return train_and_evaluate(make_classifier("LogisticRegression"), "LogisticRegression", train, test)[1]


@query("probability_scores")
def q_probability_scores(spark, sf_dir):
    """The probability of label 1 for every test row."""
    ready, _ = encode.featurize(weighted_split(spark, sf_dir), fit_on="train", keep=("id", LABEL, WEIGHT))
    ready = files.stage_table(ready, "ready")
    pred = make_classifier("LogisticRegression").fit(ready.where(F.col("split") == "train")).transform(ready.where(F.col("split") == "test"))
    return pred.select("id", LABEL, evaluate.positive_score(pred, "probability").alias("score"), "prediction")


@query("probability_score")
def q_probability_score(spark, sf_dir):
    ready, _ = encode.featurize(weighted_split(spark, sf_dir), fit_on="train", keep=("id", LABEL, WEIGHT))
    ready = files.stage_table(ready, "ready")
    model = make_classifier("LogisticRegression").fit(ready.where(F.col("split") == "train"))
    pred = model.transform(ready.where(F.col("split") == "test"))
    p = evaluate.positive_score(pred, "probability")
    raw = evaluate.positive_score(pred)
    return pred.select("id", LABEL, p.between(0, 1).alias("in_range"),
                       (F.col("prediction") == (p > 0.5).cast("double")).alias("predicts_half"),
                       (F.abs(p - 1 / (1 + F.exp(-raw))) < 1e-9).alias("is_logistic"))


@query("feature_importances")
def q_feature_importances(spark, sf_dir):
    """The fifteen most important features of a decision tree, by name."""
    train, _, _ = _train_test(spark, sf_dir)
    return top_importances(make_classifier("DecisionTree").fit(train), train, 15)


@query("feature_importance_topk")
def q_feature_importance_topk(spark, sf_dir):
    train, test, _ = _train_test(spark, sf_dir)
    model = make_classifier("DecisionTree").fit(train)
    lower = F.lag("importance").over(Window.orderBy("rank"))  # fifteen rows
    top = top_importances(model, train, 15)
    return top.select("rank", F.col("feature").rlike("^(" + "|".join(NUMERIC_FEATURES + [f"{c}_ohe_.*" for c in CATEGORICAL_FEATURES]) + ")$").alias("named"),
                      F.coalesce(F.col("importance") <= lower, F.lit(True)).alias("in_order"),
                      F.col("importance").between(0, 1).alias("in_range"))


@query("auc_roc")
def q_auc_roc(spark, sf_dir):
    return evaluate.auc_roc(fx.scored(spark, sf_dir))


@query("classification_metrics")
def q_classification_metrics(spark, sf_dir):
    return evaluate.classification_metrics(fx.scored(spark, sf_dir))


@query("metrics_by_model")
def q_metrics_by_model(spark, sf_dir):
    return evaluate.metrics_by_model(fx.scored(spark, sf_dir))


@query("roc_curve")
def q_roc_curve(spark, sf_dir):
    return evaluate.roc_curve(fx.scored(spark, sf_dir))


# ======================================================================================
# K: streaming (availableNow runs into fresh folders, then a batch read of the sink)
# ======================================================================================

#: Messages per landed file: the number of files, and with it of decode tasks, follows the data.
LANDED_MESSAGES = 20_000


def _land_messages(spark, sf_dir, where=None) -> str:
    if where is None and fx.landed_messages(sf_dir):
        return fx.landed_messages(sf_dir)
    path = scratch_path(spark, "messages")
    msgs = fx.messages(spark, sf_dir)
    if where is not None:
        msgs = msgs.where(where)
    msgs.write.mode("overwrite").option("maxRecordsPerFile", LANDED_MESSAGES).option("compression", MESSAGE_CODEC).parquet(path)
    return path


def _await(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _stream_bronze_table(spark, sf_dir) -> str:
    from loanflow.streaming.ingest import stream_bronze

    src = _land_messages(spark, sf_dir)
    out, ck = scratch_path(spark, "bronze_stream"), scratch_path(spark, "bronze_ckpt")
    cfg = SourceConfig(fmt="parquet", path=src)
    _await(stream_bronze(spark, cfg, out, ck, trigger={"availableNow": True}))
    return out


@query("message_source")
def q_message_source(spark, sf_dir):
    from loanflow.sources.messages import read_messages

    src = _land_messages(spark, sf_dir)
    out, ck = scratch_path(spark, "raw_stream"), scratch_path(spark, "raw_ckpt")
    stream = read_messages(spark, SourceConfig(fmt="parquet", path=src))
    _await(files.append_stream(stream.drop("key"), out, ck, trigger={"availableNow": True}, codec=MESSAGE_CODEC))
    return files.read_table(spark, out).select(
        "topic", "partition", "offset", "timestamp", F.col("value").isNull().alias("value_is_null"))


@query("stream_bronze")
def q_stream_bronze(spark, sf_dir):
    return files.read_table(spark, _stream_bronze_table(spark, sf_dir)).drop(INGESTION_TS)


@query("stream_append_sink")
def q_stream_append_sink(spark, sf_dir):
    return files.read_table(spark, _stream_bronze_table(spark, sf_dir)).drop(INGESTION_TS)


#: Order keys per landed file of ``rate_limit``, where one file makes one micro-batch.
BATCH_KEYS = 4_000


@query("rate_limit")
def q_rate_limit(spark, sf_dir):
    """Messages landed as one file per key range, read one file per trigger: rows per micro-batch."""
    from loanflow.streaming.progress import ingest_progress

    return ingest_progress(_limited_streams(spark, _land_ranges(spark, sf_dir)), by=["stream"]).select("batch_rows")


def _land_ranges(spark, sf_dir) -> dict[str, str]:
    """Messages landed as one file per range of ``BATCH_KEYS`` order keys, dealt to as many folders as the cluster runs tasks:
    a path per stream name."""
    src = scratch_path(spark, "ranges")
    ranged = fx.ranged_messages(spark, sf_dir, BATCH_KEYS, max(1, spark.sparkContext.defaultParallelism))
    ranged.write.partitionBy("share", "range").option("compression", MESSAGE_CODEC).parquet(src)
    return {n.replace("share=", "bronze-"): f"{src}/{n}/*" for n in files.list_names(spark, src) if n.startswith("share=")}


def _limited_streams(spark, folders: dict[str, str]) -> DataFrame:
    """Bronze rows with the name of the ``stream`` they came by: every folder is a stream of its own, one file per trigger.

    A micro-batch of one file is one task, so streams run side by side, one for each task the cluster runs at once.
    """
    from loanflow.streaming.ingest import stream_bronze

    tables = {name: scratch_path(spark, "bronze_stream") for name in folders}
    running = [stream_bronze(spark, SourceConfig(fmt="parquet", path=path, max_per_trigger=1), tables[name],
                             scratch_path(spark, "bronze_ckpt"), trigger={"availableNow": True}, name=name)
               for name, path in folders.items()]
    try:
        for q in running:
            _await(q)
    finally:
        for q in running:
            q.stop()
    none = spark.createDataFrame([], BRONZE_SCHEMA).withColumn("stream", F.lit(""))
    return reduce(DataFrame.unionByName, [files.read_table(spark, t).withColumn("stream", F.lit(name)) for name, t in tables.items()], none)


@query("stream_progress")
def q_stream_progress(spark, sf_dir):
    """What the engine reported of each micro-batch while the streams ran, beside the rows that landed."""
    from loanflow.streaming.progress import ProgressLog, ingest_progress, progress_table

    log, folders = scratch_path(spark, "progress"), _land_ranges(spark, sf_dir)
    with ProgressLog(spark, log, names=set(folders)):
        rows = _limited_streams(spark, folders)
    told = progress_table(spark, log).select(
        F.col("name").alias("stream"), F.row_number().over(Window.partitionBy("query_id").orderBy("batch_id")).alias("nth"),
        "batch_rows", "total_rows",
        ((F.col("input_rows_per_sec") >= 0) & (F.col("processed_rows_per_sec") > 0) & (F.col("batch_ms") > 0)).alias("timed"))
    landed = ingest_progress(rows, by=["stream"]).select(
        "stream", "batch_time", F.col("batch_rows").alias("landed_rows"), F.col("total_rows").alias("landed_total"))
    landed = landed.withColumn("nth", F.row_number().over(Window.partitionBy("stream").orderBy("batch_time")))  # one row per micro-batch
    both = told.join(landed, ["stream", "nth"], "full")
    return both.select("batch_rows", "landed_rows", (F.col("total_rows") == F.col("landed_total")).alias("same_total"), "timed")


@query("stream_fan_out")
def q_stream_fan_out(spark, sf_dir):
    """One stream of messages into two tables: decoded rows, and the payloads that hold no loan."""
    from loanflow.sources.messages import read_messages
    from loanflow.streaming.fan_out import Sink, read_sink, start_fan_out

    src = _land_messages(spark, sf_dir)
    rows = decode_messages(read_messages(spark, SourceConfig(fmt="parquet", path=src)))
    good, bad = scratch_path(spark, "loans"), scratch_path(spark, "rejected")
    sinks = [Sink("loans", good, lambda b: b.where("id IS NOT NULL")), Sink("rejected", bad, lambda b: b.where("id IS NULL"))]
    _await(start_fan_out(rows, sinks, scratch_path(spark, "fan_ckpt"), trigger={"availableNow": True}))
    return reduce(DataFrame.unionByName, [read_sink(spark, s.path, rows.schema).drop(INGESTION_TS).withColumn("sink", F.lit(s.name)) for s in sinks])


@query("table_stream_scan")
def q_table_stream_scan(spark, sf_dir):
    path = scratch_path(spark, "bronze_batch")
    files.write_table(bronze(spark, sf_dir), path)
    schema = files.read_table(spark, path).schema
    out, ck = scratch_path(spark, "copy_stream"), scratch_path(spark, "copy_ckpt")
    src = files.stream_table(spark, path, schema)
    _await(files.append_stream(src, out, ck, trigger={"availableNow": True}))
    return no_audit(files.read_table(spark, out))


@query("stream_silver")
def q_stream_silver(spark, sf_dir):
    """Silver starts before the Bronze folder exists, finds nothing, and takes everything after a restart."""
    from loanflow.streaming.ingest import stream_bronze, stream_silver

    bronze_path = scratch_path(spark, "bronze_stream")
    out, ck = scratch_path(spark, "silver_stream"), scratch_path(spark, "silver_ckpt")
    once = {"availableNow": True}
    _await(stream_silver(spark, bronze_path, out, ck, trigger=once))
    cfg = SourceConfig(fmt="parquet", path=_land_messages(spark, sf_dir))
    _await(stream_bronze(spark, cfg, bronze_path, scratch_path(spark, "bronze_ckpt"), trigger=once))
    _await(stream_silver(spark, bronze_path, out, ck, trigger=once))
    return no_audit(files.read_table(spark, out))


@query("chained_streams")
def q_chained_streams(spark, sf_dir):
    """Bronze and Silver streams run at the same time, chained through the Bronze folder."""
    from loanflow.streaming.ingest import run_chain, stream_bronze, stream_silver

    src = _land_messages(spark, sf_dir)
    b_out, b_ck = scratch_path(spark, "bronze_stream"), scratch_path(spark, "bronze_ckpt")
    s_out, s_ck = scratch_path(spark, "silver_stream"), scratch_path(spark, "silver_ckpt")
    cfg = SourceConfig(fmt="parquet", path=src)
    silver = stream_silver(spark, b_out, s_out, s_ck, trigger={"processingTime": "1 second"})
    bronze = stream_bronze(spark, cfg, b_out, b_ck, trigger={"availableNow": True})
    run_chain(spark, bronze, silver, b_out, s_ck)  # Silver ends when it has Bronze's last commit
    return no_audit(files.read_table(spark, s_out))


@query("restart_from_checkpoint")
def q_restart_from_checkpoint(spark, sf_dir):
    from loanflow.streaming.ingest import stream_bronze

    src = scratch_path(spark, "messages")
    msgs = fx.messages(spark, sf_dir)
    even = F.col("offset") % 2 == 0
    msgs.where(even).write.mode("append").option("maxRecordsPerFile", LANDED_MESSAGES).option("compression", MESSAGE_CODEC).parquet(src)
    out, ck = scratch_path(spark, "bronze_stream"), scratch_path(spark, "bronze_ckpt")
    cfg = SourceConfig(fmt="parquet", path=src)
    _await(stream_bronze(spark, cfg, out, ck, trigger={"availableNow": True}))
    msgs.where(~even).write.mode("append").option("maxRecordsPerFile", LANDED_MESSAGES).option("compression", MESSAGE_CODEC).parquet(src)  # new files arrive
    _await(stream_bronze(spark, cfg, out, ck, trigger={"availableNow": True}))  # resumes
    _await(stream_bronze(spark, cfg, out, ck, trigger={"availableNow": True}))  # nothing new
    return files.read_table(spark, out).drop(INGESTION_TS)


@query("ingest_progress")
def q_ingest_progress(spark, sf_dir):
    from loanflow.streaming.progress import ingest_progress

    return ingest_progress(fx.stamped(spark, sf_dir))


# ======================================================================================
# L: composite layers
# ======================================================================================

@query("bronze_to_silver")
def q_bronze_to_silver(spark, sf_dir):
    return no_audit(silver(spark, sf_dir))


@query("silver_to_gold")
def q_silver_to_gold(spark, sf_dir):
    return no_audit(gold(spark, sf_dir))


@query("backfill")
def q_backfill(spark, sf_dir):
    from loanflow.plans.backfill import backfill

    csv = scratch_path(spark, "csv")
    files.write_loans_csv(fx.loan_bronze(spark, sf_dir), csv)
    return backfill(spark, csv, scratch_path(spark, "bronze"), scratch_path(spark, "silver"))


def _long_part(name: str, df: DataFrame, keys: list, values: list) -> DataFrame:
    """One profile table as (part, key, measure, value) rows."""
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys]) if keys else F.lit("")
    pairs = F.array(*[F.struct(F.lit(v).alias("measure"), F.col(v).cast("double").alias("value")) for v in values])
    return df.select(F.lit(name).alias("part"), key.alias("key"), F.inline(pairs))


#: Key and value columns of each part of the Gold profile that is compared.
PROFILE_PARTS = {
    "shape": ([], ["n_rows"]),
    "label_distribution": ([LABEL], ["count", "pct"]),
    "class_balance": ([], ["n0", "n1", "ratio"]),
    "describe": (["column_name"], ["count", "mean", "stddev", "min", "max"]),
    "null_profile": (["column_name", "severity"], ["null_count", "null_pct"]),
    "categorical": (["column_name", "value"], ["rank", "count", "pct"]),
    "dominant": (["column_name", "value"], ["count", "pct"]),
    "status_top": (["loan_status"], ["count", "pct"]),
    "time_series": (["issue_d"], ["count"]),
    "histogram": (["bin"], ["count"]),
}


@query("gold_profile")
def q_gold_profile(spark, sf_dir):
    from loanflow.plans.profile import gold_profile

    # Gold is a table in the reference; profile a written copy, not twelve re-parses of the raw rows
    table = files.stage_table(gold(spark, sf_dir, keep=["id"]).drop("id"), "gold")
    parts = gold_profile(table)
    return reduce(DataFrame.unionByName, [_long_part(name, parts[name], *kv) for name, kv in PROFILE_PARTS.items()])


@query("gold_to_ml_ready")
def q_gold_to_ml_ready(spark, sf_dir):
    from loanflow.plans.ml_ready import gold_to_ml_ready, write_ml_ready

    train, test, model = gold_to_ml_ready(gold(spark, sf_dir, keep=["id"]), key="id")
    paths = write_ml_ready(train, test, model, scratch_path(spark, "ml_ready"))
    t = files.read_table(spark, paths["train"]).withColumn("split", F.lit("train"))
    s = files.read_table(spark, paths["test"]).withColumn("split", F.lit("test"))
    both = t.unionByName(s).withColumn("slots", encode.as_array("features"))
    return both.select("split", LABEL, F.round(WEIGHT, 6).alias(WEIGHT), F.size("slots").alias("n_slots"),
                       _slot_sum().alias("slot_sum"))


@query("leaderboard_all")
def q_leaderboard_all(spark, sf_dir):
    """The five models' metrics, ranked, with the best one and the best tree model marked."""
    from loanflow.plans.training import train_all

    train, test, _ = _train_test(spark, sf_dir)
    return train_all(train, test)[0].withColumnRenamed("model", "model_name")


@query("train_all")
def q_train_all(spark, sf_dir):
    from loanflow.plans.training import train_all

    train, test, _ = _train_test(spark, sf_dir)
    board, _, _ = train_all(train, test)
    board = board.withColumnRenamed("model", "model_name")
    whole = Window.partitionBy()  # five models
    flags = board.select("model_name", F.sum(F.col("is_best").cast("int")).over(whole).alias("n_best"),
                         F.sum(F.col("is_best_tree").cast("int")).over(whole).alias("n_best_tree"),
                         F.max("rank").over(whole).alias("n_models"))
    return _checked(board).join(flags, "model_name")


# Flagship: label distribution of Gold with the class weight of each label.
@query("label_weights")
def q_label_weights(spark, sf_dir):
    from loanflow.session import materialize

    counts = materialize(gold(spark, sf_dir).groupBy(LABEL).agg(F.count(F.lit(1)).alias("count")))
    w = weights.class_weights(None, counts=counts).select(LABEL, F.round("weight", 6).alias("weight"))
    return with_share(counts).join(w, LABEL).orderBy(LABEL)



# ======================================================================================
# Operators without a function of their own, registered through the query that uses them
# ======================================================================================

@query("columns_by_type")
def q_columns_by_type(spark, sf_dir):
    """B6: numeric and string columns found from the Silver schema, with non-NULL counts over all rows."""
    s = no_audit(silver(spark, sf_dir))
    numeric, strings = cols_op.numeric_columns(s), cols_op.string_columns(s)
    names = numeric + strings
    # one aggregate over both kinds: Silver is read once
    counts = s.agg(*[F.count(F.col(c)).alias(c) for c in names])
    kind = F.when(F.col("column_name").isin(*numeric), F.lit("numeric")).otherwise(F.lit("string"))
    return counts.unpivot([], names, "column_name", "non_null").withColumn("kind", kind)


@query("first_existing_column")
def q_first_existing_column(spark, sf_dir):
    """B8: the first time-column candidate present, used for the time series (E11)."""
    from loanflow.schema import TIME_CANDIDATES

    g = gold(spark, sf_dir)
    return profile.count_by_time(g, cols_op.first_existing(g, TIME_CANDIDATES))


@query("trim")
def q_trim(spark, sf_dir):
    """D5: the space-only test behind blank -> NULL (C1)."""
    return q_blank_to_null(spark, sf_dir)


@query("typed_null_literals")
def q_typed_null_literals(spark, sf_dir):
    """D6: typed NULL metadata columns of batch Bronze (A11)."""
    return bronze(spark, sf_dir).select("id", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp")


@query("audit_timestamp")
def q_audit_timestamp(spark, sf_dir):
    """D7: one processing and one ingestion stamp per query, on every row."""
    s = silver(spark, sf_dir)
    return s.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_distinct("processing_timestamp").alias("n_processing_stamps"),
                 F.count_distinct(INGESTION_TS).alias("n_ingestion_stamps"),
                 F.count(F.when(F.col("processing_timestamp").isNull(), F.lit(1))).alias("n_missing"))


@query("json_parse")
def q_json_parse(spark, sf_dir):
    """D8: JSON build (to_json) and parse (from_json) round trip of every raw row."""
    return q_publish_json(spark, sf_dir)


@query("order_by")
def q_order_by(spark, sf_dir):
    """grouped results in order (label distribution ordered by label)."""
    return profile.distribution(gold(spark, sf_dir), LABEL)


@query("limit_n")
def q_limit_n(spark, sf_dir):
    """first n rows by an order (top 5 loan statuses)."""
    return profile.top_values(gold(spark, sf_dir), "loan_status", 5)


@query("distinct")
def q_distinct(spark, sf_dir):
    """G2: distinct (label, classWeight) pairs."""
    return q_distinct_pairs(spark, sf_dir)
