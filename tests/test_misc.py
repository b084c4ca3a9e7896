"""Schema helpers, audit stamps, backfill, model save/load, classifiers, chained streams."""
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from loanflow import catalog
from loanflow.operators.models import make_classifier, top_importances
from loanflow.operators.columns import columns_of, first_existing, preview, schema_profile
from loanflow.plans.backfill import backfill
from loanflow.plans.silver import bronze_to_silver
from loanflow.schema import PROCESSING_TS
from loanflow.session import scratch_path
from loanflow.sources import files
from loanflow.sources.messages import with_backfill_metadata
from test_silver import raw_rows


def test_columns_by_type_first_existing_schema_profile(spark):
    df = spark.createDataFrame([(1, 2.0, "a", "b")], "i int, d double, s string, t string")
    assert columns_of(df, NumericType) == ["i", "d"] and columns_of(df, StringType) == ["s", "t"]
    assert first_existing(df, ["zz", "t", "s"]) == "t" and first_existing(df, ["zz"]) is None
    prof = [(r.data_type, r.n_columns) for r in schema_profile(df).collect()]
    assert prof == [("String", 2), ("Double", 1), ("Integer", 1)]


def test_preview_falls_back_to_first_six(spark):
    df = spark.range(20).selectExpr(*[f"id AS c{i}" for i in range(8)])
    assert preview(df, ["nope"], 3, order_by="c0").columns == [f"c{i}" for i in range(6)]
    assert [r.c0 for r in preview(df, ["c0"], 3, order_by="c0").collect()] == [0, 1, 2]


def test_audit_stamp_constant_within_query(spark):
    df = bronze_to_silver(with_backfill_metadata(raw_rows(spark, [{"id": str(i)} for i in range(50)])))
    assert df.select(PROCESSING_TS).distinct().count() == 1
    assert df.select("ingestion_timestamp").distinct().count() == 1


def test_backfill_counts_and_tables(spark, sf_small):
    from loanflow import fixtures as fx

    csv = scratch_path(spark, "csv")
    files.write_loans_csv(fx.loan_bronze(spark, sf_small).repartition(3), csv)
    b, s = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    r = backfill(spark, csv, b, s).first()
    assert (r.raw_count, r.bronze_count, r.silver_count, r.consistent) == (1500, 1500, 1500, True)
    assert len(files.read_table(spark, s).columns) == 161
    # idempotent: a second run replaces, never appends
    assert backfill(spark, csv, b, s).first().silver_count == 1500


def test_model_save_load_same_features(spark, sf_small):
    df = catalog.REGISTRY["model_save_load"](spark, sf_small)
    assert df.count() == 1500 and df.where(~F.col("same_features")).count() == 0


@pytest.mark.parametrize("name", ["LogisticRegression", "DecisionTree"])
def test_classifier_beats_chance(spark, sf_small, name):
    r = catalog.trained(spark, sf_small, name).first()
    assert 0.5 < r.auc < 0.95 and r.tn + r.fp + r.fn + r.tp > 0 and r.train_seconds >= 0  # the labels are noisy


def test_feature_importances_named(spark, sf_small):
    train, _, _ = catalog._train_test(spark, sf_small)
    model = make_classifier("DecisionTree").fit(train)
    rows = top_importances(model, train, 15).orderBy("rank").collect()
    assert 0 < len(rows) <= 15 and [r.rank for r in rows] == list(range(1, len(rows) + 1))
    assert all(not r.feature.startswith("numeric_scaled_") for r in rows)
    checked = catalog.REGISTRY["feature_importance_topk"](spark, sf_small).collect()
    assert len(checked) == 15 and all(r.named and r.in_order and r.in_range for r in checked)


def test_chained_streams(spark, sf_small):
    df = catalog.REGISTRY["chained_streams"](spark, sf_small)
    assert df.count() == 1500 and len(df.columns) == 159


def test_model_scoring_after_backfill_in_same_session(spark, sf_small):
    """The backfill must leave the session usable for ML scoring (no Observation: see plans/backfill.py)."""
    catalog.REGISTRY["backfill"](spark, sf_small).collect()
    r = catalog.trained(spark, sf_small, "LogisticRegression").first()
    assert r.tn + r.fp + r.fn + r.tp > 0


def test_train_all_frees_what_it_caches_and_marks_the_best_tree(spark, sf_small):
    from loanflow.plans.training import train_all

    train, test, _ = catalog._train_test(spark, sf_small)
    board, _, models = train_all(train, test, names=["LogisticRegression", "DecisionTree", "LinearSVC"])
    rows = board.collect()
    assert [r.model for r in rows if r.is_best_tree] == ["DecisionTree"] and sum(r.is_best for r in rows) == 1
    assert not train.is_cached and not test.is_cached and len(models) == 3


def test_every_raw_column_has_values(spark, sf_small):
    from loanflow import fixtures as fx

    raw = fx.loan_bronze(spark, sf_small)
    counts = raw.agg(*[F.count(F.when(F.trim(c) != "", 1)).alias(c) for c in raw.columns]).first().asDict()
    assert len(counts) == 151 and min(counts.values()) > 0


def test_published_messages_read_back_as_a_stream(spark, sf_small):
    from loanflow import fixtures as fx
    from loanflow.sources.messages import SourceConfig, publish, read_messages

    path, out, ck = (scratch_path(spark, n) for n in ("published", "landed", "landed_ckpt"))
    publish(fx.loan_bronze(spark, sf_small), "t", path=path)
    stream = read_messages(spark, SourceConfig(fmt="parquet", path=path))
    files.append_stream(stream, out, ck, trigger={"availableNow": True}).awaitTermination()
    got = files.read_table(spark, out)
    assert got.count() == got.select("partition", "offset").distinct().count() == 1500
    assert got.where("value IS NULL OR timestamp IS NULL OR topic <> 't'").count() == 0


def test_count_reconcile_sees_a_lost_row(spark, sf_small):
    from loanflow.sources.reconcile import reconcile_counts

    a, b = spark.range(10), spark.range(9)
    assert not reconcile_counts(a, b, b).first().consistent and reconcile_counts(a, a, a).first().consistent


def test_remove_scratch_deletes_what_was_staged(spark):
    import os

    from loanflow import session

    mine, others = [], session._SCRATCH[:]
    session._SCRATCH.clear()
    try:
        files.stage_table(spark.range(5), "gone")
        mine = session._SCRATCH[:]
        assert os.path.isdir(mine[0].removeprefix("file:")) and session.remove_scratch(spark) == 1
        assert not os.path.exists(mine[0].removeprefix("file:")) and session.remove_scratch(spark) == 0
    finally:
        session._SCRATCH.extend(others)
