"""Gold rules: label, drop list, fills."""
import math

from loanflow.operators.columns import drop_leakage_columns, select_features
from loanflow.plans.gold import silver_to_gold
from loanflow.plans.silver import bronze_to_silver
from loanflow.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from loanflow.sources.messages import with_backfill_metadata
from test_silver import raw_rows


def gold_of(spark, rows, keep=()):
    return silver_to_gold(bronze_to_silver(with_backfill_metadata(raw_rows(spark, rows))), keep=keep)


def test_label_rules(spark):
    statuses = ["Charged Off", "Default", "Does not meet the credit policy. Status:Charged Off",
                "Does not meet the credit policy. Status:Fully Paid", "Current", None, " "]
    out = gold_of(spark, [{"loan_status": s} for s in statuses]).collect()
    assert [r.label for r in out] == [1, 1, 1, 0, 0, 0, 0]
    assert out[5].loan_status == "Unknown" and out[6].loan_status == "Unknown"
    assert out[1].is_charged_off is False  # 'Default' is label 1 but not charged off


def test_fill_nan_and_null(spark):
    out = gold_of(spark, [{"loan_amnt": "NaN", "dti": None, "grade": None}]).first()
    assert out.loan_amnt == 0.0 and out.dti == 0.0 and out.grade == "Unknown"
    assert out.issue_d is None  # dates are not filled
    assert not math.isnan(out.loan_amnt)


def test_gold_width_and_kept_columns(spark):
    g = gold_of(spark, [{"id": "1"}])
    assert len(g.columns) == 115
    assert "kafka_topic" in g.columns and "id" not in g.columns and "kafka_offset" not in g.columns
    assert "id" in gold_of(spark, [{"id": "1"}], keep=["id"]).columns


def test_feature_selection_order(spark):
    g = gold_of(spark, [{"id": "1"}])
    f = select_features(drop_leakage_columns(g))
    assert f.columns == NUMERIC_FEATURES + CATEGORICAL_FEATURES + ["label"]
    assert "loan_status" not in drop_leakage_columns(g).columns
