"""DuckDB oracle text per registered query name (see ``loanflow.catalog``).

Model training and Bernoulli samples differ between engines in their values;
their queries return what can be counted (rows, labels, slots) and invariants
that must be true, and the text here counts the same and states the truth.
"""

from __future__ import annotations

from loanflow import fixtures as fx
from loanflow.catalog import BATCH_KEYS, PROFILE_PARTS
from loanflow.checks.duckdb_sql import (
    SCORED,
    SILVER_ORDER,
    SILVER_TYPES,
    cols,
    features_select,
    gd_select,
    gold_columns,
    in_list,
    lb_select,
    qi,
    slb_select,
    sv_select,
    with_ctes,
)
from loanflow.schema import (
    CATEGORICAL_FEATURES,
    DATE_COLUMNS,
    DEFAULT_STATUSES,
    DESCRIBE_COLUMNS,
    GOLD_DROP_COLUMNS,
    LEAKAGE_COLUMNS,
    LOAN_COLUMNS,
    NUMERIC_COLUMNS,
    NUMERIC_FEATURES,
    PERCENT_COLUMNS,
    PREVIEW_COLUMNS,
    PROFILE_CATEGORICALS,
)

ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql


def pct(x: str, total: str) -> str:
    return f"ROUND(COALESCE(CAST({x} AS DOUBLE) * 100.0 / NULLIF(CAST({total} AS DOUBLE), 0), 0.0), 6)"


def r6(x: str) -> str:
    return f"ROUND({x}, 6)"


N_GOLD = "(SELECT COUNT(*) FROM gd)"
BACKFILL_META = ("'backfill_csv' AS kafka_topic, CAST(NULL AS INTEGER) AS kafka_partition, "
                 "CAST(NULL AS BIGINT) AS kafka_offset, CAST(NULL AS TIMESTAMP) AS kafka_timestamp")
HASH_SPLIT = ("CASE WHEN CAST(('0x' || substr(md5('42:' || id), 1, 8)) AS BIGINT) < round(0.8 * 4294967296) "
              "THEN 'train' ELSE 'test' END")
SILVER_NO_DROP = [c for c in SILVER_ORDER if c not in set(GOLD_DROP_COLUMNS)]


def gold_ctes(body: str) -> str:
    """lb, sv, gd (Gold keeping id), ft (features + id), cw (class weights), ws (weighted + split)."""
    extra = (
        f",\nft AS ({features_select('gd', keep=['id'])}),\n"
        "cw AS (SELECT label, COUNT(*) AS count, CAST((SELECT COUNT(*) FROM ft) AS DOUBLE) / "
        "((SELECT COUNT(DISTINCT label) FROM ft) * COUNT(*)) AS weight FROM ft GROUP BY label),\n"
        f"ws AS (SELECT ft.*, cw.weight AS \"classWeight\", {HASH_SPLIT} AS split FROM ft JOIN cw USING (label))\n"
    )
    return (f"WITH lb AS ({lb_select()}),\nsv AS ({sv_select()}),\ngd AS ({gd_select(keep=['id'])})"
            f"{extra}{body}")


def stream_ctes(body: str) -> str:
    return f"WITH slb AS ({slb_select()}),\nssv AS ({sv_select('slb', meta='src')})\n{body}"


def scored_ctes(body: str) -> str:
    return f"WITH scored AS ({SCORED})\n{body}"


# ======================================================================================
# A
# ======================================================================================
# Spark's CSV reader returns an empty field as NULL (a JSON message keeps ""); Silver is equal either way.
oracle("csv_scan", f"WITH lb AS ({lb_select()}) SELECT " + ", ".join(
    f"NULLIF({qi(c)}, '') AS {qi(c)}" for c in LOAN_COLUMNS) + " FROM lb")
oracle("csv_scan_parallel", ORACLES["csv_scan"])
oracle("table_scan", f"WITH lb AS ({lb_select()}) SELECT *, {BACKFILL_META} FROM lb")
oracle("backfill_metadata", ORACLES["table_scan"])
oracle("table_stream_scan", ORACLES["table_scan"])
oracle("table_overwrite", with_ctes(f"SELECT {cols(gold_columns())} FROM gd"))
oracle("versioned_overwrite", with_ctes("SELECT 'last' AS version, loan_status, label, loan_amnt FROM gd UNION ALL "
                                        "SELECT 'before', loan_status, label, NULL FROM gd WHERE label = 1"))
oracle("optional_scan", with_ctes("SELECT loan_status, loan_amnt, label, c.\"case\" FROM gd, "
                                  "(VALUES ('missing'), ('written'), ('broken')) c(\"case\") WHERE c.\"case\" <> 'written' OR label = 1"))
oracle("table_ready", with_ctes("SELECT true AS ready, false AS ready_before, COUNT(*) AS n_rows FROM gd"))
oracle("publish_json", lb_select())
oracle("json_decode", slb_select())
oracle("count_reconcile", f"WITH lb AS ({lb_select()}) SELECT COUNT(*) AS raw_count, COUNT(*) AS bronze_count, "
                          "COUNT(*) AS silver_count, true AS consistent FROM lb")
oracle("backfill", ORACLES["count_reconcile"])
oracle("model_save_load", gold_ctes("SELECT id, label, true AS same_features FROM ft"))

# ======================================================================================
# B
# ======================================================================================
_JSON = "json_object(" + ", ".join(f"'{c}', {qi(c)}" for c in LOAN_COLUMNS) + ")"
oracle("project_cast_rename",
       f"WITH lb AS ({lb_select('o_orderkey, o_orderdate')}) SELECT CASE WHEN o_orderkey % {fx.BAD_JSON_EVERY} = 0 THEN '{{bad' "
       f"WHEN o_orderkey % {fx.NULL_JSON_EVERY} = 0 THEN NULL ELSE CAST({_JSON} AS VARCHAR) END AS message, "
       f"'{fx.MESSAGE_TOPIC}' AS kafka_topic, CAST(o_orderkey % {fx.MESSAGE_PARTITIONS} AS INTEGER) AS kafka_partition, "
       f"CAST(floor(o_orderkey / {fx.MESSAGE_PARTITIONS}) AS BIGINT) AS kafka_offset, o_orderdate AS kafka_timestamp FROM lb")
oracle("struct_expand", f"WITH slb AS ({slb_select()}) SELECT {cols(LOAN_COLUMNS)} FROM slb")
oracle("drop_sparse_columns", with_ctes(f"SELECT {cols(SILVER_NO_DROP)} FROM sv"))
oracle("drop_leakage_columns", with_ctes(
    f"SELECT {cols([c for c in gold_columns() if c not in set(LEAKAGE_COLUMNS)])} FROM gd"))
oracle("select_features", with_ctes(features_select("gd")))
oracle("sample_rows_projection", gold_ctes(f"SELECT {cols(PREVIEW_COLUMNS)} FROM gd ORDER BY id LIMIT 10"))

# ======================================================================================
# C
# ======================================================================================
oracle("blank_to_null", f"WITH lb AS ({lb_select()}) SELECT " + ", ".join(
    f"CASE WHEN trim({qi(c)}) = '' THEN NULL ELSE {qi(c)} END AS {qi(c)}" for c in LOAN_COLUMNS) + " FROM lb")
oracle("default_label", with_ctes(
    f"SELECT id, loan_status, CASE WHEN loan_status IN ({in_list(DEFAULT_STATUSES)}) THEN 1 ELSE 0 END AS label FROM sv"))
oracle("high_risk_flag", with_ctes("SELECT id, grade, is_high_risk FROM sv"))
oracle("charged_off_flag", with_ctes("SELECT id, loan_status, is_charged_off FROM sv"))
oracle("guarded_ratio", with_ctes("SELECT id, loan_amnt, annual_inc, loan_to_income_ratio FROM sv"))


def _fill_num(c: str) -> str:
    t = SILVER_TYPES[c]
    if t == "double":
        return f"CASE WHEN {qi(c)} IS NULL OR isnan({qi(c)}) THEN 0.0 ELSE {qi(c)} END AS {qi(c)}"
    return f"COALESCE({qi(c)}, 0) AS {qi(c)}"


_NUMERIC_SILVER = [c for c in SILVER_ORDER if SILVER_TYPES[c] in ("double", "int", "long")]
_STRING_SILVER = [c for c in SILVER_ORDER if SILVER_TYPES[c] == "string"]
oracle("fill_numeric", with_ctes("SELECT id, " + ", ".join(_fill_num(c) for c in _NUMERIC_SILVER) + " FROM sv"))
oracle("fill_string", with_ctes("SELECT " + ", ".join(
    f"COALESCE({qi(c)}, 'Unknown') AS {qi(c)}" for c in _STRING_SILVER) + " FROM sv"))

_NULL_COLS = DESCRIBE_COLUMNS + ["revol_util", "mort_acc", "emp_length"]


def _null_row(c: str) -> str:
    p = pct(f"COUNT(*) FILTER (WHERE {qi(c)} IS NULL)", "COUNT(*)")
    return (f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {qi(c)} IS NULL) AS null_count, {p} AS null_pct, "
            f"CASE WHEN {p} > 5.0 THEN 'high' WHEN {p} > 0 THEN 'low' ELSE 'clean' END AS severity FROM sv")


oracle("null_profile", with_ctes(" UNION ALL ".join(_null_row(c) for c in _NULL_COLS)))
oracle("imbalance_flag", with_ctes(
    "SELECT n0, n1, ROUND(CAST(n0 AS DOUBLE) / NULLIF(n1, 0), 6) AS ratio, "
    "COALESCE(CAST(n0 AS DOUBLE) / NULLIF(n1, 0) > 3.0 OR CAST(n0 AS DOUBLE) / NULLIF(n1, 0) < 1.0 / 3.0, false) "
    "AS imbalanced FROM (SELECT COUNT(*) FILTER (WHERE label = 0) AS n0, COUNT(*) FILTER (WHERE label = 1) AS n1 FROM gd)"))
oracle("quantile_clip", gold_ctes(
    "SELECT id, loan_amnt FROM gd WHERE loan_amnt >= (SELECT quantile_cont(loan_amnt, 0.01) FROM gd) "
    "AND loan_amnt <= (SELECT quantile_cont(loan_amnt, 0.99) FROM gd)"))

# ======================================================================================
# D
# ======================================================================================
oracle("parse_percent", with_ctes(f"SELECT id, {cols(PERCENT_COLUMNS)} FROM sv"))
oracle("cast_numeric", with_ctes(f"SELECT id, {cols(NUMERIC_COLUMNS)} FROM sv"))
oracle("parse_month_date", with_ctes(f"SELECT id, {cols(DATE_COLUMNS)} FROM sv"))
oracle("fico_average", with_ctes("SELECT id, fico_range_low, fico_range_high, fico_avg FROM sv"))
oracle("share_percent", with_ctes(f"SELECT grade, COUNT(*) AS count, {pct('COUNT(*)', N_GOLD)} AS pct FROM gd GROUP BY grade"))

# ======================================================================================
# E
# ======================================================================================
oracle("row_count", with_ctes(f"SELECT COUNT(*) AS n_rows, CAST({len(gold_columns()) + 2} AS BIGINT) AS n_columns FROM gd"))
oracle("label_distribution", with_ctes(
    f"SELECT label, COUNT(*) AS count, {pct('COUNT(*)', N_GOLD)} AS pct FROM gd GROUP BY label"))
oracle("status_topk", with_ctes(
    f"SELECT loan_status, COUNT(*) AS count, {pct('COUNT(*)', N_GOLD)} AS pct FROM gd GROUP BY loan_status "
    "ORDER BY count DESC, loan_status ASC NULLS FIRST LIMIT 15"))

_CAT_LONG = " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({qi(c)} AS VARCHAR) AS value FROM gd"
                               for c in PROFILE_CATEGORICALS)
_CAT_RANKED = (f"SELECT column_name, value, count, ROW_NUMBER() OVER (PARTITION BY column_name "
               f"ORDER BY count DESC, value ASC NULLS FIRST) AS rank FROM "
               f"(SELECT column_name, value, COUNT(*) AS count FROM ({_CAT_LONG}) GROUP BY column_name, value)")
oracle("categorical_topk", with_ctes(
    f"SELECT column_name, rank, value, count, {pct('count', N_GOLD)} AS pct FROM ({_CAT_RANKED}) WHERE rank <= 10"))
oracle("dominant_value", with_ctes(
    f"SELECT column_name, value, count, {pct('count', N_GOLD)} AS pct FROM ({_CAT_RANKED}) WHERE rank = 1"))
oracle("describe_numeric", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT({qi(c)}) AS count, {r6(f'AVG({qi(c)})')} AS mean, "
    f"{r6(f'STDDEV_SAMP({qi(c)})')} AS stddev, {r6(f'MIN({qi(c)})')} AS min, {r6(f'MAX({qi(c)})')} AS max FROM gd"
    for c in DESCRIBE_COLUMNS)))
oracle("null_counts", with_ctes("SELECT COUNT(*) AS n_rows, " + ", ".join(
    f"COUNT(*) FILTER (WHERE {qi(c)} IS NULL) AS {qi(c)}" for c in DESCRIBE_COLUMNS) + " FROM sv"))
oracle("class_weights", gold_ctes("SELECT label, count, ROUND(weight, 6) AS weight FROM cw"))
oracle("with_class_weight", gold_ctes(
    'SELECT ft.*, ROUND(cw.weight, 6) AS "classWeight" FROM ft JOIN cw USING (label)'))
oracle("distinct_pairs", gold_ctes('SELECT DISTINCT label, ROUND(weight, 6) AS "classWeight" FROM cw'))
oracle("time_series_count", with_ctes("SELECT issue_d, COUNT(*) AS count FROM gd GROUP BY issue_d"))
oracle("histogram", with_ctes(
    "SELECT bins.bin, ROUND(b.lo + bins.bin * b.w, 6) AS bin_lo, ROUND(b.lo + (bins.bin + 1) * b.w, 6) AS bin_hi, "
    "COUNT(k.bin) AS count FROM (SELECT range AS bin FROM range(40)) bins "
    "CROSS JOIN (SELECT lo, hi, (hi - lo) / 40.0 AS w FROM (SELECT quantile_cont(loan_amnt, 0.01) AS lo, "
    "quantile_cont(loan_amnt, 0.99) AS hi FROM gd)) b "
    "LEFT JOIN (SELECT CAST(CASE WHEN q.w > 0 THEN LEAST(FLOOR((loan_amnt - q.lo) / q.w), 39) ELSE 0 END AS BIGINT) "
    "AS bin FROM gd, (SELECT lo, hi, (hi - lo) / 40.0 AS w FROM (SELECT quantile_cont(loan_amnt, 0.01) AS lo, "
    "quantile_cont(loan_amnt, 0.99) AS hi FROM gd)) q WHERE loan_amnt >= q.lo AND loan_amnt <= q.hi) k "
    "ON k.bin = bins.bin GROUP BY bins.bin, b.lo, b.w"))

_CM = ("SELECT model, COUNT(*) AS n, "
       "COUNT(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, COUNT(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp, "
       "COUNT(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, COUNT(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp "
       "FROM scored GROUP BY model")
oracle("confusion_matrix", scored_ctes(
    "SELECT *, " + ", ".join(f"{pct(k, 'n')} AS {k}_pct" for k in ("tn", "fp", "fn", "tp")) + f" FROM ({_CM})"))

# ======================================================================================
# F, G, H
# ======================================================================================
_CLS = (
    "SELECT model, ROUND(SUM(tp) / SUM(n_true), 6) AS accuracy, "
    "ROUND(SUM(n_true * COALESCE(tp / NULLIF(n_pred, 0), 0)) / SUM(n_true), 6) AS precision, "
    "ROUND(SUM(n_true * COALESCE(tp / NULLIF(n_true, 0), 0)) / SUM(n_true), 6) AS recall, "
    "ROUND(SUM(n_true * CASE WHEN COALESCE(tp / NULLIF(n_pred, 0), 0) + COALESCE(tp / NULLIF(n_true, 0), 0) > 0 "
    "THEN 2 * COALESCE(tp / NULLIF(n_pred, 0), 0) * COALESCE(tp / NULLIF(n_true, 0), 0) / "
    "(COALESCE(tp / NULLIF(n_pred, 0), 0) + COALESCE(tp / NULLIF(n_true, 0), 0)) ELSE 0 END) / SUM(n_true), 6) AS f1 "
    "FROM (SELECT model, cls, CAST(SUM(n_true) AS DOUBLE) AS n_true, CAST(SUM(n_pred) AS DOUBLE) AS n_pred, "
    "CAST(SUM(tp) AS DOUBLE) AS tp FROM ("
    "SELECT model, CAST(label AS DOUBLE) AS cls, 1 AS n_true, 0 AS n_pred, CASE WHEN label = prediction THEN 1 ELSE 0 END AS tp FROM scored "
    "UNION ALL SELECT model, prediction AS cls, 0, 1, 0 FROM scored) GROUP BY model, cls) GROUP BY model"
)
_SCORE_COUNTS = ("SELECT model, score, COUNT(*) FILTER (WHERE label = 1) AS pos, COUNT(*) FILTER (WHERE label = 0) AS neg "
                 "FROM scored GROUP BY model, score")
_AUC = (
    "SELECT model, ROUND(SUM(pos * (neg_below + 0.5 * neg)) / (SUM(pos) * SUM(neg)), 6) AS auc FROM ("
    "SELECT *, COALESCE(SUM(neg) OVER (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
    f"AS neg_below FROM ({_SCORE_COUNTS})) GROUP BY model"
)
_METRICS = (f"SELECT a.model, a.auc, c.accuracy, c.f1, c.precision, c.recall, m.tn, m.fp, m.fn, m.tp "
            f"FROM ({_AUC}) a JOIN ({_CLS}) c USING (model) JOIN ({_CM}) m USING (model)")
oracle("auc_roc", scored_ctes(_AUC))
oracle("classification_metrics", scored_ctes(_CLS))
oracle("metrics_by_model", scored_ctes(_METRICS))
oracle("roc_curve", scored_ctes(
    "SELECT model, ROUND(score, 6) AS threshold, "
    "ROUND(SUM(neg) OVER w / SUM(neg) OVER (PARTITION BY model), 6) AS fpr, "
    "ROUND(SUM(pos) OVER w / SUM(pos) OVER (PARTITION BY model), 6) AS tpr "
    f"FROM ({_SCORE_COUNTS}) WINDOW w AS (PARTITION BY model ORDER BY score DESC "
    "RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"))
oracle("model_leaderboard", scored_ctes(
    "SELECT *, ROW_NUMBER() OVER (ORDER BY auc DESC NULLS LAST, model) AS rank, "
    "ROW_NUMBER() OVER (ORDER BY auc DESC NULLS LAST, model) = 1 AS is_best, "
    f"model = 'm2' AS is_best_tree FROM ({_METRICS})"))

_FT_COLS = NUMERIC_FEATURES + CATEGORICAL_FEATURES + ["label"]
oracle("except_distinct", gold_ctes(
    f'SELECT {cols(_FT_COLS)}, ROUND("classWeight", 6) AS "classWeight" FROM ('
    f'SELECT {cols(_FT_COLS)}, "classWeight" FROM ws EXCEPT '
    f'SELECT {cols(_FT_COLS)}, "classWeight" FROM ws WHERE split = \'train\')'))
oracle("train_test_split", gold_ctes("SELECT id, label, split FROM ws"))
oracle("split_report", gold_ctes("SELECT split, label, COUNT(*) AS count FROM ws GROUP BY split, label"))

# ======================================================================================
# I
# ======================================================================================
_IDX = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, value, CAST(ROW_NUMBER() OVER (ORDER BY n DESC, value ASC) - 1 AS DOUBLE) AS idx, "
    f"COUNT(*) OVER () AS n_labels FROM (SELECT {qi(c)} AS value, COUNT(*) AS n FROM ft GROUP BY {qi(c)})"
    for c in CATEGORICAL_FEATURES)
oracle("string_index", gold_ctes(f"SELECT column_name, value, idx FROM ({_IDX})"))
oracle("string_index_table", ORACLES["string_index"])
oracle("one_hot", gold_ctes(
    f"SELECT column_name, value, CAST(n_labels AS INTEGER) AS size, CAST(idx AS BIGINT) AS active FROM ({_IDX})"))
oracle("assemble_numeric", gold_ctes(" UNION ALL ".join(
    f"SELECT id, {i} AS slot, {qi(c)} AS value FROM ft" for i, c in enumerate(NUMERIC_FEATURES))))
oracle("standard_scale", gold_ctes(" UNION ALL ".join(
    f"SELECT id, {i} AS slot, ROUND(CASE WHEN s.sd = 0 OR s.sd IS NULL THEN 0.0 ELSE ({qi(c)} - s.m) / s.sd END, 6) AS value "
    f"FROM ft, (SELECT AVG({qi(c)}) AS m, STDDEV_SAMP({qi(c)}) AS sd FROM ft) s"
    for i, c in enumerate(NUMERIC_FEATURES))))


def _vector(fit: str) -> str:
    """CTEs for (id, slot, value) of every non-zero slot, the pipeline fitted on the rows of ``ws`` where ``fit``."""
    parts = [f"SELECT ws.id, {i} AS slot, CASE WHEN s.sd = 0 OR s.sd IS NULL THEN 0.0 ELSE ({qi(c)} - s.m) / s.sd END AS value "
             f"FROM ws, (SELECT AVG({qi(c)}) AS m, STDDEV_SAMP({qi(c)}) AS sd FROM ws WHERE {fit}) s"
             for i, c in enumerate(NUMERIC_FEATURES)]
    before = str(len(NUMERIC_FEATURES))
    for c in CATEGORICAL_FEATURES:
        parts.append(
            f"SELECT ws.id, {before} + x.idx AS slot, 1.0 AS value FROM ws JOIN (SELECT value, ROW_NUMBER() OVER (ORDER BY n DESC, "
            f"value ASC) - 1 AS idx FROM (SELECT {qi(c)} AS value, COUNT(*) AS n FROM ws WHERE {fit} GROUP BY {qi(c)})) x "
            f"ON ws.{qi(c)} = x.value")
        before += f" + (SELECT COUNT(DISTINCT {qi(c)}) FROM ws WHERE {fit})"
    return f"vec AS ({' UNION ALL '.join(parts)}), size AS (SELECT {before} AS n_slots)"


def vector_ctes(fit: str, body: str) -> str:
    return gold_ctes(f", {_vector(fit)} {body}")


_IN_TRAIN = "split = 'train'"
oracle("assemble_features", vector_ctes("true", "SELECT id, CAST(slot AS INTEGER) AS slot, ROUND(value, 6) AS value FROM vec "
                                                "WHERE ROUND(value, 6) <> 0"))
_READY = ('label, ROUND("classWeight", 6) AS "classWeight", split, CAST((SELECT n_slots FROM size) AS INTEGER) AS n_slots, '
          "ROUND(t.total, 4) AS slot_sum FROM ws JOIN (SELECT id, SUM(value * (slot + 1)) AS total FROM vec GROUP BY id) t USING (id)")
oracle("feature_pipeline", vector_ctes(_IN_TRAIN, f"SELECT id, {_READY}"))
oracle("gold_to_ml_ready", vector_ctes(_IN_TRAIN, f"SELECT {_READY}"))

# ======================================================================================
# H, J: samples and models
# ======================================================================================
oracle("stratified_sample", gold_ctes(
    "SELECT label, COUNT(*) AS n_rows, true AS subset, true AS share_ok FROM ft GROUP BY label"))
oracle("uniform_sample", with_ctes("SELECT COUNT(*) AS n_rows, true AS subset, true AS share_ok FROM gd"))
oracle("split_parity", gold_ctes(
    "SELECT label, COUNT(*) AS n_distinct, true AS disjoint, true AS test_distinct, true AS train_is_larger "
    f"FROM (SELECT DISTINCT {cols(NUMERIC_FEATURES + CATEGORICAL_FEATURES + ['label'])} FROM ft) GROUP BY label"))
_CHECKED = ("(SELECT COUNT(*) FROM ws WHERE split = 'test') AS n_test, "
            "(SELECT COUNT(*) FROM ws WHERE split = 'test' AND label = 1) AS n_positive, "
            "true AS accuracy_ok, true AS recall_is_accuracy, true AS auc_ok, true AS timed")
_MODELS = {"train_logistic_regression": "LogisticRegression", "train_linear_svc": "LinearSVC",
           "train_decision_tree": "DecisionTree", "train_random_forest": "RandomForest", "train_gbt": "GBTClassifier"}
for _key, _model in _MODELS.items():
    oracle(_key, gold_ctes(f"SELECT '{_model}' AS model_name, {_CHECKED}"))
oracle("train_all", gold_ctes(
    f"SELECT m.model_name, {_CHECKED}, CAST(1 AS BIGINT) AS n_best, CAST(1 AS BIGINT) AS n_best_tree, 5 AS n_models "
    f"FROM (VALUES {', '.join(f'({chr(39)}{m}{chr(39)})' for m in _MODELS.values())}) m(model_name)"))
oracle("train_and_evaluate", vector_ctes(_IN_TRAIN, (
    "SELECT 'DecisionTree' AS model_name, label, COUNT(*) AS n_rows, true AS binary, true AS in_matrix, 1.0 AS importance_sum, "
    "CAST((SELECT n_slots FROM size) AS BIGINT) AS n_slots FROM ws WHERE split = 'test' GROUP BY label")))
oracle("probability_score", gold_ctes(
    "SELECT id, label, true AS in_range, true AS predicts_half, true AS is_logistic FROM ws WHERE split = 'test'"))
oracle("feature_importance_topk", vector_ctes(_IN_TRAIN, (
    "SELECT CAST(range AS INTEGER) AS rank, true AS named, true AS in_order, true AS in_range "
    "FROM range(1, 16), size WHERE range <= n_slots")))

# ======================================================================================
# K, L
# ======================================================================================
oracle("stream_bronze", slb_select())
oracle("stream_append_sink", slb_select())
oracle("restart_from_checkpoint", slb_select())
oracle("message_source",
       f"SELECT '{fx.MESSAGE_TOPIC}' AS topic, CAST(o_orderkey % {fx.MESSAGE_PARTITIONS} AS INTEGER) AS partition, "
       f"CAST(floor(o_orderkey / {fx.MESSAGE_PARTITIONS}) AS BIGINT) AS offset, o_orderdate AS timestamp, "
       f"(o_orderkey % {fx.BAD_JSON_EVERY} <> 0 AND o_orderkey % {fx.NULL_JSON_EVERY} = 0) AS value_is_null "
       "FROM orders JOIN customer ON o_custkey = c_custkey")
oracle("rate_limit", f"SELECT COUNT(*) AS batch_rows FROM orders JOIN customer ON o_custkey = c_custkey "
                     f"GROUP BY floor(o_orderkey / {BATCH_KEYS})")
oracle("stream_progress", f"SELECT COUNT(*) AS batch_rows, COUNT(*) AS landed_rows, true AS same_total, true AS timed "
                          f"FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY floor(o_orderkey / {BATCH_KEYS})")
oracle("stream_fan_out", f"SELECT *, CASE WHEN id IS NULL THEN 'rejected' ELSE 'loans' END AS sink FROM ({slb_select()}) t")
oracle("stream_silver", stream_ctes("SELECT * FROM ssv"))
oracle("chained_streams", stream_ctes("SELECT * FROM ssv"))
oracle("ingest_progress", (
    "WITH b AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS t, COUNT(*) AS n FROM events GROUP BY 1), "
    "c AS (SELECT t, n, CAST(SUM(n) OVER (ORDER BY t) AS BIGINT) AS total, LAG(t) OVER (ORDER BY t) AS prev, "
    "MIN(t) OVER () AS first FROM b) "
    "SELECT t AS batch_time, n AS batch_rows, total AS total_rows, "
    "ROUND(CASE WHEN prev IS NOT NULL AND epoch(t) - epoch(prev) > 0 THEN n / (epoch(t) - epoch(prev)) ELSE 0.0 END, 6) "
    "AS rows_per_sec, "
    "ROUND(CASE WHEN epoch(t) - epoch(first) > 0 THEN total / (epoch(t) - epoch(first)) ELSE 0.0 END, 6) "
    "AS avg_rows_per_sec FROM c"))
oracle("bronze_to_silver", with_ctes(f"SELECT {cols(SILVER_ORDER)} FROM sv"))
oracle("silver_to_gold", with_ctes(f"SELECT {cols(gold_columns())} FROM gd"))
oracle("label_weights", gold_ctes(
    f"SELECT label, COUNT(*) AS count, {pct('COUNT(*)', N_GOLD)} AS pct, "
    "(SELECT ROUND(weight, 6) FROM cw WHERE cw.label = gd.label) AS weight FROM gd GROUP BY label"))

# ======================================================================================
# Operators registered through the query that uses them
# ======================================================================================
_KIND = {"double": "numeric", "int": "numeric", "long": "numeric", "string": "string"}
oracle("columns_by_type", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT({qi(c)}) AS non_null, '{_KIND[SILVER_TYPES[c]]}' AS kind FROM sv"
    for kind in ("numeric", "string") for c in SILVER_ORDER if _KIND.get(SILVER_TYPES[c]) == kind)))
oracle("first_existing_column", ORACLES["time_series_count"])
oracle("trim", ORACLES["blank_to_null"])
oracle("typed_null_literals", f"WITH lb AS ({lb_select()}) SELECT id, {BACKFILL_META} FROM lb")
oracle("audit_timestamp", f"WITH lb AS ({lb_select()}) SELECT COUNT(*) AS n_rows, CAST(1 AS BIGINT) AS "
                          "n_processing_stamps, CAST(1 AS BIGINT) AS n_ingestion_stamps, CAST(0 AS BIGINT) AS n_missing FROM lb")
oracle("json_parse", ORACLES["publish_json"])
oracle("order_by", ORACLES["label_distribution"])
oracle("limit_n", with_ctes(
    f"SELECT loan_status, COUNT(*) AS count, {pct('COUNT(*)', N_GOLD)} AS pct FROM gd GROUP BY loan_status "
    "ORDER BY count DESC, loan_status ASC NULLS FIRST LIMIT 5"))
oracle("distinct", ORACLES["distinct_pairs"])


# ======================================================================================
# Gold profile: the tables above as (part, key, measure, value) rows
# ======================================================================================
_PROFILE_SOURCES = {
    "shape": ORACLES["row_count"],
    "label_distribution": ORACLES["label_distribution"],
    "class_balance": ORACLES["imbalance_flag"],
    "describe": ORACLES["describe_numeric"],
    "null_profile": with_ctes(" UNION ALL ".join(_null_row(c).replace("FROM sv", "FROM gd") for c in DESCRIBE_COLUMNS)),
    "categorical": ORACLES["categorical_topk"],
    "dominant": ORACLES["dominant_value"],
    "status_top": ORACLES["status_topk"],
    "time_series": ORACLES["time_series_count"],
    "histogram": ORACLES["histogram"],
}


def _profile_part(name: str) -> str:
    keys, values = PROFILE_PARTS[name]
    key = " || '|' || ".join(f"COALESCE(CAST({qi(k)} AS VARCHAR), 'NULL')" for k in keys) or "''"
    return " UNION ALL ".join(
        f"SELECT '{name}' AS part, {key} AS key, '{v}' AS measure, CAST({qi(v)} AS DOUBLE) AS value "
        f"FROM ({_PROFILE_SOURCES[name]})" for v in values)


oracle("gold_profile", " UNION ALL ".join(_profile_part(name) for name in PROFILE_PARTS))
