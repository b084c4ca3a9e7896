"""Independent DuckDB texts for the correctness gate.

The oracle parses the loan rows with DuckDB's own functions (TRY_CAST,
TRY_STRPTIME, ...).  It shares with the package the fixture text and the
column lists of ``loanflow.schema``: a wrong list there would be wrong on both
sides, a wrong operator would not.  CTE names: ``lb`` raw rows, ``sv``
Silver (without audit stamps), ``gd`` Gold (without audit stamps).
"""

from __future__ import annotations

from loanflow import fixtures as fx
from loanflow.schema import (
    CATEGORICAL_FEATURES,
    DATE_COLUMNS,
    DEFAULT_STATUSES,
    GOLD_DROP_COLUMNS,
    HIGH_RISK_GRADES,
    LOAN_COLUMNS,
    NUMERIC_COLUMNS,
    NUMERIC_FEATURES,
    PERCENT_COLUMNS,
)

NUM = set(NUMERIC_COLUMNS)
PCT = set(PERCENT_COLUMNS)
DAT = set(DATE_COLUMNS)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def qi(name: str) -> str:
    """Quoted identifier (some loan columns, e.g. ``desc``, are reserved words)."""
    return '"' + name + '"'


def in_list(values) -> str:
    return ", ".join(q(v) for v in values)


def lb_select(extra: str = "") -> str:
    """Raw loan rows; the fixture text with DuckDB's month formatting."""
    month = "strftime(o_orderdate, '%b-%Y')"
    parts = [f"{fx.LOAN_BRONZE_EXPRS[c].replace('{MMM}', month)} AS {qi(c)}" for c in LOAN_COLUMNS]
    if extra:
        parts.append(extra)
    return "SELECT " + ",\n  ".join(parts) + "\nFROM orders JOIN customer ON o_custkey = c_custkey"


def slb_select() -> str:
    """Bronze as decoded from the message fixture: bad or missing payload -> all data NULL; Kafka columns."""
    month = "strftime(o_orderdate, '%b-%Y')"
    bad = f"(o_orderkey % {fx.BAD_JSON_EVERY} = 0 OR o_orderkey % {fx.NULL_JSON_EVERY} = 0)"
    parts = [f"CASE WHEN {bad} THEN NULL ELSE {fx.LOAN_BRONZE_EXPRS[c].replace('{MMM}', month)} END AS {qi(c)}"
             for c in LOAN_COLUMNS]
    parts += [f"'{fx.MESSAGE_TOPIC}' AS kafka_topic",
              f"CAST(o_orderkey % {fx.MESSAGE_PARTITIONS} AS INTEGER) AS kafka_partition",
              f"CAST(floor(o_orderkey / {fx.MESSAGE_PARTITIONS}) AS BIGINT) AS kafka_offset",
              "o_orderdate AS kafka_timestamp"]
    return "SELECT " + ",\n  ".join(parts) + "\nFROM orders JOIN customer ON o_custkey = c_custkey"


def _blank(c: str) -> str:
    return f"CASE WHEN trim({c}) = '' THEN NULL ELSE {c} END"


def sv_select(src: str = "lb", meta: bool = True) -> str:
    """Silver from raw rows, typed by DuckDB; backfill metadata when ``meta``."""
    parts = []
    for c in LOAN_COLUMNS:
        b = _blank(qi(c))
        if c in PCT:
            parts.append(f"TRY_CAST(replace({b}, '%', '') AS DOUBLE) AS {qi(c)}")
        elif c in NUM:
            parts.append(f"TRY_CAST({b} AS DOUBLE) AS {qi(c)}")
        elif c in DAT:
            parts.append(f"CAST(TRY_STRPTIME({b}, '%b-%Y') AS DATE) AS {qi(c)}")
        else:
            parts.append(f"{b} AS {qi(c)}")
    body = "SELECT " + ",\n  ".join(parts)
    if meta == "src":
        body += ",\n  kafka_topic, kafka_partition, kafka_offset, kafka_timestamp"
    elif meta:
        body += (",\n  'backfill_csv' AS kafka_topic, CAST(NULL AS INTEGER) AS kafka_partition,"
                 " CAST(NULL AS BIGINT) AS kafka_offset, CAST(NULL AS TIMESTAMP) AS kafka_timestamp")
    body += f"\nFROM {src}"
    derived = (
        "SELECT *, (fico_range_low + fico_range_high) / 2 AS fico_avg,\n"
        "  CASE WHEN annual_inc > 0 THEN loan_amnt / annual_inc END AS loan_to_income_ratio,\n"
        f"  COALESCE(grade IN ({in_list(HIGH_RISK_GRADES)}), false) AS is_high_risk,\n"
        "  COALESCE(contains(loan_status, 'Charged Off'), false) AS is_charged_off\n"
        f"FROM ({body}) t"
    )
    return derived


SILVER_TYPES = {}
for _c in LOAN_COLUMNS:
    SILVER_TYPES[_c] = "double" if (_c in NUM or _c in PCT) else ("date" if _c in DAT else "string")
SILVER_TYPES.update({"kafka_topic": "string", "kafka_partition": "int", "kafka_offset": "long",
                     "kafka_timestamp": "timestamp", "fico_avg": "double", "loan_to_income_ratio": "double",
                     "is_high_risk": "boolean", "is_charged_off": "boolean"})
SILVER_ORDER = LOAN_COLUMNS + ["kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp",
                               "fico_avg", "loan_to_income_ratio", "is_high_risk", "is_charged_off"]


def gold_columns(keep=()) -> list[str]:
    drop = set(GOLD_DROP_COLUMNS) - set(keep)
    return [c for c in SILVER_ORDER if c not in drop] + ["label"]


def gd_select(src: str = "sv", keep=()) -> str:
    parts = []
    for c in gold_columns(keep):
        if c == "label":
            parts.append(f"CASE WHEN loan_status IN ({in_list(DEFAULT_STATUSES)}) THEN 1 ELSE 0 END AS label")
            continue
        t, c = SILVER_TYPES[c], qi(c)
        if t == "double":
            parts.append(f"CASE WHEN {c} IS NULL OR isnan({c}) THEN 0.0 ELSE {c} END AS {c}")
        elif t in ("int", "long"):
            parts.append(f"COALESCE({c}, 0) AS {c}")
        elif t == "string":
            parts.append(f"COALESCE({c}, 'Unknown') AS {c}")
        else:
            parts.append(c)
    return "SELECT " + ",\n  ".join(parts) + f"\nFROM {src}"


def with_ctes(body: str, gold_keep=()) -> str:
    return (f"WITH lb AS ({lb_select()}),\nsv AS ({sv_select()}),\ngd AS ({gd_select(keep=gold_keep)})\n{body}")


def features_select(src: str = "gd", keep=()) -> str:
    cols = list(keep) + NUMERIC_FEATURES + CATEGORICAL_FEATURES + ["label"]
    return f"SELECT {', '.join(qi(c) for c in cols)} FROM {src}"


def cols(names) -> str:
    return ", ".join(qi(c) for c in names)


SCORED = (
    "SELECT o_orderkey AS id, m.model AS model, "
    f"{fx.SCORED_LABEL_EXPR} AS label, "
    f"{fx.SCORE_EXPR} AS score, "
    f"CASE WHEN {fx.SCORE_EXPR} >= 0.5e0 THEN 1e0 ELSE 0e0 END AS prediction "
    "FROM orders, (SELECT 'm1' AS model, 0 AS shift UNION ALL SELECT 'm2' AS model, 1 AS shift) m"
)
