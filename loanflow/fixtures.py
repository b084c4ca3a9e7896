"""Loan-shaped inputs projected from the driver's TPC-H-like tables.

The reference ships no data, so every query runs on rows derived from
``orders`` (+ ``customer``) and ``events``.  All projections are row-local
except the ``orders``-``customer`` equi-join.  ``customer`` grows with
``orders``, so neither side has a size bound and the size decides how they are joined
(where it is a shuffle, adaptive execution splits a hot customer); only the seven joined columns move,
and the wide rows are built after it.  ``land`` writes the rows and the messages once, for timing what
reads them.  The expressions are those of the DuckDB fixtures, so both engines build identical
raw rows; Spark takes the month once for a row and reads the texts of remainders from tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanflow.schema import DATE_COLUMNS, LOAN_COLUMNS, LOAN_SCHEMA, MESSAGE_SCHEMA, NUMERIC_COLUMNS, PERCENT_COLUMNS
from loanflow.sources.messages import to_messages

# FIXED VALUES: the fixture text (loan-shaped rows from orders + customer).
MONTH_TEXT = "date_format(o_orderdate, 'MMM-yyyy')"
LOAN_BRONZE_EXPRS = {
    "id": "CAST(o_orderkey AS STRING)",
    "loan_amnt": "CAST(o_totalprice AS STRING)",
    "term": "CASE WHEN o_orderkey % 2 = 0 THEN ' 36 months' ELSE ' 60 months' END",
    "int_rate": "CONCAT(CAST(5 + o_orderkey % 25 AS STRING), '.', LPAD(CAST(o_orderkey % 100 AS STRING), 2, '0'), '%')",
    "installment": "CONCAT(CAST(100 + o_orderkey % 900 AS STRING), '.5')",
    "grade": "SUBSTRING('ABCDEFG', CAST(1 + o_orderkey % 7 AS INT), 1)",
    "sub_grade": "CONCAT(SUBSTRING('ABCDEFG', CAST(1 + o_orderkey % 7 AS INT), 1), CAST(1 + o_orderkey % 5 AS STRING))",
    "emp_length": "CASE WHEN o_orderkey % 11 = 0 THEN '  ' WHEN o_orderkey % 11 = 10 THEN '10+ years' "
                  "ELSE CONCAT(CAST(o_orderkey % 11 AS STRING), ' years') END",
    "home_ownership": "c_mktsegment",
    "annual_inc": "CASE WHEN o_orderkey % 50 = 7 THEN '' WHEN o_orderkey % 50 = 8 THEN '0' "
                  "ELSE CAST(c_acctbal AS STRING) END",
    "verification_status": "CASE o_orderstatus WHEN 'F' THEN 'Verified' WHEN 'P' THEN 'Source Verified' "
                           "ELSE 'Not Verified' END",
    "issue_d": "{MMM}",
    # the label follows the interest rate (o_orderkey % 25) only in part, the rest is a scrambled key: no model separates it
    "loan_status": "CASE WHEN o_orderkey % 25 > 16 AND o_orderkey * 104729 % 10009 % 3 = 0 THEN 'Charged Off' "
                   "ELSE CASE o_orderkey * 7919 % 10007 % 20 WHEN 0 THEN 'Charged Off' WHEN 1 THEN 'Default' "
                   "WHEN 2 THEN 'Does not meet the credit policy. Status:Charged Off' "
                   "WHEN 3 THEN 'Does not meet the credit policy. Status:Fully Paid' "
                   "WHEN 4 THEN 'Late (31-120 days)' WHEN 5 THEN 'Current' WHEN 6 THEN ' ' "
                   "ELSE 'Fully Paid' END END",
    "purpose": "o_orderpriority",
    "dti": "CASE WHEN o_orderkey % 40 = 3 THEN 'n/a' ELSE CONCAT(CAST(o_orderkey % 40 AS STRING), '.25') END",
    "earliest_cr_line": "CASE WHEN o_orderkey % 30 = 5 THEN 'bad-date' ELSE {MMM} END",
    "fico_range_low": "CAST(600 + (o_orderkey % 50) * 5 AS STRING)",
    "fico_range_high": "CAST(604 + (o_orderkey % 50) * 5 AS STRING)",
    "revol_util": "CASE WHEN o_orderkey % 17 = 0 THEN ' ' ELSE CONCAT(CAST(o_orderkey % 101 AS STRING), '.1%') END",
    "delinq_2yrs": "CAST(o_orderkey % 3 AS STRING)",
    "open_acc": "CAST(o_orderkey % 23 AS STRING)",
    "pub_rec": "CAST(o_orderkey % 2 AS STRING)",
    "revol_bal": "CAST(o_orderkey % 9973 AS STRING)",
    "total_acc": "CAST(o_orderkey % 41 AS STRING)",
    "mort_acc": "CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE CAST(o_orderkey % 6 AS STRING) END",
    "pub_rec_bankruptcies": "CAST(o_orderkey % 2 AS STRING)",
    "application_type": "CASE WHEN o_orderkey % 10 = 9 THEN 'Joint App' ELSE 'Individual' END",
    "initial_list_status": "CASE WHEN o_orderkey % 3 = 0 THEN 'w' ELSE 'f' END",
    "desc": "CASE WHEN o_orderkey % 9 = 0 THEN '' WHEN o_orderkey % 9 = 1 THEN CONCAT('first line, \"quoted\"', CHR(10), "
            "'second line ', CAST(o_orderkey AS STRING)) ELSE CONCAT('plain ', CAST(o_orderkey % 7 AS STRING)) END",
    "title": "CASE WHEN o_orderkey % 8 = 0 THEN '\"\"' WHEN o_orderkey % 8 = 1 THEN 'a, b' ELSE o_orderpriority END",
}


def _by_kind(column: str, n: int) -> str:
    """Values of the ``n``-th column without a text of its own: mostly well-formed for its kind, else blank or malformed."""
    k = f"o_orderkey % {n + 7}"
    if column in DATE_COLUMNS:
        value, bad = "{MMM}", "13-2015"
    elif column in PERCENT_COLUMNS:
        value, bad = f"CONCAT(CAST({k} AS STRING), '.25%')", "%%"
    elif column in NUMERIC_COLUMNS:
        value, bad = f"CONCAT(CAST({k} AS STRING), '.{n % 10}')", "1,5"
    else:
        value, bad = f"CONCAT('{column[:3]} ', CAST({k} AS STRING))", "  "
    return (f"CASE (o_orderkey + {n}) % 12 WHEN 0 THEN ' ' WHEN 1 THEN '' WHEN 2 THEN '{bad}' WHEN 3 THEN NULL "
            f"ELSE {value} END")


LOAN_BRONZE_EXPRS.update({c: _by_kind(c, n) for n, c in enumerate(LOAN_COLUMNS) if c not in LOAN_BRONZE_EXPRS})
#: A remainder of the key as text, alone or with a constant before or after it.
_REMAINDER = "CAST(o_orderkey % {m} AS STRING)"
_REMAINDER_TEXT = re.compile(r"CONCAT\((?:'([^',|]*)', )?{0}(?:, '([^',|]*)')?\)|{0}".format(
    re.escape(_REMAINDER).replace(re.escape("{m}"), r"(\d{1,3})")))


def _looked_up(text: str) -> str:
    """The same expression, with texts made of a remainder taken from a table of all of them.

    A remainder by m has 2 m - 1 values, since that of a negative key is negative.  The table is a literal once it is planned, so a row
    reads a text instead of making one; nearly all of the 151 columns are such texts.
    """
    def table_of(found: re.Match) -> str:
        before, m, after, alone = found.groups()
        m = int(m or alone)
        texts = "|".join(f"{before or ''}{k}{after or ''}" for k in range(1 - m, m))
        return f"get(split('{texts}', '[|]'), CAST(o_orderkey % {m} + {m - 1} AS INT))"

    return _REMAINDER_TEXT.sub(table_of, text)


#: The month of a row is one column for all the texts that hold it.
_MONTH = "_month"
_LOAN_EXPRS = [f"{_looked_up(LOAN_BRONZE_EXPRS[c]).replace('{MMM}', _MONTH)} AS `{c}`" for c in LOAN_COLUMNS]
# Message fixture: corrupt and missing payloads, partition/offset from the key.
BAD_JSON_EVERY = 97
NULL_JSON_EVERY = 89
MESSAGE_PARTITIONS = 4
MESSAGE_TOPIC = "loans"
# Scored fixture: two pseudo-models over orders.
SCORED_MODELS = [("m1", 0), ("m2", 1)]
SCORE_EXPR = ("CAST((o_orderkey * 7919 + shift * o_orderkey % 11 * 37) % 700 "
              "+ CASE WHEN o_orderkey % 20 < 3 THEN 200 ELSE 0 END AS DOUBLE) / 1000e0")
SCORED_LABEL_EXPR = "CASE WHEN o_orderkey % 20 < 3 THEN 1 ELSE 0 END"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    return orders.join(customer, orders.o_custkey == customer.c_custkey)


def _loan_rows(joined: DataFrame, extra=()) -> DataFrame:
    return joined.withColumn(_MONTH, F.expr(MONTH_TEXT)).selectExpr(*_LOAN_EXPRS, *extra)


#: Folders of landed fixtures: sf_dir -> (loan rows, messages).
_LANDED: dict[str, tuple[str, str]] = {}


def land(spark: SparkSession, sf_dir: str, tasks: int) -> None:
    """Write the loan rows and messages of ``sf_dir`` as tables of ``tasks`` files; from now on this process reads those."""
    from loanflow.session import scratch_path

    rows, msgs = scratch_path(spark, "landed-loans"), scratch_path(spark, "landed-messages")
    loan_bronze(spark, sf_dir).repartition(tasks).write.parquet(rows)
    messages(spark, sf_dir).repartition(tasks).write.parquet(msgs)
    _LANDED[sf_dir.rstrip("/")] = (rows, msgs)


def landed_messages(sf_dir: str) -> str | None:
    """The folder of landed messages, where ``land`` wrote them."""
    landed = _LANDED.get(sf_dir.rstrip("/"))
    return landed[1] if landed else None


def loan_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw all-string loan rows (151 columns, each with well-formed, blank and malformed values)."""
    landed = _LANDED.get(sf_dir.rstrip("/"))
    return spark.read.schema(LOAN_SCHEMA).parquet(landed[0]) if landed else _loan_rows(_joined(spark, sf_dir))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message-shaped rows (Kafka layout) carrying ``loan_bronze`` as JSON, with planted bad payloads."""
    landed = _LANDED.get(sf_dir.rstrip("/"))
    if landed:
        return spark.read.schema(MESSAGE_SCHEMA).parquet(landed[1])
    return _message_rows(_joined(spark, sf_dir))


def ranged_messages(spark: SparkSession, sf_dir: str, keys: int, shares: int) -> DataFrame:
    """``messages`` with their ``range`` of ``keys`` order keys, and its ``share`` of all ranges; the rows of a range lie together in one task.

    The narrow joined rows are dealt out and sorted, and the messages are built where they then lie.
    """
    def dealt(rows: DataFrame, key) -> DataFrame:
        rows = rows.withColumn("range", F.floor(key / keys)).withColumn("share", F.col("range") % shares)
        return rows.repartition("range").sortWithinPartitions("share", "range")

    if _LANDED.get(sf_dir.rstrip("/")):
        return dealt(messages(spark, sf_dir), F.col("offset") * MESSAGE_PARTITIONS + F.col("partition"))
    return _message_rows(dealt(_joined(spark, sf_dir), F.col("o_orderkey")), keep=["share", "range"])


def _message_rows(joined: DataFrame, keep=()) -> DataFrame:
    raw = _loan_rows(joined, extra=["CAST(o_orderdate AS TIMESTAMP) AS _ts", *keep])
    msg = to_messages(raw, MESSAGE_TOPIC, keep=["id", "_ts", *keep])
    k = F.col("id").cast("long")
    value = (F.when(k % BAD_JSON_EVERY == 0, F.lit("{bad").cast("binary"))
             .when(k % NULL_JSON_EVERY == 0, F.lit(None).cast("binary"))
             .otherwise(F.col("value")))
    return msg.select(
        "key",
        value.alias("value"),
        "topic",
        (k % MESSAGE_PARTITIONS).cast("int").alias("partition"),
        F.floor(k / MESSAGE_PARTITIONS).cast("long").alias("offset"),
        F.col("_ts").alias("timestamp"),
        *keep,
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, model, label, score, prediction): two score columns per order, many tied scores.

    The two models are a literal array exploded per row - a narrow Generate, not a join.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(s).alias("shift")) for m, s in SCORED_MODELS])
    rows = orders.select("o_orderkey", F.inline(models))
    score = F.expr(SCORE_EXPR)
    return rows.select(
        F.col("o_orderkey").alias("id"),
        "model",
        F.expr(SCORED_LABEL_EXPR).alias("label"),
        score.alias("score"),
        F.when(score >= 0.5, F.lit(1.0)).otherwise(F.lit(0.0)).alias("prediction"),
    )


def stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with a day-grain ``ingestion_timestamp``: each day stands in for one micro-batch."""
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id", "user_id",
        F.date_trunc("day", F.col("ts")).cast("timestamp").alias("ingestion_timestamp"),
    )
