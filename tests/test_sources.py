"""Sources and sinks: CSV quirks, JSON decode, idempotent overwrite, optional scan, readiness."""
from loanflow.schema import BRONZE_COLUMNS, LOAN_COLUMNS
from loanflow.session import scratch_path
from loanflow.sources import files
from loanflow.sources.messages import decode_messages, to_messages
from loanflow.sources.reconcile import reconcile_counts


def test_csv_multiline_quotes_and_missing_columns(spark):
    path = scratch_path(spark, "csvtest")
    import os
    os.makedirs(path)
    header = ",".join(LOAN_COLUMNS)
    desc_idx = LOAN_COLUMNS.index("desc")
    vals = [""] * len(LOAN_COLUMNS)
    vals[0] = "1"
    vals[desc_idx] = '"line one\nline ""two"""'
    with open(f"{path}/part-0.csv", "w") as fh:
        fh.write(header + "\n" + ",".join(vals) + "\n")
    rows = files.read_loans_csv(spark, path).collect()
    assert len(rows) == 1 and rows[0]["desc"] == 'line one\nline "two"' and rows[0]["id"] == "1"
    assert rows[0]["member_id"] is None


def test_json_round_trip_and_bad_payload(spark):
    from test_silver import raw_rows

    raw = raw_rows(spark, [{"id": "1", "term": " 36 months", "emp_length": ""}])
    msgs = to_messages(raw, "t").selectExpr("key", "value", "topic", "CAST(0 AS INT) AS partition",
                                            "CAST(5 AS BIGINT) AS offset", "CAST(NULL AS TIMESTAMP) AS timestamp")
    bad = spark.createDataFrame([(None, bytearray(b"{bad"), "t", 0, 6, None)], msgs.schema)
    out = decode_messages(msgs.unionByName(bad)).orderBy("kafka_offset").collect()
    assert out[0]["term"] == " 36 months" and out[0]["emp_length"] == ""
    assert all(out[1][c] is None for c in LOAN_COLUMNS)
    assert list(out[0].asDict()) == BRONZE_COLUMNS


def test_overwrite_idempotent_and_optional_scan(spark):
    df = spark.range(10)
    path = scratch_path(spark, "ow")
    files.write_table(df, path)
    files.write_table(df, path)
    assert files.read_table(spark, path).count() == 10
    fallback = spark.range(3)
    assert files.read_or_else(spark, path + "_missing", fallback).count() == 3
    assert files.table_ready(spark, path) and not files.table_ready(spark, path + "_missing")


def test_reconcile_counts(spark):
    a = spark.range(5)
    r = reconcile_counts(a, a, a.limit(4)).first()
    assert (r.raw_count, r.bronze_count, r.silver_count, r.consistent) == (5, 5, 4, False)
    r = reconcile_counts(5, a, a).first()  # a count observed during a write stands in for a frame
    assert (r.raw_count, r.bronze_count, r.silver_count, r.consistent) == (5, 5, 5, True)


def test_versions_replace_atomically(spark):
    import pytest
    from pyspark.sql import functions as F

    from loanflow.sources import versions as v

    path = scratch_path(spark, "versions")
    with pytest.raises(FileNotFoundError):
        v.read_version(spark, path)
    assert v.write_version(spark.range(10), path) == 1
    with pytest.raises(Exception, match="half-way"):
        v.write_version(spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("half-way")).cast("long")).alias("id")), path)
    old = v.read_version(spark, path)
    assert old.count() == 10
    assert v.write_version(spark.range(5).withColumn("more", F.lit("x")), path) == 2
    assert old.count() == 10 and v.read_version(spark, path, 1).count() == 10  # a running reader keeps its version
    assert v.read_version(spark, path).columns == ["id", "more"]
    files.touch_once(spark, f"{path}/_versions/{3:012d}")  # a writer that died while it wrote its manifest
    assert v.read_version(spark, path).count() == 5
    assert v.write_version(spark.range(3), path) == 4
    assert not files.touch_once(spark, f"{path}/_versions/{4:012d}", "other\n")
    assert v.remove_old_versions(spark, path, keep=1) == 3  # two old versions and what the failed write left
    assert v.read_version(spark, path).count() == 3 and [n for n, _ in v.versions(spark, path)] == [4]


def test_rows_of_writes_and_footers(spark):
    from loanflow.sources.write_metrics import WrittenRows, footer_count, footer_counts

    a, b, c = (scratch_path(spark, n) for n in "abc")
    with WrittenRows(spark) as w:
        spark.range(1000).repartition(3).where("id % 2 = 0").write.parquet(a)  # planned by adaptive execution
        spark.range(7).write.parquet(b)
        spark.range(0).write.parquet(c)
        assert (w.rows(a), w.rows(b), w.rows(c), w.rows(a + "x")) == (500, 7, 0, None)
        spark.range(9).write.mode("overwrite").parquet(b)
        assert w.rows(b) == 9
    spark.range(11).write.mode("overwrite").parquet(b)
    assert w.rows(b) == 9  # closed
    assert (footer_count(spark, a), footer_count(spark, b), footer_count(spark, c)) == (500, 11, 0)
    assert "PushedAggregation: [COUNT(*)]" in footer_counts(spark, a)._jdf.queryExecution().executedPlan().toString()


def test_backfill_scans_the_csv_once(spark, sf_small):
    """The reconciliation of a finished backfill reads no file: it is a projection of counts already known."""
    from loanflow import fixtures as fx
    from loanflow.plans.backfill import backfill

    csv = scratch_path(spark, "csv")
    files.write_loans_csv(fx.loan_bronze(spark, sf_small), csv)
    counts = backfill(spark, csv, scratch_path(spark, "b"), scratch_path(spark, "s"))
    assert "Scan" not in counts._jdf.queryExecution().executedPlan().toString()
    files.remove(spark, csv)
    row = counts.first()
    assert (row.raw_count, row.bronze_count, row.silver_count, row.consistent) == (1500, 1500, 1500, True)


def test_message_directories_are_packed(spark, sf_small):
    """Landed and published messages, which repeat their column names, and a stream's copy of them take the stronger codec."""
    import glob

    from loanflow import catalog
    from loanflow import fixtures as fx
    from loanflow.session import scratch_path
    from loanflow.sources import files, messages

    published, copy = scratch_path(spark, "published"), scratch_path(spark, "copy")
    messages.publish(fx.loan_bronze(spark, sf_small), "loans", path=published)
    landed = catalog._land_messages(spark, sf_small)
    stream = messages.read_messages(spark, messages.SourceConfig(fmt="parquet", path=landed))
    files.append_stream(stream, copy, scratch_path(spark, "ck"), trigger={"availableNow": True}, codec=messages.MESSAGE_CODEC).awaitTermination()
    for path in (published, landed, copy):
        assert glob.glob(f"{path.removeprefix('file:')}/part-*.zstd.parquet") and not glob.glob(f"{path.removeprefix('file:')}/part-*.snappy.parquet")
    assert files.read_table(spark, copy).count() == files.read_table(spark, published).count() == 1500
