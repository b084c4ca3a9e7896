"""Streaming: batch = stream Silver, exactly-once restart, rate limit, ingest progress."""

from pyspark.sql import functions as F

from loanflow import catalog
from loanflow import fixtures as fx
from loanflow.schema import AUDIT_COLUMNS
from loanflow.session import scratch_path
from loanflow.sources import files
from loanflow.sources.messages import SourceConfig
from loanflow.streaming.ingest import stream_bronze, stream_silver
from loanflow.streaming.progress import ingest_progress

ONCE = {"availableNow": True}


def land(spark, sf, n_files=6):
    path = scratch_path(spark, "msgs")
    fx.messages(spark, sf).repartition(n_files).write.parquet(path)
    return path


def test_stream_silver_equals_batch_silver(spark, sf_small):
    src = land(spark, sf_small)
    b_out, b_ck = scratch_path(spark, "b"), scratch_path(spark, "bck")
    s_out, s_ck = scratch_path(spark, "s"), scratch_path(spark, "sck")
    stream_bronze(spark, SourceConfig(fmt="parquet", path=src, max_per_trigger=2), b_out, b_ck, ONCE).awaitTermination()
    stream_silver(spark, b_out, s_out, s_ck, ONCE).awaitTermination()
    meta = ["kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp"]
    streamed = files.read_table(spark, s_out).drop(*AUDIT_COLUMNS, *meta)
    # batch path over the same decoded rows
    from loanflow.plans.silver import bronze_to_silver
    from loanflow.sources.messages import decode_messages
    batch = bronze_to_silver(decode_messages(fx.messages(spark, sf_small))).drop(*AUDIT_COLUMNS, *meta)
    assert streamed.count() == batch.count() == 1500
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_rate_limit_and_progress(spark, sf_small):
    src = land(spark, sf_small, n_files=6)
    out, ck = scratch_path(spark, "b"), scratch_path(spark, "bck")
    stream_bronze(spark, SourceConfig(fmt="parquet", path=src, max_per_trigger=2), out, ck, ONCE).awaitTermination()
    table = files.read_table(spark, out)
    prog = ingest_progress(table).orderBy("batch_time").collect()
    assert len(prog) == 3  # 6 files, 2 per trigger
    assert prog[-1].total_rows == 1500 and prog[0].rows_per_sec == 0.0


def test_restart_no_loss_no_duplicates(spark, sf_small):
    df = catalog.REGISTRY["restart_from_checkpoint"](spark, sf_small)
    assert df.count() == 1500 and df.select("kafka_partition", "kafka_offset").distinct().count() == 1500


def test_ingest_progress_on_stamped_events(spark, sf_small):
    rows = ingest_progress(fx.stamped(spark, sf_small)).orderBy("batch_time").collect()
    assert rows[-1].total_rows == 1000
    assert all(r.total_rows == sum(x.batch_rows for x in rows[: i + 1]) for i, r in enumerate(rows))


def test_minimum_never_lowers_the_decode_tasks(spark, sf_small):
    """A trigger of 8 files is decoded by 8 tasks though the minimum is 2; batches and rows are unchanged."""
    import os

    src = land(spark, sf_small, n_files=24)
    out, ck = scratch_path(spark, "b"), scratch_path(spark, "bck")
    cfg = SourceConfig(fmt="parquet", path=src, max_per_trigger=8, min_partitions=2)
    small = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # one split per file
    try:
        q = stream_bronze(spark, cfg, out, ck, ONCE)
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", small)
    sizes = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    assert len(sizes) == 3 and sum(sizes) == 1500
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(parts) == 24  # 3 batches x 8 files
    table = files.read_table(spark, out)
    assert table.count() == 1500 and table.select("kafka_partition", "kafka_offset").distinct().count() == 1500
    assert len(ingest_progress(table).collect()) == 3


def test_admission_by_bytes(spark, sf_small):
    """Micro-batches follow the bytes of the files, not their number; by default one wave of tasks is taken."""
    import os

    src = land(spark, sf_small, n_files=8)
    sizes = [os.path.getsize(f"{src}/{f}") for f in os.listdir(src) if f.startswith("part-")]
    batches = {}
    for bound in (None, 1, 2 * max(sizes) + 1):
        cfg = SourceConfig(fmt="parquet", path=src, max_bytes_per_trigger=bound)
        out, ck = scratch_path(spark, "b"), scratch_path(spark, "bck")
        q = stream_bronze(spark, cfg, out, ck, ONCE)
        q.awaitTermination()
        batches[bound] = len([p for p in q.recentProgress if p["numInputRows"]])
        assert files.read_table(spark, out).count() == 1500
    assert batches[None] == 1 and batches[1] == 8 and batches[2 * max(sizes) + 1] in (3, 4)
    assert files.wave_bytes(spark) == spark.sparkContext.defaultParallelism * 128 * 2**20


def test_progress_log(spark, sf_small):
    from loanflow.streaming.progress import ProgressLog, progress_table

    src = land(spark, sf_small, n_files=6)
    log = scratch_path(spark, "log")
    assert progress_table(spark, log).count() == 0
    out, ck = scratch_path(spark, "b"), scratch_path(spark, "bck")
    with ProgressLog(spark, log, names={"watched"}, every=2):
        q = stream_bronze(spark, SourceConfig(fmt="parquet", path=src, max_per_trigger=2), out, ck, ONCE, name="watched")
        q.awaitTermination()
        stream_bronze(spark, SourceConfig(fmt="parquet", path=src), scratch_path(spark, "b"), scratch_path(spark, "bck"), ONCE, name="other").awaitTermination()
    told = progress_table(spark, log).orderBy("batch_id").collect()
    assert [r["batch_id"] for r in told] == [0, 1, 2] and {r["name"] for r in told} == {"watched"}
    assert [r["batch_rows"] for r in told] == [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    assert told[-1]["total_rows"] == 1500
    # a replayed batch reports again and counts once
    spark.read.parquet(log).where("batch_id = 1").write.mode("append").parquet(log)
    again = progress_table(spark, log).orderBy("batch_id").collect()
    assert [r["reports"] for r in again] == [1, 2, 1] and again[-1]["total_rows"] == 1500
    # nothing more is written once the log is closed
    n = spark.read.parquet(log).count()
    stream_bronze(spark, SourceConfig(fmt="parquet", path=src), scratch_path(spark, "b"), scratch_path(spark, "bck"), ONCE, name="watched").awaitTermination()
    assert spark.read.parquet(log).count() == n


def test_fan_out_is_exactly_once_across_a_failure(spark, sf_small):
    """The stream fails between its two sinks in one batch and inside a ledger in another; a restart repeats nothing."""
    import pytest

    from loanflow.sources.messages import read_messages
    from loanflow.streaming.fan_out import Sink, committed_batches, read_sink, start_fan_out

    src = land(spark, sf_small, n_files=6)
    keys = "topic string, partition int, offset long"
    first, second, ck = scratch_path(spark, "one"), scratch_path(spark, "two"), scratch_path(spark, "ck")
    sinks = [Sink("one", first, lambda b: b.select("topic", "partition", "offset")),
             Sink("two", second, lambda b: b.select("topic", "partition", "offset").where("partition = 1"))]
    wrote = []

    def run(fail_at):
        def between(sink, batch):
            wrote.append((sink.name, batch))
            if (sink.name, batch) == fail_at:
                raise RuntimeError("lost")

        stream = read_messages(spark, SourceConfig(fmt="parquet", path=src, max_per_trigger=2))
        start_fan_out(stream, sinks, ck, ONCE, between=between).awaitTermination()

    assert read_sink(spark, first, keys).count() == 0
    for fail_at in (("two", 0), ("one", 1)):
        with pytest.raises(Exception, match="lost"):
            run(fail_at)
    # the first sink has batch 0; the second wrote it, but without a marker at first: written again, not read twice
    assert committed_batches(spark, first) == [0] and committed_batches(spark, second) == [0]
    run(None)
    assert wrote.count(("one", 0)) == 1 and wrote.count(("two", 0)) == 2 and wrote.count(("one", 1)) == 2
    a, b = read_sink(spark, first, keys), read_sink(spark, second, keys)
    assert a.count() == a.distinct().count() == 1500
    assert b.count() == b.distinct().count() == a.where("partition = 1").count()
    run(None)  # nothing new
    assert read_sink(spark, first, keys).count() == 1500


def test_chain_hands_over_every_commit(spark, sf_small):
    from loanflow.streaming.ingest import run_chain, unconsumed_files

    src = land(spark, sf_small, n_files=6)
    b_out, b_ck, s_out, s_ck = (scratch_path(spark, n) for n in ("b", "bck", "s", "sck"))
    assert unconsumed_files(spark, b_out, s_ck) == 0
    silver = stream_silver(spark, b_out, s_out, s_ck, trigger={"processingTime": "1 second"}, max_files_per_trigger=1)
    bronze = stream_bronze(spark, SourceConfig(fmt="parquet", path=src, max_per_trigger=2), b_out, b_ck, ONCE)
    run_chain(spark, bronze, silver, b_out, s_ck)
    assert not silver.isActive and not bronze.isActive
    assert unconsumed_files(spark, b_out, s_ck) == 0
    assert files.read_table(spark, s_out).count() == 1500
    # more Bronze that no Silver has read is seen as such
    spark.read.parquet(src).limit(5).write.mode("append").parquet(src)
    stream_bronze(spark, SourceConfig(fmt="parquet", path=src), b_out, b_ck, ONCE).awaitTermination()
    assert unconsumed_files(spark, b_out, s_ck) >= 1


def test_chain_raises_what_stops_it(spark, sf_small):
    import pytest
    from pyspark.sql import functions as F

    from loanflow.streaming.ingest import run_chain

    src = land(spark, sf_small, n_files=2)
    b_out, b_ck, s_out, s_ck = (scratch_path(spark, n) for n in ("b", "bck", "s", "sck"))
    silver = stream_silver(spark, b_out, s_out, s_ck, trigger={"processingTime": "1 second"})
    broken = files.stream_table(spark, src, spark.read.parquet(src).schema).select(F.raise_error(F.lit("no more")).cast("int").alias("x"))
    bronze = files.append_stream(broken, b_out, b_ck, trigger=ONCE)
    with pytest.raises(RuntimeError, match="no more"):
        run_chain(spark, bronze, silver, b_out, s_ck)
    assert not silver.isActive and not bronze.isActive


def test_limited_streams_share_the_files(spark, sf_mid):
    """One file per micro-batch, dealt to a stream per task slot: four ranges of keys on four cores are four streams."""
    folders = catalog._land_ranges(spark, sf_mid)
    assert len(folders) == 4
    rows = catalog._limited_streams(spark, folders)
    got = ingest_progress(rows, by=["stream"]).select("stream", "batch_rows", "total_rows").collect()
    assert {r.stream for r in got} == set(folders)
    assert sorted(r.batch_rows for r in got) == [3000, 4000, 4000, 4000] and all(r.total_rows == r.batch_rows for r in got)


def test_progress_of_each_stream_by_itself(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", 2), ("b", 4)], "stream string, s int").select(
        "stream", F.timestamp_seconds("s").alias("ingestion_timestamp"))
    got = {(r.stream, r.batch_rows, r.total_rows, r.rows_per_sec) for r in ingest_progress(rows, by=["stream"]).collect()}
    assert got == {("a", 1, 1, 0.0), ("a", 2, 3, 2.0), ("b", 1, 1, 0.0), ("b", 1, 2, 0.5)}


def test_progress_log_waits_for_late_reports(spark, sf_small, monkeypatch):
    """Reports that come more than ten seconds late are waited for, and none is written on the thread that reports."""
    import threading
    import time

    from pyspark.sql.streaming import StreamingQueryListener

    from loanflow.streaming.progress import ProgressLog, progress_table

    class Slow(StreamingQueryListener):
        def onQueryStarted(self, event):
            pass

        def onQueryProgress(self, event):
            time.sleep(6)

        def onQueryTerminated(self, event):
            pass

    reports, writes = set(), set()
    note, flush = ProgressLog.onQueryProgress, ProgressLog.flush
    monkeypatch.setattr(ProgressLog, "onQueryProgress", lambda self, e: (reports.add(threading.get_ident()), note(self, e))[1])
    monkeypatch.setattr(ProgressLog, "flush", lambda self: (writes.add(threading.get_ident()), flush(self))[1])
    src, log, slow = land(spark, sf_small, n_files=6), scratch_path(spark, "log"), Slow()
    spark.streams.addListener(slow)
    try:
        with ProgressLog(spark, log, every=1):
            stream_bronze(spark, SourceConfig(fmt="parquet", path=src, max_per_trigger=2), scratch_path(spark, "b"), scratch_path(spark, "bck"), ONCE).awaitTermination()
    finally:
        spark.streams.removeListener(slow)
    assert [r["total_rows"] for r in progress_table(spark, log).orderBy("batch_id").collect()][-1] == 1500
    assert reports and writes and not reports & writes
