"""One stream into several tables, each micro-batch exactly once in every one of them.

Spark runs a ``foreachBatch`` function at least once per micro-batch.  ``FanOut`` makes that exactly once per
sink with a ledger: a micro-batch goes to a folder of its own in each sink (``batch_id=N``, replaced when it is
written again), and a marker in the sink's ledger is created after the write.  A replayed micro-batch
skips the sinks that have its marker and rewrites the others.  Readers take the folders that have a marker,
so a half-written batch is never seen.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from loanflow.sources.files import DEFAULT_FORMAT, ensure_folder, list_names, touch_once

BATCH = "batch_id"


@dataclass
class Sink:
    """A table at ``path`` that takes ``rows(batch)`` of every micro-batch."""

    name: str
    path: str
    rows: Callable[[DataFrame], DataFrame] = lambda batch: batch


def _ledger(path: str) -> str:
    return f"{path.rstrip('/')}/_ledger"


def committed_batches(spark: SparkSession, path: str) -> list[int]:
    """The micro-batches of a sink that are whole."""
    return sorted(int(n) for n in list_names(spark, _ledger(path)) if n.isdigit())


def read_sink(spark: SparkSession, path: str, schema, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """All rows of the committed micro-batches; no row where none is committed yet."""
    whole = committed_batches(spark, path)
    reader = spark.read.format(fmt).schema(schema)
    if not whole:
        return spark.createDataFrame([], schema)
    return reader.load([f"{path.rstrip('/')}/{BATCH}={b}" for b in whole])


class FanOut:
    """The ``foreachBatch`` function for a list of sinks.  ``between`` is called after each write (for tests of failures)."""

    def __init__(self, sinks: list[Sink], fmt: str = DEFAULT_FORMAT, between: Callable[[Sink, int], None] | None = None):
        if len({s.path.rstrip("/") for s in sinks}) != len(sinks):
            raise ValueError("sinks need folders of their own")
        self.sinks, self.fmt, self.between = sinks, fmt, between

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        todo = [s for s in self.sinks if str(batch_id) not in list_names(spark, _ledger(s.path))]
        if not todo:
            return
        batch = batch.persist()  # decoded once for all sinks
        try:
            for s in todo:
                s.rows(batch).write.format(self.fmt).mode("overwrite").save(f"{s.path.rstrip('/')}/{BATCH}={batch_id}")
                if self.between:
                    self.between(s, batch_id)
                touch_once(spark, f"{_ledger(s.path)}/{batch_id}")
        finally:
            batch.unpersist()


def start_fan_out(df: DataFrame, sinks: list[Sink], checkpoint: str, trigger: dict | None = None, name: str | None = None,
                  fmt: str = DEFAULT_FORMAT, between: Callable[[Sink, int], None] | None = None) -> StreamingQuery:
    """Start the stream ``df`` into all sinks; a restart on the same checkpoint and folders repeats no batch."""
    for s in sinks:
        ensure_folder(df.sparkSession, _ledger(s.path))
    writer = df.writeStream.foreachBatch(FanOut(sinks, fmt, between)).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or {"processingTime": "5 seconds"})).start()
