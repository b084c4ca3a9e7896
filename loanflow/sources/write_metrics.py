"""Row counts without another read: from the metrics of a write, and from the footers of written files."""

from __future__ import annotations

from pyspark.java_gateway import ensure_callback_server_started
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class _WriteListener:
    """The engine's side: hands the rows of each finished write of files to the ``WrittenRows`` that are open."""

    class Java:
        implements = ["org.apache.spark.sql.util.QueryExecutionListener"]

    def __init__(self):
        self.open: list[WrittenRows] = []

    def onSuccess(self, func_name, execution, duration_ns) -> None:  # noqa: N802 - the interface's name
        if not self.open:
            return
        plan = execution.executedPlan()
        while plan.nodeName() in ("AdaptiveSparkPlan", "ResultQueryStage"):
            plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan.plan()
        if plan.nodeName().startswith("Execute InsertIntoHadoopFsRelationCommand"):
            rows = plan.metrics().get("numOutputRows")
            if rows.isDefined():
                for w in self.open:
                    w.found[plan.cmd().outputPath().toString()] = rows.get().value()

    def onFailure(self, func_name, execution, error) -> None:  # noqa: N802
        pass


#: One listener per session of the engine: a proxy cannot be taken off again, so it stays and rests between uses.
_LISTENERS: dict[tuple, _WriteListener] = {}


def _listener(spark: SparkSession) -> _WriteListener:
    key = (spark.sparkContext.applicationId, spark._jsparkSession.hashCode())
    if key not in _LISTENERS:
        ensure_callback_server_started(spark.sparkContext._gateway)
        _LISTENERS[key] = _WriteListener()
        spark._jsparkSession.listenerManager().register(_LISTENERS[key])
    return _LISTENERS[key]


class WrittenRows:
    """The rows that each write of files reports while this context is open, by output path.

    (Not an ``Observation``: in Spark 4.1 its manager stays with the session and makes later model summaries
    unserializable.)
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.found: dict[str, int] = {}

    def __enter__(self) -> WrittenRows:
        _listener(self.spark).open.append(self)
        return self

    def __exit__(self, *_) -> None:
        self._settle()
        _listener(self.spark).open.remove(self)

    def _settle(self) -> None:
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()

    def rows(self, path: str) -> int | None:
        """Rows of the last finished write to ``path``; None where none was seen (another writer, another format)."""
        self._settle()
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return self.found.get(fs.makeQualified(folder).toString())


def footer_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row, ``n``: rows of a parquet table, as an aggregate that the scan answers from the files' footers."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))


def footer_count(spark: SparkSession, path: str) -> int:
    """Rows of a parquet table, from its files' footers; 0 for a folder without files."""
    return footer_counts(spark, path).first()["n"] or 0  # a scan without any footer answers null


