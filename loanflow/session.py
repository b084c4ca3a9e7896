"""Session helpers: a local session for tests/bench, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "loanflow", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster, use the session you are given.

    ``extra`` adds settings (for example an event log folder for ``tools/eventlog.py``).
    """
    builder = SparkSession.builder
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    return (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where the session names none, a local master gets a folder of our own; on a
    cluster that is an error, since executors would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="loanflow-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder for tables a job writes."""
    path = f"{checkpoint_root(spark)}/loanflow/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


#: Paths handed out by this process, for ``remove_scratch``.
_SCRATCH: list[str] = []


def remove_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables that this process wrote, once no frame read from them is needed; returns their number."""
    removed = 0
    while _SCRATCH:
        path = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        removed += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return removed


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint in the shared checkpoint folder.

    Used on grouped results that several later steps read (totals, offsets,
    split points): they then read the small checkpointed frame instead of
    re-running the scan and parse that produced it.  Survives executor loss
    (the data is in the shared folder, not on an executor).
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
