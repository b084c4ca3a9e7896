"""Batch and streaming file/table sources and sinks.

``fmt`` defaults to parquet; pass ``fmt='delta'`` where the Delta connector is
installed - the calls are the same.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamReader, StreamingQuery

from loanflow.schema import LOAN_SCHEMA

DEFAULT_FORMAT = "parquet"


def read_loans_csv(spark: SparkSession, path: str, schema=LOAN_SCHEMA) -> DataFrame:
    """CSV with header, quoted multi-line fields, '"' as quote and escape, declared all-string schema.

    ``multiLine`` makes each file one split, so land the CSV as many files to read it in parallel.
    """
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("multiLine", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


#: Rows per landed file, so that the number of files follows the data.
LANDED_ROWS = 20_000


def write_loans_csv(df: DataFrame, path: str, rows_per_file: int = LANDED_ROWS) -> None:
    """The inverse of ``read_loans_csv`` (header, '"' quote and escape); files of ``rows_per_file`` rows at most, one reader task each."""
    (df.write.mode("overwrite").option("header", "true").option("quote", '"').option("escape", '"')
     .option("maxRecordsPerFile", rows_per_file)
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(path))


def stage_table(df: DataFrame, name: str = "stage", fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """Write ``df`` once as a table in the shared checkpoint folder and read it back.

    For frames that several fitting passes read: the passes scan a compact,
    column-pruned table instead of re-running the parse that built it, and the
    lineage is cut (a lost executor re-reads the table, it does not recompute).
    """
    from loanflow.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.format(fmt).mode("overwrite").save(path)
    return df.sparkSession.read.format(fmt).load(path)


def ensure_folder(spark: SparkSession, path: str) -> None:
    """Create an empty folder, so that a stream can watch it before its writer has started."""
    fs, folder = _folder(spark, path)
    fs.mkdirs(folder)


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none where it does not exist."""
    fs, folder = _folder(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(folder)) if fs.exists(folder) else []


def touch_once(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create a small file; False where it exists already (the file system decides which of two writers is first)."""
    fs, file = _folder(spark, path)
    try:
        out = fs.create(file, False)
    except Py4JJavaError as e:
        if fs.exists(file):
            return False
        raise e
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder or file; False where there was none."""
    fs, folder = _folder(spark, path)
    return bool(fs.delete(folder, True))


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    fs, file = _folder(spark, path)
    stream = fs.open(file)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def read_table(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    return spark.read.format(fmt).load(path)


def wave_bytes(spark: SparkSession) -> int:
    """Input of one full wave of tasks: as many splits of the session's size as the cluster runs tasks at once."""
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return split * max(1, spark.sparkContext.defaultParallelism)


def admitted(spark: SparkSession, reader: DataStreamReader, max_files: int | None = None, max_bytes: int | None = None) -> DataStreamReader:
    """What a micro-batch of a directory stream takes: a number of files where one is given, else files up to a number of bytes.

    Admission by size lets micro-batches follow the data and the cluster, however the files were cut.  A file larger than
    the bound still makes a batch of its own.
    """
    if max_files:
        return reader.option("maxFilesPerTrigger", max_files)
    return reader.option("maxBytesPerTrigger", max_bytes or wave_bytes(spark))


def stream_table(spark: SparkSession, path: str, schema, fmt: str = DEFAULT_FORMAT,
                 max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Incremental read of a table as a stream (file streams need the explicit schema), admitted by size unless files are counted."""
    reader = spark.readStream.format(fmt).schema(schema)
    return admitted(spark, reader, max_files_per_trigger, max_bytes_per_trigger).load(path)


def write_table(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT, mode: str = "overwrite") -> None:
    """Replace the whole table (schema included); running it twice leaves the same table."""
    writer = df.write.format(fmt).mode(mode)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    writer.save(path)


def append_stream(df: DataFrame, path: str, checkpoint: str, fmt: str = DEFAULT_FORMAT,
                  trigger: dict | None = None, name: str | None = None, codec: str | None = None) -> StreamingQuery:
    """Append every micro-batch with the native file sink: exactly-once through the checkpoint; ``codec`` where not the session's."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if codec:
        writer = writer.option("compression", codec)
    writer = writer.trigger(**(trigger or {"processingTime": "5 seconds"}))
    return writer.start(path)


def read_or_else(spark: SparkSession, path: str, other: DataFrame, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """The table at ``path``, or ``other`` when it cannot be read: missing, of another format, or with a broken first file.

    One row is read to find out; a file that turns out broken later fails the query that reads it.
    """
    try:
        df = read_table(spark, path, fmt)
        df.take(1)
        return df
    except (PySparkException, Py4JJavaError):
        return other


def table_ready(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> bool:
    """A table exists at ``path``, can be read and holds at least one row (reads one row, not a full count)."""
    try:
        return len(read_table(spark, path, fmt).limit(1).take(1)) > 0
    except (PySparkException, Py4JJavaError):
        return False


def save_pipeline(model, path: str) -> None:
    """Persist a fitted PipelineModel, replacing what is there."""
    model.write().overwrite().save(path)


def load_pipeline(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
