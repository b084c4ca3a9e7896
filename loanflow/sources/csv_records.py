"""Multi-line CSV read in parallel: any file is cut into splits, and records that cross a cut are put together again.

A line feed inside quotes does not end a record, so a split cannot tell by itself where its first record starts.
The parity of quotes can: with ``"`` as quote and as escape every quoted field holds an even number of
them, so a place is inside quotes exactly if an odd number of quotes lies before it in its file.

1. One narrow pass counts the quotes of every split.  A running sum over each file's splits says which of them start
   inside quotes; the driver takes their places only (16 bytes per such split, where planning a
   scan already holds an entry for every split).
2. A second narrow pass cuts the splits into records (Arrow batches, in order) and stages only the pieces at the
   ends of splits, at most two per split; the pieces of a record are joined in order.
3. The records that lie whole in a split are cut by the task that parses them with ``from_csv``; none of them is shuffled or
   written, so the disk holds no second copy of the text.

Result: the rows of ``read_loans_csv`` for quoted CSV as that writes and reads it (a quote only at the ends of a quoted
field, or doubled inside it), with its header per file, blank lines, missing trailing fields and nulls.  A file with a
lone quote inside an unquoted field is not such CSV; ``read_loans_csv`` reads it.  A compressed file is one split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanflow.schema import LOAN_SCHEMA
from loanflow.session import scratch_path

QUOTE = '"'
#: Tasks for small splits, for each task that the cluster runs at once.
TASKS_PER_SLOT = 4
_PIECES = "file long, start long, seq int, header boolean, record string"


def _lines(spark: SparkSession, path: str, split_bytes: int | None) -> DataFrame:
    """(file, start, value): the lines of all files in order within each split; both passes get the same splits.

    The scan is planned by a session of its own whose split size is fixed here, so that a cluster that grows or
    shrinks between the passes does not change it.
    """
    own = spark.newSession()
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    own.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes or split))
    own.conf.set("spark.sql.files.minPartitionNum", str(max(1, spark.sparkContext.defaultParallelism)))
    if split_bytes:
        own.conf.set("spark.sql.files.openCostInBytes", str(split_bytes))
    text = own.read.option("lineSep", "\n").text(path)
    lines = text.select(F.xxhash64(F.input_file_name()).alias("file"), F.input_file_block_start().alias("start"), "value")
    if not split_bytes or split_bytes >= split:
        return lines
    # a task takes one small split after another, up to a split of the session's size, in four tasks or more for each that runs at
    # once: tasks and staged files follow the data
    small = text.rdd.getNumPartitions()
    return lines.coalesce(max(1, TASKS_PER_SLOT * spark.sparkContext.defaultParallelism, -(-small * split_bytes // split)))


def _places(lines: DataFrame) -> tuple[set[tuple[int, int]], set[int]]:
    """Splits that start inside quotes, and files whose lines end in carriage return and line feed."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE)))
    first = F.when(F.col("start") == 0, F.col("value").endswith("\r"))
    splits = lines.groupBy("file", "start").agg(F.sum(quotes).alias("n"), F.first(first, ignorenulls=True).alias("crlf"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    odd = splits.select("file", "start", "crlf", (F.coalesce(before, F.lit(0)) % 2 == 1).alias("inside"))
    found = odd.where("inside OR crlf").collect()  # an entry per split that starts inside quotes
    return {(r["file"], r["start"]) for r in found if r["inside"]}, {r["file"] for r in found if r["crlf"]}


class _Cutter:
    """Cuts the lines of one split after another into records: ``whole`` ones (Arrow arrays), and ``pieces`` at the ends of splits."""

    def __init__(self, inside: set[tuple[int, int]], crlf: set[int]):
        self.inside_at, self.crlf = inside, crlf
        self.whole: list[pa.Array] = []
        self.pieces: list[tuple] = []
        self.key: tuple[int, int] | None = None

    def open(self, key: tuple[int, int]) -> None:
        self.close()
        self.key, self.held = key, []
        self.inside = self.continued = key in self.inside_at
        self.header = key[1] == 0
        self.strip = key[0] in self.crlf

    def lines(self, text: pa.Array, quotes: np.ndarray) -> None:
        """The next lines of the open split, and the number of quotes in each."""
        if self.strip:
            text = pc.if_else(pc.ends_with(text, "\r"), pc.utf8_slice_codeunits(text, 0, -1), text)
        parity = (np.cumsum(quotes) + self.inside) % 2
        ends = np.flatnonzero(parity == 0) + 1
        self.inside = bool(parity[-1])
        at = 0
        # one by one while what was held, a piece or the header may come
        while len(ends) and (self.held or self.continued or self.header):
            self.put("\n".join([*self.held, *text[at:ends[0]].to_pylist()]))
            at, ends = ends[0], ends[1:]
        if len(ends):
            bounds = pa.array(np.r_[at, ends] - at, pa.int32())
            records = pc.binary_join(pa.ListArray.from_arrays(bounds, text[at:ends[-1]]), "\n")
            self.whole.append(records.filter(pc.not_equal(records, "")))
            at = ends[-1]
        self.held += text[at:].to_pylist()

    def put(self, record: str, open_end: bool = False) -> None:
        self.held = []
        if self.continued or open_end:
            # goes on from the split before (1), or starts here and goes on into the next one (2)
            self.pieces.append((*self.key, 1 if self.continued else 2, self.header and not self.continued, record))
        elif record and not self.header:
            self.whole.append(pa.array([record], pa.string()))
        self.header = self.header and not record  # blank lines before the header are none
        self.continued = False

    def close(self) -> None:
        if self.key is not None and self.held:
            self.put("\n".join(self.held), True)
        self.key = None


def _cut(lines: DataFrame, inside: set, crlf: set, pieces: bool) -> DataFrame:
    """The pieces at the ends of splits, or the records that lie whole in a split."""
    names = [c.split()[0] for c in _PIECES.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _Cutter(inside, crlf)

        def ready() -> Iterator[pa.RecordBatch]:
            whole, cutter.whole = cutter.whole, []
            rows, cutter.pieces = cutter.pieces, []
            if pieces and rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
            elif not pieces and whole:
                yield from pa.Table.from_arrays([pa.chunked_array(whole)], names=["record"]).combine_chunks().to_batches()

        for b in batches:
            if not b.num_rows:
                continue
            file, start = (b.column(c).to_numpy() for c in ("file", "start"))
            text = b.column("value").cast(pa.string())
            quotes = pc.count_substring(text, QUOTE).to_numpy()
            cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
            for i, j in zip(np.r_[0, cuts], np.r_[cuts, b.num_rows]):
                key = int(file[i]), int(start[i])
                if key != cutter.key:
                    cutter.open(key)
                cutter.lines(text[i:j], quotes[i:j])
            yield from ready()
        cutter.close()
        yield from ready()

    return lines.mapInArrow(run, _PIECES if pieces else "record string")


def _joined(pieces: DataFrame) -> DataFrame:
    """(record, header): the pieces of each record, joined in order.

    A piece belongs to the last piece before it in its file that starts a record.  Windows run over the
    pieces only, at most two per split.
    """
    order = Window.partitionBy("file").orderBy("start", "seq")
    owner = F.last(F.when(F.col("seq") == 2, F.col("start")), ignorenulls=True).over(order)
    owned = pieces.withColumn("owner", owner)
    whole = owned.groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("start", "seq", "record"))).alias("p"), F.bool_or("header").alias("header"))
    return whole.select(F.array_join(F.col("p.record"), "\n").alias("record"), "header")


def read_csv_records(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    """(record): the text of every record of all files, without headers and blank lines; ``split_bytes`` bounds the splits."""
    lines = _lines(spark, path, split_bytes)
    inside, crlf = _places(lines)
    folder = scratch_path(spark, "csv-pieces")
    _cut(lines, inside, crlf, pieces=True).write.parquet(folder)
    joined = _joined(spark.read.schema(_PIECES).parquet(folder)).where("NOT header")
    # the first frame of a union gives its session, which is the caller's; the scan of the lines keeps the splits of its own
    return joined.select("record").unionByName(_cut(lines, inside, crlf, pieces=False))


def read_loans_csv_parallel(spark: SparkSession, path: str, schema=LOAN_SCHEMA, split_bytes: int | None = None) -> DataFrame:
    """The rows of ``read_loans_csv``, each file read by as many tasks as it has splits."""
    text = schema if isinstance(schema, str) else schema.simpleString()[len("struct<"):-1].replace(":", " ")
    options = {"quote": QUOTE, "escape": QUOTE, "mode": "PERMISSIVE"}
    row = F.from_csv("record", F.lit(text), options)
    return read_csv_records(spark, path, split_bytes).select(row.alias("row")).select("row.*")
