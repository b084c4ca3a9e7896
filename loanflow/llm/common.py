"""Helpers shared by the operators: inputs, staged tables, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanflow.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """(doc_id, text, *more) of any input: null text is the empty text; other columns are left out, so their names cannot clash."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        *[F.col(c) for c in more],
    )


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the cluster's shared folder and read back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Record batches of few rows, so that a task holds few texts as Python strings at once."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, root), root the smallest node of its component.

    Alternates two steps until nothing changes.  Large-star points every larger
    neighbour of a node at the node's smallest neighbour; small-star does the
    same for the smaller ones.  Each round is two grouped minima and joins over
    the edge list, staged as a table; paths shrink by half or more, so the number of rounds
    follows the logarithm of the longest path.  A node with very many neighbours is
    a skewed join key, which adaptive execution splits; its minimum is combined map-side.
    """
    cur = staged(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        star = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = star.where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        cur = staged(small.select("e.a", "e.b").where("a != b").distinct(), "edges")
        now = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").bitwiseAND(0xFFFFFFFF))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components: no fixed point after {max_rounds} rounds")
    nodes = cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root")).distinct()
