"""Exact deduplication by content-defined chunk recipes, in DataFrame expressions only.

1. Every text is cut at content-defined places (a sentence or line end after at
   least ``MIN_CHUNK`` characters, at most ``MAX_CHUNK``), so equal texts are cut alike.
2. The chunk store keeps each different chunk once.  A chunk's identifier is its
   SHA-256; the store is checked to hold one text for every identifier before any
   identifier is trusted.  This is the only time that text moves, and repeated chunks are
   combined before they do.
3. A document's recipe is the ordered list of its identifiers.  Documents are
   compared by their recipes: short lists are shuffled, never the documents.

Cases: a null text is the empty text, whose recipe is the empty list; null ids
are smaller than every other id; of repeated rows (same id, same text) exactly one
stays; an empty table gives an empty result; only the two named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanflow.llm.common import id_and_text, staged

MIN_CHUNK = 512
MAX_CHUNK = 4096


def chunks(text: Column) -> Column:
    """The content-defined chunks of a text; joined, they are the text."""
    pattern = (rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK}}}?(?:(?<=[.!?\n])|\z)"
               rf"|.{{{MAX_CHUNK}}}|.+")
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def chunk_store(docs: DataFrame) -> DataFrame:
    """Every different chunk once, with its identifier."""
    piece = docs.select(F.explode(chunks(F.col("text"))).alias("chunk"))
    return piece.select(F.unhex(F.sha2("chunk", 256)).alias("chunk_id"), "chunk").distinct()


def verify_store(store: DataFrame) -> None:
    """Stops if two different chunks have one identifier."""
    clash = store.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
    if clash:
        raise ValueError("two different chunks have the same identifier; recipes cannot be compared")


def recipes(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, recipe, text_sha256), staged: short rows in place of the documents."""
    return staged(docs.select(
        "doc_id", F.monotonically_increasing_id().alias("row_key"),
        F.transform(chunks(F.col("text")), lambda c: F.unhex(F.sha2(c, 256))).alias("recipe"),
        F.sha2("text", 256).alias("text_sha256")), "recipes")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.  Of equal texts the largest id stays."""
    docs = id_and_text(docs, id_col, text_col)
    verify_store(chunk_store(docs))
    rows = recipes(docs)
    # combined map-side, and written, so that the join below splits the rows of a large group over tasks
    groups = staged(rows.groupBy("recipe").agg(
        F.max(F.struct("doc_id", "row_key")).alias("keep"), F.count(F.lit(1)).alias("group_size")), "recipe-groups")
    return rows.join(groups, "recipe").select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("keep.row_key") == F.col("row_key")).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one for each text, with all their columns."""
    stay = exact_dedup(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias("_keep_id"), F.col("text_sha256").alias("_keep_sha"))
    rows = docs.withColumn("_sha", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).withColumn("_id", F.col(id_col).cast("long"))
    rows = rows.join(stay, F.col("_id").eqNullSafe(F.col("_keep_id")) & (F.col("_sha") == F.col("_keep_sha")), "left_semi")
    return rows.dropDuplicates(["_id", "_sha"]).drop("_id", "_sha")
