"""Corpus pipeline: documents to packed token sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but
the last return the columns of ``documents``.  Between stages the rows are written and read
again, so a lost executor costs a stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanflow.llm.common import staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity model rejects go; the model is learned from the labelled rows of ``docs``."""
    from loanflow.llm import toxicity

    return toxicity.drop_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id stays."""
    from loanflow.llm.exact_dedup import keep_one

    return keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id stays."""
    from loanflow.llm.jaccard import keep_one_of_group

    return keep_one_of_group(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows."""
    from loanflow.llm.pii import mask_documents

    return mask_documents(docs, chars_col="n_chars")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, mixed by source."""
    import public_tokenizers

    from loanflow.llm.packing import pack
    from loanflow.llm.queries import BYTE_BPE, BYTE_BPE_SPECIAL

    return pack(docs, public_tokenizers.path(BYTE_BPE), BYTE_BPE_SPECIAL)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: SQL cannot express tokenizing, message passing or learning; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
