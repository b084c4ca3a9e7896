"""Bronze -> Silver: one DataFrame function for batch and Structured Streaming.

Row-local projections only (no shuffle), so a streaming micro-batch and a batch
backfill plan the same narrow stage: each column's type from its kind, then the
columns derived from typed ones and the audit stamp.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from loanflow.functions.cleaning import typed_columns
from loanflow.functions.derived import with_derived, with_processing_time


def bronze_to_silver(df: DataFrame) -> DataFrame:
    return with_processing_time(with_derived(typed_columns(df)))
