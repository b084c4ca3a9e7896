"""Batch backfill: CSV -> Bronze table -> Silver table, then a count reconciliation.

The same ``bronze_to_silver`` serves this job and the stream.  Bronze is
written once and Silver is built from the written Bronze, so the CSV is parsed
once and the Silver job restarts from a durable table if executors are lost.
The CSV is read once: the raw row count is what the Bronze write itself reports, and the tables'
counts come from their files' footers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanflow.plans.silver import bronze_to_silver
from loanflow.sources.files import DEFAULT_FORMAT, read_loans_csv, read_table, write_table
from loanflow.sources.messages import with_backfill_metadata
from loanflow.sources.reconcile import reconcile_counts
from loanflow.sources.write_metrics import WrittenRows, footer_count


def backfill(spark: SparkSession, csv_path: str, bronze_path: str, silver_path: str,
             fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """Run the backfill; returns the reconciliation row (raw, Bronze, Silver counts, consistent).

    Formats whose writer reports no rows (or that are not parquet) are counted by reading them.
    """
    raw = read_loans_csv(spark, csv_path)
    with WrittenRows(spark) as written:
        write_table(with_backfill_metadata(raw), bronze_path, fmt)
        n_raw = written.rows(bronze_path)
    bronze = read_table(spark, bronze_path, fmt)
    write_table(bronze_to_silver(bronze), silver_path, fmt)
    silver = read_table(spark, silver_path, fmt)
    if fmt == DEFAULT_FORMAT:
        bronze, silver = footer_count(spark, bronze_path), footer_count(spark, silver_path)
    return reconcile_counts(raw if n_raw is None else n_raw, bronze, silver, spark=spark)
