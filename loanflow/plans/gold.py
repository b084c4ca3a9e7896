"""Silver -> Gold: label, drop sparse/identifier columns, fill NULLs.

Row-local: Catalyst collapses it into the scan's stage.  ``keep`` retains
columns from the drop list (e.g. ``id`` so a later split can key on it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from loanflow.functions.derived import with_label
from loanflow.operators.columns import drop_sparse_columns
from loanflow.operators.nulls import fill_numeric, fill_string


def silver_to_gold(df: DataFrame, keep=()) -> DataFrame:
    return (
        df.transform(with_label)
        .transform(lambda d: drop_sparse_columns(d, keep))
        .transform(fill_numeric)
        .transform(fill_string)
    )
