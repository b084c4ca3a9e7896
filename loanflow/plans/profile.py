"""Gold profile: every exploratory table as a lazy DataFrame, keyed by name.

Nothing is collected here; each entry is one job when the caller acts on it.
Profile a written Gold table (``read_table``), not a frame still derived from
raw rows: each part is then a column-pruned scan of the table.  For a derived
frame, write it once first (``sources.files.stage_table``); at scale that is
what keeps a dozen parts from re-parsing the raw input a dozen times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanflow.operators.columns import first_existing, preview, schema_profile
from loanflow.operators.nulls import class_balance, null_profile
from loanflow.operators.profile import (
    categorical_profile,
    count_by_time,
    describe_long,
    distribution,
    table_shape,
    top_values,
)
from loanflow.operators.quantiles import histogram
from loanflow.schema import (
    DESCRIBE_COLUMNS,
    HISTOGRAM_CANDIDATES,
    LABEL,
    PREVIEW_COLUMNS,
    PROFILE_CATEGORICALS,
    TIME_CANDIDATES,
    existing,
)


def gold_profile(gold: DataFrame, top_status: int = 15, top_categories: int = 10, preview_rows: int = 10,
                 order_key: str | None = None) -> dict[str, DataFrame]:
    numeric = existing(gold, DESCRIBE_COLUMNS)
    out = {
        "shape": table_shape(gold),
        "schema": schema_profile(gold),
        "label_distribution": distribution(gold, LABEL),
        "class_balance": class_balance(gold, LABEL),
        "describe": describe_long(gold, numeric),
        "null_profile": null_profile(gold, numeric),
        "categorical": categorical_profile(gold, PROFILE_CATEGORICALS, top_categories),
        "preview": preview(gold, PREVIEW_COLUMNS, preview_rows, order_by=order_key),
    }
    # the most frequent value per column is rank 1 of the categorical profile: no second pass
    out["dominant"] = out["categorical"].where(F.col("rank") == 1).drop("rank")
    if "loan_status" in gold.columns:
        out["status_top"] = top_values(gold, "loan_status", top_status)
    time_col = first_existing(gold, TIME_CANDIDATES)
    if time_col:
        out["time_series"] = count_by_time(gold, time_col)
    hist_col = first_existing(gold, HISTOGRAM_CANDIDATES)
    if hist_col:
        out["histogram"] = histogram(gold, hist_col)
    return out
