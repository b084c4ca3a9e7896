"""Gold -> model-ready train/test tables and the fitted feature pipeline.

Default order avoids the reference's two quirks: the split is decided per row
from a key hash (disjoint, complete, no shuffle), and the pipeline is fitted
on the train rows only.  ``parity=True`` reproduces the reference order: fit
on all rows, then Bernoulli sample + EXCEPT DISTINCT.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanflow.operators.columns import drop_leakage_columns, select_features
from loanflow.operators.encode import featurize
from loanflow.operators.split import SPLIT, hash_split, sample_and_subtract
from loanflow.operators.weights import with_class_weight
from loanflow.schema import LABEL, WEIGHT
from loanflow.sources.files import DEFAULT_FORMAT, save_pipeline, stage_table, write_table


def gold_to_ml_ready(gold: DataFrame, key: str = "id", frac: float = 0.8, seed: int = 42,
                     parity: bool = False):
    """Returns (train, test, pipeline_model); train/test hold features, label, classWeight."""
    selected = select_features(drop_leakage_columns(gold, keep=[key]), keep=[key])
    # weights, indexer fit, scaler fit and both splits all read this compact table
    weighted = with_class_weight(stage_table(selected, "features"))
    if parity:
        ready, model = featurize(weighted.drop(key), fit_on="all")
        train, test = sample_and_subtract(ready, LABEL, {0: frac, 1: frac}, seed)
        return train, test, model
    split = hash_split(weighted, key, frac, seed)
    ready, model = featurize(split, fit_on="train")
    train = ready.where(F.col(SPLIT) == "train").select("features", LABEL, WEIGHT)
    test = ready.where(F.col(SPLIT) == "test").select("features", LABEL, WEIGHT)
    return train, test, model


def write_ml_ready(train: DataFrame, test: DataFrame, model, root: str, fmt: str = DEFAULT_FORMAT) -> dict:
    """Write train, test and the pipeline under ``root``; returns the three paths."""
    paths = {"train": f"{root}/train", "test": f"{root}/test", "pipeline_model": f"{root}/pipeline_model"}
    write_table(train, paths["train"], fmt)
    write_table(test, paths["test"], fmt)
    save_pipeline(model, paths["pipeline_model"])
    return paths
