"""The five MLlib classifiers, training with timing, evaluation and feature importances."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanflow.operators.evaluate import metrics_by_model, positive_score
from loanflow.schema import LABEL, NUMERIC_FEATURES, WEIGHT

# FIXED VALUES: classifier settings (all weighted by the class-weight column).
CLASSIFIERS = {
    "LogisticRegression": {"maxIter": 50, "regParam": 0.01, "elasticNetParam": 0.0, "family": "binomial"},
    "LinearSVC": {"maxIter": 20, "regParam": 0.01},
    "DecisionTree": {"maxDepth": 10, "maxBins": 32, "minInstancesPerNode": 100},
    "RandomForest": {"numTrees": 50, "maxDepth": 10, "maxBins": 32, "minInstancesPerNode": 100,
                     "subsamplingRate": 0.8, "seed": 42},
    "GBTClassifier": {"maxIter": 30, "maxDepth": 6, "maxBins": 32, "stepSize": 0.1, "subsamplingRate": 0.8,
                      "seed": 42},
}
TREE_MODELS = {"DecisionTree", "RandomForest", "GBTClassifier"}


def make_classifier(name: str, features: str = "features", label: str = LABEL, weight: str | None = WEIGHT,
                    **overrides):
    from pyspark.ml import classification as C

    cls = {"LogisticRegression": C.LogisticRegression, "LinearSVC": C.LinearSVC,
           "DecisionTree": C.DecisionTreeClassifier, "RandomForest": C.RandomForestClassifier,
           "GBTClassifier": C.GBTClassifier}[name]
    params = dict(CLASSIFIERS[name], **overrides)
    if weight:
        params["weightCol"] = weight
    return cls(featuresCol=features, labelCol=label, **params)


def scored_frame(predictions: DataFrame, name: str, label: str = LABEL) -> DataFrame:
    """Predictions -> long evaluation rows (model, label, score, prediction, probability).

    ``score`` is the raw one, for the AUC; ``probability`` is for the ROC curve and NULL for a model without one,
    which a curve over it then skips.
    """
    return predictions.select(F.lit(name).alias("model"), F.col(label).alias("label"), positive_score(predictions).alias("score"),
                              F.col("prediction"), positive_score(predictions, "probability").alias("probability"))


def train_and_evaluate(estimator, name: str, train: DataFrame, test: DataFrame):
    """Fit on ``train`` (timed) and score ``test``.

    Returns (model, scored rows, metrics row with train_seconds, importances); the last is a frame
    (rank, slot, feature, importance) of all slots for a tree model and None for the others.
    """
    t0 = time.time()
    model = estimator.fit(train)
    seconds = time.time() - t0
    scored = scored_frame(model.transform(test), name)
    metrics = metrics_by_model(scored).withColumn("train_seconds", F.lit(round(seconds, 3)))
    importances = ranked_importances(model, train) if hasattr(model, "featureImportances") else None
    return model, scored, metrics, importances


def feature_names(df: DataFrame, col: str = "features", numeric_names=None) -> list[str]:
    """Slot names from the vector's ML attributes; unnamed slots fall back to ``Feature_<i>``.

    Scaled numeric slots arrive as ``numeric_scaled_<i>``; with ``numeric_names`` they are mapped back.
    """
    meta = df.schema[col].metadata.get("ml_attr", {})
    size = meta.get("num_attrs", 0)
    names = {}
    for group in meta.get("attrs", {}).values():
        for a in group:
            names[a["idx"]] = a.get("name")
    size = max(size, max(names) + 1 if names else 0)
    out = []
    for i in range(size):
        n = names.get(i) or f"Feature_{i}"
        if numeric_names and n.startswith("numeric_scaled_"):
            j = int(n.rsplit("_", 1)[1])
            n = numeric_names[j] if j < len(numeric_names) else n
        out.append(n)
    return out


def ranked_importances(model, df: DataFrame, col: str = "features", numeric_names=NUMERIC_FEATURES) -> DataFrame:
    """Feature importances of a tree model with slot names, highest first: (rank, slot, feature, importance)."""
    imp = model.featureImportances.toArray().tolist()
    names = feature_names(df, col, numeric_names)
    rows = [(i, names[i] if i < len(names) else f"Feature_{i}", float(v)) for i, v in enumerate(imp)]
    spark = df.sparkSession
    frame = spark.createDataFrame(rows, "slot int, feature string, importance double")
    # one row per vector slot: a window over the model's feature count, not over data rows
    w = Window.orderBy(F.desc("importance"), "slot")
    return frame.withColumn("rank", F.row_number().over(w))


def top_importances(model, df: DataFrame, k: int = 15, col: str = "features", numeric_names=NUMERIC_FEATURES) -> DataFrame:
    """The ``k`` highest feature importances of a tree model."""
    return ranked_importances(model, df, col, numeric_names).where(F.col("rank") <= k)
