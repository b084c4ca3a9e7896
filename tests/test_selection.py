"""Split points by levels, and label ranks as a table."""

import random

import pytest
from pyspark.sql import functions as F

from loanflow.operators import encode
from loanflow.operators.ordered import running_totals, split_points, with_range_bucket


def sizes(df, points):
    values = sorted(r["v"] for r in df.collect() if r["v"] is not None and r["v"] == r["v"])
    out, at = [], 0
    for p in [*points, float("inf")]:
        n = at
        while at < len(values) and (values[at] < p or p == float("inf")):
            at += 1
        out.append(at - n)
    return out


@pytest.mark.parametrize("name, values", [
    ("even", [float(i) for i in range(5000)]),
    ("heavy tail", [random.Random(i).lognormvariate(0, 6) for i in range(4000)]),
    ("close together", [1.0 + i * 1e-12 for i in range(3000)] + [1.9, 1e300, -1e300]),
    ("both signs", [random.Random(i).gauss(0, 1e-9) for i in range(3000)]),
    ("two clusters", [float(i % 50) for i in range(50)] + [1e18 + 1024.0 * i for i in range(3000)]),
])
def test_split_points_balance(spark, name, values):
    df = spark.createDataFrame([(v,) for v in set(values)], "v double").repartition(3)
    n = 16
    points = split_points(df, "v", n)
    assert points == sorted(set(points)) and len(points) < n
    got = sizes(df, points)
    share = len(set(values)) / n
    assert sum(got) == len(set(values)) and max(got) <= 2 * share + 1


def test_split_points_of_odd_input(spark):
    inf, nan = float("inf"), float("nan")
    frame = lambda vs: spark.createDataFrame([(v,) for v in vs], "v double")
    assert split_points(frame([]), "v", 8) == []
    assert split_points(frame([None, nan]), "v", 8) == []
    assert split_points(frame([3.0] * 100), "v", 8) == []
    assert split_points(frame([1.0, 2.0]), "v", 1) == []
    assert len(split_points(frame([-inf, inf, 0.0, 1.0]), "v", 4)) <= 3
    hot = frame([5.0] * 900 + [float(i) for i in range(100)])
    points = split_points(hot, "v", 10)
    assert sum(sizes(hot, points)) == 1000 and 5.0 in points
    assert with_range_bucket(hot, "v", 10, "b").where("v = 5").select("b").distinct().count() == 1


def test_running_totals_over_skewed_keys(spark):
    rng = random.Random(3)
    keys = sorted({rng.lognormvariate(0, 8) * rng.choice([-1, 1]) for _ in range(800)} | {0.0})
    df = spark.createDataFrame([(k, i % 7) for i, k in enumerate(keys)], "k double, x long").repartition(4)
    for down in (False, True):
        got = {r["k"]: r["cum_x"] for r in running_totals(df, "k", ["x"], descending=down, n_buckets=32).collect()}
        total, want = 0, {}
        for i, k in sorted(enumerate(keys), key=lambda p: p[1], reverse=down):
            total += i % 7
            want[k] = total
        assert got == want


def test_label_ranks_equal_the_library(spark):
    """200,000 labels of few frequencies: most ranks are decided by the label, over many tasks."""
    n = 200_000
    df = spark.range(n).select(
        F.concat(F.lit("v"), F.pmod(F.col("id") * 7919, F.lit(n)).cast("string")).alias("wide"),
        F.when(F.col("id") % 3 == 0, None).otherwise(F.concat(F.lit("é"), (F.col("id") % 5).cast("string"))).alias("narrow"),
        F.lit(None).cast("string").alias("none"))
    df = df.unionByName(df.where("wide LIKE 'v1%'"))
    cols = ["wide", "narrow"]
    ranks = encode.label_ranks(df, [*cols, "none"])
    assert ranks.count() == n + 5
    got = {c: [r["value"] for r in ranks.where(F.col("column_name") == c).orderBy("idx").collect()] for c in cols}
    for c, labels in zip(cols, encode.fit_index(df, cols).labelsArray):
        assert got[c] == list(labels)
    few = spark.createDataFrame([("v1", "é1", "x"), ("unseen", None, None), (None, "é4", "y")], "wide string, narrow string, none string")
    a = encode.index_by_table(few, [*cols, "none"], ranks).select("wide_idx", "narrow_idx", "none_idx").collect()
    b = encode.fit_index(df, cols).transform(few).select("wide_idx", "narrow_idx").collect()
    assert sorted((r["wide_idx"], r["narrow_idx"]) for r in a) == sorted(map(tuple, b))
    assert {r["none_idx"] for r in a} == {0.0}
