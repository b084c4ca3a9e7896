"""Profiles: single-pass top-k against brute force, describe, null profile, class balance, shares."""
import numpy as np
import pandas as pd

from loanflow.functions.shares import with_share
from loanflow.operators.nulls import class_balance, null_profile
from loanflow.operators.profile import categorical_profile, describe_long, distribution, top_k_per_group, top_values


def test_top_k_per_group_exact_with_many_values(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.integers(0, 4, 4000).astype(str), "v": rng.integers(0, 500, 4000).astype(str)})
    pdf.loc[:1300, "v"] = "hot"  # one value with a third of all rows
    counts = spark.createDataFrame(pdf).groupBy("g", "v").count()
    got = top_k_per_group(counts, "g", "v", 5, buckets=8).orderBy("g", "rank").toPandas()
    c = pdf.groupby(["g", "v"]).size().reset_index(name="count")
    for g, grp in c.groupby("g"):
        expect = grp.sort_values(["count", "v"], ascending=[False, True]).head(5)
        mine = got[got.g == g]
        assert list(mine.v) == list(expect.v) and list(mine["count"]) == list(expect["count"])


def test_categorical_profile_and_top_values(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "y"), (None, "y")], "c1 string, c2 string")
    prof = {(r.column_name, r.rank): (r.value, r["count"], r.pct) for r in categorical_profile(df, ["c1", "c2"], 2).collect()}
    assert prof[("c1", 1)] == ("a", 2, 50.0) and prof[("c2", 1)] == ("y", 3, 75.0)
    assert prof[("c1", 2)][0] is None  # NULL sorts first among ties of count 1
    tv = top_values(df, "c2", 1).collect()
    assert tv[0].c2 == "y" and tv[0]["count"] == 3 and tv[0].pct == 75.0


def test_describe_long(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "a double")
    r = describe_long(df, ["a", "missing"]).first()
    assert (r.column_name, r["count"], r.mean, r.stddev, r.min, r.max) == ("a", 3, 2.0, 1.0, 1.0, 3.0)


def test_null_profile_severity(spark):
    rows = [(None, 1.0, 1.0)] + [(1.0, None if i < 3 else 1.0, 1.0) for i in range(99)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    prof = {r.column_name: (r.null_count, r.null_pct, r.severity) for r in null_profile(df, ["a", "b", "c"]).collect()}
    assert prof["a"] == (1, 1.0, "low") and prof["b"] == (3, 3.0, "low") and prof["c"] == (0, 0.0, "clean")
    df2 = spark.createDataFrame([(None,)] * 6 + [(1.0,)] * 94, "a double")
    assert null_profile(df2, ["a"]).first().severity == "high"


def test_class_balance_and_distribution(spark):
    df = spark.createDataFrame([(0,)] * 8 + [(1,)] * 2, "label int")
    r = class_balance(df).first()
    assert (r.n0, r.n1, r.ratio, r.imbalanced) == (8, 2, 4.0, True)
    assert class_balance(spark.createDataFrame([(0,)] * 3, "label int")).first().ratio is None
    d = {r.label: (r["count"], r.pct) for r in distribution(df).collect()}
    assert d == {0: (8, 80.0), 1: (2, 20.0)}


def test_share_of_empty_total_is_zero(spark):
    counts = spark.createDataFrame([("a", 0)], "k string, count long")
    assert with_share(counts).first().pct == 0.0


def test_gold_profile_dominant_is_categorical_rank_one(spark, sf_small):
    from loanflow import catalog
    from loanflow.operators.profile import dominant_values
    from loanflow.plans.profile import gold_profile
    from loanflow.schema import PROFILE_CATEGORICALS

    g = catalog.gold(spark, sf_small)
    parts = gold_profile(g)
    assert {"shape", "schema", "categorical", "dominant", "histogram", "status_top"} <= set(parts)
    got = parts["dominant"].select("column_name", "value", "count", "pct")
    want = dominant_values(g, PROFILE_CATEGORICALS).select("column_name", "value", "count", "pct")
    assert got.count() == len(PROFILE_CATEGORICALS)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
