"""Distributed running totals and exact quantiles against brute force (numpy/pandas)."""
import numpy as np
import pandas as pd
import pytest

from loanflow.operators.ordered import running_totals
from loanflow.operators.quantiles import clip_quantiles, histogram, quantile_frame


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_match_brute_force(spark, descending):
    rng = np.random.default_rng(7)
    n = 3000
    pdf = pd.DataFrame({"g": rng.integers(0, 3, n), "k": rng.integers(0, 200, n).astype(float),
                        "a": rng.integers(0, 5, n), "b": rng.integers(0, 3, n)})
    # a hot key holding a third of the rows
    pdf.loc[: n // 3, "k"] = 42.0
    agg = pdf.groupby(["g", "k"], as_index=False)[["a", "b"]].sum()
    df = spark.createDataFrame(agg)
    out = running_totals(df, "k", ["a", "b"], by=["g"], descending=descending, n_buckets=16,
                         prev_col="prev").toPandas()
    for _, r in out.iterrows():
        grp = agg[agg.g == r.g]
        sel = grp[grp.k >= r.k] if descending else grp[grp.k <= r.k]
        assert r.cum_a == sel.a.sum() and r.cum_b == sel.b.sum()
        before = grp[grp.k > r.k] if descending else grp[grp.k < r.k]
        expect_prev = (before.k.min() if descending else before.k.max()) if len(before) else None
        if expect_prev is None:
            assert pd.isna(r.prev)
        else:
            assert r.prev == expect_prev


def test_quantiles_match_numpy_linear(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(100, 30, 2000), np.full(700, 55.5), [None] * 10])
    df = spark.createDataFrame(pd.DataFrame({"x": vals.astype(float)}))
    probs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = quantile_frame(df, "x", probs, n_buckets=8).first()
    clean = vals[~pd.isna(vals)].astype(float)
    for i, p in enumerate(probs):
        assert got[f"q{i}"] == pytest.approx(np.quantile(clean, p), rel=1e-12, abs=1e-9)


def test_clip_and_histogram(spark):
    pdf = pd.DataFrame({"x": np.arange(1000, dtype=float)})
    df = spark.createDataFrame(pdf)
    lo, hi = np.quantile(pdf.x, [0.01, 0.99])
    kept = clip_quantiles(df, "x").count()
    assert kept == int(((pdf.x >= lo) & (pdf.x <= hi)).sum())
    h = histogram(df, "x", bins=10).orderBy("bin").toPandas()
    assert len(h) == 10 and h["count"].sum() == kept
    expect, _ = np.histogram(pdf.x[(pdf.x >= lo) & (pdf.x <= hi)], bins=10, range=(lo, hi))
    assert list(h["count"]) == list(expect)
