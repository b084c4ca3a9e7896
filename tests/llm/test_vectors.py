"""Whitening and vector codes against brute force, with odd rows."""

import hashlib
import math

import numpy as np
import pytest

from loanflow.llm import vector_codes as vc
from loanflow.llm import whitening as wh
from loanflow.llm.queries import REGISTRY

SCHEMA = "vec_id long, embedding array<float>, label int, x int, code string, n int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, 1, "c", 2) for i, v, lab in rows], SCHEMA).repartition(3)


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def ints(v, scale):
    return [math.floor(scale * float(np.float32(c))) for c in v]


# -- vector codes ---------------------------------------------------------------------------

def plain_nearest(point, book):
    far = [sum((int(a) - int(b)) ** 2 for a, b in zip(point, e)) for e in book]
    at = min(range(len(far)), key=lambda i: (far[i], i))
    return at, far[at]


def brute_codes(rows, parts=8, entries=16, rounds=6):
    kept = sorted(((i, ints(v, 4096), lab) for i, v, lab in rows if usable(v)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    w = len(kept[0][1]) // parts
    cut = lambda x: [x[p * w:(p + 1) * w] for p in range(parts)]
    books = [[cut(x)[p] for _, x, _ in kept[:entries]] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            to = [plain_nearest(cut(x)[p], books[p])[0] for _, x, _ in kept]
            for e in range(len(books[p])):
                mine = [cut(x)[p] for (_, x, _), t in zip(kept, to) if t == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    found = [(i, [plain_nearest(cut(x)[p], books[p]) for p in range(parts)], lab) for i, x, lab in kept]
    by = {}
    for _, f, lab in found:
        by[lab] = by.get(lab, 0) + sum(d for _, d in f)
    return [(i, "".join(f"{e:02x}" for e, _ in f), sum(d for _, d in f), by[lab], digest) for i, f, lab in found]


def coded(spark, rows):
    out, books = vc.compress(frame(spark, rows))
    return [(r["vec_id"], r["code"], r["error"], r["label_error"], books.sha256() if books else "") for r in out.collect()]


def order(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("n", [0, 1, 5, 16, 90])
def test_codes_against_brute_force(spark, n):
    rng = np.random.default_rng(n)
    rows = [(int(i), rng.integers(-3, 4, 16).astype(float).tolist() if i % 3 else rng.normal(size=16).astype(np.float32).tolist(), int(i % 4) or None)
            for i in rng.permutation(n)]
    rows += [(900, None, 1), (901, [None] + [0.0] * 15, 1), (902, [math.nan] * 16, 1), (903, [math.inf] * 16, 1)]
    rows += rows[:3] + [(None, [0.5] * 16, 3), (None, [-0.0] * 16, None)] if n > 5 else []
    assert order(coded(spark, rows)) == order(brute_codes(rows))


def test_codes_of_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = [tuple(r) for r in REGISTRY["op13_vector_codes"](spark, sf).collect()]
    assert order(got) == order(brute_codes(rows))


@pytest.mark.parametrize("k", [1, 2, 16, 200])
def test_orchard_is_exact_and_measures_less(k):
    rng = np.random.default_rng(k)
    book = rng.integers(-9, 10, (k, 3)) * (1 if k < 200 else 50)
    points = np.concatenate([rng.integers(-9, 10, (2000, 3)) * (1 if k < 200 else 50), book])
    measured = []
    at, far = vc.nearest(points, book, measured=measured)
    every = ((points[:, None] - book[None]) ** 2).sum(2)
    assert (at == every.argmin(1)).all() and (far == every.min(1)).all()
    assert measured[0] <= every.size and (k < 16 or measured[0] < 0.9 * every.size)


def test_codes_decode(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=16).tolist(), None) for i in range(40)]
    out, books = vc.compress(frame(spark, rows))
    back = {r["vec_id"]: r["vector"] for r in vc.decode(out, books).collect()}
    for r in out.collect():
        x = ints(rows[r["vec_id"]][1], 4096)
        assert sum((a - b * 4096) ** 2 for a, b in zip(x, back[r["vec_id"]])) == r["error"]
    assert vc.decode(spark.createDataFrame([(1, None)], "vec_id long, code string"), books).first()["vector"] is None


@pytest.mark.parametrize("rows", [[(1, [1.0] * 16, 1), (2, [1.0] * 8, 1)], [(1, [1.0] * 9, 1)], [(1, [1e30] * 16, 1)]])
def test_codes_refuse(spark, rows):
    with pytest.raises(ValueError):
        vc.compress(frame(spark, rows))


# -- whitening ------------------------------------------------------------------------------

def brute_white(rows, k=4):
    kept = [(i, ints(v, 256)) for i, v, _ in rows if usable(v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), float)
    n, mean = len(fit), fit.mean(0)
    cov = (fit - mean).T @ (fit - mean) / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    sums = [int(s) for s in fit.sum(0)]
    dev = {tuple(x): sum((n * c - s) ** 2 for c, s in zip(x, sums)) for _, x in kept}
    return kept, n, dev, values[:k], axes[:, :k], mean, np.trace(cov)


def check_white(spark, rows):
    got = [r.asDict() for r in wh.whiten_embeddings(frame(spark, rows))[0].collect()]
    kept, n, dev, values, axes, mean, trace = brute_white(rows)
    k = len(values)
    assert len(got) == len(kept) * k
    ids = {}
    for i, x in kept:
        ids.setdefault(i, []).append(x)
    sign = {}
    for r in sorted(got, key=lambda r: -abs(r["whitened"])):
        c = r["component"] - 1
        assert r["n"] == n and r["identity_error"] <= 1e-4
        assert r["explained"] == pytest.approx(values[c] / trace, rel=1e-9)
        want = [((np.array(x) - mean) @ axes[:, c] / math.sqrt(values[c]), dev[tuple(x)]) for x in ids[r["vec_id"]]]
        sign.setdefault(c, 1 if any(abs(w - r["whitened"]) < 1e-6 for w, _ in want) else -1)
        assert any(abs(w * sign[c] - r["whitened"]) < 1e-8 and v == r["deviation"] for w, v in want)


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=12) * np.linspace(0.2, 2, 12) + 3).astype(np.float32).tolist(), 1) for i in range(80)]
    rows += rows[:30] * 2 + [(500, rows[0][1], None), (None, rows[1][1], None)]
    rows += [(900, None, 1), (901, [None] + [0.0] * 11, 1), (902, [math.nan] * 12, 1), (903, [-math.inf] * 12, 1)]
    check_white(spark, rows)


def test_whitening_of_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    check_white(spark, rows)


def test_whitening_without_variance(spark):
    one = [(1, [0.5, 1.0, 2.0], 1), (2, [0.5, 1.0, 2.0], 1)]
    got = wh.whiten_embeddings(frame(spark, one))[0].collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got] == [(1, 0, 0.0, 0.0, 0.0)] * 6
    line = [(i, [float(i), 2.0 * i, -1.0 * i, 0.0, 1.0], 1) for i in range(5)]
    got = wh.whiten_embeddings(frame(spark, line))[0].collect()
    assert all(r["whitened"] == 0.0 for r in got if r["component"] > 1)
    assert sorted(abs(r["whitened"]) for r in got if r["component"] == 1) == pytest.approx([0, 2 ** -0.5, 2 ** -0.5, 2 ** 0.5, 2 ** 0.5])
    assert all(r["identity_error"] < 1e-12 for r in got)
    assert wh.whiten_embeddings(frame(spark, [(1, None, 1)]))[0].collect() == []
    assert wh.whiten_embeddings(frame(spark, []))[0].collect() == []


def test_deviation_beyond_a_long(spark):
    rows = [(i, [float(i % 2) * 100_000, float(i)], 1) for i in range(300)]
    got = {r["vec_id"]: r["deviation"] for r in wh.whiten_embeddings(frame(spark, rows))[0].collect()}
    _, _, dev, *_ = brute_white(rows)
    for i, v, _ in rows:
        want = dev[tuple(ints(v, 256))]
        assert got[i] == (want if want < 2 ** 63 else None)
    assert None in got.values()


@pytest.mark.parametrize("rows", [[(1, [1.0] * 4, 1), (2, [1.0] * 3, 1)], [(1, [1e9], 1)]])
def test_whitening_refuses(spark, rows):
    with pytest.raises(ValueError):
        wh.whiten_embeddings(frame(spark, rows))


def spectrum(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))[0]
    m = q @ np.diag(values) @ q.T
    return (m + m.T) / 2


@pytest.mark.parametrize("a", [
    spectrum(np.linspace(0.1, 3, 40)),
    spectrum(np.r_[np.ones(8), 1 + 1e-9 * np.arange(8), np.linspace(0.1, 0.5, 24)]),  # one multiple value beside a cluster
    spectrum(np.r_[1 + 1e-12 * np.arange(20), np.linspace(0.1, 0.5, 20)]),
    spectrum(np.r_[1e6, 1e-6 * (1 + 1e-7 * np.arange(10))]),
    np.eye(9), np.zeros((4, 4)), np.ones((6, 6)), np.array([[3.0]]), np.diag(1 + 1e-10 * np.arange(12)),
])
def test_refined_eigenvectors(a):
    values, x = wh.refined_eigh(a)
    top = max(np.abs(a).max(), 1e-300)
    assert np.abs(a.astype(wh.WIDE) @ x - x * values).max() / top < 1e-16
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-16
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() / top < 1e-13
    assert (np.diff(values) <= 0).all()
