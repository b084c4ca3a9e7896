"""Embedding whitening: distributed exact covariance, float32 eigenvectors refined in higher precision.

Method.  Components become integers x = floor(256 * c).  The fit list is each distinct vector once; its count, sums and
the products of centred entries are summed in tasks as integers and added up by Spark, so the covariance is exact
before its one rounding, whatever the partitioning.  Entries are centred by the floor of the mean before they are
multiplied; the rest of the mean (less than one) is taken off exactly.  The eigenvectors come from a float32
solve and are corrected by Ogita-Aishima iterations, matrix products in extended precision that double the right digits
each time.  Eigenvalues too close for that form a cluster: the matrix is projected on the cluster's vectors, shifted by
their mean value, solved in float32 again at its own scale and refined, recursively, and the vectors are turned by the result.

Scale.  Only matrices of the vectors' length reach the driver; rows stay in tasks (Arrow batches).  A vector that
is a third of all rows is one row per task before the shuffle that makes the list distinct.

Defined cases.  Vectors that are null or hold null, NaN or infinite entries are dropped; an empty table gives an empty
result.  Repeated rows come back as often as they came and count once.  Vectors of fewer than ``k`` entries have so many
components.  Components without variance (value at most the rounding error of the largest) are whitened to 0.0 and
left out of ``identity_error``; ``explained`` is 0.0 where there is no variance at all.  ``deviation`` is null where a
long cannot hold it.  Vectors of unequal lengths and entries beyond ``LIMIT`` after scaling raise ValueError.  Columns other
than the named ones are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanflow.llm.common import sliced, staged
from loanflow.llm.vector_codes import integer_vectors, one_length

SCALE = 256
COMPONENTS = 4
#: Magnitude of a scaled entry that is taken: products of centred entries stay exact in a double.
LIMIT = 1 << 25
BLOCK = 4096
#: The precision of the refinement (80-bit where the machine has it).
WIDE = np.longdouble
EXACT = 1 << 53
LONG = (1 << 63) - 1


@dataclass
class Whitening:
    """Count, sums and refined components of a fit list."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    k: int

    @property
    def centre(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """Sums of the entries less the centre: the mean's part below one, times n."""
        return np.array([s % self.n for s in self.sums], np.int64)

    def explained(self) -> np.ndarray:
        return self.values[:self.k] / self.trace if self.trace > 0 else np.zeros(self.k)

    def varied(self) -> np.ndarray:
        """The components that have variance."""
        top = self.values[:self.k]
        return top > len(self.sums) * np.finfo(float).eps * max(float(self.values[0]), 0.0)

    def project(self, z: np.ndarray) -> np.ndarray:
        """Whitened rows of entries less the centre."""
        ok = self.varied()
        axes = self.vectors[:, :self.k] / np.sqrt(np.where(ok, self.values[:self.k], 1.0))
        return ((z - self.rest / self.n) @ axes) * ok


def _blocks(batches):
    for b in sliced(batches, BLOCK):
        if b.num_rows:
            flat = b.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            yield b, flat.reshape(b.num_rows, -1)


def _step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """One Ogita-Aishima step: (values, corrected vectors, pairs too close to separate, size of the correction)."""
    r = np.eye(len(a), dtype=WIDE) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    size = lambda m: float(np.linalg.norm(m.astype(float), 2))
    bound = 2 * (size(s - np.diag(values)) + size(a) * size(r))
    gap = values[None, :] - values[:, None]
    close = np.abs(gap) <= bound
    e = np.where(close, r / 2, (s + values[None, :] * r) / np.where(close, WIDE(1), gap))
    return values, x + x @ e, close, float(np.abs(e).max())


def _clusters(values: np.ndarray, close: np.ndarray) -> list[np.ndarray]:
    """Runs of neighbouring values that are too close, of two or more."""
    order = np.argsort(values)
    edges = np.flatnonzero(~close[order[:-1], order[1:]]) + 1
    return [c for c in np.split(order, edges) if len(c) > 1]


def refined_eigh(a: np.ndarray, rounds: int = 12, depth: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors of a symmetric matrix, from a float32 solve refined in ``WIDE``."""
    a = np.asarray(a, WIDE)
    scale = np.abs(a).max() if a.size else WIDE(0)
    if not scale > 0:
        return np.zeros(len(a), WIDE), np.eye(len(a), dtype=WIDE)
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(WIDE)
    eps = float(np.finfo(WIDE).eps) * len(a)
    for i in range(rounds):
        values, x, close, change = _step(a, x)
        turned = False
        if i >= 1 and depth:
            for c in _clusters(values, close):
                v, shift = x[:, c], values[c].mean()
                sub = v.T @ (a @ v - shift * v)
                if np.abs(sub).max() > eps:  # else one value, and any basis of its vectors does
                    x[:, c] = v @ refined_eigh((sub + sub.T) / 2, rounds, depth - 1)[1]
                    turned = i < rounds // 2
        if i >= 2 and not turned and change <= eps ** 0.5:  # the step just made squared the error
            break
    for _ in range(3):  # what steps between close values leave of the vectors' lengths and angles
        x = x + x @ ((np.eye(len(a), dtype=WIDE) - x.T @ x) / 2)
    values = np.diag(x.T @ (a @ x)) / np.einsum("ij,ij->j", x, x)
    x = x / np.sqrt(np.einsum("ij,ij->j", x, x))
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order]


def _products(rows: DataFrame, centre: np.ndarray, span: int) -> dict[tuple[int, int], int]:
    """Sums of the products of centred entries, upper triangle, exact."""
    d = len(centre)
    exact_rows = max(1, (EXACT - 1) // max(1, span * span))

    def sums(batches):
        total = np.zeros((d, d), object)
        for _, x in _blocks(batches):
            z = (x - centre).astype(float)
            for at in range(0, len(z), exact_rows):
                block = z[at:at + exact_rows]
                total += (block.T @ block).astype(np.int64).astype(object)
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                          pa.array([str(v) for v in total[i, j]], pa.string())], names=["i", "j", "s"])

    found = rows.select("x").mapInArrow(sums, "i int, j int, s string")
    added = found.groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    return {(r["i"], r["j"]): int(r["s"]) for r in added.collect()}  # length x length / 2 rows


def fit_whitening(rows: DataFrame, k: int = COMPONENTS) -> tuple[Whitening | None, DataFrame]:
    """(model, staged fit list) of integer vectors ``x``; no model without vectors."""
    once = staged(rows.select("x").distinct(), "fit_list")
    d = one_length(once, LIMIT)
    if d is None:
        return None, once
    per = (once.select(F.posexplode("x").alias("place", "v")).groupBy("place")
           .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.min("v").alias("low"), F.max("v").alias("high")))
    places = sorted(per.collect(), key=lambda r: r["place"])  # one row per entry of a vector
    n, sums = (places[0]["n"], [int(r["s"]) for r in places]) if places else (once.count(), [])
    centre = np.array([s // n for s in sums], np.int64)
    span = max([max(r["high"] - c, c - r["low"]) for r, c in zip(places, centre.tolist())], default=0)
    found = _products(once, centre, span)
    rest = [s % n for s in sums]
    v = np.zeros((d, d))
    for (i, j), q in found.items():
        v[i, j] = v[j, i] = (n * q - rest[i] * rest[j]) / (n * n)
    values, vectors = refined_eigh(v)
    vectors, k = vectors.astype(float), min(k, d)
    lead = np.abs(vectors).argmax(0) if d else np.zeros(0, int)
    vectors = vectors * np.where(vectors[lead, np.arange(d)] < 0, -1.0, 1.0)
    trace = sum(n * found[i, i] - rest[i] ** 2 for i in range(d)) / (n * n)
    return Whitening(n, sums, values.astype(float), vectors, trace, k), once


def identity_error(once: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, over the components with variance."""
    k, centre = model.k, model.centre

    def sums(batches):
        total, first = np.zeros((k, k)), np.zeros(k)
        for _, x in _blocks(batches):
            w = model.project((x - centre).astype(float))
            total += w.T @ w
            first += w.sum(0)
        i, j = np.indices((k, k)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[i, np.full(k, -1)], pa.int32()), pa.array(np.r_[j, np.arange(k)], pa.int32()),
                                          pa.array(np.r_[total.ravel(), first])], names=["i", "j", "s"])

    added = once.mapInArrow(sums, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()  # (k + 1) x k rows
    cov, mean = np.zeros((k, k)), np.zeros(k)
    for r in added:
        if r["i"] < 0:
            mean[r["j"]] = r["s"] / model.n
        else:
            cov[r["i"], r["j"]] = r["s"] / model.n
    ok = model.varied()
    off = (cov - np.outer(mean, mean) - np.eye(k))[np.ix_(ok, ok)]
    return float(np.abs(off).max()) if off.size else 0.0


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained), one row per vector of ``rows`` and component."""
    k, n, centre, rest = model.k, model.n, model.centre, model.rest
    explained = model.explained()

    def deviations(z):
        small = int(np.abs(z).max(initial=0)) + 1
        wide = z if len(rest) * (n * small) ** 2 < LONG else z.astype(object)
        found = ((wide * n - (rest if wide is z else rest.astype(object))) ** 2).sum(1)
        return [int(v) if v <= LONG else None for v in found.tolist()]

    def rows_of(batches):
        for b, x in _blocks(batches):
            z = x - centre
            w, dev = model.project(z.astype(float)), deviations(z)
            m = len(z)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                 pa.array(np.full(m * k, n), pa.int64()), pa.array(dev, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                 pa.array(w.ravel()), pa.array(np.tile(explained, m))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained"])

    return rows.select("vec_id", "x").mapInArrow(
        rows_of, "vec_id long, component int, n long, deviation long, whitened double, explained double")


def whiten_embeddings(vectors: DataFrame, k: int = COMPONENTS, scale: int = SCALE, id_col: str = "vec_id",
                      vec_col: str = "embedding") -> tuple[DataFrame, Whitening | None]:
    """(rows of ``whiten`` with identity_error, model) for every complete vector."""
    rows = integer_vectors(vectors, scale, id_col, vec_col)
    model, once = fit_whitening(rows, k)
    if model is None:
        none = "component int, n long, deviation long, whitened double, explained double, identity_error double"
        return rows.select("vec_id", *[F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in none.split(", ")]), None
    return whiten(rows, model).withColumn("identity_error", F.lit(identity_error(once, model))), model
