"""Vector code compression: product quantization in integers, nearest entries by Orchard's search.

Method.  A vector's components become integers (floor of ``scale`` times the component), the vector is cut into
equal consecutive parts, and each part position has a codebook, fitted by rounds of assignment and integer means.
A codebook's nearest entry to a part is searched along *distance-sorted neighbour lists* (Orchard): every entry
holds all others sorted by their distance to it.  The search stands at an entry, walks its list, measures and
marks each entry not yet marked, jumps to the list of a nearer one at once, and stops where the list's distance
exceeds twice the distance to the entry it stands at: by the triangle inequality what follows is farther.  With
squared distances the bound is four times; it stops only beyond it, so a tie still meets its lower index.
All arithmetic is in 64-bit integers, hence exact and the same for every partitioning.

Scale.  Vectors are staged once as integers.  Each round is one pass over them: Arrow batches in tasks, which
send one sum per codebook entry; Spark adds these up.  The driver holds codebooks only (parts x entries rows), and
tasks receive them with the task.  Sums per label are combined map-side and joined back by size.

Defined cases.  Vectors that are null or hold null, NaN or infinite components are dropped; an empty table gives an
empty result.  With fewer kept vectors than entries the codebooks have so many entries.  Of equal ids the lesser
vector comes first among the first entries, null ids last.  Repeated rows come back as often as they came.
Vectors of unequal lengths, a length that the parts do not divide, and components beyond ``LIMIT`` after scaling
raise ValueError: exact squared distances would not fit a long.  Columns other than the named ones are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanflow.llm.common import sliced, staged

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Magnitude of a scaled component that is taken.
LIMIT = 1 << 26
#: Vectors in memory at once in a task.
BLOCK = 4096


def complete(vec: Column) -> Column:
    """The vector is there, and all its components are finite numbers."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return vec.isNotNull() & ~F.exists(vec, bad)


def integer_vectors(vectors: DataFrame, scale: int, id_col: str = "vec_id", vec_col: str = "embedding", *more: str) -> DataFrame:
    """Staged (vec_id, x, *more) of the complete vectors, x the floors of ``scale`` times the components."""
    vec = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("v"), *more).where(complete(F.col("v")))
    return staged(rows.select("vec_id", F.transform("v", lambda c: F.floor(c * float(scale))).alias("x"), *more), "vectors")


def one_length(rows: DataFrame, limit: int) -> int | None:
    """The length of all vectors ``x``, None where there are none; components are checked against the limit."""
    largest = F.aggregate("x", F.lit(0).cast("long"), lambda a, c: F.greatest(a, c, -c))
    low, high, most = rows.agg(F.min(F.size("x")), F.max(F.size("x")), F.max(largest)).first()
    if low is None:
        return None
    if low != high:
        raise ValueError(f"vectors of {low} and of {high} components")
    if most > limit:
        raise ValueError(f"a component of {most} after scaling; at most {limit} can be held exactly")
    return low


@dataclass
class Codebooks:
    """``entries[part, entry, place]``: integer components, fitted on components scaled by ``scale``."""

    entries: np.ndarray
    scale: int = SCALE

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def neighbour_lists(book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry all others by rising squared distance to it, and these distances."""
    gaps = ((book[:, None, :] - book[None, :, :]) ** 2).sum(2)
    alone = gaps.copy()
    np.fill_diagonal(alone, -1)
    order = np.argsort(alone, axis=1, kind="stable")[:, 1:]
    return order, np.take_along_axis(gaps, order, 1)


def nearest(points: np.ndarray, book: np.ndarray, lists: tuple[np.ndarray, np.ndarray] | None = None,
            measured: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of each point's nearest entry, ties to the lower index; all points search side by side.

    ``measured`` takes the number of distances that were computed.
    """
    order, gaps = lists or neighbour_lists(book)
    n, steps = len(points), order.shape[1]
    at = np.zeros(n, np.int64)
    best = ((points - book[0]) ** 2).sum(1)
    marked = np.zeros((n, len(book)), bool)
    marked[:, 0] = True
    place = np.zeros(n, np.int64)
    active = np.arange(n if steps else 0)
    count = n
    while active.size:
        entry, gap = order[at[active], place[active]], gaps[at[active], place[active]]
        near = gap <= 4 * best[active]
        active, entry = active[near], entry[near]
        place[active] += 1
        fresh = ~marked[active, entry]
        who, to = active[fresh], entry[fresh]
        marked[who, to] = True
        far = ((points[who] - book[to]) ** 2).sum(1)
        count += len(who)
        better = (far < best[who]) | ((far == best[who]) & (to < at[who]))
        who = who[better]
        at[who], best[who], place[who] = to[better], far[better], 0
        active = active[place[active] < steps]
    if measured is not None:
        measured.append(count)
    return at, best


def _blocks(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for b in sliced(batches, BLOCK):
        if b.num_rows:
            flat = b.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            yield b, flat.reshape(b.num_rows, parts, -1)


def _assign(x: np.ndarray, entries: np.ndarray, lists: list) -> tuple[np.ndarray, np.ndarray]:
    found = [nearest(x[:, p], entries[p], lists[p]) for p in range(len(entries))]
    return np.stack([i for i, _ in found], 1), np.stack([d for _, d in found], 1)


def _moved(rows: DataFrame, entries: np.ndarray) -> np.ndarray:
    """One round: every part to its nearest entry, every used entry to the floor of its parts' mean."""
    parts, k, width = entries.shape

    def sums(batches):
        lists = [neighbour_lists(e) for e in entries]
        total, count = np.zeros(entries.shape, np.int64), np.zeros((parts, k), np.int64)
        for _, x in _blocks(batches, parts):
            to, _ = _assign(x, entries, lists)
            for p in range(parts):
                np.add.at(total[p], to[:, p], x[:, p])
                count[p] += np.bincount(to[:, p], minlength=k)
        used = np.argwhere(count > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used[:, 0], pa.int32()), pa.array(used[:, 1], pa.int32()), pa.array(count[count > 0], pa.int64()),
             pa.array(list(total[count > 0]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    found = rows.select("x").mapInArrow(sums, "part int, entry int, n long, sums array<long>")
    added = (found.select("part", "entry", "n", F.posexplode("sums").alias("place", "s")).groupBy("part", "entry", "place")
             .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())  # parts x entries x width rows
    out = entries.copy()
    for r in added:
        out[r["part"], r["entry"], r["place"]] = int(r["s"]) // r["n"]
    return out


def fit_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    """Codebooks of staged integer vectors (vec_id, x): first the parts of the least ids, then ``rounds`` rounds; None without vectors."""
    length = one_length(rows, LIMIT)
    if length is None:
        return None
    if length == 0 or length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(entries).collect()
    book = np.array([r["x"] for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)
    for _ in range(rounds):
        book = _moved(rows, book)
    return Codebooks(book, scale)


def encode(rows: DataFrame, books: Codebooks, *more: str) -> DataFrame:
    """(vec_id, code, error, *more): two hex digits per part, and the squared distance to the decoded vector."""
    entries = books.entries
    parts = len(entries)
    kinds = {f.name: f for f in rows.schema.fields}
    schema = ", ".join(["vec_id long", "code string", "error long", *[f"`{c}` {kinds[c].dataType.simpleString()}" for c in more]])

    def codes(batches):
        lists = [neighbour_lists(e) for e in entries]
        for b, x in _blocks(batches, parts):
            to, far = _assign(x, entries, lists)
            text = [bytes(r).hex() for r in to.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(text, pa.string()), pa.array(far.sum(1), pa.int64()),
                                              *[b.column(c) for c in more]], names=["vec_id", "code", "error", *more])

    return rows.select("vec_id", "x", *more).mapInArrow(codes, schema)


def decode(codes: DataFrame, books: Codebooks, id_col: str = "vec_id", code_col: str = "code") -> DataFrame:
    """(vec_id, vector array<double>): the entries' components side by side, scaled back; a null code gives a null vector."""
    entries, scale = books.entries, books.scale

    def vectors(batches):
        for b in sliced(batches, BLOCK):
            out = []
            for code in b.column("code").to_pylist():
                at = None if code is None else bytes.fromhex(code)
                out.append(None if at is None else np.concatenate([entries[p, e] for p, e in enumerate(at)]) / scale)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(out, pa.list_(pa.float64()))], names=["vec_id", "vector"])

    return codes.select(F.col(id_col).cast("long").alias("vec_id"), F.col(code_col).alias("code")).mapInArrow(
        vectors, "vec_id long, vector array<double>")


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks | None]:
    """((vec_id, label, code, error, label_error), codebooks): every complete vector coded, errors summed over equal labels."""
    named = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("embedding"), F.col(label_col).alias("label"))
    rows = integer_vectors(named, scale, "vec_id", "embedding", "label")
    books = fit_codebooks(rows, parts, entries, rounds, scale)
    if books is None:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error")), None
    coded = staged(encode(rows, books, "label"), "codes")
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    out = coded.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", "label", "code", "error", "label_error"), books
