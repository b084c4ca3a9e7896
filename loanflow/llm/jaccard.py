"""N-gram Jaccard join: an exact similarity join in the metric space of Jaccard distances.

Two documents link when the Jaccard similarity of their sets of five-word shingles is at least 0.75,
that is, when their distance is at most r = 0.25.  Documents with equal sets are one class.

1. Cells.  Most documents are at distance 1 from nearly all others, where no document pivot
   tells them apart.  So the first pivots are single shingles, in one global order (shingles that are frequent in the
   corpus last): two linked documents share a shingle among the first n - ceil(0.75 n) + 1 of each, so a
   document is replicated to the cells of that many pivots.  Two classes in a cell are candidates.  How many cells
   they share bounds their intersection from above, which rules out nearly all that do not link.  A cell
   of more than ``CELL_MATES`` classes, and every cell of a frequent shingle, gives a chain of edges in place of pairs.
2. Regions.  The connected components of the candidates left are the Voronoi regions: each link lies within one
   region.  A region is joined by itself.
3. A region joins recursively around pivot documents.  Let d be the distance to the pivot.  Documents with d <= r
   link to the pivot; two of them are connected and need no comparison.  The others may link to one of
   those only if d <= 2r, and any two only if their d differ by at most r (triangle inequality).  What is left
   is joined around the next pivot.
4. Large regions (a group of near copies may hold a third of all rows) take their first pivot as a
   distributed join.  Only documents outside r, and the boundary documents that the
   triangle inequality lets them reach, go on, in blocks of ``BLOCK`` classes against blocks of like size.

Shingles are 64-bit hashes, and a class is named by a 64-bit hash of its set; different ones
are taken as different (for 10^9 documents two of 10^18 pairs of classes may share a name with probability 0.03).

Cases: null or blank text has an empty set, links with nothing and is its own component; fewer than five words are
one shingle; copies and repeated rows are one class and each get their row; a null id counts for nothing
in the smallest id of a component; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanflow.llm.common import components, id_and_text, sliced, staged

SHINGLE = 5
NUM, DEN = 75, 100
BLOCK = 256
#: The counting table has about a cell per shingle of the corpus, within these powers of two; the bit table of frequent
#: cells, which tasks hold, has one bit per cell: 128 MB at most.
CELL_BITS = (16, 30)
#: A cell is frequent with more than this many shingles, and four times the mean.
FREQUENT = 16
#: Classes that one class is compared with in a cell; cells with more are chained.
CELL_MATES = 32
#: Cells of frequent shingles are dealt to so many tasks each.
SALTS = 16
#: Shingles of more than one in so many sets of a block are counted by a table.
DENSE = 8
#: Lists of cells summed up at a time.
LISTS = 1024
#: Two classes of one link differ by one step of size at most (a little more than the largest ratio of their sizes).
SIZE_STEP = math.log(DEN / NUM) + 1e-6
PLACES = "array<struct<k:int,b:int>>"
MEET = "array<struct<i:struct<k:int,b:int>,both:boolean,j:struct<k:int,b:int>>>"
#: Bytes of text hashed at a time.
CHUNK = 1 << 19

_U = np.uint64
_A, _B, _C = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB), _U(0xD6E8FEB86659FD93)
#: Bytes of a word that are mixed block by block.
LONG_WORD = 64
_EIGHT = np.arange(8)
#: The lowest n bytes of a block, by n.
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], _U)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _A
    x = (x ^ (x >> _U(27))) * _B
    return x ^ (x >> _U(31))


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the words of lower-cased bytes.

    A word is taken in blocks of eight bytes, and its hash is mixed after each block; words of over ``LONG_WORD`` bytes take
    64 bits of a cryptographic hash.  (No running polynomial: modulo 2^64 those collide on structured words.)
    """
    a = np.frombuffer(data, np.uint8)
    space = (a == 32) | ((a >= 9) & (a <= 13))
    edge = np.flatnonzero(np.diff(np.r_[True, space, True].view(np.int8)))
    start, end = edge[::2], edge[1::2]
    size = end - start
    a = np.r_[a, np.zeros(8, np.uint8)]
    acc = size.astype(_U) * _C
    who = np.flatnonzero(size <= LONG_WORD)
    at = 0
    while who.size:
        rest = size[who] - at
        block = np.ascontiguousarray(a[(start[who] + at)[:, None] + _EIGHT]).view("<u8").ravel() & _KEEP[np.minimum(rest, 8)]
        acc[who] = _mix((acc[who] ^ block) * _A + _B)
        at += 8
        who = who[rest > 8]
    for i in np.flatnonzero(size > LONG_WORD):
        acc[i] = int.from_bytes(blake2b(data[start[i]:end[i]], digest_size=8).digest(), "little")
    return start, acc


def _doc_words(data: bytes) -> np.ndarray:
    """Hashes of one text's words, read in chunks that end between words."""
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + CHUNK)
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        out.append(_word_hashes(data[at:end])[1])
        at = end
    return np.concatenate(out) if out else np.zeros(0, _U)


def _runs(words: np.ndarray) -> np.ndarray:
    n = len(words) - SHINGLE + 1
    acc = words[:n]
    for k in range(1, SHINGLE):
        acc = _mix(acc * _C + words[k:k + n])
    return acc


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    lowered = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
    out: list[np.ndarray] = []

    def one(words: np.ndarray) -> np.ndarray:
        if len(words) >= SHINGLE:
            return np.unique(_runs(words))
        acc = np.full(1, len(words), _U)
        for w in words:
            acc = _mix(acc * _C + w)
        return acc if len(words) else np.zeros(0, _U)

    group: list[bytes] = []
    size = 0
    for k, data in enumerate(lowered):
        if len(data) >= CHUNK // 2:
            if group:
                out += _group_sets(group, one)
                group, size = [], 0
            out.append(one(_doc_words(data)))
            continue
        group.append(data)
        size += len(data) + 1
        if size > CHUNK // 2 or k == len(lowered) - 1:
            out += _group_sets(group, one)
            group, size = [], 0
    return out + (_group_sets(group, one) if group else [])


def _group_sets(group: list[bytes], one) -> list[np.ndarray]:
    start, words = _word_hashes(b" ".join(group))
    ends = np.cumsum([len(d) + 1 for d in group])
    cut = np.searchsorted(start, ends)
    return [one(words[a:b]) for a, b in zip(np.r_[0, cut[:-1]], cut, strict=True)]


def class_name(s: np.ndarray) -> int:
    """A signed 64-bit name of a sorted set."""
    import xxhash

    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def prefix_length(n: int) -> int:
    return n - -(-n * NUM // DEN) + 1


def similar(common: int, n: int, m: int) -> bool:
    return DEN * common >= NUM * (n + m - common)


def first_pass(docs: DataFrame, bits: int) -> DataFrame:
    """Staged rows of two kinds: a document's (doc_id, n, cls), and a task's (bucket, low): the cells of its shingles, 2^16 to a bucket, low 16 bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def cells() -> pa.RecordBatch:
            c = np.sort(np.concatenate(held) >> _U(64 - bits)).astype(np.uint32)
            bucket = c >> np.uint32(16)
            cut = np.flatnonzero(np.diff(bucket)) + 1
            lists = [x.astype("<u2").tobytes() for x in np.split(c, cut)]
            names = bucket[np.r_[0, cut]].astype(np.int32)
            none = [None] * len(lists)
            return pa.record_batch([pa.array(none, pa.int64()), pa.array(none, pa.int32()), pa.array(none, pa.int64()), pa.array(names), pa.array(lists, pa.binary())], names=fields)

        fields = ["doc_id", "n", "cls", "bucket", "low"]
        for b in sliced(batches):
            sets = shingle_sets(b.column("text").to_pylist())
            none = [None] * len(sets)
            yield pa.record_batch([b.column("doc_id"), pa.array([len(s) for s in sets], pa.int32()), pa.array([class_name(s) if len(s) else None for s in sets], pa.int64()),
                                   pa.array(none, pa.int32()), pa.array(none, pa.binary())], names=fields)
            held += [s for s in sets if len(s)]
            size += sum(map(len, sets))
            if size >= 1 << 20:
                yield cells()
                held, size = [], 0
        if held:
            yield cells()

    return staged(docs.mapInArrow(run, "doc_id long, n int, cls long, bucket int, low binary"), "shingle-pass")


def frequent_cells(cells: DataFrame, bits: int, total: int) -> bytearray:
    """Bit table of the cells with many shingles: 2^bits bits.  Each bucket is summed in a group of its own."""
    least = FREQUENT + 4 * total / (1 << bits)

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        count, held = np.zeros(1 << 16, np.int64), []
        # a list holds a few cells of 2^16: many lists are summed up at a time
        lists = rows.column("low").to_pylist()
        for k, low in enumerate(lists):
            held.append(low)
            if len(held) == LISTS or k == len(lists) - 1:
                count += np.bincount(np.frombuffer(b"".join(held), "<u2"), minlength=1 << 16)
                held = []
        hot = np.packbits(count > least, bitorder="little").tobytes() if (count > least).any() else None
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "hot": pa.array([hot], pa.binary())})

    return _bit_table(cells.groupBy("bucket").applyInArrow(run, "bucket int, hot binary").where("hot is not null"), bits, "frequent-cells")


def _bit_table(buckets: DataFrame, bits: int, name: str) -> bytearray:
    """The table of all buckets' bits.  They are computed by all tasks and stored first: an iterator over what is not would run one partition after another."""
    out = bytearray(1 << (bits - 3))
    for r in staged(buckets, name).toLocalIterator():
        out[r["bucket"] << 13:(r["bucket"] + 1) << 13] = r["hot"]
    return out


def _has_bit(table: np.ndarray, cell: np.ndarray) -> np.ndarray:
    return (table[(cell >> _U(3)).astype(np.int64)] >> (cell & _U(7)).astype(np.uint8)) & 1 == 1


def cells_of(docs: DataFrame, bits: int, hot) -> DataFrame:
    """(shingle, salt, cls, n, after): each class in the cells of its first shingles.  Salt spreads cells of frequent
    shingles (-1: not one); ``after``: how many shingles of the class come after those of its infrequent cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = np.frombuffer(hot.value, np.uint8), set()
        for b in sliced(batches):
            cols: list[list[np.ndarray]] = [[], [], [], [], []]
            for s in shingle_sets(b.column("text").to_pylist()):
                if not len(s) or (name := class_name(s)) in seen:
                    continue
                seen.add(name)
                frequent = _has_bit(table, s >> _U(64 - bits))
                p, common = prefix_length(len(s)), s[~frequent]
                own = min(p, len(common))
                first = np.r_[common[:own], s[frequent][:p - own]]
                for col, x in zip(cols, (first.view(np.int64), np.where(np.arange(p) < own, -1, name % SALTS).astype(np.int8), np.full(p, name, np.int64),
                                         np.full(p, len(s), np.int32), np.full(p, len(s) - own, np.int32)), strict=True):
                    col.append(x)
            if cols[0]:
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in cols], names=["shingle", "salt", "cls", "n", "after"])

    return docs.mapInArrow(run, "shingle long, salt byte, cls long, n int, after int")


def _cell_pairs(rows: dict[str, np.ndarray], at: np.ndarray, fresh: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """(i, j, sure) of the pairs that rows j (where ``fresh``) make with earlier rows i of their cell; ``at``: a row's place in its cell."""
    out = []
    salted = rows["salt"] >= 0
    for lag in range(1, CELL_MATES + 1):
        j = np.flatnonzero(fresh & (at >= lag))
        if not len(j):
            break
        i = j - lag
        sure = (at[j] > CELL_MATES) | salted[j]
        take = np.where(sure, lag == 1, True)
        sure |= at[j] == CELL_MATES
        n, m = rows["n"][i], rows["n"][j]
        take &= sure | (DEN * np.minimum(n, m) >= NUM * np.maximum(n, m))
        out.append((i[take], j[take], sure[take]))
    return out


def candidate_edges(cells: DataFrame) -> DataFrame:
    """Rows (a, b, bound, least, shingle) from cells, each read as a sorted stream: candidates a and b, which need an
    intersection of ``least`` and have at most ``bound`` common shingles beside the cells they share (both null: to be kept
    whatever they share).  For each part of a salted cell, also its first class as (a, null, null, null, shingle)."""
    names = ("shingle", "salt", "cls", "n", "after")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {k: np.zeros(0, np.int64) for k in names}  # the rows before, as far as pairs may reach
        held_at = np.zeros(0, np.int64)
        for batch in batches:
            rows = {k: np.r_[held[k], batch.column(k).to_numpy().astype(np.int64)] for k in names}
            same = np.r_[False, (rows["shingle"][1:] == rows["shingle"][:-1]) & (rows["salt"][1:] == rows["salt"][:-1])]
            fresh = np.arange(len(same)) >= len(held_at)
            keep = ~(fresh & same & np.r_[False, rows["cls"][1:] == rows["cls"][:-1]])
            rows, same, fresh = {k: v[keep] for k, v in rows.items()}, same[keep], fresh[keep]
            if not fresh.any():
                continue
            # places in the cell: from its first row here, or on from the rows held
            start = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
            at = np.arange(len(same)) - start
            if len(held_at):
                at += np.where(start == 0, held_at[0], 0)
            firsts = np.flatnonzero(fresh & (at == 0) & (rows["salt"] >= 0))
            pairs = _cell_pairs(rows, at, fresh)
            i, j = (np.concatenate([p[k] for p in pairs] or [np.zeros(0, np.int64)]).astype(np.int64) for k in (0, 1))
            sure = np.concatenate([p[2] for p in pairs] or [np.zeros(0, bool)]).astype(bool)
            n_all = rows["n"][i] + rows["n"][j]
            no_b = np.r_[np.zeros(len(i), bool), np.ones(len(firsts), bool)]
            no_n = np.r_[sure, np.ones(len(firsts), bool)]
            fill = np.zeros(len(firsts), np.int64)
            yield pa.record_batch([
                pa.array(np.r_[rows["cls"][i], rows["cls"][firsts]]), pa.array(np.r_[rows["cls"][j], fill], mask=no_b),
                pa.array(np.r_[np.maximum(rows["after"][i], rows["after"][j]), fill], mask=no_n),
                pa.array(np.r_[-(-NUM * n_all // (NUM + DEN)), fill], mask=no_n),
                pa.array(np.r_[rows["shingle"][i], rows["shingle"][firsts]], mask=~no_b)], names=["a", "b", "bound", "least", "shingle"])
            held, held_at = {k: v[-CELL_MATES:] for k, v in rows.items()}, at[-CELL_MATES:]

    sorted_cells = cells.repartition("shingle", "salt").sortWithinPartitions("shingle", "salt", "cls")
    return sorted_cells.mapInArrow(run, "a long, b long, bound long, least long, shingle long")


def regions(cells: DataFrame) -> DataFrame:
    """(cls, region) of the classes that may link to another one, staged; a region is named by its smallest class."""
    counted = candidate_edges(cells).groupBy("a", "b", "bound", "least", "shingle").agg(F.count(F.lit(1)).alias("shared"))
    counted = staged(counted.where("b is null or bound is null or shared + bound >= least"), "candidates")
    edges = counted.where("b is not null").select("a", "b")
    # the first classes of the salted parts of a cell meet in a cell of their own, all to be kept
    nothing = F.lit(0)
    parts = counted.where("b is null").select("shingle", F.lit(0).cast("byte").alias("salt"), F.col("a").alias("cls"), nothing.alias("n"), nothing.alias("after"))
    edges = edges.unionByName(candidate_edges(parts).where("b is not null").select("a", "b"))
    return staged(components(edges).select(F.col("node").alias("cls"), F.col("root").alias("region")), "regions")


def region_sets(docs: DataFrame, region: DataFrame, n_classes: int) -> DataFrame:
    """(region, size, cls, n, shingles) of each class of a region once, staged.  A bit table of the classes keeps other documents from the shuffle."""
    bits = min(max(16, (8 * n_classes).bit_length()), CELL_BITS[1])
    cell = F.shiftrightunsigned("cls", 64 - bits)

    def fill(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        hot = np.zeros(1 << 16, bool)
        hot[rows.column("cell").to_numpy() & 0xFFFF] = True
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "hot": pa.array([np.packbits(hot, bitorder="little").tobytes()], pa.binary())})

    buckets = region.select(cell.alias("cell")).distinct().withColumn("bucket", F.shiftright("cell", 16).cast("int"))
    wanted = docs.sparkSession.sparkContext.broadcast(_bit_table(buckets.groupBy("bucket").applyInArrow(fill, "bucket int, hot binary"), bits, "wanted-classes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = np.frombuffer(wanted.value, np.uint8), set()
        for b in sliced(batches):
            names, sets = [], []
            for s in shingle_sets(b.column("text").to_pylist()):
                if len(s):
                    name = class_name(s)
                    at = np.array([name & (1 << 64) - 1], _U) >> _U(64 - bits)
                    if name not in seen and _has_bit(table, at)[0]:
                        seen.add(name)
                        names.append(name)
                        sets.append(s)
            yield pa.record_batch([pa.array(names, pa.int64()), pa.array([len(s) for s in sets], pa.int32()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["cls", "n", "shingles"])

    rows = docs.mapInArrow(run, "cls long, n int, shingles binary")
    return staged(rows.join(region, "cls").dropDuplicates(["cls"]).select("region", "size", "cls", "n", "shingles"), "region-sets")


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def link(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _overlaps(sets: list[np.ndarray], columns: int = 1 << 14, at_once: int = 1 << 19) -> np.ndarray:
    """Sizes of all intersections of a block of sorted sets, by slices of the hash values of about ``at_once`` shingles each."""
    n_slices = max(1, -(-sum(map(len, sets)) // at_once))
    edges = np.array([(i << 64) // n_slices for i in range(1, n_slices)], _U)
    cuts = [np.r_[0, np.searchsorted(s, edges), len(s)] for s in sets]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for k in range(n_slices):
        out += _slice_overlaps([s[c[k]:c[k + 1]] for s, c in zip(sets, cuts, strict=True)], columns)
    return np.rint(out).astype(np.int64)


def _slice_overlaps(sets: list[np.ndarray], columns: int) -> np.ndarray:
    """Shingles of one set only are left out; those of few sets are counted pair by pair, those of many by products of the table
    (set, shingle), ``columns`` shingles at a time."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, shingle, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    count = count[shingle]
    owner, shingle, count = owner[count > 1], shingle[count > 1], count[count > 1]
    order = np.argsort(shingle, kind="stable")
    owner, shingle, count = owner[order], shingle[order], count[order]
    few = count * DENSE <= n
    out = _pair_counts(owner[few], shingle[few], n)
    owner, shingle = owner[~few], shingle[~few]
    column = np.cumsum(np.r_[False, shingle[1:] != shingle[:-1]]) if len(shingle) else shingle
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        a, b = np.searchsorted(column, (at, at + columns))
        part = np.zeros((n, min(columns, int(column[-1]) + 1 - at)), np.float32)
        part[owner[a:b], column[a:b] - at] = 1
        out += part @ part.T
    return out


def _pair_counts(owner: np.ndarray, shingle: np.ndarray, n: int) -> np.ndarray:
    """How many shingles each two sets share, from the sets of each shingle side by side."""
    upper = np.zeros(n * n, np.int64)
    at = np.arange(len(owner))
    lag = 1
    while len(at := at[at + lag < len(owner)]) and len(at := at[shingle[at + lag] == shingle[at]]):
        upper += np.bincount(owner[at] * n + owner[at + lag], minlength=n * n)
        lag += 1
    upper = upper.reshape(n, n).astype(np.float64)
    return upper + upper.T + np.diag(np.bincount(owner, minlength=n))


class _Joiner:
    """Links among a block of sets in memory, as a spanning forest."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes, self.common = np.array([len(s) for s in sets]), _overlaps(sets)
        self.forest, self.links = _Forest(len(sets)), []

    def check(self, i: int, js: np.ndarray) -> np.ndarray:
        """Distances of i to js; links what is near."""
        c = self.common[i, js]
        both = self.sizes[i] + self.sizes[js] - c
        for j in js[DEN * c >= NUM * both]:
            if self.forest.link(i, int(j)):
                self.links.append((i, int(j)))
        return 1 - c / both


def join_sets(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the links between non-empty sets, by recursion around pivots."""
    joiner, r, eps = _Joiner(sets), 1 - NUM / DEN, 1e-9
    rest = np.argsort(joiner.sizes, kind="stable")
    while len(rest) > 1:
        pivot, others = int(rest[0]), rest[1:]
        d = joiner.check(pivot, others)
        inside = d <= r + eps
        # links between what is outside and what is inside: d <= 2r, and distances to the pivot that differ by r at most
        for x, dx in zip(others[~inside], d[~inside], strict=True):
            if dx <= 2 * r + eps:
                joiner.check(int(x), others[inside & (np.abs(d - dx) <= r + eps)])
        rest = others[~inside]
    return joiner.links


def cross_join_blocks(sets: list[np.ndarray], out: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links between a block outside a pivot's radius and a block inside it."""
    joiner, inside = _Joiner(sets), np.flatnonzero(~out)
    for i in np.flatnonzero(out):
        joiner.check(int(i), inside)
    return joiner.links


def _read_sets(rows: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    return rows.column("cls").to_numpy(), [np.frombuffer(x, _U) for x in rows.column("shingles").to_pylist()]


def _edges(pairs: list[tuple[int, int]], names: np.ndarray) -> pa.Table:
    i = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.table({"a": pa.array(names[i[:, 0]], pa.int64()), "b": pa.array(names[i[:, 1]], pa.int64())})


def small_links(sets: DataFrame) -> DataFrame:
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        names, s = _read_sets(rows)
        return _edges(join_sets(s), names)

    return sets.groupBy("region").applyInArrow(run, "a long, b long")


def pivot_distances(sets: DataFrame) -> DataFrame:
    """Adds ``d``, the distance to the region's pivot, the class that names it."""
    pivots = sets.where("cls = region").select("region", F.col("shingles").alias("pivot"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            d = []
            for p, s in zip(b.column("pivot").to_pylist(), b.column("shingles").to_pylist(), strict=True):
                x, y = np.frombuffer(p, _U), np.frombuffer(s, _U)
                c = len(np.intersect1d(x, y, assume_unique=True))
                d.append(1 - c / (len(x) + len(y) - c))
            yield pa.record_batch([*(b.column(k) for k in ("region", "cls", "n", "shingles")), pa.array(d, pa.float64())], names=["region", "cls", "n", "shingles", "d"])

    return sets.join(pivots, "region").mapInArrow(run, "region long, cls long, n int, shingles binary, d double")


def large_links(sets: DataFrame) -> DataFrame:
    """Links of large regions: around the first pivot by a join, then what is left in blocks against blocks.

    Blocks are made by step of size, and only blocks of the same or the next step meet: sizes further apart than that do not link.
    """
    r, eps = 1 - NUM / DEN, 1e-9
    far = staged(pivot_distances(sets), "pivot-distances")
    stars = far.where((F.col("d") <= r + eps) & (F.col("cls") != F.col("region"))).select(F.col("region").alias("a"), F.col("cls").alias("b"))
    outside = F.col("d") > r + eps
    per = far.groupBy("region").agg(F.min(F.when(outside, F.col("d"))).alias("least"), F.sum(outside.cast("long")).alias("n_out")).where("n_out > 0")
    left = far.join(per, "region").where(outside | ((F.col("least") <= 2 * r + eps) & (F.col("d") >= F.col("least") - r - eps) & (F.col("cls") != F.col("region"))))
    left = left.select("region", "cls", "shingles", "d", outside.alias("out"), F.floor(F.log("n") / SIZE_STEP).cast("int").alias("k"))
    blocks = left.groupBy("region", "k").agg(*[F.ceil(F.count(F.when(c, 1)) / BLOCK).cast("int").alias(kind) for kind, c in (("n_out", F.col("out")), ("n_in", ~F.col("out")))])
    blocks = blocks.groupBy("region").agg(F.map_from_entries(F.collect_list(F.struct("k", F.struct("n_out", "n_in")))).alias("blocks"))
    left = left.join(blocks, "region")

    def number(kind: str, k):
        return F.coalesce(F.try_element_at("blocks", k)[kind], F.lit(0))

    def near(kind: str):
        """The blocks that the sizes let a class link to."""
        of = lambda k: F.when(number(kind, k) > 0, F.transform(F.sequence(F.lit(0), number(kind, k) - 1), lambda b: F.struct(k.alias("k"), b.alias("b")))).otherwise(F.array().cast(PLACES))
        return F.concat(*[of(F.col("k") + step) for step in (-1, 0, 1)])

    own_blocks = F.when(F.col("out"), number("n_out", F.col("k"))).otherwise(number("n_in", F.col("k")))
    left = left.withColumn("own", F.struct("k", F.pmod(F.xxhash64("cls"), own_blocks).cast("int").alias("b")))
    # a block outside meets each block outside once and each block inside once; blocks inside do not meet
    meet = F.when(F.col("out"), F.concat(
        F.transform(near("n_out"), lambda p: F.struct(F.least("own", p).alias("i"), F.lit(True).alias("both"), F.greatest("own", p).alias("j"))),
        F.when(F.col("d") <= 2 * r + eps, F.transform(near("n_in"), lambda p: F.struct(F.col("own").alias("i"), F.lit(False).alias("both"), p.alias("j")))).otherwise(F.array().cast(MEET)))
    ).otherwise(F.transform(near("n_out"), lambda p: F.struct(p.alias("i"), F.lit(False).alias("both"), F.col("own").alias("j"))))
    dealt = left.select("region", "cls", "shingles", "out", F.explode(meet).alias("m")).select("region", "cls", "shingles", "out", "m.*")

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        names, s = _read_sets(rows)
        out, both = np.array(rows.column("out").to_pylist(), bool), key[2].as_py()
        return _edges(join_sets(s) if both else cross_join_blocks(s, out), names)

    return stars.unionByName(dealt.repartition("region", "i", "both", "j").groupBy("region", "i", "both", "j").applyInArrow(run, "a long, b long"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, cls (documents with equal sets share it), component_id."""
    spark = docs.sparkSession
    docs = id_and_text(docs, id_col, text_col)
    chars = docs.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    bits = min(max(CELL_BITS[0], (chars // 6).bit_length()), CELL_BITS[1])
    first = first_pass(docs, bits)
    names = first.where("n is not null").select("doc_id", "n", "cls")
    total = names.agg(F.sum("n")).first()[0] or 0
    hot = spark.sparkContext.broadcast(frequent_cells(first.where("bucket is not null").select("bucket", "low"), bits, total))
    region = regions(cells_of(docs, bits, hot))
    sizes = region.groupBy("region").agg(F.count(F.lit(1)).alias("size"))
    region = staged(region.join(sizes, "region"), "sized-regions")
    n_classes = region.count()
    links = None
    if n_classes:
        sets = region_sets(docs, region, n_classes)
        small = small_links(sets.where(F.col("size") <= BLOCK).drop("size"))
        large = large_links(sets.where(F.col("size") > BLOCK).drop("size"))
        links = components(small.unionByName(large))
    least = names.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("least"))
    if links is not None:
        links = staged(links, "links")
        linked = least.join(links.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    else:
        linked = least.withColumn("root", F.col("cls"))
    linked = staged(linked, "class-roots")
    ids = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = linked.join(ids, "root").select("cls", "component_id")
    return names.join(by_class, "cls", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), "cls", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one_of_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component the one with the smallest id, and every row without a word.

    Null ids come last, and of rows that share an id (or have none) the one with the smallest hash of id and text
    stays.  Only rows equal in id and text stay or go together.
    """
    row = F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    named = docs.select(row.alias("doc_id"), F.col(text_col).alias("text"))
    groups = staged(jaccard_components(named).select(F.col("doc_id").alias("_row"), "cls", "component_id"), "row-groups")
    ids = docs.select(F.col(id_col).cast("long").alias("id"), row.alias("_row"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "_row"))["_row"]
    least = ids.join(groups.where("cls is not null"), "_row").groupBy("component_id").agg(first.alias("_keep"))
    free = "_keep"
    while free in docs.columns:
        free += "_"
    stay = least.select(F.col("_keep").alias(free)).unionByName(groups.where("cls is null").select(F.col("_row").alias(free)))
    return docs.join(stay, row == F.col(free), "left_semi")
