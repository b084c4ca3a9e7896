"""Mixture-controlled packing: deficit round-robin over source queues.

1. Documents are tokenized, an end id after each, and cut into queue items of at most
   ``ITEM_TOKENS`` ids.  Each source is a queue; an item's place in its queue is the number
   of ids before it, from running sums within a task and sums over the tasks before.
2. The token share of each source is its target.  The stream is divided into groups of about ``GROUP_TOKENS`` ids;
   an item belongs to the group in which its source's accumulated quantum passes
   the item's place.  Each queue is turned by a phase hashed from its name (places are modulo the source's ids), so that small
   sources, however many, start all over the stream and not in the first group.  A group that starts with an item cut off from its target begins with that
   deficit, so deficits carry over from group to group wherever they run.
3. Within a group, windows of ``WINDOW_SEQUENCES`` sequences are filled by deficit
   round-robin: each source gains its share of the window, sends items (cut where its deficit
   ends, if at least ``LEAST_PIECE`` ids go) and carries the rest to the next window.  A source whose share of a window
   is less than ``LEAST_PIECE`` ids sends an item whole when the accumulated quantum passes its place.
4. The group's ids fill sequences of ``SEQUENCE`` ids; the rest of the last one is cut into
   sequences whose lengths are powers of two, which need no padding.

A source with most of the rows is spread over all groups, and small sources over groups by their phases.

Cases: a null text is empty and has the end id alone; a null source is a queue of its
own; repeated rows are packed each; null ids stay; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanflow.llm.common import id_and_text, sliced, staged

SEQUENCE = 1024
END_ID = 0
ITEM_TOKENS = 1 << 16
GROUP_TOKENS = 1 << 20
WINDOW_SEQUENCES = 64
LEAST_PIECE = 64
#: tiktoken's regex engine fails on runs of about 1,000,000 white-space characters; those from here on are encoded without it.
LONG_RUN = 1 << 18
#: White space of the pattern (Unicode White_Space); Python's has four control characters more.
SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")

_encoders: dict = {}


def encode_long(enc, special: dict[str, int], text: str) -> list[int]:
    """Ids of a text that may have long white-space runs.  Those are cut out where the pattern cuts them: before their last
    character, or at their end where a special string or the end of the text follows."""
    ids: list[int] = []
    parts = re.split(f"({'|'.join(map(re.escape, sorted(special, key=len, reverse=True)))})", text) if special else [text]
    for k, part in enumerate(parts):
        if k % 2:
            ids.append(special[part])
            continue
        at = 0
        for m in SPACES.finditer(part):
            if m.end() - m.start() >= LONG_RUN:
                end = m.end() - (m.end() < len(part))
                ids += enc.encode_ordinary(part[at:m.start()])
                ids += enc._encode_single_piece(part[m.start():end])
                at = end
        ids += enc.encode_ordinary(part[at:])
    return ids


def byte_bpe(ranks_path: str, special: dict[str, int]):
    """An encoder of the byte-level BPE vocabulary at ``ranks_path``, one per worker; texts to lists of ids, specials recognised in texts."""
    key = (ranks_path, tuple(special.items()))
    if key not in _encoders:
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        allowed = set(special)
        _encoders[key] = lambda text: (encode_long(enc, special, text) if len(text) >= LONG_RUN
                                       else enc.encode(text, allowed_special=allowed, disallowed_special=()))
    return _encoders[key]


ITEM_SCHEMA = "doc_id long, source string, part int, before long, start long, doc_tokens long, n int, ids binary"


def id_type(ranks_path: str, special: dict[str, int]) -> str:
    """The narrowest little-endian unsigned type that holds every id of a vocabulary."""
    with open(ranks_path, "rb") as f:
        most = max([int(line.split()[1]) for line in f] + [*special.values()])
    return "<u2" if most < 1 << 16 else "<u4"


def tokenize(docs: DataFrame, ranks_path: str, special: dict[str, int], source_col: str, dtype: str) -> DataFrame:
    """Queue items, staged; ids in 16 bits each where the vocabulary allows.  ``part`` and ``before``: the task, and the ids of the source before the item in that task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before, encode = TaskContext.get().partitionId(), {}, byte_bpe(ranks_path, special)
        schema = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("part", pa.int32()), ("before", pa.int64()), ("start", pa.int64()),
                            ("doc_tokens", pa.int64()), ("n", pa.int32()), ("ids", pa.binary())])
        for batch in sliced(batches):
            rows: list[list] = [[] for _ in schema]
            size = 0
            for doc_id, text, source in zip(*(batch.column(c) for c in ("doc_id", "text", "source")), strict=True):
                source = source.as_py()
                ids = np.asarray([*encode(text.as_py()), END_ID], dtype)
                for start in range(0, len(ids), ITEM_TOKENS):
                    item = ids[start:start + ITEM_TOKENS]
                    at = before.get(source, 0)
                    before[source] = at + len(item)
                    for out, v in zip(rows, (doc_id.as_py(), source, part, at, start, len(ids), len(item), item.tobytes()), strict=True):
                        out.append(v)
                    size += len(item)
                if size > 1 << 20:
                    yield pa.record_batch([pa.array(v, f.type) for v, f in zip(rows, schema, strict=True)], schema=schema)
                    rows, size = [[] for _ in schema], 0
            if rows[0]:
                yield pa.record_batch([pa.array(v, f.type) for v, f in zip(rows, schema, strict=True)], schema=schema)

    docs = docs.select("doc_id", "text", F.col(source_col).cast("string").alias("source"))
    return staged(docs.mapInArrow(run, ITEM_SCHEMA), "tokens")


def queue_places(items: DataFrame) -> DataFrame:
    """Adds ``place`` (ids of the source before the item) and ``total`` (ids of the source).  Sums per task and source meet in small rows only."""
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    items = items.withColumn("queue", key)
    sums = items.groupBy("queue", "part").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("queue").orderBy("part")
    sums = sums.select("queue", "part", (F.sum("n").over(w) - F.col("n")).alias("ahead"), F.sum("n").over(Window.partitionBy("queue")).alias("total"))
    # the sums are written first, so Spark knows their size and broadcasts them where they are small; else the join's
    # keys split a hot source by task
    return items.join(staged(sums, "queue-sums"), ["queue", "part"]).withColumn("place", F.col("ahead") + F.col("before")).drop("part", "before", "ahead")


PIECES = pa.schema([*((c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")), ("ids", pa.binary()), ("source", pa.string())])


def pack_group(group: int, n_groups: int, total: int, items: list[tuple]) -> list[tuple]:
    """Pieces of one group; ``total``: the ids of all groups.  ``items``: (doc_id, queue, source, start, doc_tokens, place, total, ids as numpy array)."""
    items.sort(key=lambda x: (x[1], x[5]))
    queues: dict[str, list] = {}
    for x in items:
        queues.setdefault(x[1], []).append(x)
    names, size = list(queues), sum(len(x[7]) for x in items)
    # a group's target is its share of each source; what earlier groups have sent too much or too little of it is the deficit to begin with
    quantum = {q: queues[q][0][6] / n_groups for q in names}
    deficit = {q: group * quantum[q] - queues[q][0][5] for q in names}
    head, taken = dict.fromkeys(names, 0), dict.fromkeys(names, 0)
    # what each source gains in a window; sources without an item in this group leave their part of the window to it
    gain = {q: quantum[q] * WINDOW_SEQUENCES * SEQUENCE * n_groups / total for q in names}
    order: list[tuple] = []  # (item, from, to)
    while names:
        for q in names:
            deficit[q] += gain[q]
            while head[q] < len(queues[q]) and deficit[q] > 0:
                item = queues[q][head[q]]
                rest = len(item[7]) - taken[q]
                go = rest if deficit[q] >= rest or gain[q] < LEAST_PIECE else int(deficit[q])
                if go < min(rest, LEAST_PIECE):
                    break
                if rest - go < LEAST_PIECE:  # no crumbs: the deficit goes below 0 and is carried
                    go = rest
                order.append((item, taken[q], taken[q] + go))
                deficit[q] -= go
                taken[q] += go
                if taken[q] == len(item[7]):
                    head[q], taken[q] = head[q] + 1, 0
        names = [q for q in names if head[q] < len(queues[q])]
    # lengths of the group's sequences: full ones, then powers of two
    left, lengths = size % SEQUENCE, [SEQUENCE] * (size // SEQUENCE)
    lengths += [1 << b for b in range(SEQUENCE.bit_length() - 2, -1, -1) if left >> b & 1]
    out, seq, offset = [], 0, 0
    for item, a, b in order:
        doc_id, _, source, start, doc_tokens, _, _, ids = item
        while a < b:
            n = min(b - a, lengths[seq] - offset)
            piece = ids[a:a + n].tobytes()
            out.append((doc_id, start + a, n, zlib.crc32(piece), doc_tokens, (group << 32) | seq, offset, piece, source))
            a, offset = a + n, offset + n
            if offset == lengths[seq]:
                seq, offset = seq + 1, 0
    return out


def pack(docs: DataFrame, ranks_path: str, special: dict[str, int] | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit), source."""
    docs = id_and_text(docs.withColumn("_source", F.col(source_col)), id_col, text_col, "_source")
    special, dtype = special or {}, id_type(ranks_path, special or {})
    items = tokenize(docs, ranks_path, special, "_source", dtype)
    total = items.agg(F.sum("n")).first()[0] or 0
    n_groups = max(1, -(-total // GROUP_TOKENS))
    # a fraction of the source's ids, as a source may have fewer ids than there are groups
    phase = F.pmod(F.xxhash64("queue"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    placed = queue_places(items).withColumn("place", (F.col("place") + phase * F.col("total")) % F.col("total").cast("double"))
    placed = placed.withColumn("group", F.least(F.floor(F.col("place") * n_groups / F.col("total")), F.lit(n_groups - 1)).cast("long"))

    names, types = zip(*[(f.name, f.type) for f in PIECES], strict=True)

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        items = [(*r[:7], np.frombuffer(r[7], dtype).astype("<u4")) for r in zip(*(rows.column(c).to_pylist() for c in (
            "doc_id", "queue", "source", "start", "doc_tokens", "place", "total", "ids")), strict=True)]
        pieces = pack_group(key[0].as_py(), n_groups, total, items)
        return pa.table([pa.array(c, t) for c, t in zip(zip(*pieces, strict=True), types, strict=True)], names=list(names))

    return placed.groupBy("group").applyInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary, source string")
