"""Links that must not be: structured words; rows that share an id; the exchange before a region's blocks."""

import itertools

import numpy as np

from loanflow.llm import jaccard


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def brute(docs):
    sets = {}
    for i, text in docs:
        w = "".join(c.lower() if c.isascii() else c for c in text).split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_structured_words_do_not_collide(spark):
    docs = []
    for n in (8, 64, 1024, 4096):
        word = thue_morse(n)
        other = word.translate(str.maketrans("ab", "ba"))
        for w in (word, other):
            docs.append((len(docs), " ".join([w, "b", w, "d", w, "f", w])))
    docs += [(len(docs), docs[4][1] + " g"), (len(docs) + 1, "a\x00 " * 9), (len(docs) + 2, "a " * 9)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(
        spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute(docs)


def test_word_hashes_are_distinct():
    rng = np.random.default_rng(0)
    words = {bytes(rng.integers(97, 100, rng.integers(1, 20)).astype(np.uint8)) for _ in range(20_000)}
    words |= {b"x" * n for n in range(1, 200)} | {b"\x00" * n for n in range(1, 80)}
    words = sorted(words)
    data = b" ".join(words)
    start, found = jaccard._word_hashes(data)
    assert len(start) == len(words) and len(set(found.tolist())) == len(words)
    again = jaccard._word_hashes(b"\n".join(reversed(words)))[1]
    assert (again[::-1] == found).all()


def test_near_copies_that_share_an_id(spark):
    base = " ".join(f"w{i}" for i in range(40))
    docs = [(1, base), (1, base + " x"), (None, base + " y"), (None, base + " z"), (5, "other words here"), (None, ""), (None, None), (None, "alone")]
    kept = jaccard.keep_one_of_group(spark.createDataFrame([(i, t, 7) for i, t in docs], "doc_id long, text string, _keep int")).collect()
    near = [r for r in kept if (r["text"] or "").startswith("w0")]
    assert len(near) == 1 and near[0]["doc_id"] == 1
    assert sorted(r["text"] or "" for r in kept if r not in near) == ["", "", "alone", "other words here"]
    nulls = [(None, base), (None, base + " x"), (None, base + " y")]
    assert jaccard.keep_one_of_group(spark.createDataFrame(nulls, "doc_id long, text string")).count() == 1


def test_blocks_of_a_region_have_their_own_exchange(spark):
    """Without broadcasts a region's block pairs are dealt by (region, i, both, j), not by region alone."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sets = spark.createDataFrame([(1, c, 5, bytes(40)) for c in range(1, 4)], "region long, cls long, n int, shingles binary")
        plan = jaccard.large_links(sets)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    at = plan.index("FlatMapGroupsInArrow")
    dealt = next(line for line in plan[at:].splitlines() if "Exchange" in line)
    assert "region" in dealt and "both" in dealt


def test_bit_tables_are_summed_by_all_tasks(spark):
    """A table of 64 partitions takes a few jobs, not one after another for each of them; its bits are those of the counts."""
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    old = {k: spark.conf.get(k) for k in conf}
    rng = np.random.default_rng(1)
    lists = [(b, rng.integers(0, 40, n).astype("<u2")) for b in range(200) for n in (1, 700, 3000)]
    cells = spark.createDataFrame([(b, bytearray(x.tobytes())) for b, x in lists], "bucket int, low binary")
    jobs = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        before = jobs()
        got = np.unpackbits(np.frombuffer(jaccard.frequent_cells(cells, 24, 80 << 24 >> 2), np.uint8), bitorder="little")
        assert jobs() - before < 20
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    count = np.zeros(1 << 24, np.int64)
    for b, x in lists:
        count[b << 16:(b + 1) << 16] += np.bincount(x, minlength=1 << 16)
    least = jaccard.FREQUENT + 80
    assert 0 < (count > least).sum() < (count > 0).sum() and (got == (count > least)).all()


def test_overlaps_of_rare_and_common_shingles():
    rng = np.random.default_rng(2)
    common = np.arange(1, 60, dtype=np.uint64)
    sets = [np.unique(np.r_[common[rng.random(59) < 0.8], rng.integers(100, 900, rng.integers(1, 90)).astype(np.uint64)]) for _ in range(70)] + [np.array([7], np.uint64)]
    got = jaccard._overlaps(sets, columns=16, at_once=500)
    want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    off = ~np.eye(len(sets), dtype=bool)
    assert (got[off] == want[off]).all()


def test_blocks_meet_by_size(spark, monkeypatch):
    """Chains of links over many sizes are whole, in blocks that meet by size."""
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    rng = np.random.default_rng(3)
    sets, shared = {}, np.arange(1, 4, dtype=np.uint64)
    for start in (4, 5, 9, 30, 100, 400):
        grown = rng.integers(1 << 40, 1 << 60, start).astype(np.uint64)
        for _ in range(12):  # each is up to a third longer than the one before
            more = rng.integers(1 << 40, 1 << 60, max(1, int(len(grown) * rng.choice([0.05, 0.2, 1 / 3, 0.4])))).astype(np.uint64)
            grown = np.unique(np.r_[grown, more, shared])
            sets[len(sets) + 1] = grown
    rows = [(1, c, len(s), bytearray(s.tobytes())) for c, s in sets.items()]
    frame = jaccard.large_links(spark.createDataFrame(rows, "region long, cls long, n int, shingles binary"))

    def root_of(edges):
        root = {c: c for c in sets}

        def find(c):
            return c if root[c] == c else find(root[c])

        for a, b in edges:
            x, y = sorted((find(a), find(b)))
            root[y] = x
        return {c: find(c) for c in sets}

    near = [(a, b) for a, b in itertools.combinations(sets, 2)
            if 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))]
    got = [(r["a"], r["b"]) for r in frame.collect()]
    assert len(near) > 20 and root_of(got) == root_of(near)
    assert all(tuple(sorted(e)) in set(near) for e in got)
