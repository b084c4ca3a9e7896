"""Decontamination against brute force: exact phrases, proximity, parts of long texts, odd rows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from loanflow.llm import decontamination as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, window=10):
    found = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            found.setdefault(tuple(w[i:i + window]), set()).add(item)
    sizes = {len(p) for p in found}
    out = []
    for doc, text in docs:
        w, hit, names = words(text), set(), set()
        for m in sizes:
            for i in range(len(w) - m + 1):
                p = tuple(w[i:i + m])
                if p in found:
                    hit.update(range(i, i + m))
                    names |= {str(x) for x in found[p] if x is not None}
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return out


def key(row):
    return tuple((x is not None, str(x)) for x in row)


def run(spark, docs, items, **kw):
    left = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], "doc_id long, text string, term string, pos int, phrase_id int").repartition(3)
    right = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id int")
    rows = d.decontaminate(left, right, **kw).drop("item_ids").collect()
    return sorted((tuple(r) for r in rows), key=key)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    text = lambda n, v: " ".join(rng.choice(["ab", "Ab", "é", "É", "cd1", "x" + str(rng.randrange(v))]) + rng.choice(["", ",", " -"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 4, 6]), 3)) for i in range(12)]
    docs = [(i, text(rng.randrange(0, 60), 4)) for i in range(40)]
    assert run(spark, docs, items, window=4) == sorted(brute(docs, items, 4), key=key)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(25))
    items = [(1, long), (2, None), (3, " .,\n"), (4, "One two"), (5, "one TWO!"), (None, "w1 w2"), (10, "w24 end"), (4, "three")]
    docs = [(1, long), (1, long), (2, None), (3, ""), (4, "one,two one two"), (None, "ONE two"), (None, long), (0, long + " end three"),
            (7, "w0 " * 50), (8, "a\x00one\x7ftwo b"), (9, "ONEtwo onetwo")]
    assert run(spark, docs, items) == sorted(brute(docs, items), key=key)
    assert run(spark, docs, []) == sorted(brute(docs, []), key=key)
    assert run(spark, [], items) == []


def test_whole_table(spark):
    from loanflow.llm.queries import REGISTRY

    sf = "/root/testdata/sf0.001"
    read = lambda t, c: [tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(*c).collect()]
    got = sorted((tuple(r) for r in REGISTRY["op11_decontamination"](spark, sf).collect()), key=key)
    assert got == sorted(brute(read("documents", ["doc_id", "text"]), read("benchmark", ["item_id", "text"])), key=key)
    assert any(r[5] for r in got) and not all(r[5] for r in got)


def test_parts_keep_words_and_places(spark):
    texts = [("  a bb, ccc é É xX  " * k) + "zz" * j for k in (1, 5, 9) for j in (0, 3, 40)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    low = d.lowered(F.col("text"))
    for r in df.select("text", d.parts_of(low, 16).alias("parts"), d.count_words(low, 16).alias("n")).collect():
        w, at = words(r["text"]), 0
        for p in r["parts"]:
            assert p["base"] == at
            here = words(p["part"])
            assert w[at:at + len(here)] == here
            at += len(here)
        assert at == len(w) == r["n"]


def test_long_text(spark):
    """2,000,000 words in one text of two parts and more, a phrase across every cut."""
    phrase = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.repeat(F.lit(phrase + " lam "), 50_000).alias("text"))
    items = spark.createDataFrame([(3, phrase)], "item_id long, text string")
    row = d.decontaminate(docs, items).first()
    assert (row["n_words"], row["n_hit"], row["item_ids"]) == (550_000, 500_000, ["3"])


def test_proximity(spark):
    """Every term within ``slop`` words of its place, measured from the rarest one."""
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice("abcdefgh") for _ in range(30))) for i in range(30)] + [(99, "q a b")]
    items = [(1, "q a b"), (2, "a c b d"), (3, "h")]
    left = spark.createDataFrame(docs, "doc_id long, text string")
    known, of_items = d.phrases(spark.createDataFrame(items, "item_id long, text string"))
    index = d.index_documents(left)
    assert index.count() == sum(len(words(t)) for _, t in docs)
    counts = {r["term"]: r["n"] for r in index.groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}
    for slop in (0, 1, 2):
        got = {(r["doc_id"], r["item_id"], r["start"]) for r in d.find(index, known, slop).join(of_items, "phrase_id").collect()}
        want = set()
        for doc, text in docs:
            w = words(text)
            for item, phrase in items:
                p = words(phrase)
                lead = min(range(len(p)), key=lambda i: (counts.get(p[i], 0), p[i], i))
                for at in range(len(w)):
                    start = at - lead
                    near = all(any(0 <= start + i + e < len(w) and w[start + i + e] == t for e in range(-slop, slop + 1)) for i, t in enumerate(p) if i != lead)
                    if w[at] == p[lead] and near and (slop or start >= 0):
                        want.add((doc, item, start))
        assert got == want
