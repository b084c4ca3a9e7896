"""Long texts and logs: work in proportion to their length, results as from brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from loanflow.llm import chat, fingerprint, secrets
from loanflow.llm.spans import RUN, sums_before


@pytest.mark.parametrize("n", [0, 1, RUN - 1, RUN, RUN + 1, 3 * RUN + 5])
def test_sums_before(spark, n):
    rng = random.Random(n)
    values = [rng.randrange(100) for _ in range(n)]
    got = spark.createDataFrame([(values,)], "v array<int>").select(sums_before(F.col("v")).alias("s")).first()["s"]
    assert got == [sum(values[:i]) for i in range(n)]


def test_many_hits_in_one_text(spark):
    rng = random.Random(7)
    text = "".join(rng.choice(["token=abcdef ", "Secret: 'q1w2e3r4'\n", "é😀 ", "api_key=short ", "x" * rng.randrange(5)]) for _ in range(60_000))
    docs = spark.createDataFrame([(1, text), (2, "")], "doc_id long, text string")
    rows = {r["doc_id"]: r["spans"] for r in secrets.scan_secrets(docs).collect()}
    rule = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    want = [(m.start(), m.end()) for m in rule.finditer(text) if len(m[2]) >= 6]
    assert [(s["start"], s["end"]) for s in rows[1] if s["kind"] == "assign"] == want and len(want) > 20_000
    assert rows[2] == []


def brute_fold(events):
    logs = {}
    for conv, seq, kind, message, role, text in events:
        logs.setdefault((conv, message), []).append((seq, role or "", text or "", kind or "message"))
    out = []
    for (conv, message), log in logs.items():
        log.sort(key=lambda e: (e[0] is not None, e[0] or 0, *e[1:]))
        role, parts, gone = "", [], False
        for _, r, t, k in log:
            role = r or role
            parts = [*parts, t] if k == "delta" else [] if k == "delete" else [t]
            gone = k == "delete"
        if not gone:
            out.append((conv, message, log[0][0], role, "".join(parts)))
    return out


def test_fold_against_brute_force(spark):
    rng = random.Random(11)
    events = [(rng.randrange(6), rng.choice([None, *range(12)]), rng.choice(["message", "delta", "delta", "delta", "edit", "regenerate", "delete", None]),
               rng.randrange(4), rng.choice([None, "", "user", "assistant"]), rng.choice([None, "", "a", "b", "c"])) for _ in range(600)]
    got = chat.fold_events(spark.createDataFrame(events, "conv_id long, seq long, kind string, message long, role string, text string")).collect()
    order = lambda rows: sorted(rows, key=str)
    assert order((r["conv_id"], r["message"], r["seq"], r["role"], r["text"]) for r in got) == order(brute_fold(events))


def test_long_logs(spark):
    n = 60_000
    base = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("seq"), F.lit("assistant").alias("role"), F.concat(F.lit("x"), F.col("id")).alias("text"))
    log = base.withColumns({"kind": F.when(F.col("seq") == 0, "message").otherwise("delta"), "message": F.lit(5)})
    whole = "".join(f"x{i}" for i in range(n))
    assert chat.fold_events(log).first()["text"] == whole
    # as many messages without a sequence number are one part
    many = base.withColumns({"message": F.col("seq"), "seq": F.lit(None).cast("long"), "kind": F.lit("message")})
    row = chat.read_back(chat.format_conversations(many)).first()
    assert row["n_turns"] == n and len(row["turns"]) == n
    assert row["loss_text"] == "".join(t["text"] for t in row["turns"])


def test_long_text_has_one_fingerprint(spark):
    line = "alpha beta, gamma delta\nepsilon zeta "
    docs = spark.range(2).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 0, F.repeat(F.lit(line), 100_000)).otherwise(F.lit(line)).alias("text"))
    rows = {r["doc_id"]: r["fp"] for r in fingerprint.fingerprint_documents(docs).collect()}
    paragraphs = [p for p in (line * 100_000).split("\n") if p]
    assert len(rows[0]) == fingerprint.WIDTH and len(paragraphs) == 100_001
    inner = spark.createDataFrame([("epsilon zeta alpha beta, gamma delta",)], "p string").select(fingerprint.fingerprint(F.col("p")).alias("f")).first()["f"]
    ends = spark.createDataFrame([("alpha beta, gamma delta\nepsilon zeta ",)], "p string").select(fingerprint.fingerprint(F.col("p")).alias("f")).first()["f"]
    for k in range(fingerprint.EQUAL):
        assert rows[0][k] == (99_999 * inner[k] + ends[k]) & fingerprint.POWER
