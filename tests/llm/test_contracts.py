"""Every operN query on whole small tables against brute force in plain Python."""

import collections
import hashlib
import re
import zlib

import public_tokenizers
import pytest

from loanflow.llm.queries import CONTROL_TEXT, ORACLES, REGISTRY

SF = "/root/testdata/sf0.001"


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def run(spark, name, sf=SF):
    return [r.asDict() for r in REGISTRY[name](spark, sf).collect()]


@pytest.fixture(scope="module")
def documents(spark):
    return [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def test_op1_reads_back_what_it_formatted(spark):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"] or "") for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    rows += [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)]
    by = collections.defaultdict(list)
    for c, turn, role, text in sorted(rows):
        by[c].append((role, text))
    got = {r["conv_id"]: r for r in run(spark, "op1_chat_formatting")}
    assert set(got) == set(by)
    for c, turns in by.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        want = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
        assert (got[c]["n_turns"], got[c]["turns_sha256"], got[c]["loss_chars"], got[c]["loss_sha256"]) == want
        assert got[c]["formatted_chars"] >= sum(len(t) for _, t in turns)


def brute(pattern, text, keep, flags=0, ascii_only=True):
    return [(m.start(), m.end()) for m in re.finditer(pattern, text, flags | (re.A if ascii_only else 0)) if keep(m)]


KEYWORD = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))


def base_secrets(text):
    return {
        "assign": brute(rf"""({KEYWORD})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, lambda m: len(m[2]) >= 6),
        "access": brute(r"AKIA[A-Z0-9]+", text, lambda m: len(m[0]) >= 20),
        "hex": brute(r"[0-9a-f]+", text, lambda m: len(m[0]) >= 24),
    }


def test_op2_base_spans(spark, documents):
    got = {r["doc_id"]: r for r in run(spark, "op2_secret_scan", "/root/testdata/sf0.01")}
    docs = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    assert len(got) == len(docs)
    assert any(r["n_assign"] for r in got.values())
    for d, text in docs:
        found = base_secrets(text)
        order = {k: i for i, k in enumerate(found)}
        spans = sorted((s, order[k], e, k) for k, v in found.items() for s, e in v)
        assert tuple(got[d][f"n_{k}"] for k in found) == tuple(len(v) for v in found.values())
        assert got[d]["base_sha256"] == sha(",".join(f"{k}:{s}:{e}" for s, _, e, k in spans))
        assert {f"{k}:{s}:{e}" for s, _, e, k in spans} <= set(got[d]["spans"].split(","))  if spans else True


def luhn(d):
    return sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(int(c) for c in reversed(d))) % 10 == 0


def digits(x):
    return re.sub("[^0-9]", "", x)


def base_pii(text):
    return {
        "email": brute(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text, lambda m: True),
        "ip": brute(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text, lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        "card": brute(r"[0-9]([\x20-]?[0-9])+", text, lambda m: 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))),
        "phone": brute(r"\+[0-9][\x20().0-9-]+[0-9]", text, lambda m: 8 <= len(digits(m[0])) <= 15),
    }


def test_op6_base_spans(spark):
    got = {r["doc_id"]: r for r in run(spark, "op6_pii", "/root/testdata/sf0.01")}
    docs = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    for d, text in docs:
        found = base_pii(text)
        assert tuple(got[d][f"n_{k}"] for k in found) == tuple(len(v) for v in found.values())
        spans = [f"{k}:{s}:{e}" for k, v in found.items() for s, e in v]
        assert got[d]["base_sha256"] == sha(",".join(spans))
        assert set(spans) <= set(got[d]["spans"].split(",")) or not spans


def shingles(text):
    w = text.encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(docs):
    sets, up = {d: shingles(t) for d, t in docs}, {d: d for d, _ in docs}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)) and 100 * len(x & y) >= 75 * len(x | y):
                up[max(root(a), root(b))] = min(root(a), root(b))
    return {d: (len(sets[d]), root(d)) for d in ids}


def test_op4_equals_all_pairs(spark):
    docs = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in run(spark, "op4_ngram_jaccard_join", "/root/testdata/sf0.01")}
    assert got == brute_components(docs)
    assert any(c != d for d, (_, c) in got.items())


def test_op5_pieces(spark, documents):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: [*tok.encode(t, add_special_tokens=False).ids, 0] for d, t in documents}
    rows = run(spark, "op5_packing")
    seen, per_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        piece = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(piece) == r["length"] > 0 and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in piece))
        seen[r["doc_id"]].append((r["start"], r["length"]))
        per_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for d, whole in ids.items():
        at = 0
        for start, n in sorted(seen[d]):
            assert start == at
            at += n
        assert at == len(whole)
    for pieces in per_seq.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 1024 and at & (at - 1) == 0  # full, or a power of two: no padding


def test_op5_mixture(spark):
    """In the windows of a group, every source has about its share of the ids."""
    from loanflow.llm.packing import pack

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), {"<|endoftext|>": 50256}).select("sequence_id", "length", "source").collect()
    total, half = collections.Counter(), collections.Counter()
    middle = sorted(r["sequence_id"] for r in rows)[len(rows) // 2]
    for r in rows:
        total[r["source"]] += r["length"]
        half[r["source"]] += r["length"] * (r["sequence_id"] < middle)
    for s in total:
        assert abs(half[s] / sum(half.values()) - total[s] / sum(total.values())) < 0.03


def test_op7_held_out_accuracy(spark):
    rows = run(spark, "op7_toxicity", "/root/testdata/sf0.1")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert sum(p == y for p, y in held) / len(held) > 0.97
    assert sum(p for p, y in held if y) / sum(y for _, y in held) > 0.85


def test_op8_equals_library(spark, documents):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r["doc_id"]: r for r in run(spark, "op8_sentencepiece")}
    for d, text in documents:
        ids = sp.encode(text)
        assert (got[d]["n_tokens"], got[d]["ids_sha256"], got[d]["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids)))


def test_op9_equals_sql(spark, documents):
    groups = collections.defaultdict(list)
    for d, t in documents:
        groups[t].append(d)
    got = {r["doc_id"]: r for r in run(spark, "op9_exact_dedup")}
    assert len(got) == len(documents) and "op9_exact_dedup" in ORACLES
    for t, ids in groups.items():
        for d in ids:
            r = got[d]
            assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (max(ids), len(ids), d == max(ids), sha(t))


def test_op10_edits_and_likeness(spark, documents):
    texts = dict(documents)
    order = sorted(texts, reverse=True)
    got = {r["doc_id"]: r for r in run(spark, "op10_fingerprints")}
    for k, d in enumerate(order):
        t, nxt = texts[d], texts[order[(k + 1) % len(order)]]
        cut = len(t) // 3
        assert got[d]["edited_sha256"] == sha(t[:len(t) - cut] + nxt[:cut]) and got[d]["n_chars"] == len(t)
    same = collections.defaultdict(set)
    for d, t in documents:
        same[t].add(got[d]["fingerprint"])
    assert all(len(v) == 1 for v in same.values()) and len({f for v in same.values() for f in v}) == len(same)
    assert sum(r["near_edited"] for r in got.values()) > 3 * sum(r["near_next"] for r in got.values())
    assert all(0 <= r[c] <= 1 for r in got.values() for c in ("near_edited", "near_next"))


def test_op3_equals_exact_containment(spark):
    from loanflow.llm.licenses import NOTICES

    def words(t):
        return re.findall(r"[a-z0-9](?:[a-z0-9.-]*[a-z0-9])?", t.lower())

    def grams(w):
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    tpl = [grams(words(t)) for _, t in NOTICES]
    want = set()
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect():
        w = words(r["text"] or "")
        for k, g in enumerate(tpl):
            if any(len(g & grams(w[at:at + 132])) >= 0.75 * len(g) for at in range(0, max(1, len(w) - 4), 64)):
                want.add((r["doc_id"], k))
    got = {(r["doc_id"], r["template"]) for r in run(spark, "op3_license_scan", "/root/testdata/sf0.01")}
    assert got == want and got
