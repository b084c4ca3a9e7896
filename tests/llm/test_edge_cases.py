"""Nulls, empty and long texts, ties and repeated rows, empty tables, and extra columns with clashing names."""

import hashlib
import random
import re
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loanflow.llm import chat, exact_dedup, fingerprint, jaccard, licenses, packing, pii, secrets, sentencepiece_codec, toxicity
from loanflow.llm.common import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, cls int, words string, hashes string, row_key int, _bucket int"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
LONG = "alpha beta gamma delta " * 20_000 + "x" * 200_000 + "7" * 50_000


def rows_of(texts):
    return [(i, t, None, s, 0, "d", 1, "w", "h", 2, 3) for i, t, s in texts]


@pytest.fixture(scope="module")
def odd(spark):
    texts = [(None, None, None), (None, "", "a"), (1, "", "a"), (1, None, "a"), (2, "one two three", "a"), (3, "one  two\tTHREE", None),
             (4, LONG, "b"), (4, LONG, "b"), (5, LONG + " y", "b"), (6, "\n\n \t", "b"), (7, "日本語 😀 é\x00", "c"), (7, "password = hunter22", "c")]
    return spark.createDataFrame(rows_of(texts), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_rows_in_rows_out(odd):
    n = odd.count()
    assert exact_dedup.exact_dedup(odd).count() == n
    assert secrets.scan_secrets(odd).count() == n
    assert jaccard.jaccard_components(odd).count() == n
    assert pii.find_pii(odd).count() == n
    assert sentencepiece_codec.encode_documents(odd, MODEL).count() == n
    assert fingerprint.with_next(fingerprint.fingerprint_documents(odd), "fp").count() == n


def test_empty_tables(empty, spark):
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert secrets.scan_secrets(empty).count() == 0
    assert jaccard.jaccard_components(empty).count() == 0
    assert pii.find_pii(empty).count() == 0
    assert licenses.scan_licenses(empty).count() == 0
    assert sentencepiece_codec.encode_documents(empty, MODEL).count() == 0
    assert fingerprint.with_next(fingerprint.fingerprint_documents(empty), "fp").count() == 0
    assert packing.pack(empty, RANKS).count() == 0
    model = toxicity.learn(empty, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score_documents(empty, model).count() == 0
    events = spark.createDataFrame([], "conv_id long, seq long, kind string, message long, role string, text string")
    assert chat.format_conversations(events).count() == 0


def test_exact_dedup_ties(odd):
    got = exact_dedup.exact_dedup(odd).collect()
    blank = [r for r in got if r["text_sha256"] == hashlib.sha256(b"").hexdigest()]
    assert len(blank) == 4 and all(r["keep_id"] == 1 and r["group_size"] == 4 for r in blank) and sum(r["kept"] for r in blank) == 1
    long = [r for r in got if r["doc_id"] == 4]
    assert len(long) == 2 and sum(r["kept"] for r in long) == 1
    kept = exact_dedup.keep_one(odd)
    assert kept.columns == odd.columns and kept.count() == len({r["text_sha256"] for r in got})


def test_chunks_join_to_the_text(spark):
    rnd = random.Random(1)
    texts = ["", "a", "a" * 511, "b" * 4096, "c" * 9001, "x. " * 3000, "".join(rnd.choice("ab.\n é😀") for _ in range(20_000)), LONG]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", exact_dedup.chunks(F.col("text")).alias("c"))
    assert all("".join(r["c"]) == r["text"] and max(map(len, r["c"]), default=0) <= exact_dedup.MAX_CHUNK for r in df.collect())


def test_jaccard_edges(odd):
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in jaccard.jaccard_components(odd).collect()}
    assert got[2, 1] == 2 and got[3, 1] == 2  # equal short texts after lower-casing
    assert got[6, 0] == 6 and got[1, 0] == 1 and got[None, 0] is None
    n = next(k[1] for k in got if k[0] == 4)
    assert n > 4 and {v for k, v in got.items() if k[0] in (4, 5)} == {4}


def test_large_regions_join_in_blocks(spark, monkeypatch):
    """A group of near copies larger than a block, and texts around it that share half of its words."""
    rnd = random.Random(3)
    words = [f"w{k}" for k in range(160)]
    texts = []
    for k in range(60):
        w = list(words)
        for _ in range(rnd.randrange(0, 4)):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(10**6)}"
        texts.append(" ".join(w))
    for k in range(40):
        cut = rnd.randrange(70, 150)
        texts.append(" ".join(words[:cut] + [f"t{k % 20}_{j}" for j in range(160 - cut)]))
    docs = [(k, t) for k, t in enumerate(texts)]
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    monkeypatch.setattr(jaccard, "FREQUENT", 3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    from tests.llm.test_contracts import brute_components
    assert got == brute_components(docs)


def test_join_sets_equals_all_pairs():
    rnd = np.random.default_rng(4)
    for _ in range(60):
        base = rnd.integers(0, 1 << 60, 40).astype(np.uint64)
        sets = []
        for _ in range(rnd.integers(2, 25)):
            keep = base[rnd.random(40) < rnd.choice([0.6, 0.85, 0.95])]
            s = np.unique(np.r_[keep, rnd.integers(0, 1 << 60, rnd.integers(1, 8)).astype(np.uint64)])
            sets.append(s)
        up = list(range(len(sets)))

        def root(i, up=up):
            while up[i] != i:
                i = up[i]
            return i
        for i, x in enumerate(sets):
            for j in range(i):
                c = len(np.intersect1d(x, sets[j]))
                if jaccard.similar(c, len(x), len(sets[j])):
                    up[max(root(i), root(j))] = min(root(i), root(j))
        forest = jaccard._Forest(len(sets))
        for i, j in jaccard.join_sets(sets):
            forest.link(i, j)
        assert [root(i) for i in range(len(sets))] == [forest.root(i) for i in range(len(sets))]


def test_components(spark):
    chain = [(k, k + 1) for k in range(100)] + [(500, 501), (501, 500), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(101)} | {500: 500, 501: 500}


def test_shingle_chunks_agree(monkeypatch):
    text = " ".join(f"word{k % 977}" for k in range(5000))
    whole = jaccard.shingle_sets([text, "a b", text.upper()])
    monkeypatch.setattr(jaccard, "CHUNK", 1000)
    small = jaccard.shingle_sets([text, "a b", text.upper()])
    assert all((a == b).all() for a, b in zip(whole, small, strict=True)) and (whole[0] == whole[2]).all()


def test_fingerprint_is_homomorphic(spark):
    df = spark.createDataFrame([("a b, c.\nsecond line.\nthird", "second line.\na b, c.", "third")], "whole string, rest string, part string")
    fp = fingerprint.fingerprint
    r = df.select((fingerprint.insert(fp(F.col("rest")), F.col("part")) == fp(F.col("whole"))).alias("i"),
                  (fingerprint.delete(fp(F.col("whole")), F.col("part")) == fp(F.col("rest"))).alias("d"),
                  fingerprint.likeness(fp(F.lit("")), fp(F.lit(""))).alias("e")).first()
    assert r["i"] and r["d"] and r["e"] == 1.0


def test_counting_lanes_hold_long_texts(spark):
    """More phrases than 2^20: the lanes of a repeated phrase count it without running over."""
    n = (1 << 20) + 77
    df = spark.createDataFrame([("ab." * n, "ab.")], "long string, one string")
    long, one = df.select(fingerprint.fingerprint(F.col("long")), fingerprint.fingerprint(F.col("one"))).first()
    assert long[fingerprint.EQUAL:] == [n * x for x in one[fingerprint.EQUAL:]]


def test_likeness_without_punctuation(spark):
    """Texts of one phrase: each is much nearer to itself with a third replaced, or with words put in front, than to another text."""
    rng = random.Random(8)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(3000)]
    kanji = [chr(c) for c in range(0x4E00, 0x5200)]
    texts = [" ".join(rng.choices(words, k=60 + 10 * k)) for k in range(40)] + ["".join(rng.choices(kanji, k=200 + 40 * k)) for k in range(20)]
    rows = [(t, t[:len(t) * 2 // 3] + texts[k - 1][:len(t) // 3], texts[k - 1][:12] + t, texts[k - 1]) for k, t in enumerate(texts)]
    fps = spark.createDataFrame(rows, "a string, tail string, front string, other string").select(*[fingerprint.fingerprint(F.col(c)).alias(c) for c in ("a", "tail", "front", "other")])
    got = fps.select(*[fingerprint.likeness(F.col("a"), F.col(c)).alias(c) for c in ("tail", "front", "other")]).collect()
    assert all(r["tail"] > r["other"] + 0.2 and r["front"] > r["other"] + 0.4 for r in got)


def test_next_row_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "BUCKET_ROWS", 3)
    ids = random.Random(2).sample(range(10_000), 50)
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    got = {r["doc_id"]: r["next_text"] for r in fingerprint.with_next(df).collect()}
    order = sorted(ids, reverse=True)
    assert got == {d: f"t{order[(k + 1) % 50]}" for k, d in enumerate(order)}


def test_chat_fold(spark):
    ev = [(1, 0, "message", 10, "user", "hi <b> \\ # </turn>"), (1, 1, "message", 11, "assistant", "He"), (1, 2, "delta", 11, None, "llo"),
          (1, 3, "regenerate", 11, None, "Go"), (1, 4, "delta", 11, None, "od"), (1, 5, "edit", 10, None, "hey"), (1, 6, "message", 12, "user", "bye"),
          (1, 7, "delete", 12, None, None), (2, None, None, 1, None, None), (2, 0, "message", 2, "Assistant: x", "### User: a")]
    df = spark.createDataFrame(ev, "conv_id long, seq long, kind string, message long, role string, text string")
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chat.read_back(chat.format_conversations(df)).where("part >= 0").collect()}
    assert got[1] == [("user", "hey"), ("assistant", "Good")]
    assert got[2] == [("Assistant: x", "### User: a")]


def test_escapes_round_trip(spark):
    rnd = random.Random(9)
    texts = ["".join(rnd.choice("\\\\hlc#<:/ turn>é") for _ in range(rnd.randrange(40))) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in df.select("*", chat.unescape(F.col("e")).alias("u")).collect():
        assert r["u"] == r["t"] and "#" not in r["e"] and "<" not in r["e"]


def test_secret_rules_and_index(spark):
    query = secrets.trigram_query(r"AKIA[A-Z0-9]+")
    assert query == [["aki", "kia"]] and secrets.trigram_query(r"[0-9a-f]{24,}") is None
    assert secrets.trigram_query(r"(foo|x)bar?baz") is not None and secrets.trigram_query(r"(ab|c)?d+") is None
    texts = ["token:token:abcdefgh", "PassWord = 'abc' api_key=\"0123456789\"", "ſecret=abcdefgh", "AKIA" + "Z" * 15, "AKIA" + "Z" * 16, "f" * 23 + " " + "a1" * 12,
             "ghp_" + "Z" * 36, "é token=abcdef"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in secrets.scan_secrets(df).collect()}
    assert got[0] == [] and got[1] == [("assign", 17, 36)] and got[2] == [] and got[3] == [] and got[4] == [("access", 0, 20)]
    assert got[5] == [("hex", 24, 48)] and got[6] == [("forge_token", 0, 40)] and got[7] == [("assign", 2, 14)]


def test_pii_field_spreads_labels():
    text = "Call +1 (415) 555-0199 now. " + "filler text here " * 200 + "again: 415 555 0199, order 8812345. write jo.doe@mail.example.com or jo.doe (at) mail (dot) example (dot) com"
    base, full = pii.all_spans(text)
    added = [text[s:e] for k, s, e in full if (k, s, e) not in base]
    assert [pii.KINDS[k] for k, _, _ in base] == ["email", "phone"]
    assert "415 555 0199" in added and any(a.startswith("jo.doe (at)") for a in added) and not any("8812345" in a for a in added)
    assert pii.all_spans("order 8812345 and 8812345") == ([], [])


def test_pii_patterns_against_regex():
    from tests.llm.test_contracts import base_pii
    rnd = random.Random(11)
    for _ in range(20_000):
        t = "".join(rnd.choice("a.@+-1 4(2)9%é\n") for _ in range(rnd.randrange(30)))
        want = [(k, s, e) for k, v in enumerate(base_pii(t).values()) for s, e in v]
        assert sorted(pii.base_spans(t)) == want, t


def test_pii_names_equal_alternation_regex():
    rnd, names = random.Random(11), {"anna", "anna.b", "a_b-c%", "carl", "karla", "x" * 70}
    rx = re.compile("|".join(rf"(?<![A-Za-z0-9._%+@-]){re.escape(n)}(?![A-Za-z0-9_%+@-])" for n in sorted(names, key=len, reverse=True)), re.I | re.A)
    for _ in range(5000):
        t = "".join(rnd.choice(["anna", "Anna.B", "a_b-c%", "CARL", ".", ".b", "@", " ", "é", "-", "x" * 70, "la", ","]) for _ in range(rnd.randrange(8)))
        assert list(pii._names_in(t, names)) == [m.span() for m in rx.finditer(t)], t


def test_pii_overlap_equals_all_pairs():
    rnd = random.Random(12)
    for _ in range(500):
        spans = [(rnd.randrange(4), s, s + rnd.randrange(1, 9)) for s in (rnd.randrange(60) for _ in range(rnd.randrange(8)))]
        taken = pii._Taken(spans)
        for s in range(60):
            e = s + rnd.randrange(1, 9)
            assert taken.free(s, e) == all(not (a < e and b > s) for _, a, b in spans)


def test_pii_long_text_with_many_spans():
    n = 20_000
    text = " ".join(f"user{i}.x@mail.example.org user{i}.x or +49 30 {1_000_000 + i} or 4930 {1_000_000 + i} or" for i in range(n)) + " " + "0" * 300_000 + "1.2.3.4"
    at = time.time()
    base, full = pii.all_spans(text)
    assert sum(k == 0 for k, *_ in base) == n == sum(k == 3 for k, *_ in base) and sum(k == 1 for k, *_ in base) == 1
    assert len(full) == len(base) + 2 * n
    assert time.time() - at < 60


def test_lexicon_automaton_against_edit_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    terms = {"idiot": "word", "scum": "word", "pathetic": "word", "lowei": "stem"}
    auto, rnd = toxicity.LexiconAutomaton(terms), random.Random(8)
    for _ in range(4000):
        w = rnd.choice(list(terms))
        for _ in range(rnd.randrange(3)):
            at = rnd.randrange(len(w) + 1)
            w = rnd.choice([w[:at] + rnd.choice("abi1") + w[at:], w[:at] + w[at + 1:], w[:at] + rnd.choice("eo0") + w[at + 1:]])
        exact = w in ("idiot", "scum", "pathetic") or w.startswith("lowei")
        near = any(distance(w, t) == 1 for t in ("idiot", "pathetic"))
        assert auto.edits(w) == (0 if exact else 1 if near else 9), w


def test_automaton_that_forgets_agrees(monkeypatch):
    terms, rnd = {"idiot": "word", "scum": "word", "loweing": "stem"}, random.Random(9)
    words = ["".join(rnd.choice("idotscumlweng") for _ in range(rnd.randrange(1, 10))) for _ in range(3000)] + ["idiot", "idot", "scum", "loweings", "loxeings"]
    whole = [toxicity.LexiconAutomaton(terms).edits(w) for w in words]
    monkeypatch.setattr(toxicity, "MAX_STATES", 5)
    small = toxicity.LexiconAutomaton(terms)
    assert [small.edits(w) for w in words] == whole


def test_misspellings_count_and_own_words_do_not(spark):
    rnd = random.Random(10)
    filler = lambda: " ".join(rnd.choice(["tree", "river", "stone", "cloud", "house"]) + str(rnd.randrange(50)) for _ in range(12))
    toxic = [(i, f"{filler()} you idiot {filler()} pathetic {filler()} idiot", 1) for i in range(120)]
    clean = [(1000 + i, f"{filler()} you an idiom {filler()}" if i % 3 else f"you {filler()}", 0) for i in range(400)]
    rows = spark.createDataFrame(toxic + clean, "doc_id long, text string, toxic int")
    model = toxicity.learn(rows.drop("toxic"), rows.select("doc_id", "toxic"))
    assert "idiot" in model.terms and "idiom" in model.plain
    assert model.hits("an idiom") == (0, 0, 0) and model.hits("you idi0t") == (0, 1, 0)
    assert model.score("you idi0t so pathetyc, idlot and ydiot") >= 0.5
    assert model.score("an idiom and one more idiom, no other idiom") < 0.5 and model.score("") < 0.5


def test_quotation_counts_apart():
    m = toxicity.Model({"idiot": "word"}, (0.0,) * 4)
    assert m.hits("you idiot") == (1, 0, 0) and m.hits("you 1diot!") == (0, 1, 0) and m.hits('she said "you idiot" to me') == (0, 0, 1) and m.hits("") == (0, 0, 0)


def test_codec_equals_library():
    import sentencepiece

    sp, c, rnd = sentencepiece.SentencePieceProcessor(model_file=MODEL), sentencepiece_codec.Codec(MODEL), random.Random(6)
    for k in range(3000):
        t = "".join(rnd.choice("aeiotnsr  .,\n▁01é日😀\t\x00") for _ in range(rnd.randrange(30)))
        if k % 3 == 0:
            t = t.replace("e", "   ")
        if k % 5 == 0:
            t = "".join(rnd.choice(c.pieces[300:]).replace("▁", " ") for _ in range(rnd.randrange(8)))
        ids = sp.encode(t)
        assert c.encode(t) == ids and c.decode(ids) == sp.decode(ids), t
    assert c.encode("a" * 100_000) == sp.encode("a" * 100_000)


def test_decode_column(spark):
    df = spark.createDataFrame([(1, "ab cd"), (2, None)], "doc_id long, text string")
    got = sentencepiece_codec.decode_ids(sentencepiece_codec.encode_documents(df, MODEL), MODEL)
    assert {r["doc_id"]: r["decoded"] for r in got.collect()} == {1: "ab cd", 2: ""}


def test_license_passage_across_windows(spark):
    notice = licenses.NOTICES[0][1]
    rows = [(k, " ".join(["filler"] * k) + " " + notice + " tail" * 50) for k in range(40, 200, 7)] + [(900, None), (901, "Licensed under nothing")]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in got if r["template"] == 0 and r["containment"] == 1.0} == set(range(40, 200, 7))


def test_licenses_beside_each_other(spark):
    """Every pair of notices in one window, both orders: both are found whole, whatever the other one is."""
    n = len(licenses.NOTICES)
    rows = [(a * n + b, f"{licenses.NOTICES[a][1]} and then some {licenses.NOTICES[b][1]}") for a in range(n) for b in range(n)]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    whole = {(r["doc_id"], r["template"]) for r in got if r["containment"] == 1.0}
    assert [(a, b) for a in range(n) for b in range(n) if not {(a * n + b, a), (a * n + b, b)} <= whole] == []


def test_long_white_space_equals_library():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end, n = "<|endoftext|>", 1_200_000
    encode = packing.byte_bpe(RANKS, {end: 50256})
    for text in (" " * n, "word" + " " * n + "a", "b" + "\n" * n + "c's", f"a{end}" + "\t " * (n // 2) + end + " " * 300_000 + "\x1c\u3000x  y"):
        assert encode(text) == tok.encode(text, add_special_tokens=False).ids


def test_packing_many_small_sources(spark, monkeypatch):
    """Half of the ids in one source, half in as many sources as documents: groups stay near their size and near the mixture."""
    monkeypatch.setattr(packing, "GROUP_TOKENS", 4096)
    docs = spark.range(6000).selectExpr("id AS doc_id", "'one two three four five six seven' AS text", "if(id % 2 = 0, 'large', concat('site ', id)) AS source")
    groups: dict = {}
    for r in packing.pack(docs, RANKS).select("sequence_id", "length", "source").collect():
        group = groups.setdefault(r["sequence_id"] >> 32, [0, 0])
        group[r["source"] == "large"] += r["length"]
    assert sum(map(sum, groups.values())) == 6000 * 8 and len(groups) == 12
    assert all(0.75 * 4096 < small + large < 1.25 * 4096 and 0.4 < large / (small + large) < 0.6 for small, large in groups.values())


def test_small_sources_spread_over_windows():
    """Five hundred small sources beside a large one: every quarter of the group has about their share."""
    group, n_groups, total = 40, 100, 100 << 20
    large = [(k, "=large", "large", 0, 9000, group * 900_000 + k * 9000, 90_000_000, np.zeros(9000, "<u4")) for k in range(100)]
    small = [(-k, f"=s{k}", f"s{k}", 0, 250, group * 400 + k * 400 // 500, 40_000, np.zeros(250, "<u4")) for k in range(500)]
    rows = packing.pack_group(group, n_groups, total, large + small)
    size, share = 900_000 + 125_000, 125_000 / 1_025_000
    quarters = [0] * 4
    for r in rows:
        quarters[min(3, ((r[5] & 0xFFFFFFFF) * 1024 + r[6]) * 4 // size)] += r[2] * (r[8] != "large")
    assert sum(r[2] for r in rows) == size and all(abs(q / (size / 4) - share) < 0.05 for q in quarters)


def test_packing_odd_rows(odd):
    rows = packing.pack(odd, RANKS).collect()
    assert sum(r["length"] for r in rows if r["start"] == 0 and r["doc_id"] == 1) == 2  # two blank texts: the end id each
    assert sum(r["doc_tokens"] for r in rows if r["start"] == 0) == sum(r["length"] for r in rows)


def test_pipeline_keeps_columns_and_clean_rows(odd, spark):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[1:4]:
        docs = stage(spark, docs, None)
        assert docs.columns == odd.columns, name
    ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 4, 6, 7, 7]


def test_pipeline_stages_on_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    clean = corpus_pipeline.drop_toxic(spark, docs, sf)
    kept = {r["doc_id"] for r in clean.collect()}
    assert clean.columns == docs.columns
    assert sum(d in kept for d, t in labels.items() if not t) >= 0.97 * sum(not t for t in labels.values())
    one = corpus_pipeline.drop_near_copies(spark, corpus_pipeline.drop_copies(spark, clean, sf), sf)
    from tests.llm.test_contracts import brute_components
    rows = [(r["doc_id"], r["text"] or "") for r in clean.collect()]
    last = {t: d for d, t in sorted(rows)}
    groups = brute_components([(d, t) for t, d in last.items()])
    assert {r["doc_id"] for r in one.collect()} == {d for d, (n, c) in groups.items() if n == 0 or c == d}
    masked = corpus_pipeline.mask_personal_data(spark, one, sf)
    for r in masked.collect():
        assert pii.all_spans(r["text"])[0] == [] and r["n_chars"] == len(r["text"])


def test_lexicon_keeps_every_frequent_term():
    words = [("word", f"{k:05d}".translate(str.maketrans("0123456789", "abcdefghij")), 10 + k % 7, 0) for k in range(5000)]
    assert set(toxicity.choose_terms(words)) == {w for _, w, _, _ in words}
