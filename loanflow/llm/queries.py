"""Registered queries of the operators, and DuckDB SQL where it can express one."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanflow.llm.common import id_and_text, table

REGISTRY: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


#: Conversation -7 of the contract of op1: both rows say this.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


@query("op1_chat_formatting")
def op1(spark, sf_dir):
    from loanflow.llm import chat

    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long").alias("seq"), "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("seq"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    events = rows.unionByName(extra).withColumns({"kind": F.lit("message"), "message": F.monotonically_increasing_id()})
    parts = chat.read_back(chat.format_conversations(events))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    whole = chat.join_parts(parts, turns_text=turns, loss_text=F.col("loss_text"), formatted=F.col("formatted"))
    return whole.select(
        "conv_id", "n_turns", F.sha2("turns_text", 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


@query("op9_exact_dedup")
def op9(spark, sf_dir):
    from loanflow.llm.exact_dedup import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLES["op9_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


@query("op10_fingerprints")
def op10(spark, sf_dir):
    from loanflow.llm import fingerprint as fp

    docs = fp.fingerprint_documents(table(spark, sf_dir, "documents"))
    rows = fp.with_next(docs, "fp").withColumn("n_chars", F.length("text"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars") - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    rows = rows.withColumn("edited", edited).withColumn("edited_fp", fp.fingerprint(F.col("edited")))
    return rows.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fp.as_hex(F.col("fp")).alias("fingerprint"), fp.as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
        fp.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        fp.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))


@query("op2_secret_scan")
def op2(spark, sf_dir):
    from loanflow.llm import secrets
    from loanflow.llm.spans import digest_text

    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    base = {r.kind for r in secrets.RULES if r.base}
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[n(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(digest_text(F.filter("spans", lambda s: s["kind"].isin(*base))), 256).alias("base_sha256"),
        digest_text(F.col("spans")).alias("spans"))


@query("op3_license_scan")
def op3(spark, sf_dir):
    from loanflow.llm.licenses import TEMPLATES, scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"), TEMPLATES)


#: The byte-level BPE vocabulary of op5, and the one string that it treats as a special token.
BYTE_BPE = "byte_bpe_50k.tiktoken"
BYTE_BPE_SPECIAL = {"<|endoftext|>": 50256}


@query("op5_packing")
def op5(spark, sf_dir):
    import public_tokenizers

    from loanflow.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), BYTE_BPE_SPECIAL).drop("ids", "source")


@query("op8_sentencepiece")
def op8(spark, sf_dir):
    import public_tokenizers

    from loanflow.llm.sentencepiece_codec import encode_documents

    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)


@query("op6_pii")
def op6(spark, sf_dir):
    from loanflow.llm.pii import KINDS, find_pii
    from loanflow.llm.spans import digest_text

    found = find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    n = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[n(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(digest_text(base), 256).alias("base_sha256"), digest_text(F.col("spans")).alias("spans"))


@query("op7_toxicity")
def op7(spark, sf_dir):
    from loanflow.llm import toxicity

    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op4_ngram_jaccard_join")
def op4(spark, sf_dir):
    from loanflow.llm.jaccard import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op11_decontamination")
def op11(spark, sf_dir):
    from loanflow.llm.decontamination import decontaminate

    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("item_ids")


ORACLES["op11_decontamination"] = r"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, len(w[i:i + 9]) AS m, array_to_string(w[i:i + 9], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT m FROM item_windows
), doc_windows AS (
  SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM docs, lengths WHERE len(w) >= m)
), found AS MATERIALIZED (
  SELECT DISTINCT r, d.m AS m, i, item_id FROM doc_windows d JOIN item_windows b ON b.m = d.m AND b.phrase = d.phrase
), hits AS (
  SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS pos FROM found) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS item_list
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(item_list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""


@query("op12_whitening")
def op12(spark, sf_dir):
    from loanflow.llm.whitening import whiten_embeddings

    return whiten_embeddings(table(spark, sf_dir, "embeddings"))[0]


@query("op13_vector_codes")
def op13(spark, sf_dir):
    from loanflow.llm.vector_codes import compress

    coded, books = compress(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.sha256() if books else "").alias("codebooks_sha256"))


def _codes_sql(scale: int = 4096, parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """SQL of op13: the rounds written out one after another."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""near{i} AS MATERIALIZED (
  SELECT r, p, e, d FROM (
    SELECT c.r, c.p, b.e, sum((c.v - b.v) * (c.v - b.v)) AS d FROM comp c JOIN book{i} b ON b.p = c.p AND b.j = c.j GROUP BY c.r, c.p, b.e)
  QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1)""")
        if i < rounds:
            steps.append(f"""book{i + 1} AS MATERIALIZED (
  SELECT b.p, b.e, b.j, coalesce((s - ((s % n) + n) % n) // n, b.v) AS v FROM book{i} b LEFT JOIN (
    SELECT p, e, j, sum(v) AS s, count(*) AS n FROM near{i} JOIN comp USING (r, p) GROUP BY p, e, j) m USING (p, e, j))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, x) AS r, * FROM (
    SELECT vec_id, label, [CAST(floor({scale} * CAST(c AS DOUBLE)) AS BIGINT) for c in embedding] AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len([c for c in embedding if c IS NULL OR NOT isfinite(c)]) = 0)
), comp AS MATERIALIZED (
  SELECT r, (i - 1) // (len(x) // {parts}) AS p, (i - 1) % (len(x) // {parts}) AS j, x[i] AS v
  FROM (SELECT r, x, unnest(range(1, len(x) + 1)) AS i FROM kept)
), book0 AS MATERIALIZED (SELECT p, r - 1 AS e, j, v FROM comp WHERE r <= {entries}
), {", ".join(steps)}, coded AS (
  SELECT r, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, e, j)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (r)
"""


ORACLES["op13_vector_codes"] = _codes_sql()


ORACLES["op4_ngram_jaccard_join"] = r"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                             '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)
), sets AS MATERIALIZED (
  SELECT r, count(*) AS n, md5(string_agg(shingle, chr(10) ORDER BY shingle)) AS name FROM shingles GROUP BY r
), classes AS MATERIALIZED (SELECT name, min(r) AS c, any_value(n) AS n, min(doc_id) AS least FROM sets JOIN docs USING (r) GROUP BY name
), own AS MATERIALIZED (SELECT c, n, shingle FROM classes JOIN shingles ON r = c
), links AS MATERIALIZED (
  SELECT a.c AS a, b.c AS b FROM own a JOIN own b ON a.shingle = b.shingle AND a.c < b.c
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(c, d) AS (
  SELECT c, c FROM classes UNION SELECT reach.c, edges.b FROM reach JOIN edges ON edges.a = reach.d
), roots AS (SELECT reach.c, min(least) AS root FROM reach JOIN classes ON classes.c = reach.d GROUP BY reach.c)
SELECT doc_id, coalesce(sets.n, 0) AS n_shingles, CASE WHEN sets.r IS NULL THEN doc_id ELSE root END AS component_id
FROM docs LEFT JOIN sets USING (r) LEFT JOIN classes USING (name) LEFT JOIN roots USING (c)
"""


ORACLES["op1_chat_formatting"] = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '{CONTROL_TEXT}'), (-7, 1, 'assistant', '{CONTROL_TEXT}')) AS v(conv_id, turn, role, text)
), turns AS (
  SELECT *, lower(role) = 'assistant' AS loss,
         length('### : </turn>') + 2 + length(role) + length(text) + length(regexp_replace(role || text, '[^\\\\#<:]', '', 'g')) AS chars
  FROM said
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (loss), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (loss), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""
