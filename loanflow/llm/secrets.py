"""Secret scans through a trigram inverted index, in DataFrame expressions only.

1. From each rule's regex a Boolean query over trigrams is derived (``trigram_query``): an
   OR of ANDs that every text with a match satisfies.  Letters count in lower case.
2. The index has, for every block of texts and every trigram of some query, the posting list of the
   texts that hold the trigram.  Texts are named by a digest, so copies share a posting.
3. A rule's candidates are the intersections (AND) and unions (OR) of posting lists, block by block.
4. Candidates are verified with the regex over the whole text.  Rules that have no
   mandatory trigram scan every text.

Cases: a null text is empty; every input row gives one output row, copies and repeated
rows too; null ids stay; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as sre  # the parser of the standard library
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanflow.llm.common import id_and_text
from loanflow.llm.spans import SPAN, spans


@dataclass(frozen=True)
class Rule:
    """``least``: characters that the match (or ``group`` of it) must have."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


#: The base kinds, then the kinds that this scan adds.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, True),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
)
#: Texts per block of the index.
BLOCK_TEXTS = 4096
#: Alternatives that a derived query may have before the rule counts as one without mandatory trigrams.
MAX_WORDS = 64


def mandatory_words(pattern: str) -> list[frozenset[str]]:
    """Sets of lower-case words; every match of ``pattern`` holds all words of at least one set."""
    def walk(nodes) -> list[tuple[tuple[str, ...], str]]:
        # alternatives of (finished words, the word still being read)
        alts: list[tuple[tuple[str, ...], str]] = [((), "")]

        def cut() -> None:
            nonlocal alts
            alts = [((*done, word) if word else done, "") for done, word in alts]

        def append(options) -> None:
            nonlocal alts
            alts = [((*done, *more[:-1]), word + more[-1]) if len(more) == 1 else ((*done, word + more[0], *more[1:-1]), more[-1])
                    for done, word in alts for more in options]

        for op, arg in nodes:
            if op is sre.LITERAL:
                append([(chr(arg).lower(),)])
            elif op is sre.IN and all(k is sre.LITERAL for k, _ in arg) and len(alts) * len(arg) <= MAX_WORDS:
                append([(chr(v).lower(),) for _, v in arg])
            elif op is sre.SUBPATTERN:
                append_inner(append, cut, walk(arg[3]))
            elif op is sre.BRANCH:
                append_inner(append, cut, [a for branch in arg[1] for a in walk(branch)])
            elif op is sre.MAX_REPEAT and arg[0] == 0 and arg[1] == 1 and len(alts) <= MAX_WORDS // 2 and all(k is sre.LITERAL for k, _ in arg[2]):
                append([("",), ("".join(chr(v).lower() for _, v in arg[2]),)])
            elif op is sre.MAX_REPEAT and arg[0] >= 1:
                cut()
                append_inner(append, cut, walk(arg[2]))
                cut()
            elif op is not sre.AT:
                cut()
            if len(alts) > MAX_WORDS:
                return [((), "")]
        return alts

    def append_inner(append, cut, inner) -> None:
        if all(not done for done, _ in inner):  # words only: they go on with what follows
            append([(word,) for _, word in inner])
        else:
            append([("", *done, word) if done else (word,) for done, word in inner])

    return [frozenset(w for w in (*done, word) if w) for done, word in walk(_parser.parse(pattern))]


def trigram_query(pattern: str) -> list[list[str]] | None:
    """An OR of ANDs of trigrams, or None if some match may have no mandatory trigram."""
    query = [sorted({w[i:i + 3] for w in words for i in range(len(w) - 2)}) for words in mandatory_words(pattern)]
    if not all(query):
        return None
    return [list(q) for q in sorted({tuple(q) for q in query})]


def trigram_index(docs: DataFrame, trigrams: list[str], n_blocks: int) -> DataFrame:
    """(block, postings): for each block of texts, trigram -> digests of the texts that hold it.  Trigrams that a block lacks are absent."""
    lower = docs.select("digest", F.lower("text").alias("lower"))
    held = F.array_compact(F.array(*[F.when(F.contains("lower", F.lit(t)), F.lit(t)) for t in trigrams]))
    posting = lower.select("digest", F.explode(held).alias("trigram")).distinct()
    block = F.pmod(F.xxhash64("digest"), F.lit(n_blocks))
    lists = posting.groupBy(block.alias("block"), "trigram").agg(F.collect_list("digest").alias("digests"))
    return lists.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "digests"))).alias("postings"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(digest, rules): for each candidate text the bits of the rules whose query its trigrams satisfy."""
    empty = F.array().cast("array<binary>")
    posting = lambda t: F.coalesce(F.try_element_at("postings", F.lit(t)), empty)
    found = []
    for k, rule in enumerate(rules):
        query = trigram_query(rule.pattern)
        if query is None:
            continue
        union = empty
        for clause in query:
            both = posting(clause[0])
            for t in clause[1:]:
                both = F.array_intersect(both, posting(t))
            union = F.array_union(union, both)
        found.append(F.transform(union, lambda d: F.struct(d.alias("digest"), F.lit(1 << k).alias("bit"))))  # noqa: B023  applied at once
    if not found:
        return index.select(F.lit(None).cast("binary").alias("digest"), F.lit(0).alias("rules")).limit(0)
    return index.select(F.explode(F.concat(*found)).alias("c")).groupBy("c.digest").agg(F.bit_or("c.bit").alias("rules"))


def verified(text: Column, rule: Rule, order: int) -> Column:
    return F.filter(spans(text, rule.pattern, rule.kind, order, rule.group), lambda s: F.length(s["group"]) >= rule.least)


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, text, spans (start, end, kind, order of the rule, group), by start, then rule."""
    docs = id_and_text(docs, id_col, text_col).withColumn("digest", F.unhex(F.md5("text")))
    queries = [trigram_query(r.pattern) for r in rules]
    trigrams = sorted({t for q in queries if q for clause in q for t in clause})
    n_blocks = max(1, -(-docs.count() // BLOCK_TEXTS))
    hits = candidates(trigram_index(docs, trigrams, n_blocks), rules)
    none = F.array().cast(SPAN)
    bits = F.coalesce("rules", F.lit(0))
    per_rule = [verified(F.col("text"), r, k) if queries[k] is None
                else F.when(bits.bitwiseAND(F.lit(1 << k)) != 0, verified(F.col("text"), r, k)).otherwise(none)
                for k, r in enumerate(rules)]
    rows = docs.join(hits, "digest", "left")
    by_start = lambda s: F.struct(s["start"], s["order"], s["end"], s["kind"], s["group"])
    return rows.select("doc_id", "text", F.array_sort(F.transform(F.concat(*per_rule), by_start)).alias("spans"))


