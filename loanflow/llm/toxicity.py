"""Toxicity: a learned lexicon, its trie intersected with Levenshtein automata, and scores from context windows.

Learning, from a bounded sample of labelled rows (``LABELLED_ROWS``, those with the smallest hashes of their ids):
words and word beginnings that many different toxic texts have and hardly any clean one
become the lexicon, all of them: a term stands in ``LEAST_SHARE`` of the sample's toxic texts or more, so there are at most
their mean number of different words and beginnings, divided by that share.  Texts count by the MinHash of their three-word shingles, so a group of copies counts about once.

Scoring: each word of a text runs through the lexicon automaton, the product of the terms' trie with a
Levenshtein automaton (one insertion, deletion or substitution for terms long enough), built state by
state as words need it.  A hit inside quotation marks, or next to words of reporting, within its
context window counts as quotation.  A logistic function of the log counts of open and quoted
hits, fitted on the same sample, gives the score; labels, language, source and id are no inputs.
A misspelled hit counts ``MISSPELLED`` of an exact one.  Words of clean sample texts that are one edit from a
term, and not much likelier in toxic texts, are words of their own and no misspellings.

Cases: null text is empty and gets the score of no hits; rows come back one for one, null ids and copies too;
without labels of both kinds the score is the (smoothed) share of toxic labels; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanflow.llm.common import id_and_text, sliced, staged

LABELLED_ROWS = 20_000
STEM = (4, 8)
LEAST_TEXTS = 8
LEAST_SHARE = 0.005
LIFT = 25.0
ONE_EDIT = {"word": 5, "stem": 7}
CONTEXT = 40
MISSPELLED = 0.5
#: What a worker remembers: words, and states of the automaton; beyond that it starts again.
MEMO_WORDS = 1 << 16
MAX_STATES = 1 << 14
#: Marks that open or close a quotation, and words that report one.
QUOTES = "\"“”„«»‹›「」"
REPORTING = ("said", "says", "called", "wrote", "quoted", "quote", "sagte", "nannte", "zitat", "dit", "appelé", "citation", "dijo", "llamó", "cita")
EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + QUOTES + "¡¿…–—"


class LexiconAutomaton:
    """Deterministic automaton over the terms' trie within one edit; states are made when first reached."""

    def __init__(self, terms: dict[str, str]):
        self.children: list[dict[str, int]] = [{}]
        self.word_end: list[int] = [0]  # 0: no term; 1: a term; 2: a term that one edit may reach
        self.stem_end: list[int] = [0]
        for term, kind in terms.items():
            node = 0
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.word_end.append(0)
                    self.stem_end.append(0)
                node = self.children[node][c]
            ends = self.word_end if kind == "word" else self.stem_end
            ends[node] = 2 if len(term) >= ONE_EDIT[kind] else 1
        self._forget()

    def _forget(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.members: list[frozenset] = []
        self.accepts: list[tuple[int, int]] = []  # edits by which a word may end here, and by which a stem has been read (9: none)
        self.moves: list[dict[str, int]] = []
        self.start = self._state({(0, 0)})

    def _state(self, nodes: set[tuple[int, int]]) -> int:
        todo = list(nodes)
        while todo:  # deletions: the word lacks a letter of the term
            node, edits = todo.pop()
            if edits == 0:
                for child in self.children[node].values():
                    if (child, 1) not in nodes:
                        nodes.add((child, 1))
        nodes = {(n, e) for n, e in nodes if e == 0 or (n, 0) not in nodes}
        key = frozenset(nodes)
        if key not in self.states:
            self.states[key] = len(self.members)
            self.members.append(key)
            best = lambda ends: min((e for n, e in key if ends[n] and (e == 0 or ends[n] == 2)), default=9)
            self.accepts.append((best(self.word_end), best(self.stem_end)))
            self.moves.append({})
        return self.states[key]

    def _move(self, state: int, c: str) -> int:
        nodes: set[tuple[int, int]] = set()
        for node, edits in self.members[state]:
            if (child := self.children[node].get(c)) is not None:
                nodes.add((child, edits))
            if edits == 0:
                nodes.add((node, 1))
                nodes.update((child, 1) for child in self.children[node].values())
        to = self.moves[state][c] = self._state(nodes) if nodes else -1
        return to

    def edits(self, word: str) -> int:
        """0 or 1: edits from the nearest term that the word is, or that it begins with (a stem); 9: none is near."""
        if len(self.members) > MAX_STATES:
            self._forget()
        state, best = self.start, 9
        for c in word:
            to = self.moves[state].get(c)
            state = self._move(state, c) if to is None else to
            if state < 0:
                return best
            if (e := self.accepts[state][1]) < best:
                best = e
                if best == 0:
                    return 0
        return min(best, self.accepts[state][0])


@dataclass
class Model:
    terms: dict[str, str] = field(default_factory=dict)
    weights: tuple[float, ...] = (0.0, 0.0, 0.0)  # of 1, open hits, quoted hits
    plain: frozenset[str] = frozenset()  # words of their own beside a term

    def __post_init__(self):
        self.automaton: LexiconAutomaton | None = None
        self.memo: dict[str, int] = {}

    def __getstate__(self):
        return {"terms": self.terms, "weights": self.weights, "plain": self.plain, "automaton": None, "memo": {}}

    def hits(self, text: str) -> tuple[int, int, int]:
        """How many exact, misspelled and quoted terms a text has."""
        if self.automaton is None:
            self.automaton = LexiconAutomaton(self.terms)
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        memo, low = self.memo, text.lower()
        words = low.split()
        for w in set(words).difference(memo):
            bare = w.strip(EDGE)
            memo[w] = 9 if bare in self.plain else self.automaton.edits(bare)
        found = [(k, e) for k, w in enumerate(words) if (e := memo[w]) < 9]
        if not found:
            return 0, 0, 0
        counts, places, at = [0, 0, 0], {}, 0
        wanted = {k for k, _ in found}
        for k, w in enumerate(words):  # places of the hits, in one pass over the text
            if k in wanted:
                at = low.index(w, at)
                places[k] = at
                at += len(w)
            elif k + 1 in wanted:
                at = low.index(w, at) + len(w)
        for k, e in found:
            counts[2 if self._quoted(low, words, k, places[k]) else e] += 1
        return tuple(counts)

    @staticmethod
    def _quoted(text: str, words: list[str], k: int, at: int) -> bool:
        before, after = text[max(0, at - CONTEXT):at], text[at:at + len(words[k]) + CONTEXT]
        if any(w.strip(EDGE) in REPORTING for w in words[max(0, k - 3):k]):
            return any(q in before or q in after for q in QUOTES)
        opens = max((before.rfind(q) for q in QUOTES), default=-1)
        return (opens >= 0 or words[k][0] in QUOTES) and any(q in after[1:] for q in QUOTES)

    def scores(self, texts: list[str]) -> np.ndarray:
        x = feature_rows([self.hits(t) for t in texts])
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights), -30, 30)))

    def score(self, text: str) -> float:
        return float(self.scores([text])[0])


def feature_rows(hits: list[tuple[int, ...]]) -> np.ndarray:
    """Rows (1, log of open hits, log of quoted hits) from rows (exact, misspelled, quoted)."""
    h = np.array(hits, float).reshape(-1, 3)
    return np.c_[np.ones(len(h)), np.log1p(h[:, 0] + MISSPELLED * h[:, 1]), np.log1p(h[:, 2])]


def _source_key(words: Column) -> Column:
    """Equal for copies, and mostly for near copies: the least hash of the three-word shingles of a column of words."""
    runs = F.sequence(F.lit(1), F.greatest(F.size(words) - 2, F.lit(1)))
    return F.array_min(F.transform(runs, lambda i: F.xxhash64(F.slice(words, i, 3))))


def frequent_terms(counted: DataFrame, n_toxic: int, n_clean: int) -> DataFrame:
    """(kind, term, t, c): words and stems frequent in toxic texts and much rarer in clean ones, from (word, t, c), t and c counts of texts."""
    stems = [F.when(F.length("word") >= k, F.struct(F.lit("stem").alias("kind"), F.substring("word", 1, k).alias("term"))) for k in range(STEM[0], STEM[1] + 1)]
    word = F.struct(F.lit("word").alias("kind"), F.col("word").alias("term"))
    each = counted.where("length(word) between 3 and 40").select("t", "c", F.explode(F.array_compact(F.array(word, *stems))).alias("x"))
    sums = each.groupBy("x.kind", "x.term").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    return sums.where((F.col("t") >= max(LEAST_TEXTS, LEAST_SHARE * n_toxic)) & (_lift(n_toxic, n_clean) >= LIFT))


def _lift(n_toxic: int, n_clean: int) -> Column:
    """How many times likelier a word is in toxic texts, from its counts t and c."""
    return (F.col("t") / n_toxic) / ((F.col("c") + 0.5) / n_clean)


def plain_words(counted: DataFrame, terms: dict[str, str], n_toxic: int, n_clean: int) -> frozenset[str]:
    """Words one edit from a term that clean texts of the sample have, unless they are much likelier in toxic ones.

    Collected are words beside a term only, from ``LABELLED_ROWS`` texts at most.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = LexiconAutomaton(terms)
        for b in batches:
            yield b.filter(pa.array([automaton.edits(w) == 1 for w in b.column("word").to_pylist()], pa.bool_()))

    clean = counted.where((F.col("c") > 0) & (_lift(n_toxic, n_clean) < LIFT)).select("word")
    return frozenset(r["word"] for r in clean.mapInArrow(run, "word string").collect())


def choose_terms(frequent: list[tuple[str, str, int, int]]) -> dict[str, str]:
    """Lexicon from the frequent terms: of stems that begin alike the longest that says as much as the shortest; a word in place of its stem if it is nearly all of it."""
    words = {term: t for kind, term, t, _ in frequent if kind == "word"}
    stems = {term: t for kind, term, t, _ in frequent if kind == "stem"}
    longer: dict[str, list[str]] = {}
    for s in stems:
        longer.setdefault(s[:-1], []).append(s)
    terms: dict[str, tuple[str, int]] = {}
    stem_of: dict[str, str] = {}  # the shortest stem of a family -> the one chosen
    for s in sorted(stems, key=lambda s: (len(s), s)):
        if any(s[:k] in stem_of for k in range(STEM[0], len(s))):
            continue
        chosen = s
        while longer.get(chosen) and stems[best := max(longer[chosen], key=lambda x: (stems[x], x))] >= 0.95 * stems[s]:
            chosen = best
        stem_of[s] = chosen
        terms[chosen] = ("stem", stems[chosen])
    for w, t in sorted(words.items()):
        stem = next((stem_of[w[:k]] for k in range(STEM[0], len(w) + 1) if w[:k] in stem_of), None)
        if stem is None or (t >= 0.9 * stems[stem] and w.startswith(stem)):
            terms.pop(stem, None)
            terms[w] = ("word", t)
    ranked = sorted(terms.items(), key=lambda x: (-x[1][1], x[0]))
    return {term: kind for term, (kind, _) in ranked}


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Newton steps of a ridge logistic regression."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(doc_id: Column) -> Column:
    """Rows that learning leaves out: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Lexicon and weights from labelled rows that are not held out, ``LABELLED_ROWS`` at most."""
    labels = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).dropna()
    labels = labels.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED_ROWS)
    sample = staged(id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id"), "toxic-sample")
    n = dict(sample.groupBy("toxic").count().collect())
    total = sum(n.values())
    share = (n.get(1, 0) + 0.5) / (total + 1)
    base = float(np.log(share / (1 - share)))
    if not n.get(1) or not n.get(0):
        return Model({}, (base, 0.0, 0.0))
    sample_words = staged(sample.select("toxic", F.split(F.lower("text"), r"\s+").alias("words")), "toxic-words")
    per_text = sample_words.select("toxic", _source_key(F.col("words")).alias("key"), F.array_distinct("words").alias("words"))
    per_text = per_text.select("toxic", "key", F.explode("words").alias("word")).withColumn("word", F.btrim("word", F.lit(EDGE))).distinct()
    toxic_key = F.when(F.col("toxic") == 1, F.col("key"))
    counted = staged(per_text.groupBy("word").agg(
        F.approx_count_distinct(toxic_key, 0.02).alias("t"), F.sum((F.col("toxic") == 0).cast("int")).alias("c")), "toxic-counts")
    terms = choose_terms([tuple(r) for r in frequent_terms(counted, n[1], n[0]).collect()])
    model = Model(terms, plain=plain_words(counted, terms, n[1], n[0]))
    x, y = _sample_features(sample, model)
    return Model(terms, tuple(float(v) for v in fit_logistic(x, y)), model.plain)


def _sample_features(sample: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            hits = [model.hits(t) for t in b.column("text").to_pylist()]
            yield pa.record_batch([b.column("toxic"), *(pa.array([h[k] for h in hits], pa.int64()) for k in range(3))], names=["toxic", "a", "b", "c"])

    cells = sample.select("text", "toxic").mapInArrow(run, "toxic int, a long, b long, c long").collect()
    return feature_rows([tuple(r[1:]) for r in cells]), np.array([r[0] for r in cells], float)


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """One row per input row: doc_id, text, further columns named, score (0 to 1), predicted (1 if the score is 0.5 or more)."""
    docs = id_and_text(docs, id_col, text_col, *more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            score = pa.array(model.scores(b.column("text").to_pylist()), pa.float64())
            yield pa.record_batch([*b.columns, score], names=[*b.schema.names, "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows whose text is not predicted toxic, with all their columns as they were."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            yield b.filter(pa.array(model.scores([t or "" for t in b.column(text_col).to_pylist()]) < 0.5))

    return docs.mapInArrow(run, docs.schema)
