"""Benchmark decontamination: a distributed positional inverted index, and exact phrase and proximity search in it.

Method.  Texts are lower-cased (A-Z only) and cut into words.  The index is a stored table of postings
(doc_id, text_hash, term, pos), one row per occurrence of a term; the search needs the terms of the benchmark
only, so the query stores those (``terms=None`` stores every word).  An item is searched by its *phrases*: each
window of ten consecutive words, or the whole item when it has fewer.  The terms of a phrase are ranked from the
rarest (by a count over the whole index) to the most frequent.  The rarest term's list, shifted by the term's
place in the phrase, gives the candidate starts; the second rarest term's shifted list is intersected with them
by an equality join on (text, term, place); what is left is joined with all other terms at once and kept where
every one of them stands in its place.  ``slop`` widens every place but the rarest term's by so many words to both
sides (proximity match); 0 is the exact phrase.

Scale.  Words are exploded row by row and joined with the benchmark's vocabulary (broadcast by Spark where its
size allows); the index is written where the rows are, without a shuffle.  The lists of a frequent term are
ordinary rows, keyed by text and place in every join after the first, so no list is gathered in one task; the first
join is by term and one of ``SALTS`` shares of its texts, against one row per share and phrase led by that term, so a term that
holds a third of all rows is dealt to many tasks (and adaptive execution splits further).  Texts of more
than ``PART`` characters are cut between words, so that no array holds more words than such a part has.

Defined cases.  A null text and a text without words: no words, nothing hit.  A null or wordless item: no phrase.
Equal phrases within or between items are searched once and counted for each item.  A null item_id is searched
but not named.  Repeated rows of documents come back as often as they came; equal texts under one id (null and 0
count as one id here) share their postings.  Empty documents: an empty result; an empty benchmark: nothing is hit.
Columns other than the named ones are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanflow.llm.common import id_and_text, staged

#: Consecutive words of one phrase.
WINDOW = 10
#: Shares that a term's list is dealt to in joins by term.
SALTS = 16
#: Characters of a text that are cut into words at once.
PART = 1 << 20

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Digits, a to z, and everything beyond ASCII are letters of words (of lower-cased text).
LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

KEY = ["doc_id", "text_hash"]


def lowered(text: Column) -> Column:
    """A-Z to a-z, nothing else; pure ASCII takes the cheaper built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words_of(text: Column) -> Column:
    """The words of a lower-cased text in order."""
    return F.array_remove(F.split(text, BETWEEN), "")


def _cut(text: Column, part: int) -> Column:
    """A text in parts of ``part`` characters, each carried on to the end of its last word."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{part}}}(?:{LETTERS})*"), F.lit(0))


def parts_of(text: Column, part: int = PART) -> Column:
    """Parts of a text, cut between words, with the number of words before each: array of (part, base)."""
    cut = _cut(text, part)
    bases = F.aggregate(cut, F.array(F.lit(0)), lambda a, c: F.concat(a, F.array(F.element_at(a, -1) + F.size(words_of(c)))))
    one = F.array(F.struct(text.alias("part"), F.lit(0).alias("base")))
    return F.when(F.length(text) <= part, one).otherwise(
        F.transform(F.arrays_zip(cut.alias("part"), F.slice(bases, F.lit(1), F.size(cut)).alias("base")),
                    lambda z: F.struct(z["part"].alias("part"), z["base"].alias("base"))))


def count_words(text: Column, part: int = PART) -> Column:
    """Words of a text."""
    cut = F.when(F.length(text) <= part, F.array(text)).otherwise(_cut(text, part))
    return F.aggregate(cut, F.lit(0).cast("long"), lambda a, c: a + F.size(words_of(c)))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, low, key_id, text_hash): the id as it is, and the key that the index uses."""
    rows = id_and_text(docs, id_col, text_col)
    return rows.withColumns({"low": lowered(F.col("text")), "key_id": F.coalesce("doc_id", F.lit(0).cast("long")),
                             "text_hash": F.xxhash64("text")})


def phrases(items: DataFrame, window: int = WINDOW, item_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """((phrase_id, words), (phrase_id, item_id)): the distinct phrases of all items, and the items of each."""
    rows = items.select(F.col(item_col).alias("item_id"), words_of(lowered(F.col(text_col).cast("string"))).alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    cut = rows.where(F.size("words") > 0).select("item_id", F.explode(F.transform(starts, lambda s: F.slice("words", s, window))).alias("words"))
    named = staged(cut.groupBy("words").agg(F.collect_set("item_id").alias("item_ids"))
                   .withColumn("phrase_id", F.monotonically_increasing_id()), "phrases")
    return named.select("phrase_id", "words"), named.select("phrase_id", F.explode("item_ids").alias("item_id"))


def index_documents(docs: DataFrame, terms: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                    part: int = PART) -> DataFrame:
    """The stored postings (doc_id, text_hash, term, pos) of all documents; of the words in ``terms`` (term) only, where given."""
    rows = _keyed(docs, id_col, text_col).select("key_id", "text_hash", F.inline(parts_of(F.col("low"), part)))
    words = rows.select(F.col("key_id").alias("doc_id"), "text_hash", "base", F.posexplode(words_of(F.col("part"))).alias("at", "term"))
    if terms is not None:
        words = words.join(terms.select("term").distinct(), "term")
    return staged(words.select("doc_id", "text_hash", "term", (F.col("base") + F.col("at")).alias("pos")), "postings")


def ranked_terms(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """(phrase_id, rank, term, offset, n_terms): a phrase's terms from the rarest of the index (rank 0) on."""
    terms = phrases.select("phrase_id", F.size("words").alias("n_terms"), F.posexplode("words").alias("offset", "term"))
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("phrase_id").orderBy("n", "term", "offset")
    counted = terms.join(counts, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return staged(counted.select("phrase_id", (F.row_number().over(order) - 1).alias("rank"), "term", "offset", "n_terms"), "terms")


def _shares(index: DataFrame) -> DataFrame:
    return index.withColumn("share", F.pmod("text_hash", F.lit(SALTS)))


def _for_each_share(terms: DataFrame) -> DataFrame:
    return terms.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))


def _places(candidates: DataFrame, terms: DataFrame, slop: int) -> DataFrame:
    """The candidates times the given terms and the places where each may stand."""
    at = F.col("start") + F.col("offset")
    rows = candidates.join(terms.select("phrase_id", "rank", "term", "offset"), "phrase_id")
    if slop == 0:
        return rows.withColumn("pos", at)
    return rows.withColumn("pos", F.explode(F.sequence(at - slop, at + slop)))


def find(index: DataFrame, phrases: DataFrame, slop: int = 0) -> DataFrame:
    """Stored occurrences (doc_id, text_hash, phrase_id, start, n_terms) of the phrases.

    With ``slop`` an occurrence is a start from which the rarest term stands in its place and every other term
    within ``slop`` words of its own; two terms may share a word then.
    """
    terms = ranked_terms(index, phrases)
    lead = terms.where("rank = 0").select("phrase_id", "term", "offset", "n_terms")
    found = _shares(index).join(_for_each_share(lead), ["term", "share"]).select(*KEY, "phrase_id", (F.col("pos") - F.col("offset")).alias("start"), "n_terms")
    if slop == 0:
        found = found.where("start >= 0")
    found = found.distinct()
    here = [*KEY, "term", "pos"]
    cand = [*KEY, "phrase_id", "start", "n_terms"]

    second = terms.where("rank = 1")
    lists = _shares(index).join(_for_each_share(second.select("term").distinct()), ["term", "share"], "left_semi")
    two = _places(found.where("n_terms > 1"), second, slop).join(lists.hint("merge"), here, "left_semi").select(*cand)
    left = staged(found.where("n_terms = 1").unionByName(two.distinct()), "candidates")

    rest = terms.where("rank > 1")
    # the texts with candidates grow with the input: one plan at every size, a shuffle of the postings by text
    lists = index.join(left.where("n_terms > 2").select(*KEY).distinct().hint("merge"), KEY, "left_semi")
    seen = _places(left.where("n_terms > 2"), rest, slop).join(lists.hint("merge"), here, "left_semi").select(*cand, "rank").distinct()
    whole = seen.groupBy(*cand).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == F.col("n_terms") - 2).select(*cand)
    return staged(left.where("n_terms <= 2").unionByName(whole), "occurrences")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit (words inside an occurring phrase), n_items and items_sha256 (items with
    occurring phrases; ids sorted as strings, comma-joined), item_ids, contaminated (n_hit > 0)."""
    known, of_items = phrases(items, window, item_col, item_text_col)
    index = index_documents(docs, known.select(F.explode("words").alias("term")), id_col, text_col)
    found = find(index, known)

    hit = (found.select(*KEY, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n_terms") - 1)).alias("pos")).distinct()
           .groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_hit")))
    named = (found.select(*KEY, "phrase_id").distinct().join(of_items, "phrase_id")
             .select(*KEY, F.col("item_id").cast("string").alias("item")).distinct()
             .groupBy(*KEY).agg(F.array_sort(F.collect_list("item")).alias("item_ids")))
    result = hit.join(named, KEY, "left").select(F.col("doc_id").alias("key_id"), "text_hash", "n_hit", "item_ids")

    rows = _keyed(docs, id_col, text_col).select("doc_id", "key_id", "text_hash", count_words(F.col("low")).alias("n_words"))
    out = rows.join(result, ["key_id", "text_hash"], "left").withColumn("item_ids", F.coalesce("item_ids", F.array().cast("array<string>")))
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), "item_ids")
