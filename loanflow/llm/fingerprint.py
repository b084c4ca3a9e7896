"""Document fingerprints: a homomorphic multiset hash of a text's paragraphs, in DataFrame expressions only.

A paragraph (line) is hashed to a wide vector, and a text's fingerprint is the sum of its
paragraphs' vectors modulo powers of two.  The sum does not depend on the order of the
paragraphs, and a paragraph is inserted or deleted by adding or subtracting its vector
(``insert``, ``delete``) without reading the rest of the text.

The vector has ``EQUAL`` lanes of 60 bits hashed from the whole paragraph, which decide
equality, and ``LIKE`` longs of two 30-bit lanes that count, over the paragraph's phrases
(pieces between punctuation, long ones cut further), the set bits of a hash; the last lane counts phrases.  A phrase is cut
after the first of certain bytes from its ``LEAST_UNIT``-th byte on, ``MOST_UNIT`` at the latest: the cuts follow the content, so
an edit changes the units near it only, also in a text without punctuation.  A text has fewer than
2^30 units (a string has less than 2^31 bytes), so no lane runs over into the next.  From
the counts a signed sum per lane follows, and the mean square of the difference of two
texts' signed sums estimates how many phrases differ: ``likeness`` is one minus that, divided by the
two texts' own sizes, kept within 0 and 1.

Cases: a null text is the empty text (no paragraph, all lanes 0; two empty texts have
likeness 1); equal texts have equal fingerprints; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanflow.llm.common import id_and_text

EQUAL = 4
LIKE = 24
LANES = 2 * LIKE
WIDTH = EQUAL + LIKE + 1
POWER = (1 << 60) - 1
SPREAD = (1 << 30) | 1
LOW = (1 << 30) - 1
#: Bytes of a unit of the counting lanes; it ends after a byte of value 5 modulo 8 (in English, e, m and u) or at a mark.
LEAST_UNIT = 12
MOST_UNIT = 48
_MARKS = r".,;:!?|\n"
_ENDS = "".join(f"\\x{b:02x}" for b in range(5, 256, 8) if chr(b) not in ".,;:!?|\n")
UNIT = f"[^{_MARKS}]{{{LEAST_UNIT - 1},{MOST_UNIT - 1}}}?[{_ENDS}]|[^{_MARKS}]{{1,{MOST_UNIT}}}"
#: In ``with_next``: rows per bucket of neighbouring ids, and the most buckets (bounds the broadcast table of their first rows).
BUCKET_ROWS = 4096
MAX_BUCKETS = 16384


def _add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(POWER)))


def _sum(units: Column, vector, width: int) -> Column:
    """The sum of the units' vectors; one vector at a time is held."""
    zero = F.array_repeat(F.lit(0).cast("long"), width)
    return F.aggregate(units, zero, lambda acc, u: _add(acc, vector(u)))


def _phrase_vector(phrase: Column) -> Column:
    # twenty-four longs from four hashes: each uses two bits of a hash, 30 apart, after a shift
    h = [F.xxhash64(F.lit(k), phrase) for k in range(4)]
    words = [F.shiftrightunsigned(h[k], s).bitwiseAND(F.lit(SPREAD)) for k in range(4) for s in range(0, 30, 5)]
    return F.array(*words, F.lit(1).cast("long"))


def _paragraph_vector(paragraph: Column) -> Column:
    return F.array(*[F.xxhash64(F.lit(100 + k), paragraph).bitwiseAND(F.lit(POWER)) for k in range(EQUAL)])


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text, as an array of ``WIDTH`` longs."""
    paragraphs = F.filter(F.split(text, "\n"), lambda p: p != "")
    # one character a byte, so that the cuts work in every script
    phrases = F.regexp_extract_all(F.decode(F.encode(text, "UTF-8"), "ISO-8859-1"), F.lit(UNIT), F.lit(0))
    equal = _sum(paragraphs, _paragraph_vector, EQUAL)
    like = _sum(phrases, _phrase_vector, LIKE + 1)
    return F.concat(equal, like)


def insert(fp: Column, paragraph: Column) -> Column:
    """The fingerprint after a paragraph is added anywhere."""
    return _add(fp, fingerprint(paragraph))


def delete(fp: Column, paragraph: Column) -> Column:
    """The fingerprint after a paragraph is removed."""
    return F.zip_with(fp, fingerprint(paragraph), lambda x, y: (x - y).bitwiseAND(F.lit(POWER)))


def as_hex(fp: Column) -> Column:
    return F.array_join(F.transform(fp, lambda x: F.lpad(F.hex(x), 15, "0")), "")


def _signed(fp: Column) -> Column:
    """Signed sums of the ``LANES`` counting lanes: 2 * count - phrases."""
    n = F.element_at(fp, WIDTH)
    lane = lambda x, s: F.shiftrightunsigned(x, s).bitwiseAND(F.lit(LOW))
    return F.flatten(F.transform(F.slice(fp, EQUAL + 1, LIKE), lambda x: F.array(
        *[(2 * lane(x, s) - n).cast("double") for s in (0, 30)])))


def _power(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 from two fingerprints: 1 for equal ones, about the share of common phrases else."""
    va, vb = _signed(a), _signed(b)
    own = _power(va) + _power(vb)
    differ = _power(F.zip_with(va, vb, lambda x, y: x - y))
    return F.when(a == b, F.lit(1.0)).when(own == 0, F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.lit(1.0) - differ / own))


def with_next(docs: DataFrame, *carried: str) -> DataFrame:
    """Adds ``next_<c>`` for text and each carried column: those of the next row by descending id, the first row's after the last.

    Rows go to buckets of neighbouring ids (quantiles, so their number follows the rows) and
    are ordered within their bucket only.  The first row of a bucket also goes, as a
    guest at the end, to the bucket before it.  Ties go by hash of the text, then text; null ids come last.
    """
    spark = docs.sparkSession
    rows = docs.withColumn("_h", F.xxhash64("text"))
    n, low, high = rows.agg(F.count(F.lit(1)), F.min("doc_id"), F.max("doc_id")).first()
    n_buckets = min(max(1, -(-n // BUCKET_ROWS)), MAX_BUCKETS)
    cuts: list[int] = []
    if n_buckets > 1 and low is not None and low < high:
        shares = [k / n_buckets for k in range(1, n_buckets)]
        cuts = sorted(set(rows.agg(F.percentile_approx("doc_id", F.lit(shares), 20 * n_buckets)).first()[0]))
    rows = rows.withColumn("_bucket", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(_bucket_of(cuts)))
    # the first row of each bucket, by descending id: one small row for each of at most MAX_BUCKETS buckets
    tops = rows.groupBy("_bucket").agg(F.max(F.struct("doc_id", "_h")).alias("top")).collect()
    order = sorted(r["_bucket"] for r in tops)[::-1]
    host = {b: order[k - 1] for k, b in enumerate(order)}  # the very first row is a guest of the last bucket
    tops_df = spark.createDataFrame([(r["_bucket"], r["top"]["doc_id"], r["top"]["_h"], host[r["_bucket"]]) for r in tops],
                                    "_bucket int, _top_id long, _top_h long, _host int")
    is_top = F.col("_top_id").eqNullSafe(F.col("doc_id")) & (F.col("_top_h") == F.col("_h"))
    at = lambda b, guest: F.struct(F.col(b).alias("b"), F.lit(guest).alias("guest"))
    rows = rows.join(F.broadcast(tops_df), "_bucket").withColumn("_at", F.explode(
        F.when(is_top, F.array(at("_bucket", 0), at("_host", 1))).otherwise(F.array(at("_bucket", 0)))))
    w = Window.partitionBy("_at.b").orderBy("_at.guest", F.col("doc_id").desc_nulls_last(), F.col("_h").desc(), F.col("text").desc())
    keep = [c for c in docs.columns]
    out = rows.select(*keep, "_at", *[F.lead(c).over(w).alias(f"next_{c}") for c in ("text", *carried)])
    return out.where("_at.guest = 0").drop("_at")


def _bucket_of(cuts: list[int]) -> Column:
    """The number of cuts at or below the id: a search in two levels of short literal lists."""
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[k:k + step] for k in range(0, len(cuts), step)]
    below = lambda values: F.size(F.filter(values, lambda c: c <= F.col("doc_id")))
    coarse = below(F.lit([g[0] for g in groups]))
    fine = F.get(F.lit(groups), F.greatest(coarse - 1, F.lit(0)))
    return F.when(coarse == 0, F.lit(0)).otherwise((coarse - 1) * step + below(fine))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, fp) for every row."""
    docs = id_and_text(docs, id_col, text_col)
    return docs.withColumn("fp", fingerprint(F.col("text")))
