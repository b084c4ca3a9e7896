"""Exact running totals in a global order, without a one-partition window.

``Window.orderBy(x)`` with no ``partitionBy`` moves every row into one task.
Instead:

1. range buckets: split points by selection in levels (``split_points``: a histogram of ranges, then of the parts
   of those that hold too much), and ``Bucketizer`` assigns each row its bucket by
   binary search - monotone in the order key, so buckets are ordered ranges;
2. per (group, bucket) totals - at most groups x n_buckets rows;
3. running offsets over the buckets of each group (a window over that small
   table);
4. a window per (group, bucket) ordered by the key, plus the bucket's offset.

Result is exact.  Equal keys always share a bucket, so ties are one point.
Callers should aggregate to distinct keys first (``groupBy(key).agg(...)``):
then a key that holds a third of all rows is a single row here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 64
_KEY = "_ord_key"
_BUCKET = "_ord_bucket"


def bucket_count(df: DataFrame, n_buckets: int | None) -> int:
    if n_buckets:
        return int(n_buckets)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    return max(DEFAULT_BUCKETS, 4 * parts)


#: The first level: one range per power of two, either sign.
_OCTAVES = [2.0 ** e for e in range(-1074, 1024)]
_FIRST = [-x for x in reversed(_OCTAVES)] + [0.0] + _OCTAVES
#: Parts that a range is cut into, per bucket's worth of rows in it.
_FINE = 4
_ROUNDS = 12


def _assigned(df: DataFrame, key: str, points: list[float], out: str) -> DataFrame:
    from pyspark.ml.feature import Bucketizer

    splits = [float("-inf"), *points, float("inf")]
    return Bucketizer(splits=splits, inputCol=key, outputCol=out, handleInvalid="keep").transform(df)


def _range_counts(df: DataFrame, key: str, points: list[float]) -> list[tuple[float, float, int]]:
    """(least key, greatest key, rows) of every range between the points that holds rows, in order."""
    finite = df.where(F.col(key).isNotNull() & ~F.isnan(key)).select(key)
    found = (_assigned(finite, key, points, "_range").groupBy("_range")
             .agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("n")).collect())
    return [(r["lo"], r["hi"], r["n"]) for r in sorted(found, key=lambda r: r["_range"])]


def split_points(df: DataFrame, key: str, n_buckets: int) -> list[float]:
    """At most ``n_buckets`` - 1 rising points that cut the rows into ranges of about equal numbers (one key is never cut).

    Each level is one aggregate over the rows, combined map-side: first by powers of two, then every range with more than a bucket's share is cut
    into equal widths between the least and the greatest key that it holds, about ``_FINE`` for each share, until none holds
    more or only single keys do.  Counts are exact and no task merges a sketch; the driver holds the ranges of one
    level, a few thousand for the first and at most about 2 x ``_FINE`` x ``n_buckets`` after it.
    """
    ranges = _range_counts(df, key, _FIRST)
    total = sum(n for *_, n in ranges)
    share = max(1.0, total / n_buckets)
    for _ in range(_ROUNDS):
        if not any(n > share and lo < hi for lo, hi, n in ranges):
            break
        cuts, room = [], 0.0
        for lo, hi, n in ranges:
            if n > share and lo < hi:
                parts = max(2, int(_FINE * n / share))
                inner = {lo + (hi - lo) * (i / parts) for i in range(1, parts)} if hi - lo != float("inf") else {0.0}
                cuts += [lo, *sorted(c for c in inner | {hi} if lo < c <= hi)]
                room = 0.0
            else:  # small ranges side by side are one again
                if not cuts or room + n > share:
                    cuts.append(lo)
                    room = 0.0
                room += n
        ranges = _range_counts(df, key, sorted(set(cuts) - {float("-inf"), float("inf")}))
    points, before, last = [], 0, 0
    for lo, _, n in ranges:
        bucket = min(n_buckets - 1, int((before + n / 2) / share))
        if before and bucket > last:
            points.append(lo)
        before, last = before + n, bucket
    return sorted(set(points) - {float("-inf"), float("inf")})


def with_range_bucket(df: DataFrame, key: str, n_buckets: int | None = None, out: str = _BUCKET) -> DataFrame:
    """Add ``out``: the index of the range of ``key`` (a double column) the row falls in; ranges hold about equal numbers of rows."""
    points = split_points(df, key, bucket_count(df, n_buckets))
    if not points:
        return df.withColumn(out, F.lit(0.0))
    return _assigned(df, key, points, out)


def running_totals(df: DataFrame, order_col: str, sum_cols, by=(), descending: bool = False,
                   n_buckets: int | None = None, prefix: str = "cum_", prev_col: str | None = None,
                   total_prefix: str | None = None) -> DataFrame:
    """Add ``cum_<c>`` = sum of ``c`` over the rows of the same ``by`` group whose order key is <= this row's
    (>= when ``descending``), ties included.  Optionally ``prev_col`` = the closest smaller (larger) key,
    and with ``total_prefix`` also ``<total_prefix><c>``, the sum over the whole group (from the small offsets table).

    ``order_col`` must be numeric and non-NULL.
    """
    by = list(by)
    sums = list(sum_cols)
    key = F.col(order_col).cast("double")
    base = df.withColumn(_KEY, -key if descending else key)
    base = with_range_bucket(base, _KEY, n_buckets)

    totals = base.groupBy(*by, _BUCKET).agg(*[F.sum(c).alias(f"_t_{c}") for c in sums],
                                            F.max(_KEY).alias("_bmax"))
    wb = Window.partitionBy(*by).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    group_sums = [F.sum(f"_t_{c}").over(whole).alias(f"{total_prefix}{c}") for c in sums] if total_prefix else []
    offsets = totals.select(
        *by, _BUCKET,
        *[F.coalesce(F.sum(f"_t_{c}").over(wb), F.lit(0)).alias(f"_o_{c}") for c in sums],
        F.max("_bmax").over(wb).alias("_prev_bmax"),
        *group_sums,
    )
    joined = base.join(offsets, on=by + [_BUCKET], how="inner")
    wk = Window.partitionBy(*by, _BUCKET).orderBy(_KEY).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    out = joined.withColumns({f"{prefix}{c}": F.sum(c).over(wk) + F.col(f"_o_{c}") for c in sums})
    if prev_col:
        wl = Window.partitionBy(*by, _BUCKET).orderBy(_KEY)
        prev_key = F.coalesce(F.lag(_KEY).over(wl), F.col("_prev_bmax"))
        # lag() sees the previous row; with distinct keys per group that is the previous key.
        out = out.withColumn(prev_col, -prev_key if descending else prev_key)
    return out.drop(_KEY, _BUCKET, "_prev_bmax", *[f"_o_{c}" for c in sums])
