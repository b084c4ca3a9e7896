"""Places of regex matches, in DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,kind:string,order:int,group:string>>"
#: Elements that one step of ``sums_before`` copies at most.
RUN = 128


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body (or a lambda in it) mentions it."""
    return F.transform(F.array(value), body)[0]


def sums_before(lengths: Column) -> Column:
    """For each element of an array of integers the sum of those before it.

    An array that grows by one element a step is copied each time, so the array is cut into runs: only runs grow
    element by element, and only the list of runs run by run.
    """
    def grow(acc: Column, x: Column) -> Column:
        return F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

    def from_(at: Column) -> Column:
        return F.struct(at.cast("long").alias("at"), F.array().cast("array<long>").alias("out"))

    def of_runs(runs: Column) -> Column:
        total = F.transform(runs, lambda r: F.aggregate(r, F.lit(0).cast("long"), lambda a, x: a + x))
        before = F.aggregate(total, from_(F.lit(0)), grow)["out"]
        return F.flatten(F.zip_with(runs, before, lambda r, o: F.aggregate(r, from_(o), grow)["out"]))

    def cut(p: Column) -> Column:
        last = F.greatest(F.ceil(F.size(p) / RUN).cast("int") - 1, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(p, k * RUN + 1, F.lit(RUN)))

    return bound(F.transform(lengths, lambda x: x.cast("long")), lambda p: bound(cut(p), of_runs))


def spans(text: Column, pattern: str, kind: str, order: int, group: int = 0) -> Column:
    """Leftmost non-overlapping matches of a Java regex that never matches the empty text: array of
    (start, end, kind, order, group), places in code points, end exclusive, ``group`` the text of that group.

    The pieces between matches and the matches have the same total length as the text, so each place is a running sum of lengths.
    """
    rx = F.lit(pattern)
    whole = F.regexp_extract_all(text, rx, F.lit(0))
    named = F.regexp_extract_all(text, rx, F.lit(group)) if group else whole
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("hit"), named.alias("group"))

    def placed(p: Column) -> Column:
        p = F.filter(p, lambda x: x["hit"].isNotNull())
        before = sums_before(F.transform(p, lambda x: F.length(x["gap"]) + F.length(x["hit"])))
        return F.zip_with(p, before, lambda x, at: F.struct(
            (at + F.length(x["gap"])).cast("int").alias("start"), (at + F.length(x["gap"]) + F.length(x["hit"])).cast("int").alias("end"),
            F.lit(kind).alias("kind"), F.lit(order).alias("order"), x["group"].alias("group"))).cast(SPAN)

    return F.when(F.regexp_like(text, rx), bound(parts, placed)).otherwise(F.array().cast(SPAN))


def digest_text(found: Column) -> Column:
    """``kind:start:end`` of the spans in the order given, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
