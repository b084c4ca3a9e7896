"""License scans: MinHash bands over overlapping text windows, then exact shingle containment; DataFrame expressions only.

Words are runs of ASCII letters, digits, ``.`` and ``-`` (dots and hyphens at their ends dropped) in lower case; shingles are
five consecutive words.

1. A template is cut into sections of ``SECTION`` shingles at most, all about as long.  A text's shingles that no template
   has are left out (they add to no containment); most texts end here.  What stays are *hits*: places and shingles, kept as text.
2. Windows.  Sections of n shingles are sought in windows of n + s - 1 places that begin at every s-th place, s being a quarter
   of n (at least 1): every run of n places lies in one of them whole.  A window's set are the hits in it that some section of n shingles has.
3. Retrieval.  The MinHash signature of the window's whole set is cut into ``BANDS`` bands of ``ROWS`` values, and an equality
   join on the bands finds the sections.  A window has less than 1.25 n shingles.  So the Jaccard similarity with a section of
   distinct shingles is at least 0.8 when the window holds it whole, and at least 0.75 / 1.5 = 0.5 when it holds ``CONTAINMENT`` of it,
   whatever other templates stand beside it.  Such a section is missed with probability (1 - J^ROWS)^BANDS: 4e-29 and 1e-8.
4. Verification.  The containment of a template of one section is the share of its shingles in the window.  For longer ones a
   retrieved section that the window holds to ``CONTAINMENT`` is an anchor: the whole template's shingles are counted in the span where the template must lie then, widened by a
   quarter of its length to both sides.  A template that is held to ``CONTAINMENT`` has a section that is (they are averages of each other), so sections lose none.

Templates are a parameter, of any length from five words on; the hashes of their shingles are a literal set in the plan, their
tables are joined by their size.

Cases: null text is empty; rows without a match give no row; null ids stay; copies and repeated rows give
the same matches each; an empty table gives an empty result; other columns are not read.  A very long text is dealt by windows after its hits are found.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanflow.llm.common import id_and_text, staged

#: Notices by license, in the wording that their publishers ask for.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
#: Whole licence texts, without title and copyright line.
LICENSE_TEXTS = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
)
TEMPLATES = NOTICES + LICENSE_TEXTS
SHINGLE = 5
SECTION = 64
BANDS = 64
ROWS = 2
CONTAINMENT = 0.75
WORD = r"[a-z0-9](?:[a-z0-9.-]*[a-z0-9])?"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _mix(acc: Column, x: Column) -> Column:
    return F.shiftleft(acc, 11).bitwiseOR(F.shiftrightunsigned(acc, 53)).bitwiseXOR(x)


def shingle_hashes(word_hashes: Column) -> Column:
    """A hash for each run of five words, in order; fewer words make one hash, none an empty array."""
    n = F.size(word_hashes)
    runs = F.greatest(n - (SHINGLE - 1), F.lit(0))
    mixed = F.slice(word_hashes, F.lit(1), runs)
    for k in range(1, SHINGLE):
        mixed = F.zip_with(mixed, F.slice(word_hashes, F.lit(k + 1), runs), _mix)
    whole = F.array(F.aggregate(word_hashes, F.lit(0).cast("long"), _mix))
    return F.when(n >= SHINGLE, mixed).when(n > 0, whole).otherwise(F.array().cast("array<bigint>"))


def shingles(word_list: Column) -> Column:
    """The five-word shingles themselves, as text."""
    n = F.size(word_list)
    return F.when(n >= SHINGLE, F.transform(F.sequence(F.lit(1), F.greatest(n - (SHINGLE - 1), F.lit(1))),
                                            lambda i: F.array_join(F.slice(word_list, i, SHINGLE), " ")))


def signature(hashes: Column) -> Column:
    """Keys of the ``BANDS`` MinHash bands of a non-empty set of shingle numbers."""
    least = lambda seed: F.array_min(F.transform(hashes, lambda x: F.xxhash64(F.lit(seed), x)))
    bands = [F.xxhash64(F.lit(b), *[least(b * ROWS + r) for r in range(ROWS)]) for b in range(BANDS)]
    return F.array(*bands).cast("array<bigint>")


def step_of(n: int) -> int:
    """Distance of the beginnings of the windows for sections of n shingles."""
    return max(1, n // 4)


@dataclass
class Templates:
    """The templates' tables (all of the size of the parameter, none of the size of the data)."""

    known: list[int]  # hashes of all shingles of templates
    shingles: DataFrame  # shingle (text), id, sizes: array of (n, step, window, need), wholes: long templates that have it
    sections: DataFrame  # section, n, template, license, ids, before, span (of the whole template), long
    wholes: DataFrame  # template, license, size: shingles of each long template
    any_long: bool


def templates(spark: SparkSession, notices) -> Templates:
    """Sections and shingles of the templates, each of ``SHINGLE`` words or more."""
    rows = spark.createDataFrame([(k, name, text) for k, (name, text) in enumerate(notices)], "template int, license string, text string")
    w = words(F.col("text"))
    rows = rows.select("template", "license", shingle_hashes(F.transform(w, lambda x: F.xxhash64(x))).alias("hashes"), shingles(w).alias("shingles"))
    rows = rows.orderBy("template").collect()
    if any(r["shingles"] is None for r in rows):
        raise ValueError(f"a template must have {SHINGLE} words or more")
    number: dict[str, int] = {}
    sections, wholes, sizes, owners = [], [], {}, {}
    for r in rows:
        ids = [number.setdefault(x, len(number)) for x in r["shingles"]]
        n_parts = -(-len(ids) // SECTION)
        if n_parts > 1:
            wholes.append((r["template"], r["license"], len(set(ids))))
            for x in ids:
                owners.setdefault(x, set()).add(r["template"])
        wide = len(ids) // 4
        for k in range(n_parts):
            low, high = k * len(ids) // n_parts, (k + 1) * len(ids) // n_parts
            own, n = sorted(set(ids[low:high])), high - low
            sections.append((len(sections), n, r["template"], r["license"], own, low + wide, len(ids) + 2 * wide + step_of(n), n_parts > 1))
            for x in own:
                sizes.setdefault(x, {}).setdefault(n, None)
    need = {}
    for _, n, _, _, own, *_ in sections:  # fewer hits than this hold no section of n shingles to CONTAINMENT
        need[n] = min(need.get(n, n), math.ceil(len(own) * CONTAINMENT))
    of_size = lambda n: (n, step_of(n), n + step_of(n) - 1, need[n])
    vocabulary = [(text, x, [of_size(n) for n in sorted(sizes[x])], sorted(owners.get(x, ()))) for text, x in number.items()]
    return Templates(
        sorted({h for r in rows for h in r["hashes"]}),
        spark.createDataFrame(vocabulary, "shingle string, id long, sizes array<struct<n: int, step: int, window: int, need: int>>, wholes array<int>"),
        spark.createDataFrame(sections, "section int, n int, template int, license string, ids array<bigint>, before int, span int, long boolean"),
        spark.createDataFrame(wholes, "template int, license string, size int"), bool(wholes))


def find_hits(docs: DataFrame, tpl: Templates, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored (row_key, doc_id, pos, id, sizes, wholes): the places of all rows where a shingle of a template begins."""
    docs = id_and_text(docs, id_col, text_col).select("doc_id", words(F.col("text")).alias("words"))
    docs = docs.withColumn("word_hashes", F.transform("words", lambda x: F.xxhash64(x)))
    # the row key is made beside the hashes, so that the filter below reads the finished hashes instead of being moved
    # under them, where it would compute them once for each mention
    docs = docs.select("doc_id", F.monotonically_increasing_id().alias("row_key"), "words", shingle_hashes(F.col("word_hashes")).alias("hashes"))
    docs = docs.where(F.exists("hashes", lambda x: x.isin(tpl.known)))
    places = F.filter(F.sequence(F.lit(0), F.size("hashes") - 1), lambda i: F.get(F.col("hashes"), i).isin(tpl.known))
    # single elements are read in place; a slice inside a lambda would copy the whole array for each hit
    run = lambda i: F.concat_ws(" ", *[F.get(F.col("words"), i + k) for k in range(SHINGLE)])
    at = F.transform(places, lambda i: F.struct(i.alias("pos"), run(i).alias("shingle")))
    hits = docs.select("row_key", "doc_id", F.inline(at)).join(tpl.shingles, "shingle")
    return staged(hits.select("row_key", "doc_id", "pos", "id", "sizes", "wholes"), "license_hits")


def windows(hits: DataFrame) -> DataFrame:
    """Stored (row_key, n, first_word, doc_id, seen): windows of the sizes of sections, with the hits of sections of that size."""
    sized = hits.select("row_key", "doc_id", "pos", "id", F.inline("sizes"))
    first = F.greatest(F.lit(0), F.floor((F.col("pos") - F.col("window") + F.col("step")) / F.col("step")).cast("int"))
    last = F.floor(F.col("pos") / F.col("step")).cast("int")
    sized = sized.select("row_key", "doc_id", "id", "n", "need", "step", F.explode(F.sequence(first, last)).alias("k"))
    sets = sized.groupBy("row_key", "n", (F.col("k") * F.col("step")).alias("first_word")).agg(
        F.first("doc_id").alias("doc_id"), F.first("need").alias("need"), F.array_sort(F.collect_set("id")).alias("seen"))
    return staged(sets.where(F.size("seen") >= F.col("need")).drop("need"), "license_windows")


def retrieve(win: DataFrame, tpl: Templates) -> DataFrame:
    """Windows with the sections of their size that share a band with them and that they hold to ``CONTAINMENT``.

    Equal sets are banded and verified once, however many windows have them (a notice may stand in a third of all rows);
    the sets that hold a section go back to their windows in a join that adaptive execution splits.
    """
    own = tpl.sections.select("n", "section", F.explode(signature(F.col("ids"))).alias("band"))
    sets = win.select("n", "seen").distinct().withColumn("band", F.explode(signature(F.col("seen"))))
    near = sets.join(own, ["n", "band"]).select("n", "seen", "section").distinct().join(tpl.sections.drop("n"), "section")
    share = F.size(F.array_intersect("seen", "ids")) / F.size("ids")
    held = near.withColumn("containment", share).drop("ids").where(F.col("containment") >= CONTAINMENT)
    return win.join(staged(held, "license_sets"), ["n", "seen"])


def count_wholes(anchors: DataFrame, hits: DataFrame, tpl: Templates) -> DataFrame:
    """(row_key, doc_id, template, license, first_word, containment): shingles of whole long templates in the spans of their anchors.

    Hits and spans meet by row, template and stretch of the text as long as a span, so a long text is dealt to many tasks.
    """
    spans = anchors.select("row_key", "doc_id", "template", "span", (F.col("first_word") - F.col("before")).alias("low")).distinct()
    ends = F.floor((F.col("low") + F.col("span") - 1) / F.col("span"))
    spans = spans.withColumn("stretch", F.explode(F.sequence(F.floor(F.col("low") / F.col("span")), ends)))
    lengths = tpl.sections.where("long").select("template", "span").distinct()
    placed = hits.select("row_key", "pos", "id", F.explode("wholes").alias("template")).join(lengths, "template")
    placed = placed.withColumn("stretch", F.floor(F.col("pos") / F.col("span"))).distinct()
    inside = spans.join(placed, ["row_key", "template", "span", "stretch"]).where("pos >= low and pos < low + span")
    held = inside.groupBy("row_key", "template", "span", "low").agg(F.first("doc_id").alias("doc_id"), F.size(F.collect_set("id")).alias("held"))
    return held.join(tpl.wholes, "template").select(
        "row_key", "doc_id", "template", "license", F.greatest("low", F.lit(0)).alias("first_word"), (F.col("held") / F.col("size")).alias("containment"))


def scan_licenses(docs: DataFrame, notices=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row and template found in it: doc_id, license, template, containment (of its best window), first_word (of that window)."""
    tpl = templates(docs.sparkSession, notices)
    hits = find_hits(docs, tpl, id_col, text_col)
    near = retrieve(windows(hits), tpl)
    columns = ["row_key", "doc_id", "template", "license", "first_word", "containment"]
    found = near.where(~F.col("long")).select(*columns)
    if tpl.any_long:
        whole = count_wholes(near.where("long"), hits, tpl).where(F.col("containment") >= CONTAINMENT)
        found = found.unionByName(whole.select(*columns))
    best = F.max(F.struct("containment", (-F.col("first_word")).alias("before")))
    return found.groupBy("doc_id", "row_key", "license", "template").agg(best.alias("best")).select(
        "doc_id", "license", "template", F.col("best.containment").alias("containment"), (-F.col("best.before")).cast("long").alias("first_word"))
