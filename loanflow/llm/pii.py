"""Personal data: base patterns, and a skip-chain conditional random field that makes labels consistent across a document.

Base spans come from four patterns (email, ip, card, phone).  Further candidates are numbers
written without the marks that a pattern asks for, handles equal to the name of an email address and
addresses spelled with "at" and "dot".  All candidates of a document are the field's nodes:

- unary potentials: a base span is tied to its kind, another candidate leans to "other";
- chain potentials between neighbouring candidates favour equal kinds a little;
- skip potentials join each candidate to the previous one with the same key (same digits, same name) or
  a similar key (equal length, one digit changed), however far, and favour equal kinds much.

Loopy sum-product message passing gives each node's beliefs; candidates whose best kind is not
"other" are added to the spans.  Base spans always stay.  Each node has one skip edge for the same key and one for a
similar key at most, so the field grows with the text, not with its square.

Cases: null text is empty; every row comes back, copies and null ids too; long texts are
scanned in linear time (no pattern backtracks over a run); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanflow.llm.common import id_and_text, sliced

#: The kinds in the order of the digest, and what their patterns are made of.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits is taken whole wherever it starts, so the possessive forms find what the greedy ones find
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NUMBER = re.compile(r"(?<![0-9A-Za-z])\(?[0-9](?:[\x20().-]{0,2}[0-9])++")
SPELLED = re.compile(r"([A-Za-z0-9._%+-]{1,64})\s?[\[(]\s?at\s?[\])]\s?([A-Za-z0-9-]{1,63}(?:\s?[\[(]\s?dot\s?[\])]\s?[A-Za-z0-9-]{1,63}|\.[A-Za-z0-9-]{1,63}){1,8})")
ANY_DIGIT = re.compile("[0-9]")
HANDLE = re.compile(r"[A-Za-z0-9._%+@-]+")
LEAST_NAME = 4

Span = tuple[int, int, int]  # kind, start, end


def _emails(text: str) -> list[Span]:
    """Leftmost matches of local part, @, domain: a local part reaches back to the end of the last match at most."""
    out, done, at, before = [], 0, text.find("@"), 0
    while at >= 0:
        low = max(done, before)
        head = text[low:at]
        size = len(head) - len(head.rstrip(LOCAL))
        if size and (m := DOMAIN.match(text, at + 1)):
            out.append((0, at - size, m.end()))
            done = m.end()
        before = at + 1
        at = text.find("@", max(at + 1, done))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    out = _emails(text) if "@" in text else []
    if ANY_DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p) <= 12 and int(p) <= 255 or len(p) > 12 and int(p.lstrip("0")[:4] or "0") <= 255 and len(p.lstrip("0")) <= 3 for p in m[0].split(".")):
                out.append((1, m.start(), m.end()))
        for m in CARD.finditer(text):
            d = _digits(m[0])
            if 16 <= len(d) <= 19 and luhn(d):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 8 <= len(_digits(m[0])) <= 15:
                    out.append((3, m.start(), m.end()))
    return out


def _key(kind: int, body: str) -> str:
    """What equal things of a kind have in common: the name of an address, the numbers of an ip, the digits else."""
    if kind == 0:
        return "@" + body[:body.index("@")].lower()
    return ".".join(p.lstrip("0") or "0" for p in body.split(".")) if kind == 1 else _digits(body)


class _Taken:
    """The places that base spans cover, for tests of overlap in logarithmic time."""

    def __init__(self, base: list[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, s, e in sorted(base, key=lambda x: x[1]):
            if self.ends and s <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def free(self, start: int, end: int) -> bool:
        k = bisect_left(self.starts, end)
        return k == 0 or self.ends[k - 1] <= start


def _names_in(text: str, names: set[str]) -> Iterator[tuple[int, int]]:
    """Places where a handle is one of the names, or begins with one up to a dot; of several, the longest."""
    heads, lengths = {n[:LEAST_NAME] for n in names}, sorted({len(n) for n in names}, reverse=True)
    for m in HANDLE.finditer(text):
        if text[m.start():m.start() + LEAST_NAME].lower() in heads:
            handle = m[0].lower()
            for n in lengths:
                if (n == len(handle) or handle[n:n + 1] == ".") and handle[:n] in names:
                    yield m.start(), m.start() + n
                    break


def _candidates(text: str, base: list[Span]) -> list[tuple[int, int, int, str, int]]:
    """(start, end, base kind or -1, key, kind that it may have) of all candidates, by place."""
    out = [(start, end, kind, _key(kind, text[start:end]), kind) for kind, start, end in base]
    free = _Taken(base).free
    if any(k in (2, 3) for k, *_ in base):
        for m in NUMBER.finditer(text):
            d = _digits(m[0])
            if 7 <= len(d) <= 19 and free(m.start(), m.end()):
                out.append((m.start(), m.end(), -1, d, 2 if len(d) >= 16 else 3))
    names = {key[1:] for _, _, kind, key, _ in out if kind == 0 and len(key) > LEAST_NAME}
    if names:
        out += [(s, e, -1, "@" + text[s:e].lower(), 0) for s, e in _names_in(text, names) if free(s, e)]
        for m in SPELLED.finditer(text):
            if free(m.start(), m.end()):
                out.append((m.start(), m.end(), -1, "@" + m[1].lower(), 0))
    return sorted(set(out))


#: Log potentials of the field.  "Other" is the last label.
TIED, OTHER_LEAN, CHAIN, SAME, SIMILAR = 12.0, 1.5, 0.2, 3.0, 1.0
ROUNDS, DAMPING = 20, 0.5


def consistent_labels(nodes: list[tuple[int, int, int, str, int]]) -> np.ndarray:
    """The best label of each node (0 to 3: a kind, 4: other) after loopy message passing."""
    n, n_labels = len(nodes), len(KINDS) + 1
    unary = np.zeros((n, n_labels))
    for i, (_, _, kind, _, may) in enumerate(nodes):
        if kind >= 0:
            unary[i, kind] = TIED
        else:
            unary[i, :] = -4.0
            unary[i, may], unary[i, -1] = 0.0, OTHER_LEAN
    edges: list[tuple[int, int, float]] = [(i, i + 1, CHAIN) for i in range(n - 1)]
    last: dict[str, int] = {}
    near: dict[tuple[int, str], int] = {}
    for i, (_, _, _, key, _) in enumerate(nodes):
        key = key if key[:1] == "@" or "." in key else key[-10:]  # national and international forms of a number share their end
        if key in last:
            edges.append((last[key], i, SAME))
        elif key[:1] != "@":
            close = max((near.get((p, key[:p] + key[p + 1:]), -1) for p in range(len(key))), default=-1)
            if close >= 0:
                edges.append((close, i, SIMILAR))
        last[key] = i
        for p in range(len(key) if key[:1] != "@" else 0):
            near[p, key[:p] + key[p + 1:]] = i
    if not edges:
        return unary.argmax(1)
    a, b, w = (np.array(x) for x in zip(*edges, strict=True))
    src, dst = np.r_[a, b], np.r_[b, a]
    back = np.r_[np.arange(len(a)) + len(a), np.arange(len(a))]
    same = np.exp(np.r_[w, w])[:, None] - 1.0
    message = np.zeros((len(src), n_labels))
    for _ in range(ROUNDS):
        belief = unary.copy()
        np.add.at(belief, dst, message)
        out = belief[src] - message[back]
        out -= out.max(1, keepdims=True)
        p = np.exp(out)
        new = np.log(p.sum(1, keepdims=True) + same * p)  # sum over the sender's labels: e^w where equal, 1 elsewhere
        new -= new.max(1, keepdims=True)
        message = DAMPING * message + (1 - DAMPING) * new
    belief = unary.copy()
    np.add.at(belief, dst, message)
    return belief.argmax(1)


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by kind, then start."""
    base = sorted(base_spans(text))
    if not base:
        return base, base
    nodes = _candidates(text, base)
    if all(k >= 0 for _, _, k, _, _ in nodes):
        return base, base
    labels = consistent_labels(nodes)
    added = [(int(label), s, e) for (s, e, k, _, _), label in zip(nodes, labels, strict=True) if k < 0 and label < len(KINDS)]
    return base, sorted({*base, *added})


SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """One row per input row: doc_id, text, further columns named, spans (kind, start, end in code points, base), by kind, then start."""
    docs = id_and_text(docs, id_col, text_col, *more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            spans = []
            for text in batch.column("text").to_pylist():
                base, full = all_spans(text)
                own = set(base)
                spans.append([{"kind": KINDS[k], "start": s, "end": e, "base": (k, s, e) in own} for k, s, e in full])
            yield pa.record_batch([*batch.columns, pa.array(spans, SPAN_TYPE)], names=[*batch.schema.names, "spans"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, spans array<struct<kind:string,start:int,end:int,base:boolean>>")


def mask(text: str, spans: list[dict]) -> str:
    """The text with each span replaced by its kind in capitals; of overlapping spans, the first, then the longest counts."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= at:
            out += [text[at:s["start"]], f"[{s['kind'].upper()}]"]
            at = s["end"]
        elif s["end"] > at:  # the rest of an overlapping span goes too
            at = s["end"]
    return "".join([*out, text[at:]])


def mask_documents(docs: DataFrame, text_col: str = "text", chars_col: str | None = None) -> DataFrame:
    """The same rows and columns with personal data masked in ``text_col``; ``chars_col``, if named, gets the new length.  Null text stays null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            at = b.schema.get_field_index(text_col)
            texts = []
            for text in b.column(at).to_pylist():
                spans = all_spans(text)[1] if text else []
                texts.append(mask(text, [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in spans]) if spans else text)
            yield b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    return out if chars_col is None else out.withColumn(chars_col, F.length(text_col).cast(docs.schema[chars_col].dataType))
