"""SentencePiece BPE encoding and decoding with a prefix table of last tokens.

The merge-type encoding of any prefix of a word is unique, so the table holds for each
prefix just its last token.  An automaton over the vocabulary reports every token that ends
at a place; the one that belongs there is the one whose pair with the last token before it is compatible:
merging that pair's characters alone gives the two tokens back.  The ids are then
recovered backwards, from the word's end.  No merges are simulated on the way, and time is linear in the text.

Words are encoded apart: no piece holds a space mark after another character, so nothing
merges across the start of a word (the constructor checks the vocabulary for it).  The same holds for
characters that have no piece, which become byte tokens.  Runs of several space
marks have pieces of equal score, for which order matters; they are encoded by merging.

A worker keeps one codec, and in it the last ``MEMO_WORDS`` different words at most.

Cases: null text is empty, no ids; the mark itself in a text counts as a space, as in the
library; rows come back one for one, copies and null ids too; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from loanflow.llm.common import id_and_text

MARK = "▁"
#: What a worker remembers: so many words, none longer than ``MEMO_CHARS``.
MEMO_WORDS = 1 << 20
MEMO_CHARS = 64
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


class Codec:
    def __init__(self, model_path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(model_path, "rb") as f:
            model.ParseFromString(f.read())
        norm, train = model.normalizer_spec, model.trainer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not train.byte_fallback or train.model_type != 2:
            raise ValueError("a BPE model with byte fallback, identity normalisation and a dummy prefix is expected")
        self.pieces = [p.piece for p in model.pieces]
        self.kinds = [p.type for p in model.pieces]
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        if any(MARK in p.lstrip(MARK) or (p[:2] == MARK * 2 and p.strip(MARK)) for p in self.ids):
            raise ValueError("a piece holds the space mark after another character")
        self.byte_ids = {int(p[1:-1], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == BYTE}
        self.bytes_of = {i: b for b, i in self.byte_ids.items()}
        #: a piece -> the two pieces of its last merge; none for single characters
        self.halves: dict[str, tuple[str, str]] = {}
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            if p[:2] != MARK * 2 and (len(p) == 1 or self._last_merge(p)):
                self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        self.compatible: dict[tuple[str, str], bool] = {}
        self.memo: dict[str, tuple[str, int, list[int]]] = {}

    def _merge(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """The pieces that merging gives, best score first, leftmost among equals; and the last merge."""
        parts: list[str | None] = list(text)
        left, right = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        heap: list[tuple[float, int, str, str]] = []

        def offer(i: int) -> None:
            j = right[i]
            if j < len(parts):
                a, b = parts[i], parts[j]
                if (s := self.scores.get(a + b)) is not None:
                    heapq.heappush(heap, (-s, i, a, b))

        for i in range(len(parts) - 1):
            offer(i)
        last = None
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i] if parts[i] == a else len(parts)
            if j >= len(parts) or parts[j] != b:
                continue
            parts[i], parts[j], last = a + b, None, (a, b)
            right[i] = right[j]
            if right[j] < len(parts):
                left[right[j]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [p for p in parts if p is not None], last

    def _last_merge(self, piece: str) -> bool:
        """Whether merging the piece's characters gives the piece; notes its last merge."""
        parts, last = self._merge(piece)
        if len(parts) == 1 and last:
            self.halves[piece] = last
        return len(parts) == 1

    def _pair_holds(self, a: str, b: str) -> bool:
        """Whether merging the characters of ``a + b`` gives ``a`` and ``b``.

        It does unless some merge across the border comes before the merges that close it.  Going back from the whole
        tokens, the border is next to the right half of ``a`` before a's last merge, and to the left half
        of ``b`` before b's: of the two, the later merge is undone first.
        """
        scores, halves = self.scores, self.halves
        closes: float | None = None  # score of the merge undone last: what crosses must not come before it
        crossing_left = False  # whether that merge was in the left token
        while True:
            s = scores.get(a + b)
            # of equal scores the leftmost merge comes first
            if s is not None and (closes is None or s > closes or (s == closes and not crossing_left)):
                return False
            sa = scores[a] if a in halves else None
            sb = scores[b] if b in halves else None
            if sa is None and sb is None:
                return True
            if sb is None or (sa is not None and sa < sb):
                closes, crossing_left, a = sa, True, halves[a][1]
            else:
                closes, crossing_left, b = sb, False, halves[b][0]

    def _known(self, word: str) -> list[int]:
        """Ids of a word of known characters, at most one space mark in front."""
        last: list[str] = [""] * (len(word) + 1)
        compatible = self.compatible
        for end, piece in self.automaton.iter(word):
            end += 1
            if not last[end]:
                before = last[end - len(piece)] if end > len(piece) else None
                if before is not None:
                    if not before:
                        continue
                    pair = (before, piece)
                    if (fits := compatible.get(pair)) is None:
                        if len(compatible) > MEMO_WORDS:
                            compatible.clear()
                        fits = compatible[pair] = self._pair_holds(before, piece)
                    if not fits:
                        continue
                last[end] = piece
        out, end = [], len(word)
        while end:
            out.append(self.ids[last[end]])
            end -= len(last[end])
        return out[::-1]

    def _any(self, word: str) -> list[int]:
        """Ids of any word: known stretches, byte tokens between them, runs of space marks merged."""
        out: list[int] = []
        marks = len(word) - len(word.lstrip(MARK))
        if marks > 1:  # a mark that merges into the word does so before the marks merge
            rest = self._any(word[marks - 1:])
            if rest[:1] == [self.ids.get(MARK)]:
                return [*self._run(marks), *rest[1:]]
            return [*self._run(marks - 1), *rest]
        ids, start = self.ids, 0
        for k, c in enumerate(word):
            if c not in ids:
                if start < k:
                    out += self._known(word[start:k])
                out += [self.byte_ids[b] for b in c.encode()]
                start = k + 1
        if start < len(word):
            out += self._known(word[start:])
        return out

    def _run(self, marks: int) -> list[int]:
        return [self.ids[p] for p in self._merge(MARK * marks)[0]]

    def _word(self, word: str) -> tuple[str, int, str]:
        """(ids joined by commas, how many, decoded text) of a word that starts at its space mark."""
        ids = self._any(word)
        return ",".join(map(str, ids)), len(ids), self._decode_raw(ids)

    def words(self, text: str) -> list[tuple[str, int, str]]:
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        parts = marked.split(MARK)[1:]
        if "" in parts:  # several marks in a row, or one at the end
            parts = [w[1:] for w in re.findall(f"{MARK}+[^{MARK}]*", marked)]
        out = []
        for w in parts:
            got = memo.get(w)
            if got is None:
                got = self._word(MARK + w)
                if len(w) <= MEMO_CHARS:
                    memo[w] = got
            out.append(got)
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for ids, n, _ in self.words(text) if n for i in ids.split(",")]

    def _decode_raw(self, ids: list[int]) -> str:
        """Text of ids, the dummy space still in front; bytes that are no UTF-8 become U+FFFD, one each."""
        out: list[str] = []
        data = bytearray()

        def flush() -> None:
            k = 0
            while k < len(data):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(bytes(data[k:k + n]).decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    n = 1
                k += n
            data.clear()

        for i in ids:
            if self.kinds[i] == BYTE:
                data.append(self.bytes_of[i])
                continue
            if data:
                flush()
            if self.kinds[i] == NORMAL:
                out.append(self.pieces[i].replace(MARK, " "))
            elif self.kinds[i] == UNKNOWN:
                out.append(" ⁇ ")
        if data:
            flush()
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        text = self._decode_raw(ids)
        dummy = bool(ids) and self.kinds[ids[0]] == NORMAL and self.pieces[ids[0]][0] == MARK
        return text[1:] if dummy else text


_codecs: dict[str, Codec] = {}


def codec(model_path: str) -> Codec:
    if model_path not in _codecs:
        _codecs[model_path] = Codec(model_path)
    return _codecs[model_path]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256, and ids unless ``with_ids`` is off."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                n_tokens, ids_hash, text_hash, all_ids = [], [], [], []
                for text in part.column("text").to_pylist():
                    words = c.words(text)
                    ids = ",".join([w[0] for w in words])
                    decoded = "".join([w[2] for w in words]).removeprefix(" ")
                    n_tokens.append(sum([w[1] for w in words]))
                    ids_hash.append(hashlib.sha256(ids.encode()).hexdigest())
                    text_hash.append(hashlib.sha256(decoded.encode()).hexdigest())
                    if with_ids:
                        all_ids.append([int(i) for i in ids.split(",")] if ids else [])
                cols = [part.column("doc_id"), pa.array(n_tokens, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols, names = [*cols, pa.array(all_ids, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.record_batch(cols, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)


def decode_ids(rows: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded``, the text of a column of ids; null ids give null."""
    from pyspark.sql import functions as F

    @F.pandas_udf("string")
    def run(ids):
        c = codec(model_path)
        return ids.map(lambda x: None if x is None else c.decode([int(i) for i in x]))

    return rows.withColumn("decoded", run(F.col(ids_col)))
