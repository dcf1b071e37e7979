"""Exact BPE encoding with a prefix table, and decoding.

For every prefix of a string the last token of its encoding is unique. A token sequence is the
encoding of its text exactly if each adjacent pair is the encoding of the pair's text. So one pass
from left to right suffices: at each end position an automaton lists the vocabulary entries that
end there, and the one that is compatible with the last token of the prefix before it is stored.
The ids are then recovered backwards from the last position.

Texts are cut where no vocabulary entry reaches across: before each run of word marks, and around
characters that the vocabulary lacks (they become byte tokens). Those parts repeat, so each worker
keeps a bounded memo of them.
"""

from __future__ import annotations

import heapq
import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import arrow_map

MARK = "▁"
_NORMAL, _BYTE, _USER = 1, 6, 4


class PrefixTableCodec:
    """Encoder and decoder for a merge-type (BPE) sentencepiece model with byte fallback."""

    def __init__(self, model_path: str, memo_entries: int = 250_000, core_entries: int = 60_000):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_path, "rb") as file:
            model.ParseFromString(file.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback:
            raise ValueError("a merge-type model with byte fallback is needed")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only an identity normalizer that keeps white space is supported")
        self.dummy_prefix = spec.add_dummy_prefix
        self.memo_entries, self.core_entries = memo_entries, core_entries
        self.pieces = [p.piece for p in model.pieces]
        self.ids, self.scores, self.bytes, self.chars = {}, {}, {}, set()
        self.automaton = ahocorasick.Automaton()
        for i, p in enumerate(model.pieces):
            if p.type in (_NORMAL, _USER):
                if p.type == _USER:
                    raise ValueError("user-defined symbols are not supported")
                if MARK in p.piece.lstrip(MARK):
                    raise ValueError("an entry reaches across a word mark")
                self.ids[p.piece], self.scores[p.piece] = i, p.score
                self.automaton.add_word(p.piece, (i, len(p.piece)))
                if len(p.piece) == 1:
                    self.chars.add(p.piece)
            elif p.type == _BYTE:
                self.bytes[int(p.piece[3:5], 16)] = i
        self.automaton.make_automaton()
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.parts = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        counts = Counter(self.scores.values())
        self._single_scores = {s for s, n in counts.items() if n == 1}
        self.rank = [-1 if p in self.ids and len(p) == 1 else -self.scores.get(p, 0.0) for p in self.pieces]
        self._pairs: dict[int, bool] = {}
        self._splits: dict[int, tuple[int, int] | None] = {}
        self._whole: dict[int, bool] = {}
        self._encoded: dict[str, bytes] = {}
        self._encoded_before: dict[str, bytes] = {}
        self._decoded: dict[bytes, str] = {}
        self._decoded_before: dict[bytes, str] = {}
        self._core: tuple[dict[str, bytes], dict[bytes, str]] | None = None

    def merged(self, text: str) -> list[str]:
        """The encoding of a short text by repeated best merges; the definition that pairs are tested with."""
        symbols, after, before = list(text), list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < len(symbols) and (score := self.scores.get(both := symbols[a] + symbols[b])) is not None:
                heapq.heappush(heap, (-score, a, b, both))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        while heap:
            _, a, b, both = heapq.heappop(heap)
            if not symbols[a] or not symbols[b] or after[a] != b or symbols[a] + symbols[b] != both:
                continue
            symbols[a], symbols[b], after[a] = both, "", after[b]
            if after[b] < len(symbols):
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [s for s in symbols if s]

    def _split(self, token: int) -> tuple[int, int] | None:
        """The two entries whose merge builds the token; (token, token) for one character; None if unreachable
        or if its merges are not in order of score, so that only repeated merging can tell."""
        if token in self._splits:
            return self._splits[token]
        text, found = self.pieces[token], None
        if len(text) == 1:
            found = (token, token)
        elif self.scores[text] in self._single_scores and self.merged(text) == [text]:
            for cut in range(1, len(text)):
                left, right = self.ids.get(text[:cut]), self.ids.get(text[cut:])
                if left is None or right is None or not (self._split(left) and self._split(right)):
                    continue
                if max(self.rank[left], self.rank[right]) < self.rank[token] and self.compatible(left, right, self.rank[token]):
                    found = (left, right)
                    break
        self._splits[token] = found
        return found

    def compatible(self, left: int, right: int, limit: float = math.inf) -> bool:
        """Whether the two tokens are the encoding of their joined text (up to merges of rank limit).

        Undoes the merges of both tokens, latest first. If a pair of parts that faced each other has an
        entry of its own that would have been merged before either part grew, the tokens can't stand.
        """
        key = left << 20 | right
        if limit == math.inf and (known := self._pairs.get(key)) is not None:
            return known
        a, b, top = self._split(left), self._split(right), limit
        if a is None or b is None:
            found = self.merged(self.pieces[left] + self.pieces[right]) == [self.pieces[left], self.pieces[right]]
        else:
            rank, pieces, ids = self.rank, self.pieces, self.ids
            while True:
                both = ids.get(pieces[left] + pieces[right])
                if both is not None and rank[both] < limit:
                    found = False
                    break
                if rank[left] > rank[right]:
                    limit, left = rank[left], self._split(left)[1]
                elif rank[right] >= 0:
                    limit, right = rank[right] + 0.5, self._split(right)[0]
                else:
                    found = True
                    break
        if top == math.inf:
            self._pairs[key] = found
        return found

    def _reachable(self, token: int) -> bool:
        found = self._whole.get(token)
        if found is None:
            found = self._whole[token] = self._split(token) is not None or self.merged(self.pieces[token]) == [self.pieces[token]]
        return found

    def _known(self, text: str) -> list[int]:
        """Ids of a text of which every character is in the vocabulary."""
        size = len(text)
        last, start, known = [-1] * (size + 1), [0] * (size + 1), self._pairs.get
        end = 0
        for at, (token, n) in self.automaton.iter(text):  # of the entries that end at a place, longest first
            if at < end:
                continue  # this place has its token already
            begin = at + 1 - n
            if begin:
                before = last[begin]
                fits = known(before << 20 | token)
                if fits is None:
                    fits = self.compatible(before, token)
            else:
                fits = self._reachable(token)
            if fits:
                end = at + 1
                last[end], start[end] = token, begin
        out, end = [], size
        while end:
            out.append(last[end])
            end = start[end]
        return out[::-1]

    def _part(self, part: str) -> bytes:
        """Ids of one part as 32-bit integers."""
        packed = self._encoded_before.get(part)
        if packed is None:
            if self.chars.issuperset(part):
                out = self._known(part)
            else:
                out, run = [], ""
                for c in part:
                    if c in self.chars:
                        run += c
                        continue
                    out += self._known(run)
                    out += [self.bytes[b] for b in c.encode()]
                    run = ""
                out += self._known(run)
            packed = array("i", out).tobytes()
        if len(self._encoded) >= self.memo_entries:  # the older half goes
            self._encoded_before, self._encoded = self._encoded, {}
        if len(part) <= 256:
            self._encoded[part] = packed
        return packed

    def rest(self) -> None:
        """Forgets all parts but those learned first, which are the frequent ones; for a worker that may idle between tasks."""
        if self._core is None:
            self._core = tuple(dict(islice(d.items(), self.core_entries)) for d in (self._encoded_before or self._encoded, self._decoded_before or self._decoded))
        self._encoded, self._decoded = dict(self._core[0]), dict(self._core[1])
        self._encoded_before, self._decoded_before = {}, {}

    def encode_packed(self, text: str | None) -> list[bytes]:
        """Ids of a text, part by part, as 32-bit integers; none for null or empty text."""
        if not text:
            return []
        marked = text.replace(" ", MARK)
        return [self._encoded.get(p) or self._part(p) for p in self.parts.findall(MARK + marked if self.dummy_prefix else marked)]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text."""
        return array("i", b"".join(self.encode_packed(text))).tolist()

    def _text(self, packed: bytes) -> str:
        """Text of the ids of a part, word marks kept."""
        text = self._decoded_before.get(packed)
        if text is None:
            out, raw = [], bytearray()
            for token in array("i", packed):
                if token in self.byte_of:
                    raw.append(self.byte_of[token])
                    continue
                if raw:
                    out.append(raw.decode(errors="replace"))
                    raw.clear()
                out.append(self.pieces[token])
            if raw:
                out.append(raw.decode(errors="replace"))
            text = "".join(out)
        if len(self._decoded) >= self.memo_entries:
            self._decoded_before, self._decoded = self._decoded, {}
        if len(packed) <= 1024:
            self._decoded[packed] = text
        return text

    def decode_packed(self, parts: list[bytes]) -> str:
        """Text of packed ids. A character's byte tokens never lie in two parts."""
        text = "".join([self._decoded.get(p) or self._text(p) for p in parts])
        if self.dummy_prefix and text.startswith(MARK):
            text = text[1:]
        return text.replace(MARK, " ")

    def decode(self, ids: list[int]) -> str:
        """Text of ids."""
        return self.decode_packed([array("i", ids).tobytes()] if ids else [])


@lru_cache(maxsize=2)
def codec(model_path: str) -> PrefixTableCodec:
    """One codec for each worker process and model."""
    return PrefixTableCodec(model_path)


def encode_decode(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """Encodes each whole text and decodes the ids again.

    Returns id_col, ids array<int>, decoded string, and the text with keep_text; one row for each input row, so repeated rows stay
    repeated. Null and empty texts give no ids and an empty text. Other columns are left out, so clashing
    names can't arise. No shuffle: each partition is encoded where it is read. model_path is a file that
    every worker has.
    """
    fields = [df.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.StringType())]
    schema = T.StructType(fields + ([T.StructField(text_col, T.StringType())] if keep_text else []))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        worker = codec(model_path)
        for batch in batches:
            step = 256  # texts at a time, so that their ids stay small in memory
            for at in range(0, batch.num_rows, step):
                cut = batch.slice(at, step)
                sizes, flat, texts = [0], [], []
                for text in cut.column(1).to_pylist():
                    parts = worker.encode_packed(text)
                    flat.append(packed := b"".join(parts))
                    sizes.append(sizes[-1] + len(packed) // 4)
                    texts.append(worker.decode_packed(parts))
                ids = pa.array(np.frombuffer(b"".join(flat), dtype=np.int32))
                lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), ids)
                yield pa.RecordBatch.from_arrays([cut.column(0), lists, pa.array(texts, pa.string()), *([cut.column(1)] if keep_text else [])], names=schema.names)
        worker.rest()

    return arrow_map(df.select(id_col, text_col), run, schema)
