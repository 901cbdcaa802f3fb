"""SentencePiece encoding and decoding as a weighted transducer.

A model file is compiled into three transducers: the normaliser (rewriting rules, white space, the
leading mark), the lexicon (an arc per piece, weighted) and byte fallback (a chain of byte arcs for a
character that no piece covers). Composed with a text they give a lattice, and its shortest path in the
tropical semiring is the encoding.

For a unigram model an arc weighs the negative score of its piece. A merge (BPE) model has no such
weights; its rule is a condition on neighbours, so a transition between two pieces weighs nothing if
merging the text of both gives these two again, and infinitely much otherwise. A sequence of pieces is
the model's encoding exactly if all its neighbours pass, so one finite path is left.

No piece reaches over the start of a word mark, so the lattice falls into parts there, and the best
paths of frequent parts are remembered up to a bound.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, MERGES = 1, 2
REMEMBERED = 800_000
LINKS = 1_200_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of one protocol-buffer message: number and value (bytes for strings and messages)."""
    at, end = 0, len(data)

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < end:
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            size = varint()
            yield tag >> 3, data[at : at + size]
            at += size
        else:
            size = 8 if kind == 1 else 4
            yield tag >> 3, data[at : at + size]
            at += size


class PieceTransducer:
    """Compiled model; ``encode`` and ``decode`` are functions of one text alone."""

    def __init__(self, model: bytes, rules: dict[str, str] | None = None):
        self.names, self.scores, self.kinds = [], [], []
        self.kind, self.prefix, self.squeeze, self.escape = UNIGRAM, True, True, True
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                self.names.append(piece.get(1, b"").decode("utf-8"))
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                self.kind = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                spec = dict(_fields(value))
                if spec.get(2):
                    raise ValueError("the model holds a compiled character map; give its rules as text instead")
                self.prefix, self.squeeze, self.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))
        if self.kind not in (UNIGRAM, MERGES):
            raise ValueError("only unigram and merge models are built from pieces that compose")
        self.rules = dict(rules or {})
        self._rewrite = re.compile("|".join(map(re.escape, sorted(self.rules, key=lambda s: (-len(s), s))))) if self.rules else None
        self.lexicon = {n: k for k, (n, t) in enumerate(zip(self.names, self.kinds)) if t in (NORMAL, USER) and n}
        # Every beginning of a piece, with the piece's number where it is one.
        self.entries = {n[:k]: -1 for n in self.lexicon for k in range(1, len(n))} | self.lexicon
        self.bytes_of = {int(n[3:5], 16): k for k, (n, t) in enumerate(zip(self.names, self.kinds)) if t == BYTE}
        self.unknown = next((k for k, t in enumerate(self.kinds) if t == UNKNOWN), None)
        self.penalty = 10.0 - min((s for s, t in zip(self.scores, self.kinds) if t == NORMAL), default=0.0)
        self.text_of = [
            bytes([int(n[3:5], 16)]) if t == BYTE else b"" if t == CONTROL else " ⁇ ".encode() if t == UNKNOWN else n.replace(MARK, " ").encode()
            for n, t in zip(self.names, self.kinds)
        ]
        inside = any(MARK in n.lstrip(MARK) for n in self.lexicon)
        lone = "".join(c for c in "\n\t\r" if not any(c in n for n in self.lexicon))
        # Parts: marks with what follows them, and characters that no piece holds.
        self._parts = re.compile("(?s).+" if inside else f"{MARK}*[^{MARK}{lone}]+|{MARK}+" + (f"|[{lone}]" if lone else ""))
        self._paths: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._lost = False
        self._links: dict[tuple[int, int], bool] = {}

    def normalise(self, text: str) -> str:
        if self._rewrite:
            text = self._rewrite.sub(lambda m: self.rules[m[0]], text)
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if self.prefix and text:
            text = " " + text
        return text.replace(" ", MARK) if self.escape else text

    def _merge(self, text: str) -> list[str]:
        """Pieces by merging the best neighbours again and again, the leftmost of equal ones first."""
        parts = list(text)
        while len(parts) > 1:
            best, place = None, -1
            for k in range(len(parts) - 1):
                piece = self.lexicon.get(parts[k] + parts[k + 1])
                if piece is not None and (best is None or self.scores[piece] > best):
                    best, place = self.scores[piece], k
            if best is None:
                break
            parts[place : place + 2] = [parts[place] + parts[place + 1]]
        return parts

    def _linked(self, left: int, right: int) -> bool:
        """Whether a merge model lets ``right`` follow ``left`` (-1: a start or an uncovered character)."""
        known = self._links.get((left, right))
        if known is None:
            if left < 0:
                known = self._merge(self.names[right]) == [self.names[right]]
            else:
                known = self._merge(self.names[left] + self.names[right]) == [self.names[left], self.names[right]]
            if len(self._links) < LINKS:
                self._links[left, right] = known
        return known

    def _fallback(self, character: str) -> tuple[int, ...]:
        data = character.encode("utf-8", "surrogatepass")
        if all(b in self.bytes_of for b in data):
            return tuple(self.bytes_of[b] for b in data)
        return () if self.unknown is None else (self.unknown,)

    def _arcs(self, part: str, start: int) -> list[tuple[int, int]]:
        """Arcs (end, piece) that leave a state of the lattice, the shortest first."""
        found, entries = [], self.entries
        for end in range(start + 1, len(part) + 1):
            piece = entries.get(part[start:end])
            if piece is None:
                break
            if piece >= 0:
                found.append((end, piece))
        if not found or found[0][0] > start + 1:
            found.insert(0, (start + 1, -1))
        return found

    def _only_path(self, part: str) -> list[tuple[int, int]] | None:
        """The one finite path of a merge model's lattice, by depth-first search, long arcs first.

        Whatever finite path reaches a state, it is the encoding of the text before it, so a state
        that led nowhere once need not be tried again.
        """
        n, links = len(part), self._links
        path, untried, tried = [], [self._arcs(part, 0)], set()
        while untried:
            if not untried[-1]:
                untried.pop()
                if path:
                    path.pop()
                continue
            end, piece = untried[-1].pop()
            if end in tried:
                continue
            if piece >= 0:
                left = path[-1][1] if path else -1
                ok = links.get((left, piece))
                if not (self._linked(left, piece) if ok is None else ok):
                    continue
            path.append((end, piece))
            if end == n:
                return path
            tried.add(end)
            untried.append(self._arcs(part, end))
        return None

    def _best_path(self, part: str) -> list[tuple[int, int]]:
        """The path of least weight, state by state."""
        n, scores, inf = len(part), self.scores, float("inf")
        cost, back = [0.0] + [inf] * n, [(0, -1)] * (n + 1)
        for start in range(n):
            for end, piece in self._arcs(part, start):
                total = cost[start] + (self.penalty if piece < 0 else -scores[piece])
                if total < cost[end]:
                    cost[end], back[end] = total, (start, piece)
        path, at = [], n
        while at:
            start, piece = back[at]
            path.append((at, piece))
            at = start
        return path[::-1]

    def shortest_path(self, part: str) -> array:
        """Ids along the best path of the lattice of ``part``."""
        path = self._only_path(part) if self.kind == MERGES else self._best_path(part)
        if path is None:
            found = [(self.lexicon[p],) if p in self.lexicon else self._fallback(p) for p in self._merge(part)]
        else:
            found = [(piece,) if piece >= 0 else self._fallback(part[end - 1]) for end, piece in path]
        if self.unknown is not None:  # neighbouring unknowns are one
            found = [f for k, f in enumerate(found) if f != (self.unknown,) or not k or found[k - 1] != f]
        return array("i", [i for ids in found for i in ids])

    def _path(self, part: str) -> bytes:
        """The ids of a part as packed 32-bit numbers, remembered; what was not asked for since half the
        bound is forgotten. A part that its ids do not give back is noted and not remembered."""
        path = self._older.get(part)
        if path is None:
            ids = self.shortest_path(part)
            path = ids.tobytes()
            if b"".join(map(self.text_of.__getitem__, ids)) != part.replace(MARK, " ").encode("utf-8", "surrogatepass"):
                self._lost = True
                return path
        if len(part) <= 64:
            if len(self._paths) >= REMEMBERED // 2:
                self._older, self._paths = self._paths, {}
            self._paths[part] = path
        return path

    def encode_checked(self, text: str) -> tuple[bytes, bool]:
        """The ids of a text as packed 32-bit numbers, and whether they give back the normalised text.

        Each distinct part is encoded and decoded once; a text is given back if its parts cover it and
        each of them is.
        """
        plain = self.normalise(text)
        parts = self._parts.findall(plain)
        self._lost = sum(map(len, parts)) != len(plain)
        known = self._paths.get
        ids = b"".join([known(part) or self._path(part) for part in parts])
        return ids, not self._lost

    def encode(self, text: str) -> array:
        return array("i", self.encode_checked(text)[0])

    def decode(self, ids) -> str:
        """The text that was normalised and encoded, without the leading mark."""
        text = b"".join(map(self.text_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text

    def restored(self, text: str, ids) -> bool:
        plain = self.normalise(text)
        plain = plain.replace(MARK, " ")
        return self.decode(ids) == (plain[1:] if self.prefix else plain)


_compiled: dict[int, PieceTransducer] = {}


def _transducer(shared) -> PieceTransducer:
    """One compiled model per Python worker."""
    if shared.id not in _compiled:
        _compiled.clear()
        _compiled[shared.id] = PieceTransducer(*shared.value)
    return _compiled[shared.id]


class _Shared:
    """Model and rules, sent to the executors once; their size is that of the model file."""

    def __init__(self, spark, model_path: str, rules: dict[str, str] | None):
        with open(model_path, "rb") as file:
            model = file.read()
        PieceTransducer(model, rules)  # fails here rather than in a task
        self.sent = spark.sparkContext.broadcast((model, rules))
        self.id = hash((model, tuple(sorted((rules or {}).items()))))

    @property
    def value(self):
        return self.sent.value


def encode(docs: DataFrame, model_path: str, text: str = "text", rules: dict[str, str] | None = None) -> DataFrame:
    """Documents with ``ids`` (array of int), ``n_ids`` and ``restored`` (decoding gives the normalised
    text again, which holds for any text if the model falls back to bytes).

    Every text is encoded whole and alone. Missing and empty texts have no ids. Columns of the three
    names are replaced, all others pass through, and an empty table gives an empty table. The model is
    read by the driver and sent to the executors.
    """
    made = ("ids", "n_ids", "restored")
    base = docs.select(*[c for c in docs.columns if c.lower() not in made])
    shared = _Shared(docs.sparkSession, model_path, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = _transducer(shared)
        for batch in batches:
            values, sizes, restored = [], [], []
            for value in batch.column(batch.schema.get_field_index(text)):
                ids, whole = transducer.encode_checked(value.as_py() or "")
                values.append(np.frombuffer(ids, np.int32))
                sizes.append(len(ids) // 4)
                restored.append(whole)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            flat = pa.array(np.concatenate(values) if values else np.empty(0, np.int32))
            arrays = [*batch.columns, pa.ListArray.from_arrays(offsets, flat), pa.array(sizes, pa.int32()), pa.array(restored, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, *made])

    schema = T.StructType([*base.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_ids", T.IntegerType()), T.StructField("restored", T.BooleanType())])
    return base.mapInArrow(run, schema)


def decode_column(spark, model_path: str, ids: Column, rules: dict[str, str] | None = None) -> Column:
    """Texts of arrays of ids; NULL stays NULL, no ids give an empty text."""
    shared = _Shared(spark, model_path, rules)

    @F.pandas_udf("string")
    def decoded(values):
        transducer = _transducer(shared)
        return values.map(lambda v: None if v is None else transducer.decode(v))

    return decoded(ids)
