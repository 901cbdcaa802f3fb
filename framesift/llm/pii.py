"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds to them.

The field works on the surroundings of digits and of written or spelled "at" signs. Candidate segments
are runs of tokens that could hold personal data; features look at a whole segment (what its parts are,
how many digits, checksums, what stands around it), and dynamic programming over segments of bounded
length chooses boundaries and types together. It is trained on the pattern matches of a bounded sample,
and on the same matches in spellings the patterns do not know (defanged addresses, other separators).
"""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")

# Bounds of the sample that is fetched to train, and of the training.
SAMPLE_DOCS = 600
LONGEST = 16384
SAMPLE_ZONES = 500
EPOCHS = 6

MARGIN = 24
MOST_CHARS = 80

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*")
_DIGITS = re.compile(r"[0-9]+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]|(?i:\[at\]|\(at\))")
_TOKEN = re.compile(r" {0,2}(?i:@|\[at\]|\(at\)|\[dot\]|\(dot\)) {0,2}|\[\.\]|[0-9]+|[A-Za-z]+|(?s:.)")
_AT = ("@", "[at]", "(at)")
_DOT = ("[.]", "[dot]", "(dot)")
# An address goes on in front of or behind a stretch that has these there.
_FRONT = re.compile(r"[A-Za-z0-9](?:[._%+-]|\[\.\]| {0,2}(?i:\[dot\]|\(dot\)) {0,2})\Z")
_BACK = re.compile(r"(?:[.-]|\[\.\]| {0,2}(?i:\[dot\]|\(dot\)) {0,2})[A-Za-z0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if k % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the four patterns that pass their test, by start and kind; leftmost, per kind without
    overlap, and what fails its test is dropped without another try."""
    found = []
    at, free = text.find("@"), 0
    while at >= 0:
        # The local part is the run before the sign; runs end at the sign before, so all are short in sum.
        start = at
        while start > free and _LOCAL.fullmatch(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        free = at + 1
        if domain:
            found.append(("email", start, domain.end()))
            free = domain.end()
        at = text.find("@", free)
    ip_end = card_end = 0
    for run in _DIGITS.finditer(text):
        # A run of digits that does not start a match does not start one further in either.
        if run.start() >= ip_end and (m := _IP.match(text, run.start())):
            ip_end = m.end()
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append(("ip", m.start(), m.end()))
        if run.start() >= card_end and (m := _CARD.match(text, run.start())):
            card_end = m.end()
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def zones(text: str) -> list[tuple[int, int]]:
    """Stretches around digits and at signs, joined where they touch. Each reaches as far as a segment that
    holds its digit or sign can."""
    out: list[tuple[int, int]] = []
    for m in _TRIGGER.finditer(text):
        low, high = max(0, m.start() - MOST_CHARS), min(len(text), m.end() + MOST_CHARS)
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    return out


@dataclass
class Lattice:
    """Tokens of a zone and its candidate segments (first token, end token, features)."""

    starts: list[int]
    segments: list[tuple[int, int, list[str]]]


def _shape(token: str) -> str:
    if token.isdigit():
        return "d"
    if token.isalpha():
        return "a"
    spelled = token.strip(" ").lower()
    return "@" if spelled in _AT else "." if spelled in _DOT else token


def segment_features(tokens: list[str], before: str, after: str) -> list[str]:
    shapes = [_shape(t) for t in tokens]
    groups = [t for t in tokens if t.isdigit()]
    digits = "".join(groups)
    marks = "".join(sorted({s for s in shapes if s not in "da"}))
    at, letters = shapes.count("@"), shapes.count("a")
    out = [f"marks={marks}", f"ats={min(at, 2)}", f"letters={min(letters, 1)}", f"before={_around(before)}", f"after={_around(after)}", f"first={shapes[0]}", f"last={shapes[-1]}"]
    if not at and not letters:
        n = len(digits)
        out += [f"digits={min(n, 20)}", f"groups={min(len(groups), 6)}", f"digits={min(n, 20)}&plus={tokens[0] == '+'}&zeros={digits.startswith('00')}"]
        out.append(f"card={12 <= n <= 19 and luhn(digits)}&solid={len(set(shapes)) <= 2}")
        dots = len(groups) == 4 and shapes == ["d", ".", "d", ".", "d", ".", "d"]
        out.append(f"ip={dots and all(len(g) <= 3 and int(g) <= 255 for g in groups)}")
    if at:
        place = shapes.index("@")
        out += [f"left={place > 0}", f"dot_right={'.' in shapes[place:]}", f"odd={any(s not in 'da@.-_%+' for s in shapes)}", f"ends={shapes[-1]}&{'.' in shapes[place:]}"]
        out.append(f"whole={_around(before) != 'word' and _around(after) != 'word' and ' ' not in tokens}")
    return out


def _around(c: str) -> str:
    return "none" if not c else "word" if c.isalnum() or c in "_%-" else "space" if c.isspace() else "sign" if c in "+.@()[]/" else "other"


_INNER = {" ", ".", "-", "(", ")", "/", "+", "_", "%"}


def lattice(text: str, low: int, high: int) -> Lattice:
    """Candidate segments of a zone: from a letter, digit or plus to a letter or digit, with inner signs
    only, holding a digit or an at sign, and letters only with an at sign and without spaces but those of
    spelled signs. A word that the zone cuts is in none, and an address is in one as a whole only."""
    found = [(m.start() + low, m[0]) for m in _TOKEN.finditer(text[low:high])]
    tokens, starts = [t for _, t in found], [s for s, _ in found] + [high]
    shapes = [_shape(t) for t in tokens]
    segments = []
    for i, first in enumerate(shapes):
        if first not in ("d", "a", "+") or (starts[i] > 0 and text[starts[i] - 1].isalnum() and first in "da"):
            continue
        at = digit = letter = False
        inside = bool(_FRONT.search(text[max(0, starts[i] - 10) : starts[i]]))
        spaces = 0
        for j in range(i, len(tokens)):
            s = shapes[j]
            if starts[j + 1] - starts[i] > MOST_CHARS or not (s in ("d", "a", "@") or s in _INNER):
                break
            at, digit, letter = at or s == "@", digit or s == "d", letter or s == "a"
            spaces += s == " "
            if spaces > 6 or (spaces and (at or letter)) or (at and inside):
                break
            ends = high == len(text) or not text[high].isalnum() if j + 1 == len(tokens) else shapes[j + 1] not in ("d", "a")
            if s in ("d", "a") and ends and j > i and (at or (digit and not letter)) and not (at and _BACK.match(text, starts[j + 1])):
                before = text[starts[i] - 1] if starts[i] else ""
                after = text[starts[j + 1]] if starts[j + 1] < len(text) else ""
                segments.append((i, j + 1, segment_features(tokens[i : j + 1], before, after)))
    return Lattice(starts, segments)


@dataclass
class SemiMarkovField:
    """Weights per kind and feature; tokens outside of segments weigh nothing."""

    weights: dict[str, dict[str, float]] = field(default_factory=lambda: {k: {} for k in KINDS})

    def _scores(self, lat: Lattice) -> list[tuple[int, int, int, float, list[str]]]:
        out = []
        for i, j, feats in lat.segments:
            for k, kind in enumerate(KINDS):
                w = self.weights[kind]
                out.append((i, j, k, w.get("bias", -2.0) + sum(w.get(f, 0.0) for f in feats), feats))
        return out

    def decode(self, text: str, low: int, high: int) -> list[tuple[str, int, int]]:
        """Spans of the best segmentation of a zone."""
        lat = lattice(text, low, high)
        if not lat.segments:
            return []
        n, ending = len(lat.starts) - 1, defaultdict(list)
        for i, j, k, score, _ in self._scores(lat):
            if score > 0:
                ending[j].append((i, k, score))
        best, back = [0.0] * (n + 1), [None] * (n + 1)
        for j in range(1, n + 1):
            best[j] = best[j - 1]
            for i, k, score in ending[j]:
                if best[i] + score > best[j]:
                    best[j], back[j] = best[i] + score, (i, k)
        spans, j = [], n
        while j:
            if back[j]:
                i, k = back[j]
                spans.append((KINDS[k], lat.starts[i], lat.starts[j]))
                j = i
            else:
                j -= 1
        return spans[::-1]

    def learn(self, zones_with_gold: list[tuple[Lattice, set[tuple[int, int, int]]]], epochs: int = EPOCHS, rate: float = 0.5) -> None:
        """Ascent on the log-likelihood of the gold segmentations, with step sizes per weight (AdaGrad)."""
        squares: dict[tuple[int, str], float] = defaultdict(float)
        for _ in range(epochs):
            for lat, gold in zones_with_gold:
                n, scored = len(lat.starts) - 1, self._scores(lat)
                ending, leaving = defaultdict(list), defaultdict(list)
                for s in scored:
                    ending[s[1]].append(s)
                    leaving[s[0]].append(s)
                forward, backward = [0.0] * (n + 1), [0.0] * (n + 1)
                for j in range(1, n + 1):
                    forward[j] = _log_sum([forward[j - 1], *[forward[s[0]] + s[3] for s in ending[j]]])
                for i in range(n - 1, -1, -1):
                    backward[i] = _log_sum([backward[i + 1], *[s[3] + backward[s[1]] for s in leaving[i]]])
                for i, j, k, score, feats in scored:
                    step = ((i, j, k) in gold) - math.exp(min(0.0, forward[i] + score + backward[j] - forward[n]))
                    if abs(step) > 1e-4:
                        w = self.weights[KINDS[k]]
                        for f in (*feats, "bias"):
                            squares[k, f] += step * step
                            w[f] = w.get(f, -2.0 if f == "bias" else 0.0) + rate * step / math.sqrt(squares[k, f] + 1e-3)


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def _respelled(kind: str, match: str, rng: random.Random) -> str:
    """A match in a spelling that its pattern does not know."""
    if kind == "email":
        local, domain = match.split("@")
        at, dot = rng.choice(["[at]", "(at)", " [at] ", " (at) ", " @ "]), rng.choice([".", ".", "[dot]", "(dot)", " [dot] "])
        return local + at + domain.replace(".", dot)
    if kind == "ip":
        return match.replace(".", "[.]")
    if kind == "phone":
        return "00" + match[1:]
    digits = match.replace(" ", "").replace("-", "")
    return rng.choice("./").join(digits[k : k + 4] for k in range(0, len(digits), 4))


def train(texts: list[str], seed: int = 5) -> SemiMarkovField:
    """A field trained on zones of these texts, half of those with matches also respelled."""
    rng, examples = random.Random(seed), []

    def add(text: str, spans: list[tuple[str, int, int]]) -> None:
        for low, high in zones(text):
            lat = lattice(text, low, high)
            index = {s: k for k, s in enumerate(lat.starts)}
            gold, taken = set(), low
            for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
                if start >= taken and start in index and end in index:
                    gold.add((index[start], index[end], KINDS.index(kind)))
                    taken = end
            if lat.segments and len(examples) < SAMPLE_ZONES:
                examples.append((lat, gold))

    for text in texts:
        spans = base_spans(text)
        add(text, spans)
        if spans and rng.random() < 0.5:
            kind, start, end = rng.choice(spans)
            near = text[max(0, start - 2 * MARGIN) : start]
            new = _respelled(kind, text[start:end], rng)
            other = text[end : end + 2 * MARGIN]
            if not _TRIGGER.search(near + other):
                add(near + new + other, [(kind, len(near), len(near) + len(new))])
    model = SemiMarkovField()
    if any(gold for _, gold in examples):
        model.learn(examples)
    return model


def fit(docs: DataFrame, text: str = "text") -> SemiMarkovField:
    """A field trained on at most ``SAMPLE_DOCS`` different texts that hold a digit or an at sign, of no
    more than ``LONGEST`` code points, the first by a hash of the text. Without any, it adds nothing.

    A count of the different texts first tells how small a hash has to be, so tasks return about twice
    the sample in all, not a sample each.
    """
    marked = docs.select(F.col(text).alias("_text")).filter(F.col("_text").rlike("[0-9@]") & (F.char_length("_text") <= LONGEST))
    hashed = marked.withColumn("_hash", F.xxhash64(F.lit(5), "_text"))
    texts = hashed.agg(F.approx_count_distinct("_hash").alias("n")).first()["n"]
    share = min(1.0, 2 * SAMPLE_DOCS / max(texts, 1))
    largest = min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))
    near = hashed.filter(F.col("_hash") <= F.lit(largest)).groupBy("_hash").agg(F.min("_text").alias("_text"))
    return train([r["_text"] for r in near.orderBy("_hash").limit(SAMPLE_DOCS).collect()])


def spans_of(text: str, model: SemiMarkovField) -> list[tuple[str, int, int, bool]]:
    """All spans by start and kind: pattern matches, and what the field finds clear of them."""
    if not _TRIGGER.search(text):
        return [(*s, True) for s in base_spans(text)]
    base = base_spans(text)
    out = [(*s, True) for s in base]
    if any(model.weights.values()):
        for low, high in zones(text):
            near = [s for s in base if s[1] < high and s[2] > low]
            out += [(k, a, b, False) for k, a, b in model.decode(text, low, high) if not any(a < e and b > s for _, s, e in near)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


_SPAN = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def find(docs: DataFrame, model: SemiMarkovField, text: str = "text") -> DataFrame:
    """Documents with ``pii``, an array of (kind, start, end, base): code points, end exclusive.

    A missing text counts as empty. Each row is judged alone and by its whole text; a column named
    ``pii`` is replaced, others pass through, and an empty table gives an empty table.
    """
    base = docs.select(*[c for c in docs.columns if c.lower() != "pii"])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for value in batch.column(batch.schema.get_field_index(text)):
                spans = spans_of(value.as_py() or "", model)
                found.append([{"kind": k, "start": a, "end": b, "base": own} for k, a, b, own in spans])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], [*batch.schema.names, "pii"])

    schema = T.StructType([*base.schema.fields, T.StructField("pii", T._parse_datatype_string(_SPAN))])
    return base.mapInArrow(run, schema)
