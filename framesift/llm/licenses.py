"""License scans: winnowed fingerprints pick candidates, banded alignment reports what matched.

Texts and templates are cut into lower-case tokens of letters and digits. Of every ``WINDOW``
neighbouring token pairs the one of smallest hash is a fingerprint, so any run of ``WINDOW + GRAM - 1``
tokens that a text shares with a template shares a fingerprint too (Schleimer, Wilkerson and Aiken,
"Winnowing", 2003). The window is one pair: three tokens in ten may be other ones or missing, and with
every pair a fingerprint ``HIT_SHARE`` of a template's are still there then. An inverted index of the
templates, which are few and fixed, turns fingerprints of a text into hits; hits on neighbouring
diagonals are one candidate, and a local alignment within a band around them gives coverage and span.
Templates that differ from other licences in a name or a version only also need those in the text.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from framesift.llm.common import WordHashes, grams
from framesift.llm.license_templates import NAMED, TEMPLATES

GRAM = 2
WINDOW = 1
SHORTEST = 3
BEHIND = 3
COVERAGE = 0.7
HIT_SHARE = 0.3

# ASCII signs part tokens, ASCII capitals are lower-cased, all other bytes belong to tokens.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def tokens_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def token_spans(text: str) -> list[tuple[int, int]]:
    """Code-point spans of the tokens."""
    data = text.encode("utf-8", "surrogatepass")
    starts = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80) if data else np.empty(0, np.int64)
    return [(int(starts[m.start()]) - 1, int(starts[m.end() - 1])) for m in re.finditer(rb"[^ ]+", data.translate(_FOLD))]


def winnow(hashes: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(places, fingerprints): the smallest gram of each window, the rightmost of equal ones."""
    values = grams(hashes, gram) if len(hashes) >= gram else hashes[:0]
    if len(values) == 0:
        return np.empty(0, np.int64), values
    window = min(window, len(values))
    views = np.lib.stride_tricks.sliding_window_view(values[::-1], window)
    places = len(values) - 1 - (np.arange(len(views)) + views.argmin(axis=1))
    places = np.unique(places)
    return places, values[places]


@dataclass(frozen=True)
class Match:
    license: str
    template: str
    coverage: float
    first: int
    last: int
    matched: int


def align(text: np.ndarray, template: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """Best local alignment of a template within a band of diagonals (text place minus template place
    from ``low`` to ``high``): matched tokens, first and last matched text token."""
    width = high - low + 1
    above_score = [0] * (width + 1)
    above_path: list[tuple[int, int, int]] = [(0, -1, -1)] * (width + 1)
    best, found = 0, (0, -1, -1)
    for t, wanted in enumerate(template.tolist()):
        row_score, row_path = [0] * (width + 1), [(0, -1, -1)] * (width + 1)
        for k in range(width):
            place = t + low + k
            if not 0 <= place < len(text):
                continue
            hit = int(text[place]) == wanted
            score, path = above_score[k] + (2 if hit else -1), above_path[k]
            if hit:
                path = (path[0] + 1, path[1] if path[1] >= 0 else place, place)
            if above_score[k + 1] - 1 > score:  # a template token is missing
                score, path = above_score[k + 1] - 1, above_path[k + 1]
            if k and row_score[k - 1] - 1 > score:  # a text token is extra
                score, path = row_score[k - 1] - 1, row_path[k - 1]
            if score <= 0:
                score, path = 0, (0, -1, -1)
            row_score[k], row_path[k] = score, path
            if score > best:
                best, found = score, path
        above_score, above_path = row_score, row_path
    return found


def is_named(words: list[bytes], first: int, last: int, needed: str, barred: str, version: str) -> bool:
    """Whether a match from ``first`` to ``last`` has all needed words and no barred ones, and the version
    there or just behind."""
    stretch, v = words[first : last + 1], version.encode()
    if not set(needed.encode().split()).issubset(stretch) or set(barred.encode().split()).intersection(stretch):
        return False
    inside, behind = (b" %s " % b" ".join(words[first : last + 1 + more]) for more in (0, BEHIND))
    return not version or b" %s " % v in inside or any(x % v in behind for x in (b" version %s ", b" v%s ", b" v %s "))


class TemplateIndex:
    """Templates with the inverted index of their fingerprints."""

    def __init__(self, templates: Iterable[tuple[str, str, str]] = TEMPLATES, named: Mapping[str, tuple[str, str, str]] = NAMED):
        self.hashes, self.templates, self.named = WordHashes(), [], named
        postings = defaultdict(list)
        for license, name, wording in templates:
            ids = self.hashes.array(tokens_of(wording))
            if len(ids) < SHORTEST:
                raise ValueError(f"template {name} is shorter than {SHORTEST} tokens")
            places, prints = winnow(ids)
            for place, value in zip(places.tolist(), prints.tolist()):
                postings[value].append((len(self.templates), place))
            self.templates.append((license, name, ids, len(places)))
        self.postings = dict(postings)
        self.keys = np.array(sorted(postings), np.uint64)

    def candidates(self, ids: np.ndarray, coverage: float = COVERAGE) -> list[tuple[int, int, int]]:
        """(template, lowest and highest diagonal) of stretches of diagonals with enough hits. A stretch is
        as long as tokens may be missing, and one begins at every diagonal with a hit."""
        places, prints = winnow(ids)
        slot = np.minimum(np.searchsorted(self.keys, prints), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[slot] == prints)
        diagonals = defaultdict(list)
        for k in hit.tolist():
            for template, at in self.postings[int(prints[k])]:
                diagonals[template].append((int(places[k]) - at, at))
        out = []
        for template, found in diagonals.items():
            size, wanted = len(self.templates[template][2]), self.templates[template][3]
            slack, reach = max(2, size // 8), max(2, int((1 - coverage) * size + 1e-9))
            if len({at for _, at in found}) < HIT_SHARE * wanted:
                continue
            found.sort()
            inside, last, past = defaultdict(int), 0, 0
            for k, (diagonal, at) in enumerate(found):
                while last < len(found) and found[last][0] <= diagonal + reach:
                    inside[found[last][1]] += 1
                    last += 1
                # Stretches that hold no more hits than the one before are parts of it.
                if (not k or found[k - 1][0] != diagonal) and last > past and len(inside) >= HIT_SHARE * wanted:
                    out.append((template, diagonal - slack, found[last - 1][0] + slack))
                    past = last
                inside[at] -= 1
                if not inside[at]:
                    del inside[at]
        return out

    def scan(self, text: str, coverage: float = COVERAGE) -> list[Match]:
        """Matches in token places, by place; of overlapping ones that with more matched tokens stays."""
        words = tokens_of(text)
        if len(words) < GRAM:
            return []
        ids = self.hashes.array(words)
        found = []
        for template, low, high in self.candidates(ids, coverage):
            license, name, wording, _ = self.templates[template]
            matched, first, last = align(ids, wording, low, high)
            if matched >= coverage * len(wording) and is_named(words, first, last, *self.named.get(name, ("", "", ""))):
                found.append(Match(license, name, matched / len(wording), first, last, matched))
        # Of equal ones that whose version is known.
        found.sort(key=lambda m: (-m.matched, m.first, not self.named.get(m.template, ("", "", ""))[2], m.template))
        taken, out = np.zeros(len(words), bool), []
        for m in found:
            if not taken[m.first : m.last + 1].any():
                taken[m.first : m.last + 1] = True
                out.append(m)
        return sorted(out, key=lambda m: m.first)


_FOUND = "array<struct<license:string,template:string,coverage:double,start:int,end:int>>"


def scan(docs: DataFrame, templates: Iterable[tuple[str, str, str]] = TEMPLATES, text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """Documents with ``licenses``: for each match the licence, the template, the share of its tokens
    that matched and the span in code points.

    Every text is scanned whole and alone; a missing one counts as empty. A column named ``licenses``
    is replaced, others pass through, and an empty table gives an empty table. Templates are few and
    travel with the job.
    """
    index = TemplateIndex(templates)
    base = docs.select(*[c for c in docs.columns if c.lower() != "licenses"])
    kind = pa.list_(pa.struct([("license", pa.string()), ("template", pa.string()), ("coverage", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for value in batch.column(batch.schema.get_field_index(text)):
                plain = value.as_py() or ""
                matches = index.scan(plain, coverage)
                spans = token_spans(plain) if matches else []
                found.append([{"license": m.license, "template": m.template, "coverage": m.coverage, "start": spans[m.first][0], "end": spans[m.last][1]} for m in matches])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], [*batch.schema.names, "licenses"])

    schema = T.StructType([*base.schema.fields, T.StructField("licenses", T._parse_datatype_string(_FOUND))])
    return base.mapInArrow(run, schema)
