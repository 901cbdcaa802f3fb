"""Periodic runs of words, found from Lyndon roots.

The first phase of a grouping suffix sorter (Baier) puts the suffixes of a sequence into groups that
share their longest Lyndon prefix, so its groups are a Lyndon array together with the equality of the
Lyndon words. Done under the order of the words and under its reverse, it holds a root of every run:
under one of the two orders, each full copy of the run's Lyndon root is the longest Lyndon word of its
place. Equal groups a period apart are therefore copies of one root, and common extension to both
sides makes them whole runs.

Runs of four periods or more repeat each of their three-word windows at least three times. No run
reaches beyond a stretch of such windows, so the sorter works on those stretches alone. Each document
is worked on by itself: no shuffle, and memory in proportion to one text.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_WORDS = 6
LEAST_PERIODS = 4
WINDOW = 3


class _Group:
    """Suffixes that begin with the same word of ``length`` items, between the next smaller and larger groups."""

    __slots__ = ("length", "members", "below", "above")

    def __init__(self, length: int, members: list[int]):
        self.length, self.members = length, members
        self.below: _Group | None = None
        self.above: _Group | None = None


def lyndon_groups(items: list[int]) -> tuple[list[int], list[int]]:
    """For each place the length of the longest Lyndon word that starts there, and a number that two
    places share if and only if those words are equal.

    Groups start as the places of one item and are taken from the largest down. A waiting place whose
    word ends where a word of the taken group starts grows by that word and by the copies of it that
    follow, and moves to a group above its old one: the more copies, the higher. Every place taken
    moves at most one other, so there are at most as many moves as items.
    """
    n = len(items)
    at_item: dict[int, list[int]] = {}
    for at, item in enumerate(items):
        at_item.setdefault(item, []).append(at)
    top: _Group | None = None
    home: list[_Group | None] = [None] * n
    for item in sorted(at_item):
        group = _Group(1, at_item[item])
        group.below, top = top, group
        if group.below is not None:
            group.below.above = group
        for at in group.members:
            home[at] = group
    # The places not taken yet as a linked list, with -1 and n for its ends.
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    lengths, names, name = [0] * n, [0] * n, 0
    while top is not None:
        group, top = top, top.below
        if top is not None:
            top.above = None
        copies: dict[int, int] = {}
        for at in sorted(at for at in group.members if home[at] is group):
            lengths[at], names[at] = group.length, name
            left, right = before[at], after[at]
            if right < n:
                before[right] = left
            if left >= 0:
                after[left] = right
                copies[left] = copies.get(left, 0) + 1
        name += 1
        grown: dict[tuple[int, int], list[int]] = {}
        for at, count in copies.items():
            grown.setdefault((count, id(home[at])), []).append(at)
        for (count, _), moved in sorted(grown.items(), reverse=True):
            old = home[moved[0]]
            new = _Group(old.length + count * group.length, moved)
            new.below, new.above, old.above = old, old.above, new
            if new.above is None:
                top = new
            else:
                new.above.below = new
            for at in moved:
                home[at] = new
    return lengths, names


def _extent(items: list[int], start: int, end: int, period: int) -> tuple[int, int]:
    """The widest stretch around [start, end) that keeps the period."""
    while start > 0 and items[start - 1] == items[start - 1 + period]:
        start -= 1
    while end < len(items) and items[end] == items[end - period]:
        end += 1
    return start, end


def _runs_of(items: list[int], periods: int) -> set[tuple[int, int, int]]:
    """(start, length, period) of all runs of so many periods or more."""
    found = set()
    for order in (items, [-item for item in items]):
        lengths, names = (np.array(x) for x in lyndon_groups(order))
        # A run of k whole periods has k - 1 copies of its root at least.
        places = np.arange(len(items))
        chained = np.ones(len(items), bool)
        for k in range(1, periods - 1):
            there = places + k * lengths
            chained &= there < len(items)
            chained[chained] = names[there[chained]] == names[chained]
        for start in np.flatnonzero(chained).tolist():
            period = int(lengths[start])
            if start >= period and names[start - period] == names[start]:
                continue  # a later copy of the same chain
            end = start + period
            while end < len(items) and names[end] == names[start]:
                end += period
            first, last = _extent(items, start, min(end, len(items)), period)
            if last - first >= periods * period:
                found.add((first, last - first, period))
    return found


def find_runs(items: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of numbers, by start, then period.

    A run is a stretch of ``least`` items or more and of ``periods`` (3 or more) periods or more that keeps
    its smallest period and that no neighbour extends.
    """
    if periods < 3:
        raise ValueError("periods must be 3 or more")
    n = len(items)
    if n < max(least, periods):
        return []
    runs: set[tuple[int, int, int]] = set()
    marked = np.zeros(n, bool)
    if n > WINDOW:
        # Windows as exact numbers: items, then pairs, then triples numbered anew.
        windows = np.unique(items, return_inverse=True)[1]
        singles = windows
        for k in range(1, WINDOW):
            windows = windows[:-1] * n + singles[k:]
            windows = np.unique(windows, return_inverse=True)[1]
        # How often a run repeats each window: of one word, as long as it is; else once less than its periods.
        often = np.bincount(windows)[windows] >= min(periods - 1, max(least, periods) - WINDOW + 1)
        for k in range(WINDOW):
            marked[k : k + len(often)] |= often
    else:
        marked[:] = True
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if end - start >= max(least, periods):
            for at, length, period in _runs_of(np.unique(items[start:end], return_inverse=True)[1].tolist(), periods):
                if length >= least:
                    runs.add((start + at, length, period))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def folded(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a document in which a tenth of all ids repeat a few of theirs to the end.

    With h the crc32 of the id in decimal and g = h // 10, a text with h % 10 = 0 has from word
    a = g % n on the words a to a + p - 1 over and over, p = 1 + (n - a) // (3 + g % 8).
    """
    if doc_id is None or not words:
        return words
    digest = crc32(str(doc_id).encode())
    if digest % 10:
        return words
    g, n = digest // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    root = words[a : a + p]
    return words[:a] + (root * (-(-(n - a) // p)))[: n - a]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that lie in a run after its first period."""
    if not runs:
        return words
    dropped = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    keep = np.cumsum(dropped[:-1]) == 0
    return [words[k] for k in np.flatnonzero(keep).tolist()]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact number of periods; the first, then shortest period on a tie."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


RESULT = "runs array<struct<start:bigint,length:bigint,period:bigint>>, strongest struct<start:bigint,length:bigint,period:bigint>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_WORDS_HELD = 2_000_000


def _numbers(words: list[bytes], memo: dict[bytes, int]) -> np.ndarray:
    """Equal words get equal numbers, different ones different."""
    if len(memo) > _WORDS_HELD:
        memo.clear()
    return np.fromiter((memo.setdefault(w, len(memo)) for w in words), np.int64, len(words))


def _detect(key: str, text: str, fold: bool, least: int, periods: int):
    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, int] = {}
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(key))
            values = batch.column(batch.schema.get_field_index(text))
            runs, best, rests = [], [], []
            shown = lambda run: dict(zip(("start", "length", "period"), run)) if run else None
            for doc_id, value in zip(ids, values):
                words = (value.as_py() or "").encode("utf-8", "surrogatepass").split()
                if fold:
                    words = folded(words, doc_id.as_py())
                found = find_runs(_numbers(words, memo), least, periods)
                runs.append([shown(run) for run in found])
                best.append(shown(strongest(found)))
                rests.append(b" ".join(collapsed(words, found)).decode("utf-8", "replace"))
            arrays = [ids, pa.array(runs, pa.list_(_RUN)), pa.array(best, _RUN), pa.array(rests, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["_key", "runs", "strongest", "collapsed"])

    return detect


def detect_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", fold: bool = False, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> DataFrame:
    """Per document its id, its ``runs`` (start, length, period in words), the ``strongest`` of them, that
    with most periods, or NULL, and the ``collapsed`` text.

    Words are runs of anything but ASCII white space, compared as they are. A run is a stretch of
    ``least`` words and ``periods`` of its smallest periods at least that no neighbouring word extends. The
    collapsed text is the words, joined by one space, without those that follow the first period of a
    run. With ``fold`` the words are those of ``folded``, where ids are whole numbers. Missing, empty and
    blank texts have no words, no runs and '' left; a missing id folds nothing. Repeated rows and ids are
    all returned; an empty table gives an empty table; other columns are not read.
    """
    schema = f"_key {docs.schema[key].dataType.simpleString()}, {RESULT}"
    found = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(_detect("_key", "_text", fold, least, periods), schema)
    return found.withColumnRenamed("_key", key)

