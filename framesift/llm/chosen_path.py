"""MinHash near-duplicate groups by a chosen-path similarity join.

Every document has ``COORDINATES`` minwise tokens of its set of shingles. A tree branches documents: its
root, and each node with many documents, chooses one or two coordinates, a little more than
1 / similarity on average, and sends each document on to the children named by its tokens there. Two
documents as similar as wanted are expected to meet in at least one child of each node they share, so
their chance to part grows slowly with the depth, while documents that are not alike part at once. Nodes with few documents are compared
exhaustively, and independent trees are repeated until the chance that all of them part a pair is
negligible. Whole sets confirm every link.

Equal sets are one document from the start. Before nodes are compared, each document is held against the
heads of its nodes and linked with the one most like it: first heads drawn at random, then the members
that all others resemble most, such as the text that a group was copied from. That is linear in the
documents and joins most large groups. Only nodes with several components are then compared or
branched further, a share of the small ones first, and never the documents of a node's largest
component with each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framesift.llm.bits import bit_vector, may_hold
from framesift.llm.common import WordHashes, grams, mix64, plain_words
from framesift.llm.components import components, merged
from framesift.session import materialise

GRAM = 3
PERCENT = 85
TREES = 12
DEPTH = 5
SMALL = 32
# A share of the nodes is compared first, so that the others find most links already made.
FIRST_SHARE = 4
COORDINATES = 112
# Nodes branch for pairs whose tokens agree this many standard deviations less than wanted.
SPARE_DEVIATIONS = 2
# A pair is confirmed on whole sets unless its tokens agree this many standard deviations less than wanted.
DEVIATIONS = 4
# Whether each of so many hash slots holds an odd number of shingles: two sets differ in as many shingles
# as slots at least, so this bounds their similarity for sure.
_SLOTS = 1024
# Eight bits of the first tokens for a first comparison, seven to a number; the eighth byte stays free.
_PER_LANE, _LANES = 7, 8
COMPARED = _PER_LANE * _LANES
_LOW_BITS, _HIGH_BITS = 0x007F7F7F7F7F7F7F, 0x0080808080808080
_SEEN = [*[f"s{k}" for k in range(_LANES)], *[f"b{k}" for k in range(_SLOTS // 64)]]
_CHUNK = 4096
_OUT_ROWS = 1024


def _odd(seed: int, n: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) | np.uint64(1)


def minwise(tokens: np.ndarray) -> np.ndarray:
    """The smallest hash of a set under each of ``COORDINATES`` hash functions, as 32-bit numbers."""
    best = np.full(COORDINATES, np.iinfo(np.uint64).max)
    factors, shifts = _odd(1 << 40, COORDINATES), _odd(2 << 40, COORDINATES)
    for at in range(0, len(tokens), _CHUNK):
        best = np.minimum(best, (tokens[at : at + _CHUNK, None] * factors + shifts).min(axis=0))
    return (best >> np.uint64(32)).astype(np.uint32)


def odd_slots(tokens: np.ndarray) -> np.ndarray:
    """A bit per hash slot, as 64-bit numbers."""
    counts = np.bincount((mix64(tokens) & np.uint64(_SLOTS - 1)).astype(np.int64), minlength=_SLOTS)
    return np.packbits(counts & 1).view("<i8")


def children(paths: np.ndarray, tokens: np.ndarray, choices: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child) of documents, given by their ``tokens``, at nodes that choose one or two coordinates,
    ``choices`` on average. What a node chooses depends on its path alone."""
    drawn = mix64(paths ^ np.uint64(0x5851F42D4C957F2D))
    first = (drawn & np.uint64(0xFFFF)) % np.uint64(COORDINATES)
    second = (first + np.uint64(1) + ((drawn >> np.uint64(16)) & np.uint64(0xFFFF)) % np.uint64(COORDINATES - 1)) % np.uint64(COORDINATES)
    both = (drawn >> np.uint64(40)) < np.uint64(int((choices - 1) * (1 << 24)))
    rows = np.arange(len(paths))
    rows, chosen = np.concatenate([rows, rows[both]]), np.concatenate([first, second[both]])
    values = tokens[rows, chosen.astype(np.int64)].astype(np.uint64)
    return rows, mix64(mix64(paths[rows] + (chosen << np.uint64(32))) ^ (values + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _shingles(text: str | None, memo: WordHashes, gram: int) -> np.ndarray:
    return np.unique(grams(memo.array(plain_words(text or "")), gram))


def _sign(gram: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        memo = WordHashes()
        for whole in batches:
            for at in range(0, whole.num_rows, _OUT_ROWS):
                batch = whole.slice(at, _OUT_ROWS)
                sizes, digests, tokens, lanes = [], [], [], []
                for value in batch.column(1):
                    found = _shingles(value.as_py(), memo, gram)
                    least = minwise(found)
                    sizes.append(len(found))
                    digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                    tokens.append(least.view(np.int32))
                    low = np.pad((least[:COMPARED] & np.uint32(0xFF)).astype(np.uint8).reshape(_LANES, _PER_LANE), ((0, 0), (0, 1)))
                    lanes.append(np.concatenate([low.reshape(-1).view("<i8"), odd_slots(found)]))
                arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), _lists(tokens, pa.int32()), _lists(lanes, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["_key", "n", "digest", "tokens", "lanes"])

    return sign


def _branch(choices: float, trees: int):
    """Children of (path, node, tokens) rows; of the roots of all trees where there is no path."""

    def branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = mix64(np.arange(1, trees + 1, dtype=np.uint64))
        for batch in batches:
            tokens = batch.column(2).flatten().to_numpy().view(np.uint32).reshape(-1, COORDINATES)
            nodes = batch.column(1).to_numpy()
            if batch.column(0).null_count:
                paths, at = np.tile(roots, len(nodes)), np.repeat(np.arange(len(nodes)), trees)
            else:
                paths, at = batch.column(0).to_numpy().view(np.uint64), np.arange(len(nodes))
            rows, found = children(paths, tokens[at], choices)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(nodes[at[rows]])], ["path", "node"])

    return branch


def _sets(wanted, gram: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for whole in batches:
            kept = whole.filter(pa.array(may_hold(wanted.value, whole.column(2).to_numpy().view(np.uint64))))
            for at in range(0, kept.num_rows, _OUT_ROWS):
                batch = kept.slice(at, _OUT_ROWS)
                found = [_shingles(v.as_py(), memo, gram).view(np.int64) for v in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), _lists(found, pa.int64())], ["node", "shingles"])

    return sets


class ChosenPathJoin:
    """One join over a table of documents; see ``near_duplicates``."""

    def __init__(self, docs: DataFrame, key: str, text: str, gram: int, percent: int, trees: int, depth: int, small: int):
        if not 50 < percent <= 100 or trees < 1 or depth < 1 or small < 2:
            raise ValueError("percent must lie in (50, 100], trees and depth be 1 or more, small 2 or more")
        self.gram, self.percent, self.trees, self.depth, self.small = gram, percent, trees, depth, small
        share = percent / 100
        self.most_differing = COMPARED - math.floor(COMPARED * share - DEVIATIONS * math.sqrt(COMPARED * share * (1 - share)))
        self.choices = min(2.0, 1 / (share - SPARE_DEVIATIONS * math.sqrt(share * (1 - share) / COORDINATES)))
        self.docs = docs.select(F.col(key).cast("bigint").alias("_key"), F.col(text).alias("_text"))
        signed = self.docs.mapInArrow(_sign(gram), "_key bigint, n bigint, digest binary, tokens array<int>, lanes array<bigint>")
        self.signed = materialise(signed, "signed")
        named = self.signed.filter(F.col("_key").isNotNull() & (F.col("n") > 0))
        first = named.groupBy("digest").agg(F.min(F.struct("_key", "n", "tokens", "lanes")).alias("s"))
        self.nodes = materialise(first.select("digest", F.col("s._key").alias("node"), "s.n", "s.tokens", *[F.get("s.lanes", k).alias(c) for k, c in enumerate(_SEEN)]), "nodes")
        self.tried: DataFrame | None = None
        self.grouped: DataFrame | None = None

    def _shown(self, *more: str) -> DataFrame:
        """What a comparison needs of each node."""
        return self.nodes.select("node", "n", *_SEEN, *more)

    def _parts(self) -> DataFrame:
        """Nodes with the component each is known to be in."""
        if self.grouped is None:
            return self.nodes.select("node", F.col("node").alias("part")).distinct()
        return self.nodes.select("node").distinct().join(self.grouped, "node", "left").select("node", F.coalesce("component", "node").alias("part"))

    def _branched(self, rows: DataFrame) -> DataFrame:
        """The children of (path, node) rows that hold more than one node."""
        asked = rows.join(self.nodes.select("node", "tokens"), "node").select("path", "node", "tokens")
        placed = materialise(asked.mapInArrow(_branch(self.choices, self.trees), "path bigint, node bigint"), "paths")
        held = placed.groupBy("path").agg(F.count(F.lit(1)).alias("held")).filter("held > 1").select("path")
        return materialise(placed.join(held, "path", "left_semi"), "paths")

    def _differing(self, x: str, y: str) -> Column:
        """How many of the minwise tokens of two nodes differ, seen by eight bits of each."""
        total = F.lit(0)
        for k in range(_LANES):
            apart = F.col(f"{x}s{k}").bitwiseXOR(F.col(f"{y}s{k}"))
            # A byte's high bit is set, by itself or by a carry from below, unless the byte is zero.
            carried = apart.bitwiseAND(F.lit(_LOW_BITS)) + F.lit(_LOW_BITS)
            total = total + F.bit_count(carried.bitwiseOR(apart).bitwiseAND(F.lit(_HIGH_BITS)))
        return total

    def _may_link(self, x: str, y: str) -> Column:
        """Whether two sets may be similar enough by their odd slots."""
        apart = F.lit(0)
        for k in range(_SLOTS // 64):
            apart = apart + F.bit_count(F.col(f"{x}b{k}").bitwiseXOR(F.col(f"{y}b{k}")))
        # Similarity s of sets of together t shingles means (1 - s) / (1 + s) * t differing ones at most.
        return (100 + self.percent) * apart <= (100 - self.percent) * (F.col(f"{x}n") + F.col(f"{y}n"))

    def _sizes_fit(self, x: str, y: str) -> Column:
        return (100 * F.col(x) >= self.percent * F.col(y)) & (100 * F.col(y) >= self.percent * F.col(x))

    def _confirmed(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b), a < b, not tried before, whose whole sets are similar enough.

        The sets of the documents in question are made again from their texts. A bit vector of their ids
        keeps other texts out, so texts are not shuffled.
        """
        pairs = pairs.distinct()
        if self.tried is not None:
            pairs = pairs.join(self.tried, ["a", "b"], "left_anti")
        pairs = materialise(pairs.select("a", "b"), "pairs")
        self.tried = pairs if self.tried is None else self.tried.union(pairs)
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct().select(F.xxhash64("node").alias("node"))
        wanted = self.docs.sparkSession.sparkContext.broadcast(bit_vector(ends, "node"))
        named = self.docs.filter(F.col("_key").isNotNull()).select("_key", "_text", F.xxhash64("_key").alias("hash"))
        sets = materialise(named.mapInArrow(_sets(wanted, self.gram), "node bigint, shingles array<bigint>"), "sets")
        side = lambda end: sets.select(F.col("node").alias(end), F.col("shingles").alias(f"of_{end}"))
        whole = pairs.join(side("a"), "a").join(side("b"), "b")
        shared = F.size(F.array_intersect("of_a", "of_b"))
        similar = (shared > 0) & (100 * shared >= self.percent * (F.size("of_a") + F.size("of_b") - shared))
        return materialise(whole.filter(similar).select("a", "b"), "links")

    def _link(self, pairs: DataFrame) -> None:
        found = self._confirmed(pairs)
        grouped = components(found) if self.grouped is None else merged(self.grouped, found)
        self.grouped = materialise(grouped, "components")

    def _against_heads(self, rows: DataFrame, weight: Column) -> DataFrame:
        """How each of the rows (path, node, part, ...) compares with the head of its path, the node of largest weight."""
        head = F.struct(weight.alias("weight"), *[F.col(c) for c in ("node", "n", "part", *_SEEN)])
        heads = rows.groupBy("path").agg(F.max(head).alias("h"), F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q")
        named = heads.select("path", F.col("h.node").alias("head"), F.col("h.n").alias("head_n"), F.col("h.part").alias("head_part"), *[F.col(f"h.{c}").alias(f"head_{c}") for c in _SEEN])
        met = rows.join(named, "path").filter("part <> head_part")
        linkable = self._sizes_fit("n", "head_n") & self._may_link("", "head_")
        return met.select("node", "head", self._differing("", "head_").alias("differing"), linkable.alias("linkable"))

    def _likest_heads(self, met: DataFrame) -> DataFrame:
        near = met.filter(F.col("linkable") & (F.col("differing") <= self.most_differing))
        best = near.groupBy("node").agg(F.min(F.struct("differing", "head")).alias("best"))
        return best.select(F.least("node", "best.head").alias("a"), F.greatest("node", "best.head").alias("b"))

    def _join_heads(self, rows: DataFrame) -> None:
        """Links each node with the likest of the random heads of its paths, and of the most central nodes, those
        that differ least from the random heads they met."""
        known = lambda: rows.join(self._shown(), "node").join(self._parts(), "node")
        met = materialise(self._against_heads(known(), F.xxhash64("path", "node")), "met")
        central = met.groupBy("node").agg((-F.sum("differing") / F.count(F.lit(1))).alias("weight"))
        weighed = known().join(central, "node", "left")
        headed = self._against_heads(weighed, F.coalesce("weight", F.lit(-float(COMPARED))))
        self._link(self._likest_heads(met).union(self._likest_heads(headed)))

    def _mixed(self, rows: DataFrame) -> DataFrame:
        """Rows (path, node) of paths with several components, with the component and the number of rows of the path."""
        placed = rows.join(self._parts(), "node")
        held = placed.groupBy("path").agg(F.count(F.lit(1)).alias("held"), F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q").select("path", "held")
        return placed.join(held, "path").select("path", "node", "part", "held")

    def _compared(self, rows: DataFrame) -> DataFrame:
        """All pairs of different components in each path's rows (path, node, part) whose tokens agree enough.

        The members of the largest component are compared with those of the others only.
        """
        members = rows.groupBy("path", "part").agg(F.count(F.lit(1)).alias("members"))
        largest = members.groupBy("path").agg(F.max_by("part", F.struct("members", "part")).alias("largest"))
        shown = rows.join(self._shown(), "node").join(largest, "path")
        side = lambda end: [F.col(c).alias(f"{end}_{c}") for c in ("path", "node", "n", "part", *_SEEN)]
        once = (F.col("b_part") == F.col("largest")) | (F.col("a_node") < F.col("b_node"))
        close = once & (F.col("a_part") != F.col("b_part")) & self._sizes_fit("a_n", "b_n") & (self._differing("a_", "b_") <= self.most_differing) & self._may_link("a_", "b_")
        met = shown.filter("part <> largest").select(*side("a")).join(shown.select("largest", *side("b")), (F.col("a_path") == F.col("b_path")) & close)
        return met.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b"))

    def groups(self) -> DataFrame:
        """(_key, n, component) per document."""
        rows = self._branched(self.nodes.select(F.lit(None).cast("bigint").alias("path"), "node").distinct())
        self._join_heads(rows)
        leaves = None
        for level in range(1, self.depth + 1):
            mixed = materialise(self._mixed(rows), "mixed")
            few = F.col("held") <= self.small if level < self.depth else F.lit(True)
            found = mixed.filter(few).select("path", "node")
            leaves = found if leaves is None else leaves.union(found)
            if level < self.depth:
                rows = self._branched(mixed.filter(~few).select("path", "node"))
        for chosen in (F.pmod("path", F.lit(FIRST_SHARE)) == 0, F.lit(True)):
            self._link(self._compared(self._mixed(leaves.filter(chosen)).select("path", "node", "part")))
        component = self.nodes.select("digest", "node").join(self.grouped, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
        linked = F.col("_key").isNotNull() & (F.col("n") > 0)
        return self.signed.select("_key", "n", "digest").join(component, "digest", "left").select("_key", "n", F.when(linked, F.col("component")).otherwise(F.col("_key")).alias("component"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", gram: int = GRAM, percent: int = PERCENT, trees: int = TREES, depth: int = DEPTH, small: int = SMALL) -> DataFrame:
    """Per document: its id, ``n_shingles``, ``component_id``, the smallest id reachable by links, and
    ``kept``, whether it is that document.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Two documents link when
    100 * shared shingles >= ``percent`` * shingles of both. A text of fewer words than a shingle is one
    shingle; empty and missing texts have none and link with nothing. Rows without an id are returned with
    their size, no component and ``kept`` true, and link with nothing. Repeated rows are all returned; rows
    that share an id are one document, linked by any of their texts. An empty table gives an empty table;
    other columns are not read.

    A pair of exactly the wanted similarity shares a node of one tree of five levels with a chance of
    about 0.7, of 0.5 if its tokens agree as rarely as once in a thousand pairs; more if its nodes are
    small. All twelve trees together miss it about once in a million times, and its tokens seem too
    different to be confirmed once in thirty thousand times. More similar pairs are missed less.
    """
    grouped = ChosenPathJoin(docs, key, text, gram, percent, trees, depth, small).groups()
    kept = F.coalesce(F.col("_key") == F.col("component"), F.lit(True)).alias("kept")
    return grouped.select(F.col("_key").alias(key), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), kept)
