"""N-gram Jaccard join with prefix filters under several global orders.

Two sets of word shingles that are similar enough share a token among the first few of both, whatever
order the tokens are put in. Candidates must share one under each of several orders; only then are
whole sets compared. All orders put common tokens last, so shared passages do not make candidates;
among tokens of one class of frequency each order is an own permutation.

Texts with equal sets are one node from the start. Links are sought in rounds: first every node is
compared with a few nodes of the groups that share its leading tokens, by size and then those that the
others of the group resemble most, which joins most large groups of copies in linear work. Copies with
changes of their own lead with these, as they are rare; so tokens that lead regardless of frequency make
groups too, two at a time. Then all
remaining pairs between different components are sought through every prefix token of the first order, and
held against those of the others. Nothing is lost: pairs inside a component cannot change the components.

Large sets are cut into classes by a hash of the token. Of two similar sets the tokens of at least one
class are as similar, so the first order is sought class by class, with sketches that no size saturates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framesift.llm.common import grams, mix64, small_batches, texts, word_hashes
from framesift.llm.components import components
from framesift.session import materialise, release_shuffles, scratch

GRAM = 3
PERCENT = 90
ORDERS = 2
LEADS = 4
BROADCAST_ROWS = 100_000
SKETCH_WORDS = 16
CENTRAL_ROUNDS = 2
PIECE = 2048
BEFORE = 3
COUNTERS = 1 << 20
FAN_IN = 64


def shingle_set(text: str, n: int = GRAM) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles; of the whole text where it is shorter."""
    return np.unique(grams(word_hashes(text), n))


def _count(text: str, gram: int):
    """Counts tokens into a fixed number of counters, one vector per task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, waiting, held = np.zeros(COUNTERS, np.int64), [], 0
        for batch in batches:
            for value in texts(batch, text):
                slots = shingle_set(value, gram) & np.uint64(COUNTERS - 1)
                waiting.append(slots)
                held += len(slots)
                if held > COUNTERS:
                    totals += np.bincount(np.concatenate(waiting).astype(np.int64), minlength=COUNTERS)
                    waiting, held = [], 0
        if waiting:
            totals += np.bincount(np.concatenate(waiting).astype(np.int64), minlength=COUNTERS)
        yield pa.RecordBatch.from_arrays([pa.array([totals.astype(np.uint32).tobytes()], pa.binary())], ["counts"])

    return count


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = np.zeros(COUNTERS, np.uint32)
    for batch in batches:
        for value in batch.column(0):
            part = np.frombuffer(value.as_py(), np.uint32)
            totals += np.minimum(part, np.uint32(0xFFFFFFFF) - totals)
    yield pa.RecordBatch.from_arrays([pa.array([totals.tobytes()], pa.binary())], ["counts"])


def frequency_classes(docs: DataFrame, text: str = "text", gram: int = GRAM) -> np.ndarray:
    """A class for each of ``COUNTERS`` hash slots: 0 up to twice the mean load, then one per doubling.

    The only thing that reaches the driver is this vector of fixed size. Tasks add theirs up in levels
    of ``FAN_IN``. Any vector gives right results, as every order is the same for all sets.
    """
    counts = docs.select(text).mapInArrow(_count(text, gram), "counts binary")
    parts = counts.rdd.getNumPartitions()
    while parts > 1:
        parts = -(-parts // FAN_IN)
        counts = counts.repartition(parts).mapInArrow(_add, "counts binary")
    rows = counts.collect()
    loads = np.frombuffer(rows[0][0], np.uint32).astype(np.float64) if rows else np.zeros(COUNTERS)
    mean = max(loads.mean(), 1.0)
    return np.clip(np.floor(np.log2(np.maximum(loads, 1.0) / mean)), 0, 63).astype(np.uint8)


def _places(tokens: np.ndarray, classes: np.ndarray, orders: int) -> np.ndarray:
    """Places of tokens in each global order, a row per order: by class, then by a permutation of its own."""
    level = classes[tokens & np.uint64(COUNTERS - 1)].astype(np.uint64) << np.uint64(56)
    own = np.array([0xA24BAED4963EE407 * (order + 1) & 0xFFFFFFFFFFFFFFFF for order in range(orders)], np.uint64)
    return level | (mix64(tokens ^ own[:, None]) >> np.uint64(8))


def prefix(tokens: np.ndarray, places: np.ndarray, percent: int) -> np.ndarray:
    """The first tokens of an order, of which every similar set must hold one.

    Up to and including the last place, so that equal places are all in or all out.
    """
    n = len(tokens)
    size = n - -(-percent * n // 100) + 1
    return tokens[places <= np.partition(places, size - 1)[size - 1]] if n else tokens


def _leads(tokens: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The first tokens under each order, then those under the same permutations regardless of classes."""
    if not len(tokens):
        return np.zeros(2 * LEADS, np.int64)
    plain = places[:LEADS] & np.uint64((1 << 56) - 1)
    return tokens[np.concatenate([places[:LEADS].argmin(axis=1), plain.argmin(axis=1)])].view(np.int64)


def _odd(mixed: np.ndarray, slots: int) -> np.ndarray:
    """A bit per slot, set where an odd number of mixed tokens fell into it."""
    return np.packbits(np.bincount((mixed & np.uint64(slots - 1)).view(np.int64), minlength=slots) & 1)


def parity_bits(tokens: np.ndarray, mixed: np.ndarray | None = None) -> bytes:
    """A bit per hash slot, set where it got an odd number of tokens; a power of two, twice the tokens
    or more. Two sets differ in at least as many tokens as their bits do."""
    return _odd(mix64(tokens) if mixed is None else mixed, 1 << max(6, int(2 * len(tokens) - 1).bit_length())).tobytes()


def sketch(tokens: np.ndarray, mixed: np.ndarray | None = None) -> np.ndarray:
    """Parity bits of a fixed number of slots, as 64-bit words that a join can compare."""
    return _odd(mix64(tokens) if mixed is None else mixed, 64 * SKETCH_WORDS).view(np.int64)


def _cut(mixed: np.ndarray, percent: int) -> list[tuple[int, np.ndarray | None]]:
    """The classes of ``pieces`` as (level, which tokens); None stands for all."""
    level = lambda n: max(0, int(n - 1) // PIECE).bit_length()
    out, n = [], len(mixed)
    for k in sorted({level(n), level(100 * n // percent)}) if n else []:
        if k == 0:
            out.append((0, None))
            continue
        classes = mixed >> np.uint64(64 - k)
        out += [(k, classes == c) for c in np.unique(classes)]
    return out


def pieces(tokens: np.ndarray, percent: int) -> list[tuple[int, np.ndarray]]:
    """Classes of a set by a hash of the token, as (level, tokens): 2^level classes, so many that ``PIECE``
    tokens a class are enough. A set that can be similar to one of the next level has its classes too."""
    return [(level, tokens if own is None else tokens[own]) for level, own in _cut(mix64(tokens), percent)]


def bits_allow(x: bytes, y: bytes, size_x: int, size_y: int, percent: int) -> bool:
    """Whether sets of these bits and sizes can be similar enough."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    differing = int(np.bitwise_count(a ^ b).sum())
    # Similarity s of sets of together t tokens means (1 - s) / (1 + s) * t differing ones at most.
    return (100 + percent) * differing <= (100 - percent) * (size_x + size_y)


def _bit_filter(percent: int):
    def allowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n_a, n_b, x, y = batch.columns
            rows = zip(n_a.to_pylist(), n_b.to_pylist(), x.to_pylist(), y.to_pylist())
            keep = pa.array([bits_allow(p, q, n, m, percent) for n, m, p, q in rows], pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], ["a", "b"])

    return allowed


def _lists(arrays: list[np.ndarray], kind: type = np.int64) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays).view(kind) if arrays else np.empty(0, kind)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _sign(key: str, text: str, packed_classes: bytes, percent: int, orders: int, gram: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        import xxhash

        classes = np.frombuffer(zlib.decompress(packed_classes), np.uint8)
        for batch in batches:
            sizes, digests, bits, sketches, leads, parts = [], [], [], [], [], [[] for _ in range(orders - 1)]
            counts, piece_sizes, piece_sketches, piece_prefixes = [], [], [], []
            for value in texts(batch, text):
                tokens = shingle_set(value, gram)
                mixed, places = mix64(tokens), _places(tokens, classes, max(orders, LEADS))
                sizes.append(len(tokens))
                digests.append(xxhash.xxh3_128_digest(tokens.tobytes()))
                bits.append(parity_bits(tokens, mixed))
                sketches.append(sketch(tokens, mixed))
                for k in range(1, orders):
                    parts[k - 1].append(prefix(tokens, places[k], percent).astype(np.uint32))
                leads.append(_leads(tokens, places))
                cut = _cut(mixed, percent)
                counts.append(len(cut))
                for level, which in cut:
                    own, at = (tokens, places[0]) if which is None else (tokens[which], places[0][which])
                    begun = prefix(own, at, percent)
                    piece_sizes.append(len(own))
                    piece_sketches.append(sketch(own, mixed[which]) if level else None)
                    piece_prefixes.append(mix64(begun + np.uint64(level)) if level else begun)
            ids = batch.column(batch.schema.get_field_index(key))
            cuts = pa.StructArray.from_arrays([pa.array(piece_sizes, pa.int64()), pa.array(piece_sketches, pa.list_(pa.int64())), _lists(piece_prefixes)], ["n", "sketch", "prefix"])
            cuts = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), cuts)
            arrays = [ids, pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bits, pa.binary()), pa.array(sketches, pa.list_(pa.int64())), pa.array(leads, pa.list_(pa.int64())), cuts, *[_lists(p, np.int32) for p in parts]]
            yield pa.RecordBatch.from_arrays(arrays, [key, "n", "digest", "bits", "sketch", "leads", "pieces", *[f"p{k}" for k in range(1, orders)]])

    return sign


def _sets(key: str, text: str, gram: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [shingle_set(v, gram) for v in texts(batch, text)]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(key)), _lists(tokens)], ["node", "tokens"])

    return sets


def _verify(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, left, right = (batch.column(k) for k in range(4))
            keep = []
            for k in range(batch.num_rows):
                x, y = left[k].values.to_numpy(), right[k].values.to_numpy()
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(shared > 0 and 100 * shared >= percent * (len(x) + len(y) - shared))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], ["a", "b"])

    return verify


class JaccardJoin:
    """One join over a table of documents; see ``near_groups``."""

    def __init__(self, docs: DataFrame, key: str, text: str, gram: int, percent: int, orders: int, write: Callable[[DataFrame, str], DataFrame] = materialise):
        import zlib

        if not 50 < percent <= 100 or orders < 1:
            raise ValueError("percent must lie in (50, 100], orders must be 1 or more")
        self.percent, self.gram, self.orders, self.write = percent, gram, orders, write
        self.docs = docs.select(F.col(key).cast("bigint").alias("_key"), F.col(text).alias("_text"))
        packed = zlib.compress(frequency_classes(self.docs, "_text", gram).tobytes(), 1)
        lists = "".join(f", p{k} array<int>" for k in range(1, orders))
        signed = self.docs.mapInArrow(_sign("_key", "_text", packed, percent, orders, gram), f"_key bigint, n bigint, digest binary, bits binary, sketch array<bigint>, leads array<bigint>, pieces array<struct<n: bigint, sketch: array<bigint>, prefix: array<bigint>>>{lists}")
        self.signed = write(signed, "signed")
        self.named = self.signed.filter(F.col("_key").isNotNull() & (F.col("n") > 0))
        first = self.named.groupBy("digest").agg(F.min(F.struct("_key", "n", "bits", "sketch", *[F.get("leads", k).alias(f"l{k}") for k in range(2 * LEADS)])).alias("s"))
        self.nodes = write(first.select("digest", F.col("s._key").alias("node"), "s.n", "s.bits", "s.sketch", *[f"s.l{k}" for k in range(2 * LEADS)]), "nodes")
        release_shuffles(docs.sparkSession)

    def _sizes_fit(self, x: str, y: str):
        return (100 * F.col(x) >= self.percent * F.col(y)) & (100 * F.col(y) >= self.percent * F.col(x))

    def _of(self, ids: DataFrame, table: DataFrame) -> DataFrame:
        """Rows of a table with one of some ids (_key), which are broadcast while they are few."""
        if ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
            ids = F.broadcast(ids)
        return table.join(ids, "_key", "left_semi")

    @staticmethod
    def _ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("_key")).union(pairs.select(F.col("b").alias("_key"))).distinct()

    def links(self, candidates: DataFrame, write: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
        """Those of the candidate pairs (a, b) whose whole sets are similar enough.

        Parity bits rule out most pairs that are merely alike before whole sets move.
        The sets of the documents in question are made again from their texts. Their ids are broadcast
        while they are few; beyond that the texts are shuffled to them.
        """
        side = lambda end: self.nodes.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("bits").alias(f"bits_{end}"))
        known = candidates.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
        near = write(known.mapInArrow(_bit_filter(self.percent), "a bigint, b bigint"), "candidates")
        wanted = self._of(write(self._ends(near), "wanted"), self.docs)
        sets = write(wanted.mapInArrow(_sets("_key", "_text", self.gram), "node bigint, tokens array<bigint>"), "sets")
        whole = near.join(sets.withColumnsRenamed({"node": "a", "tokens": "left"}), "a").join(sets.withColumnsRenamed({"node": "b", "tokens": "right"}), "b")
        found = whole.select("a", "b", "left", "right").mapInArrow(_verify(self.percent), "a bigint, b bigint")
        return write(found, "found")

    def _parts(self, grouped: DataFrame) -> DataFrame:
        """Nodes with the component each is known to be in."""
        return self.nodes.join(grouped, "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component")

    @staticmethod
    def _plain_keys() -> list[Column]:
        """Keys of any two of the leads regardless of classes. Texts that are alike share many of these, others
        of the same passages few."""
        return [F.xxhash64(F.lit(j), F.lit(k), f"l{j}", f"l{k}") for j, k in combinations(range(LEADS, 2 * LEADS), 2)]

    def leading_candidates(self, write: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
        """Pairs of nodes with common leading tokens: each node with the smallest and the largest of its
        group, and with the one before it by size.

        A group shares its leads under two orders. Linear in the nodes, whatever the size of a group.
        """
        keys = [F.xxhash64(F.lit(k), f"l{k}", f"l{k + 1}") for k in range(LEADS - 1)]
        leads = self.nodes.select("node", "n", F.explode(F.array(*keys, *self._plain_keys())).alias("lead"))
        own = F.struct("n", "node")
        ends = leads.groupBy("lead").agg(F.min(own).alias("low"), F.max(own).alias("high")).filter("low <> high")
        shared = write(leads.join(ends, "lead"), "leads")
        before = shared.withColumn("before", F.lag(own).over(Window.partitionBy("lead").orderBy("n", "node")))

        def pair(table: DataFrame, end: str) -> DataFrame:
            apart = (F.col("node") != F.col(f"{end}.node")) & self._sizes_fit("n", f"{end}.n")
            return table.filter(apart).select(F.least("node", f"{end}.node").alias("a"), F.greatest("node", f"{end}.node").alias("b"))

        return pair(shared, "low").union(pair(shared, "high")).union(pair(before, "before")).distinct()

    def _words(self) -> DataFrame:
        return self.nodes.select("node", "n", *[F.get("sketch", j).alias(f"s{j}") for j in range(SKETCH_WORDS)])

    @staticmethod
    def _differing(x: str, y: str) -> Column:
        """How many bits of two sketches differ."""
        differing = F.lit(0)
        for j in range(SKETCH_WORDS):
            differing = differing + F.bit_count(F.col(f"{x}s{j}").bitwiseXOR(F.col(f"{y}s{j}")))
        return differing

    def _alike(self, x: str, y: str) -> Column:
        return (100 + self.percent) * self._differing(x, y) <= (100 - self.percent) * (F.col(f"{x}n") + F.col(f"{y}n"))

    def central_candidates(self, grouped: DataFrame, write: Callable[[DataFrame, str], DataFrame], turn: int) -> DataFrame:
        """Pairs of nodes with the most central node of each group that shares a leading token, or two of those
        regardless of classes.

        Each node is held against one node of each of its groups, drawn anew each turn; the node that differs
        least from those it met is the head of its groups, such as the text that the others were copied
        from. Each node is paired with the likest of the heads of its groups. Linear in the nodes.
        """
        keys = [F.xxhash64(F.lit(k), f"l{k}") for k in range(LEADS)]
        leads = self._parts(grouped).select("node", "part", F.explode(F.array(*keys, *self._plain_keys())).alias("lead"))
        mixed = leads.groupBy("lead").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q").select("lead")
        leads = write(leads.join(mixed, "lead", "left_semi"), "leads")
        shown = leads.join(self._words(), "node")
        columns = ["node", "n", "part", *[f"s{j}" for j in range(SKETCH_WORDS)]]

        def met(rows: DataFrame, weight: Column) -> DataFrame:
            head = rows.groupBy("lead").agg(F.max(F.struct(weight.alias("weight"), *columns)).alias("h"))
            head = head.select("lead", *[F.col(f"h.{c}").alias(f"h_{c}") for c in columns])
            return rows.join(head, "lead").filter("node <> h_node")

        share = self._differing("", "h_") / (F.col("n") + F.col("h_n"))
        central = met(shown, F.xxhash64("lead", "node", F.lit(turn))).groupBy("node").agg((-F.avg(share)).alias("weight"))
        weighed = shown.join(write(central, "central"), "node", "left").withColumn("weight", F.coalesce("weight", F.lit(-1.0)))
        near = met(weighed, F.col("weight")).filter((F.col("part") != F.col("h_part")) & self._sizes_fit("n", "h_n") & self._alike("", "h_"))
        best = near.groupBy("node").agg(F.min(F.struct(share.alias("share"), "h_node")).alias("best"))
        return best.select(F.least("node", "best.h_node").alias("a"), F.greatest("node", "best.h_node").alias("b")).distinct()

    def remaining_candidates(self, grouped: DataFrame, write: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
        """All pairs of different components that share a prefix token under every order.

        Under the first order a class of both has to share one. Sketches of parity bits are compared
        inside that join, so that of large groups of texts that are merely alike hardly a pair comes out
        of it; the prefixes of the other orders are looked at for its pairs only. A pair that shares many
        tokens of a prefix comes out at the first of each stretch of them: each token goes with those
        before it, and where the pair has one of these in common, it has been found there. Prefixes of the
        other orders are kept as 32 bits of each token, which can only let more pairs through.

        The shuffles of each step are let go before the next, so that they do not add up on disk.
        """

        def done(df: DataFrame, name: str) -> DataFrame:
            df = write(df, name)
            release_shuffles(df.sparkSession)
            return df

        placed = write(self._parts(grouped).select("digest", F.col("node").alias("_key"), "part"), "placed")
        cut = self.named.join(placed, ["digest", "_key"]).select("digest", "_key", "part", "sketch", "pieces").dropDuplicates(["digest", "_key"])
        cut = cut.select("_key", "part", "sketch", F.posexplode("pieces").alias("place", "piece"))
        cut = done(cut.select("_key", "part", "place", "piece.n", F.coalesce("piece.sketch", "sketch").alias("sketch"), "piece.prefix"), "pieces")
        tokens = cut.select("_key", "part", "place", "n", F.explode("prefix").alias("token"))
        mixed = tokens.groupBy("token").agg(F.min("part").alias("least"), F.max("part").alias("most")).filter("least <> most").select("token")
        mixed = done(mixed, "mixed")
        shared = done(tokens.join(mixed, "token", "left_semi"), "shared")
        pairs = done(self._met(shared, cut).distinct(), "pairs")
        others = [f"p{k}" for k in range(1, self.orders)]
        if not others:
            return pairs
        lists = self._of(write(self._ends(pairs), "ends"), self.named.join(placed, ["digest", "_key"], "left_semi")).select("_key", *others).dropDuplicates(["_key"])
        lists = done(lists, "prefixes")
        side = lambda e: lists.select(F.col("_key").alias(e), *[F.col(c).alias(f"{e}_{c}") for c in others])
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        for c in others:
            both = both.filter(F.arrays_overlap(f"a_{c}", f"b_{c}"))
        return both.select("a", "b")

    def _met(self, shared: DataFrame, cut: DataFrame) -> DataFrame:
        """Pairs (a, b) of different components with a common prefix token and sketches that allow them,
        once for each stretch of common tokens."""
        words = [F.get("sketch", j).alias(f"s{j}") for j in range(SKETCH_WORDS)]
        at = F.array_position("prefix", F.col("token")).cast("int") - 1
        before = [F.get("prefix", at - j).alias(f"e{j}") for j in range(1, BEFORE + 1)]
        own = shared.join(cut.select("_key", "place", "sketch", "prefix"), ["_key", "place"]).select("token", "_key", "n", "part", *words, *before)
        earlier = [f"e{j}" for j in range(1, BEFORE + 1)]
        end = lambda e: own.select("token", *[F.col(c).alias(f"{e}_{c}") for c in own.columns[1:]])
        met = end("a").join(end("b"), "token").filter((F.col("a_part") < F.col("b_part")) & self._sizes_fit("a_n", "b_n"))
        for x, y in product(earlier, earlier):
            met = met.filter(F.coalesce(F.col(f"a_{x}") != F.col(f"b_{y}"), F.lit(True)))
        met = met.filter(self._alike("a_", "b_"))
        return met.select(F.col("a__key").alias("a"), F.col("b__key").alias("b"))

    def groups(self) -> DataFrame:
        """(_key, n, component) per document."""
        spark, grouped = self.docs.sparkSession, None
        central = [partial(self.central_candidates, turn=turn) for turn in range(CENTRAL_ROUNDS)]
        for candidates in (None, *central, self.remaining_candidates):
            with scratch(spark, "links") as write:
                found = self.links(candidates(grouped, write) if candidates else self.leading_candidates(write), write)
                grouped = self.write(self._joined(grouped, found) if candidates else components(found), "components")
            release_shuffles(spark)
        named = self.nodes.select("digest", "node").join(grouped, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
        return self.signed.select("_key", "n", "digest").join(named, "digest", "left").select("_key", "n", F.when(F.col("_key").isNotNull() & (F.col("n") > 0), F.col("component")).otherwise(F.col("_key")).alias("component"))

    @staticmethod
    def _joined(grouped: DataFrame, links: DataFrame) -> DataFrame:
        """Components of nodes after further links between them."""
        between = links
        for end in ("a", "b"):
            known = grouped.select(F.col("node").alias(end), F.col("component").alias("_part"))
            between = between.join(known, end, "left").withColumn(end, F.coalesce("_part", end)).drop("_part")
        whole = components(between).select(F.col("node").alias("component"), F.col("component").alias("_whole"))
        nodes = grouped.union(links.select("a", "a")).union(links.select("b", "b")).groupBy("node").agg(F.min("component").alias("component"))
        return nodes.join(whole, "component", "left").select("node", F.coalesce("_whole", "component").alias("component"))


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", gram: int = GRAM, percent: int = PERCENT, orders: int = ORDERS) -> DataFrame:
    """Per document: its id, ``n_shingles`` and ``component_id``, the smallest id reachable by links.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Two documents link when
    100 * shared shingles >= ``percent`` * shingles of both. A text of fewer words than a shingle is one
    shingle; empty and missing texts have none and link with nothing. Rows without an id are returned
    with their size, without a component, and link with nothing. Repeated rows are all returned; ids
    are expected to be unique, and rows that share an id without sharing a text are judged by either.
    An empty table gives an empty table; other columns are not read.

    Shingles are compared as 64-bit hashes: among ten thousand of two texts the chance that a chance
    collision changes a count is below one in a hundred billion.
    """
    with scratch(docs.sparkSession, "jaccard-join") as write, small_batches(docs.sparkSession):
        grouped = JaccardJoin(docs, key, text, gram, percent, orders, write).groups()
        return materialise(grouped.select(F.col("_key").alias(key), F.col("n").alias("n_shingles"), F.col("component").alias("component_id")), "groups")
