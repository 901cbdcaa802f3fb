"""Line dedup by a segment-partition edit join, with built-in functions only.

Two lines within ``threshold`` edits share one of ``threshold + 1`` segments, at a place that the edits
left and right of it can have moved. Each line is indexed by its own segments under its length, and
probes those of its own and slightly smaller lengths by the few substrings that can match
(Li, Deng, Wang and Feng, "Pass-Join", 2011). Candidates are verified with a banded bit-parallel edit
distance (Hyyrö 2003).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framesift.session import materialise, scratch

THRESHOLD = 2
SHORTEST = 20
BROADCAST_ROWS = 100_000

_BLANK = " \t\r\x0b\f"


def _keys(line: Column, length: Column, threshold: int, asked: list[tuple[int, int, int]]) -> Column:
    """Keys of the parts (gap, segment, shift) of a line.

    A line of ``length - gap`` characters has ``threshold + 1`` segments, the later ones take what does
    not divide; the part lies ``shift`` characters after its segment's place. A part that reaches past
    an end gives a key of other text, and so at worst a candidate too many. Segment bounds are worked
    out once a line, and the line is laid out with four bytes to a character, so that a part is cut out
    without a walk through the characters before it.
    """
    parts = threshold + 1
    wide = F.encode(line, "UTF-32")
    bounds = []
    for gap in range(max(g for g, _, _ in asked) + 1):
        other = length - gap
        even, longer = F.call_function("div", other, F.lit(parts)).cast("int"), other % parts
        bounds += [1 + even * k + F.greatest(longer + (k - parts), F.lit(0)) for k in range(parts + 1)]
    constants = F.array(*[F.struct(F.lit(g).alias("gap"), F.lit(k).alias("k"), F.lit(s).alias("shift"), F.lit(g * (parts + 1) + k).alias("at")) for g, k, s in asked])

    def key(c: Column, x: Column) -> Column:
        start, end = F.get(x["bounds"], c["at"]), F.get(x["bounds"], c["at"] + 1)
        return F.xxhash64(length - c["gap"], c["k"], F.substring(x["wide"], 4 * (start + c["shift"]) - 3, 4 * (end - start)))

    own = F.struct(F.array(*bounds).alias("bounds"), wide.alias("wide"))
    return F.element_at(F.transform(F.array(own), lambda x: F.transform(constants, lambda c: key(c, x))), 1)


def index_keys(line: Column, length: Column, threshold: int = THRESHOLD) -> Column:
    """Keys of the line's own segments."""
    return _keys(line, length, threshold, [(0, k, 0) for k in range(threshold + 1)])


def probe_keys(line: Column, length: Column, threshold: int = THRESHOLD) -> Column:
    """Keys under which a line finds every line at most as long that is within the threshold.

    Segment ``k`` of a line shorter by ``gap`` can start only where at most ``k`` edits lie left of it
    and at most ``threshold - k`` right of it.
    """
    return _keys(line, length, threshold, _asked(threshold))


def _asked(threshold: int) -> list[tuple[int, int, int]]:
    return [
        (gap, k, shift)
        for gap in range(threshold + 1)
        for k in range(threshold + 1)
        for shift in range(max(-k, gap - (threshold - k)), min(k, gap + (threshold - k)) + 1)
    ]


def letter_parities(line: Column) -> Column:
    """A bit per letter a-z, set where the letter is there an odd number of times.

    An insertion or deletion changes one bit at most and a substitution two, so lines within ``t``
    edits differ in at most ``2 * t`` bits.
    """
    whole = F.octet_length(line)
    bits = [F.shiftleft(((whole - F.octet_length(F.replace(line, F.lit(chr(97 + k))))) % 2).cast("bigint"), k) for k in range(26)]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out


def pair_parities(line: Column) -> Column:
    """64 bits over the pairs of neighbouring characters, set where those of a slot are there an odd number of times.

    An edit takes out and puts in four pairs at most, so lines within ``t`` edits differ in at most ``4 * t`` bits.
    """
    wide = F.encode(line, "UTF-32")

    def flip(bits: Column, at: Column, own: Column) -> Column:
        slot = F.hash(F.substring(own, 4 * at - 3, F.lit(8))).bitwiseAND(F.lit(63))
        return bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), slot))

    places = lambda own: F.sequence(F.lit(1), F.greatest(F.lit(1), (F.octet_length(own) / 4).cast("int") - 1))
    return F.element_at(F.transform(F.array(wide), lambda own: F.aggregate(places(own), F.lit(0).cast("bigint"), lambda bits, at: flip(bits, at, own))), 1)


def edit_distance(a: Column, b: Column, threshold: int = THRESHOLD) -> Column:
    """Edit distance of two texts, or ``threshold + 1`` where it is larger.

    Bit-parallel over a band of ``2 * threshold + 1`` diagonals: one step per character of ``b`` with
    words of vertical differences. The characters of ``a`` in the band are compared one by one, which
    gives the match word.
    """
    width = 2 * threshold + 1
    full = (1 << width) - 1
    long = lambda v: F.lit(v).cast("bigint")
    x = F.filter(F.split(a, ""), lambda c: c != "")
    y = F.filter(F.split(b, ""), lambda c: c != "")
    m, n = F.size(x), F.size(y)

    def let(value: Column, body) -> Column:
        return F.element_at(F.transform(F.array(value), body), 1)

    def invert(v: Column) -> Column:
        return F.bitwise_not(v).bitwiseAND(long(full))

    def step(state: Column, place: Column, xs: Column, ys: Column) -> Column:
        char = F.get(ys, place)
        match = long(0)
        for k in range(width):
            at = place + F.lit(threshold + 1 - width + k)
            hit = (at >= 0) & F.coalesce(F.get(xs, F.greatest(at, F.lit(0))) == char, F.lit(False))
            match = match.bitwiseOR(F.when(hit, long(1 << k)).otherwise(long(0)))

        def with_match(pm: Column) -> Column:
            vp, vn = state["vp"], state["vn"]
            zero = ((pm.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(pm).bitwiseOR(vn).bitwiseAND(long(full))

            def with_zero(d0: Column) -> Column:
                hp = vn.bitwiseOR(invert(d0.bitwiseOR(vp)))
                hn = d0.bitwiseAND(vp)
                lower = F.shiftright(d0, 1)
                on_diagonal = place < F.size(xs) - F.lit(threshold)
                # Below the last full column the score runs along the bottom row, one bit further down each time.
                row = F.element_at(F.array(*[long(1 << k) for k in range(width)]), F.greatest(F.lit(1), F.lit(width - 1) - (place - F.greatest(F.size(xs) - F.lit(threshold), F.lit(0)))))
                along = F.when(hp.bitwiseAND(row) != 0, 1).otherwise(0) - F.when(hn.bitwiseAND(row) != 0, 1).otherwise(0)
                down = F.when(d0.bitwiseAND(long(1 << (width - 1))) == 0, 1).otherwise(0)
                return F.struct(
                    hn.bitwiseOR(invert(lower.bitwiseOR(hp))).alias("vp"),
                    lower.bitwiseAND(hp).alias("vn"),
                    (state["score"] + F.when(on_diagonal, down).otherwise(along)).cast("int").alias("score"),
                )

            return let(zero, with_zero)

        return let(match, with_match)

    start = F.struct(
        long(full ^ ((1 << (width - threshold - 1)) - 1)).alias("vp"),
        long(0).alias("vn"),
        F.lit(threshold).cast("int").alias("score"),
    )

    def run(xs: Column, ys: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.size(ys) - 1), start, lambda s, p: step(s, p, xs, ys), lambda s: s["score"])

    banded = let(F.struct(x.alias("x"), y.alias("y")), lambda both: run(both["x"], both["y"]))
    far = F.lit(threshold + 1)
    # A side no longer than the threshold lies in the band whole; the short cases need no words.
    return F.when(F.abs(m - n) > threshold, far).when((m <= threshold) | (n <= threshold), F.least(F.levenshtein(a, b), far)).otherwise(F.least(banded, far))


def _lines(docs: DataFrame, shortest: int) -> DataFrame:
    """One row per line with a word, with the class of its text: two hashes of it, and for a short line
    of its document as well."""
    # Trimmed and measured before they are exploded, else every use of a line would do it again.
    trimmed = F.transform(F.transform(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(_BLANK))), lambda x: F.struct(x.alias("line"), F.char_length(x).alias("n")))
    sized = docs.select("_id", "_h", F.posexplode(trimmed).alias("_pos", "_l")).select("_id", "_h", "_pos", F.col("_l.line").alias("_line"), F.col("_l.n").alias("_n")).filter(F.col("_n") > 0)
    home = F.when(F.col("_n") < shortest, F.xxhash64("_id", "_h"))
    return sized.select("*", F.xxhash64("_line", home).alias("_c1"), F.xxhash64(F.lit(7), "_line", home).alias("_c2"))


def _bounded(df: DataFrame) -> DataFrame:
    """A written table, marked for broadcast only while it has few rows."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def near_lines(lines: DataFrame, keyed: DataFrame, first: DataFrame, threshold: int, materialise: Callable[[DataFrame, str], DataFrame] = materialise) -> DataFrame:
    """Line classes (_c1, _c2) that stand after a class within the threshold.

    ``keyed`` holds ``_probe``, the probe keys, of each line that takes part, ``first`` the first place and the
    number of places of each class. A line's own segments are among its probes, so one sum over the keys
    finds those that an index and another line share, which are few; only their lines are looked up again. Each is then held against two lines of every key it
    has, the first and the most common, which is linear however many lines share a key and settles
    nearly all copies of a line. Only for lines not settled by that are all earlier lines of their keys
    looked at, and only pairs whose letters and pairs of letters allow the threshold come out of the join.
    """
    own = keyed.filter(F.col("_probe").isNotNull())
    index = [at for at, (gap, _, shift) in enumerate(_asked(threshold)) if gap == shift == 0]
    probing = own.select("_c1", F.posexplode("_probe").alias("_at", "_key")).select("_key", "_c1", F.col("_at").isin(index).alias("_own"))
    # Most keys are one line's, so they go to their tasks as they are.
    met = probing.repartition("_key").groupBy("_key").agg(F.min("_c1").alias("_a"), F.max("_c1").alias("_b"), F.max("_own").alias("_own"))
    met = _bounded(materialise(met.filter((F.col("_a") != F.col("_b")) & F.col("_own")).select("_key"), "line-keys"))
    sided = lambda keys: own.select("_c1", "_c2", F.explode(keys).alias("_key")).join(met, "_key", "left_semi").distinct()
    indexed = F.array(*[F.get("_probe", at) for at in index])
    shared = materialise(sided(indexed).withColumn("_own", F.lit(True)).union(sided("_probe").withColumn("_own", F.lit(False))), "line-shared")
    wanted = materialise(shared.select("_c1", "_c2").distinct(), "line-wanted")
    texts = lines.select("_c1", "_c2", "_line").join(_bounded(wanted), ["_c1", "_c2"], "left_semi").dropDuplicates(["_c1", "_c2"])
    texts = materialise(texts.withColumn("_letters", letter_parities(F.col("_line"))).withColumn("_pairs", pair_parities(F.col("_line"))).join(first.select("_c1", "_c2", "_first", "_times"), ["_c1", "_c2"]), "line-texts")
    seen = ["_c1", "_c2", "_first", "_letters", "_pairs"]
    lettered = shared.join(texts.select(*seen, "_times"), ["_c1", "_c2"])
    differing = lambda bits: F.bit_count(F.col(f"a.{bits}").bitwiseXOR(F.col(f"b.{bits}")))
    alike = (differing("_letters") <= 2 * threshold) & (differing("_pairs") <= 4 * threshold)
    earlier = F.col("a._first") < F.col("b._first")
    line = F.struct(*seen)

    def later_near(pairs: DataFrame) -> DataFrame:
        """The later lines of pairs (a, b) that are within the threshold."""
        which = lambda x, y: F.when(earlier, F.col(x)).otherwise(F.col(y))
        ends = pairs.select(*[F.col(f"{e}._c{k}").alias(f"{e}{k}") for e in "ab" for k in (1, 2)], *[which(f"b._c{k}", f"a._c{k}").alias(f"_c{k}") for k in (1, 2)])
        ends = materialise(ends.distinct(), "line-pairs")
        named = lambda s: texts.select(F.col("_c1").alias(f"{s}1"), F.col("_c2").alias(f"{s}2"), F.col("_line").alias(f"{s}_line"))
        both = ends.join(named("a"), ["a1", "a2"]).join(named("b"), ["b1", "b2"])
        return both.filter(edit_distance(F.col("a_line"), F.col("b_line"), threshold) <= threshold).select("_c1", "_c2").distinct()

    heads = lettered.groupBy("_key").agg(F.min(F.struct(F.col("_first").alias("_lead"), *seen)).alias("_early"), F.max(F.struct("_times", *seen)).alias("_often"))
    headed = lettered.join(heads, "_key")
    with_head = lambda head: headed.select(F.struct(*[F.col(f"{head}.{c}").alias(c) for c in seen]).alias("a"), line.alias("b"))
    tried = with_head("_early").union(with_head("_often")).filter((F.col("a._c1") != F.col("b._c1")) & alike)
    settled = materialise(later_near(tried), "line-settled")
    opened = lettered.join(settled.withColumn("_open", F.lit(False)), ["_c1", "_c2"], "left").withColumn("_open", F.coalesce("_open", F.lit(True)))
    # Lines near each other have parities that differ in 2 * threshold bits at most, so one of so many groups of
    # bits and one more is equal in both; that parts the lines of a common key.
    groups, size = 2 * threshold + 1, -(-26 // (2 * threshold + 1))
    values = [F.struct(F.lit(g).alias("_g"), F.shiftright("_letters", g * size).bitwiseAND(F.lit((1 << size) - 1)).alias("_bits")) for g in range(groups)]
    parted = opened.select("*", F.inline(F.array(*values)))
    end = lambda s, is_own: parted.filter(F.col("_own") == is_own).select("_key", "_g", "_bits", line.alias(s), F.col("_open").alias(f"{s}_open"))
    undecided = F.when(earlier, F.col("b_open")).otherwise(F.col("a_open"))
    pairs = end("a", True).join(end("b", False), ["_key", "_g", "_bits"]).filter((F.col("a._c1") != F.col("b._c1")) & undecided & alike)
    return settled.union(later_near(pairs)).distinct()


def dedup_lines(docs: DataFrame, threshold: int = THRESHOLD, shortest: int = SHORTEST, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents without lines that repeat an earlier one; ``n_lines``, ``n_repeated`` and ``n_near``.

    Lines are cut at newlines and compared without white space around them; lines without a word are
    neither counted nor removed. A line goes if the same line stands earlier, or if a line within
    ``threshold`` edits does, whether or not that one stays. Earlier means a smaller id, then the place
    in the text. Lines shorter than ``shortest`` code points are compared for equality and within their
    own document only, as chance repeats them everywhere.

    Documents without an id come after all others, a missing text stays missing, and rows with one id
    and one text are one document whose copies all get the same text. Columns of the three names are
    replaced, others pass through; an empty table gives an empty table.
    """
    made = ("n_lines", "n_repeated", "n_near")
    base = docs.select(*[c for c in docs.columns if c.lower() not in made])
    keyed = base.select(F.col(key).alias("_id"), F.xxhash64(text).alias("_h"), F.col(text).alias("_text"))
    lines = _lines(keyed, shortest)
    order = F.struct(F.col("_id").isNull().alias("_last"), "_id", "_h", "_pos")
    line, size = F.col("_line"), F.col("_n")
    parts = F.when(size >= shortest, probe_keys(line, size, threshold)).alias("_probe")
    with scratch(docs.sparkSession, "line-dedup") as write:
        # One pass over the texts: who stands where, and the keys of the edit join.
        places = write(lines.select("_id", "_h", "_pos", "_c1", "_c2", parts), "lines")
        first = write(places.groupBy("_c1", "_c2").agg(F.min(order).alias("_first"), F.max(order).alias("_final"), F.count(F.lit(1)).alias("_times")), "line-classes")
        gone = near_lines(lines, places, first, threshold, write).withColumn("_near", F.lit(True))
        marked = first.filter("_first <> _final").select("_c1", "_c2", "_first").join(gone, ["_c1", "_c2"], "full")
        marked = write(marked, "line-marks")
        removed = places.select("_id", "_h", "_pos", "_c1", "_c2").join(marked, ["_c1", "_c2"]).filter(F.coalesce(F.col("_near"), F.lit(False)) | (order != F.col("_first")))
        repeated = F.coalesce(order != F.col("_first"), F.lit(False))
        per_doc = removed.groupBy("_id", "_h").agg(
            F.collect_set("_pos").alias("_gone"), F.countDistinct(F.when(repeated, F.col("_pos"))).alias("_exact")
        )
        per_doc = materialise(per_doc, "removed-lines")
    own = F.xxhash64(base[text])
    joined = base.join(per_doc, base[key].eqNullSafe(per_doc["_id"]) & (own == per_doc["_h"]), "left")
    kept = F.array_join(F.filter(F.split(base[text], "\n"), lambda x, i: ~F.array_contains(F.col("_gone"), i)), "\n")
    counted = F.size(F.filter(F.split(base[text], "\n"), lambda x: F.btrim(x, F.lit(_BLANK)) != ""))
    return joined.select(
        *[F.when(F.col("_gone").isNull(), base[text]).otherwise(kept).alias(c) if c == text else base[c] for c in base.columns],
        F.when(base[text].isNull(), 0).otherwise(counted).alias("n_lines"),
        F.coalesce("_exact", F.lit(0)).cast("int").alias("n_repeated"),
        (F.coalesce(F.size("_gone"), F.lit(0)) - F.coalesce("_exact", F.lit(0))).cast("int").alias("n_near"),
    )
