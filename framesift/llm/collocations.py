"""Phrase collocations by relational mining of occurrence tables.

The occurrences of phrases of k words are a relation (place, phrase), sorted by place and written in
blocks. Places count words and skip one number between pieces, so two occurrences are neighbours in
one piece exactly if their places differ by one. The relation of the next length is a merge join of
this one with itself at adjacent places, for a phrase can only be frequent if what it is without its
last word and without its first word is. Each level is a join, a count of groups, a semi join that
leaves the occurrences of frequent groups, and a written relation.

Groups are counted in two steps. Adjacent pairs, most of them rare, are summed by a 44-bit key of the
phrase; those of frequent keys are written with their words and counted again by the words themselves,
so equal keys of different phrases change nothing. The semi joins test a bit vector of bounded size in
the task that holds the block; only counts are shuffled, and they are summed per task before.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framesift.llm.bits import bit_vector, may_hold
from framesift.llm.common import mix64, small_batches, word_hashes
from framesift.session import LARGE_ROWS, materialise, release_shuffles

LEAST = 30
LONGEST = 4
INSIDE_PERCENT = 80
SCALE = 2_000_000
TOP = 2000
NO_LANG = "und"
BLOCK_WORDS = 1 << 18
# Keys of pairs, most of what is shuffled, keep the bits that the bit vector reads; the rest compresses away.
_PAIR_BITS = np.uint64((1 << 44) - 1)
_SALTS = 64
_AT_ONCE = 1 << 15

# Bytes that end a piece, all read as a line feed; A-Z become a-z.
_ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)

# Of one block and language: its phrases and how often each occurs; per occurrence, as packed 32-bit
# numbers, how far it is from the one before and the number of its phrase.
RELATION = "lang string, phrases array<string>, counts array<int>, gaps binary, ids binary"


class _Numbers(dict):
    """Numbers things in the order they are first asked for."""

    def __missing__(self, thing):
        self[thing] = number = len(self)
        return number


class _Block:
    """Occurrences of single words of one language, in order."""

    def __init__(self):
        self.words = _Numbers()
        self.ids = array("i")
        self.lengths: list[int] = []

    def add(self, text: str) -> None:
        number = self.words.__getitem__
        for piece in text.encode("utf-8", "surrogatepass").lower().translate(_ENDS).split(b"\n"):
            words = piece.split()
            if words:
                self.ids.extend(map(number, words))
                self.lengths.append(len(words))

    def batch(self, lang: str) -> pa.RecordBatch:
        gaps = np.ones(len(self.ids), np.int32)
        gaps[np.cumsum([0, *self.lengths[:-1]])] = 2
        return _batch(lang, [w.decode("utf-8", "replace") for w in self.words], gaps, np.frombuffer(self.ids, np.int32))


def _batch(lang: str, phrases: list[str], gaps: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    counts = np.bincount(ids, minlength=len(phrases)).astype(np.int32)
    arrays = [
        pa.array([lang], pa.string()),
        pa.array([phrases], pa.list_(pa.string())),
        pa.array([counts], pa.list_(pa.int32())),
        pa.array([gaps.tobytes()], pa.binary()),
        pa.array([ids.tobytes()], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["lang", "phrases", "counts", "gaps", "ids"])


def _occurrences(block_words: int):
    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[str, _Block] = {}
        held = 0
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang = lang.as_py()
                block = blocks.setdefault(lang, _Block())
                held -= len(block.ids)
                block.add(text.as_py() or "")
                held += len(block.ids)
                full = list(blocks) if held >= 4 * block_words else [lang] if len(block.ids) >= block_words else []
                for name in full:
                    block = blocks.pop(name)
                    held -= len(block.ids)
                    if block.ids:
                        yield block.batch(name)
        for name, block in blocks.items():
            if block.ids:
                yield block.batch(name)

    return occurrences


def _blocks(batches: Iterator[pa.RecordBatch]):
    """(lang, phrases, places, ids) of each row."""
    for batch in batches:
        for lang, phrases, gaps, ids in zip(*(batch.column(k) for k in range(4))):
            places = np.cumsum(np.frombuffer(gaps.as_buffer(), np.int32))
            yield lang.as_py(), phrases.as_py(), places, np.frombuffer(ids.as_buffer(), np.int32)


def _hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word)


def _extended(hashes: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word."""
    return mix64(hashes * np.uint64(0x2545F4914F6CDD1D) + last)


def _hashes(phrases: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of phrases of one length, and of their last words."""
    both = np.empty((2, len(phrases)), np.uint64)
    for begin in range(0, len(phrases), _AT_ONCE):
        some = phrases[begin : begin + _AT_ONCE]
        words = word_hashes(" ".join(some)).reshape(len(some), -1).T
        whole = words[0]
        for last in words[1:]:
            whole = _extended(whole, last)
        both[:, begin : begin + len(some)] = whole, words[-1]
    return both[0], both[1]


def _keys(lang: str, hashes: np.ndarray) -> np.ndarray:
    return mix64(hashes ^ np.uint64(_hash(lang.encode())))


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of counted phrases, all of one length."""
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        hashes = _hashes(batch.column(1).to_pylist())[0]
        keys = np.empty(len(hashes), np.uint64)
        for lang in set(langs.tolist()):
            keys[langs == lang] = _keys(lang, hashes[langs == lang])
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["key"])


def _adjacent(rows, frequent: np.ndarray):
    """The merge join of each block with itself at adjacent places, occurrences of frequent groups only:
    (lang, phrases, and per pair its key, its two phrases and its place)."""
    for lang, phrases, places, ids in rows:
        hashes, last = _hashes(phrases)
        kept = may_hold(frequent, _keys(lang, hashes))[ids]
        places, ids = places[kept], ids[kept]
        at = np.flatnonzero(np.diff(places) == 1)
        first, second = ids[at], ids[at + 1]
        yield lang, phrases, _keys(lang, _extended(hashes[first], last[second])) & _PAIR_BITS, first, second, places[at]


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return pa.RecordBatch.from_arrays([pa.array(keys[first].view(np.int64)), pa.array(np.add.reduceat(counts, first))], ["key", "f"])


def _count_keys(frequent):
    """Sums of the keys of a few blocks at a time."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sums, size = [], [], 0
        for _, _, keys, _, _, _ in _adjacent(_blocks(batches), frequent.value):
            found, counts = np.unique(keys, return_counts=True)
            held.append(found)
            sums.append(counts)
            size += len(found)
            if size >= 2 * BLOCK_WORDS:
                yield _summed(held, sums)
                held, sums, size = [], [], 0
        if size:
            yield _summed(held, sums)

    return count


def _extend(frequent, frequent_keys):
    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, phrases, keys, first, second, places in _adjacent(_blocks(batches), frequent.value):
            kept = may_hold(frequent_keys.value, keys)
            pairs, ids = np.unique(first[kept].astype(np.int64) * len(phrases) + second[kept], return_inverse=True)
            texts = [f"{phrases[p // len(phrases)]} {phrases[p % len(phrases)].rpartition(' ')[2]}" for p in pairs.tolist()]
            if texts:
                yield _batch(lang, texts, np.diff(places[kept], prepend=0).astype(np.int32), ids.astype(np.int32))

    return extend


def _counted(relation: DataFrame, least: int) -> DataFrame:
    counts = relation.select("lang", F.inline(F.arrays_zip("phrases", "counts")).alias("phrase", "f"))
    return counts.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)


def frequent_phrases(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases of up to ``longest`` words that occur ``least`` times or
    more, and (lang, n) of all words, of a table of documents.

    Texts are lower-cased in A-Z and cut into pieces at ``. , ; : ! ?`` and line ends, those into words at
    blanks and tabs. All occurrences inside a piece count, overlapping ones too. A missing language is
    ``und``; missing, empty and blank texts hold no words; repeated rows count as often as they come.
    A block holds about ``block_words`` words of one language, which bounds the memory of a task.
    """
    with small_batches(docs.sparkSession):
        return _mined(docs.select(F.coalesce(F.col(lang), F.lit(NO_LANG)).alias("lang"), F.col(text).alias("text")), least, longest, block_words)


def _mined(named: DataFrame, least: int, longest: int, block_words: int) -> tuple[DataFrame, DataFrame]:
    spark = named.sparkSession
    relation = materialise(named.mapInArrow(_occurrences(block_words), RELATION), "occurrences", LARGE_ROWS)
    sizes = relation.groupBy("lang").agg(F.sum(F.expr("octet_length(ids) div 4")).alias("n"))
    levels = [materialise(_counted(relation, least).withColumn("words", F.lit(1)), "phrases")]
    for words in range(2, longest + 1):
        release_shuffles(spark)
        frequent = spark.sparkContext.broadcast(bit_vector(levels[-1].select("lang", "phrase").mapInArrow(_keyed, "key bigint"), "key"))
        blocks = relation.select("lang", "phrases", "gaps", "ids")
        # Keys are summed over some blocks already, so they go to their tasks as they are.
        pairs = blocks.mapInArrow(_count_keys(frequent), "key bigint, f bigint").repartition("key")
        keys = materialise(pairs.groupBy("key").agg(F.sum("f").alias("f")).filter(F.col("f") >= least).select("key"), "keys")
        frequent_keys = spark.sparkContext.broadcast(bit_vector(keys, "key"))
        release_shuffles(spark)
        relation = materialise(blocks.mapInArrow(_extend(frequent, frequent_keys), RELATION), "occurrences", LARGE_ROWS)
        levels.append(materialise(_counted(relation, least).withColumn("words", F.lit(words)), "phrases"))
    phrases = levels[0]
    for more in levels[1:]:
        phrases = phrases.union(more)
    return phrases.select("lang", "phrase", "words", "f"), sizes


def scored(phrases: DataFrame, inside_percent: int = INSIDE_PERCENT) -> DataFrame:
    """Candidates of two words or more with their weakest cut: lang, phrase, a, l, r, score.

    A cut after k words gives l and r, the counts of both parts, and floor(2000000 a / (l + r)); the lowest
    counts, the smallest k on a tie. Candidates that lie inside a longer one with ``inside_percent`` percent
    of their occurrences or more are left out.
    """
    word = F.split("phrase", " ", -1)
    candidates = phrases.filter("words > 1").withColumn("word", word)
    part = lambda start, length: F.array_join(F.slice("word", start, length), " ")
    cuts = candidates.select("lang", "phrase", "f", "words", "word", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "f", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    known = lambda name, count: phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    both = cuts.join(known("left", "l"), ["lang", "left"]).join(known("right", "r"), ["lang", "right"])
    score = F.expr(f"cast({SCALE} as decimal(7, 0)) * cast(f as decimal(19, 0)) div (l + r)")
    weakest = both.groupBy("lang", "phrase").agg(F.first("f").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    windows = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda size: F.transform(F.sequence(F.lit(1), F.col("words") - size + 1), lambda at: F.array_join(F.slice("word", at, size), " ")),
        )
    )
    longer = candidates.filter("words > 2").select("lang", "f", F.explode(F.array_distinct(windows)).alias("phrase"))
    covers = longer.groupBy("lang", "phrase").agg(F.max("f").alias("cover"))
    inside = F.col("cover").cast("decimal(19,0)") * 100 >= F.col("a").cast("decimal(19,0)") * inside_percent
    kept = weakest.join(covers, ["lang", "phrase"], "left").filter(~F.coalesce(inside, F.lit(False)))
    return kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST, inside_percent: int = INSIDE_PERCENT, top: int = TOP) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    By score, then occurrences, both descending, then by the bytes of the phrase. What counts as an
    occurrence says ``frequent_phrases``, what as a score ``scored``. Empty tables, and languages without
    a frequent phrase, give no rows; other columns are not read.
    """
    phrases, sizes = frequent_phrases(docs, lang, text, least, longest)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First within shares of a language, so that none is ranked whole in one task.
    share = F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)).alias("share")
    best = scored(phrases, inside_percent).select("*", share).withColumn("place", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).filter(F.col("place") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
