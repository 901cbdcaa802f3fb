"""Small pieces that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but the six ASCII white-space characters. ``bytes.split()`` cuts at
# exactly these, and so does this pattern in Java, Python and RE2.
GAP = r"[\x20\x09-\x0D]+"
_GAP_BYTES = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
# The lowest 0 to 8 bytes of a number; words of more bytes are hashed one by one.
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_LONG_WORD = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty for a missing text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def uniform(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the keys alone, the same in any engine with md5."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from every fit: crc32 of its id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def first_free(columns: Iterable[str], wanted: str) -> str:
    """A column name that does not clash with those a caller's table already has."""
    taken = {c.lower() for c in columns}
    name = wanted
    while name.lower() in taken:
        name = "_" + name
    return name


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound so that long runs keep their memory."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.LIMIT:
            self[word] = value
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words of a text with A-Z lower-cased, eight bytes of all words at a time.

    Words of up to eight bytes collide with none of their length, others by chance only.
    """
    import xxhash

    raw = np.frombuffer(b" " + text.encode("utf-8", "surrogatepass").lower() + b" " * 9, np.uint8)
    gap = _GAP_BYTES[raw]
    bounds = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    starts, sizes = bounds[::2], bounds[1::2] - bounds[::2]
    eights = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
    hashes = mix64(sizes.astype(np.uint64))
    some = slice(None)
    for done in range(0, min(int(sizes.max(initial=0)), _LONG_WORD), 8):
        if done:
            some = np.flatnonzero(sizes > done)
        part = eights[starts[some] + done] & _LOW_BYTES[np.minimum(sizes[some] - done, 8)]
        hashes[some] = mix64(hashes[some] * np.uint64(0x2545F4914F6CDD1D) + part)
    for k in np.flatnonzero(sizes > _LONG_WORD):
        hashes[k] = xxhash.xxh3_64_intdigest(raw[starts[k] : starts[k] + sizes[k]].tobytes())
    return hashes


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that scatters them."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` neighbours; of the whole sequence where it is shorter; none of nothing."""
    if len(hashes) == 0:
        return hashes
    n = min(n, len(hashes))
    last = len(hashes) - n + 1
    out = mix64(hashes[:last])
    for k in range(1, n):
        out = mix64(out * np.uint64(0x2545F4914F6CDD1D) + hashes[k : k + last])
    return out


def texts(batch: pa.RecordBatch, column: str) -> Iterator[str]:
    """The texts of a batch one by one, so that only one is held as a Python string; '' for a missing one."""
    for value in batch.column(batch.schema.get_field_index(column)):
        yield value.as_py() or ""


def plain_words(text: str) -> list[bytes]:
    """Words of a text with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def has_words(text: Column) -> Column:
    """Whether a text holds anything but ASCII white space."""
    return F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m"):
    """Jobs that run inside hand rows to Python in batches of about this many bytes at most, for tables of large rows."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)
