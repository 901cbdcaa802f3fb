"""A bit vector over 64-bit keys, built by Spark, small enough to go along with every task.

It answers whether a key may be in a table: always yes for keys that are, now and then for others. So it
thins out rows before exact work without a shuffle, and never decides a result. Its size follows the
number of keys up to a fixed limit; beyond it, it lets more rows through.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_BITS = 1 << 16
MOST_BITS = 1 << 27
BITS_PER_KEY = 16
# Where a key has the numbers of its bits; the word is named by its low bits from the seventh on.
_SHIFTS = (0, 32, 38)


def bit_vector(keys: DataFrame, column: str) -> np.ndarray:
    """Words of a bit vector with three bits set per key, all in one word, so that a key is one row of the
    sum over words; at most ``MOST_BITS`` bits reach the driver."""
    wanted = BITS_PER_KEY * keys.count()
    bits = LEAST_BITS
    while bits < min(wanted, MOST_BITS):
        bits *= 2
    key = F.col(column)
    own = F.lit(0).cast("bigint")
    for shift in _SHIFTS:
        own = own.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(key, shift).bitwiseAND(F.lit(63)).cast("int")))
    words = keys.groupBy(F.shiftright(key.bitwiseAND(F.lit(bits - 1)), 6).alias("word")).agg(F.bit_or(own).alias("set"))
    vector = np.zeros(bits // 64, np.uint64)
    found = words.toArrow()
    vector[found["word"].to_numpy()] = found["set"].to_numpy().view(np.uint64)
    return vector


def may_hold(vector: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys (unsigned) may be in the table; all that are in it."""
    words = vector[((keys & np.uint64(64 * len(vector) - 1)) >> np.uint64(6)).astype(np.int64)]
    out = np.uint64(1)
    for shift in _SHIFTS:
        out = out & (words >> ((keys >> np.uint64(shift)) & np.uint64(63)))
    return out == 1
