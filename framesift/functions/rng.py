"""Keyed random draws: a function of (seed, key, salt), so retries and other engines agree."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw_hash(seed: int, key: Column, salt: str | Column = "") -> Column:
    """Hex digest used to order rows at random."""
    salt = salt if isinstance(salt, Column) else F.lit(str(salt))
    return F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string"), salt))


def uniform(seed: int, key: Column, salt: str | Column = "", method: str = "md5") -> Column:
    """Uniform double in [0, 1) from the leading 52 bits of the draw."""
    if method == "xxhash64":
        salt = salt if isinstance(salt, Column) else F.lit(str(salt))
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(str(seed)), key.cast("string"), salt), 12)
    elif method == "md5":
        bits = F.conv(F.substring(draw_hash(seed, key, salt), 1, 13), 16, 10).cast("bigint")
    else:
        raise ValueError(f"unknown method {method!r}")
    return bits.cast("double") / F.lit(float(2**52))
