"""A keyed permutation of 0 .. n - 1 as plain arithmetic, so that a shuffled place needs no sort.

A number is a pair (left, right) on a grid of about sqrt(n) by sqrt(n). Each round adds a mix of one half to
the other, modulo its side, which can be undone whatever the mix is; so all rounds together permute the
grid. The grid has fewer than sqrt(n) numbers too many: a number that lands on one of those goes through
the rounds again until it does not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framesift.schema import free_names
from framesift.session import compute_once

ROUNDS = 8
# Below 256 numbers the grid has fewer than 16 too many, so this is always enough; above, a walk goes on
# with a chance below 1 in 16 each time.
WALKS = 16
# Odd multipliers below 2^31, so that products of 32-bit numbers stay within 64 bits.
FIRST, SECOND, STEP = 1597334677, 1181783497, 2654435769
_LOW = 0xFFFFFFFF


def permutation_key(seed: int, *names: Column) -> Column:
    """A 32-bit key that depends on the seed and the names."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[n.cast("string") for n in names]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def _mixed(value: Column, key: Column, step: Column | int) -> Column:
    first = (value * FIRST + (key + step * STEP).bitwiseAND(_LOW)).bitwiseAND(_LOW)
    second = (first.bitwiseXOR(F.shiftright(first, 15)) * SECOND).bitwiseAND(_LOW)
    return second.bitwiseXOR(F.shiftright(second, 13))


def _once_more(x: Column, key: Column, a: Column, b: Column) -> Column:
    """All rounds on one number, for the few that have to go through them again."""

    def one(x: Column, i: Column) -> Column:
        left, right = F.floor(x / b).cast("bigint"), x % b
        by_right = F.pmod(left + _mixed(right, key, i.cast("bigint")), a) * b + right
        by_left = left * b + F.pmod(right + _mixed(left, key, i.cast("bigint")), b)
        return F.when(i % 2 == 0, by_right).otherwise(by_left)

    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), x, one)


def permute(df: DataFrame, name: str, index: Column, n: Column, key: Column) -> DataFrame:
    """Add the place of ``index`` in a permutation of 0 .. n - 1 chosen by a 32-bit key; n at most 2^53.

    A projection per round, for a round reads its halves several times.
    """
    count, chosen, a, b, left, right, x = free_names([*df.columns, name], "_count", "_key", "_a", "_b", "_left", "_right", "_x")
    c = F.col
    grid = df.withColumns({x: index.cast("bigint"), count: n.cast("bigint"), chosen: key.cast("bigint")})
    grid = grid.withColumn(a, F.greatest(F.floor(F.sqrt(c(count).cast("double"))).cast("bigint"), F.lit(1)))
    grid = grid.withColumn(b, F.greatest(F.expr(f"(`{count}` + `{a}` - 1) div `{a}`"), F.lit(1)))
    grid = grid.withColumns({left: F.expr(f"`{x}` div `{b}`"), right: c(x) % c(b)})
    for i in range(ROUNDS):
        if i % 2 == 0:
            grid = grid.withColumn(left, F.pmod(c(left) + _mixed(c(right), c(chosen), F.lit(i)), c(a)))
        else:
            grid = grid.withColumn(right, F.pmod(c(right) + _mixed(c(left), c(chosen), F.lit(i)), c(b)))
    grid = grid.withColumn(x, c(left) * c(b) + c(right))
    again = F.aggregate(
        F.array(*[F.lit(i) for i in range(WALKS)]), c(x), lambda at, _: F.when(at < c(count), at).otherwise(_once_more(at, c(chosen), c(a), c(b)))
    )
    grid = grid.withColumn(x, F.when(c(x) < c(count), c(x)).otherwise(again))
    failed = F.raise_error(F.lit("a permutation walked too long")).cast("bigint")
    placed = grid.select(*df.columns, F.when(c(x) < c(count), c(x)).otherwise(failed).alias(name))
    # A filter on the place must not copy all rounds into itself on its way down.
    return compute_once(placed, name)
