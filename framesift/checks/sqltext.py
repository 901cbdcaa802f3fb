"""Small SQL snippets shared by the oracles."""

from __future__ import annotations


def draw(seed: int, key: str, salt: str = "''") -> str:
    return f"md5(concat_ws('|', '{seed}', CAST({key} AS VARCHAR), {salt}))"


def uniform(seed: int, key: str, salt: str = "''") -> str:
    return f"(CAST(CAST('0x' || substr({draw(seed, key, salt)}, 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496)"


def one_decimal(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN 'nan' ELSE format('{{:.1f}}', {value}) END"


def permutation_key(seed: int, *names: str) -> str:
    digest = f"md5(concat_ws('|', {', '.join([repr(str(seed)), *[f'CAST({n} AS VARCHAR)' for n in names]])}))"
    return f"CAST('0x' || substr({digest}, 1, 8) AS BIGINT)"


def permuted(index: str, n: str, key: str) -> str:
    """Place of an index in a keyed permutation of 0 .. n - 1: rounds on a grid of about sqrt(n) by sqrt(n),
    gone through again while the place lies beyond n."""
    a = f"greatest(CAST(floor(sqrt(CAST({n} AS DOUBLE))) AS BIGINT), 1)"
    b = f"greatest(({n} + {a} - 1) // {a}, 1)"

    def mixed(v: str) -> str:
        first = f"((({v}) * 1597334677 + ({key} + i * 2654435769 & 4294967295)) & 4294967295)"
        second = f"((xor({first}, {first} >> 15) * 1181783497) & 4294967295)"
        return f"xor({second}, {second} >> 13)"

    left, right = f"s // {b}", f"s % {b}"
    one = f"CASE WHEN i % 2 = 0 THEN (({left} + {mixed(right)}) % {a}) * {b} + {right} ELSE ({left}) * {b} + ({right} + {mixed(left)}) % {b} END"
    rounds = f"list_reduce(range(8), lambda s, i: {one}, {{x}})"
    walk = rounds.replace("{x}", "w")
    return f"list_reduce(range(16), lambda w, z: CASE WHEN w < {n} THEN w ELSE {walk} END, {rounds.replace('{x}', f'CAST({index} AS BIGINT)')})"
