"""Row positions, sorting, sampling, sharding and rank assignment.

A table has no row order of its own, so each operator names its order key. Global positions never
gather the rows in one task: rows fall into slices between sampled keys, slices are counted, and a
row's position is the count of the slices before it plus its rank inside its slice.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framesift.functions.permute import permutation_key, permute
from framesift.functions.rng import draw_hash
from framesift.schema import free_names
from framesift.session import shuffle_width

_HASH_DIGITS = 6


def _columns(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def search_slice(value: Column, bounds: list[float]) -> Column:
    """Number of sorted bounds that are <= value, by binary search over a constant array."""
    if not bounds:
        return F.lit(0)
    # Parsed once when the plan is optimised, whatever the number of bounds.
    table = F.from_json(F.lit(json.dumps([float(b) for b in bounds])), "array<double>")
    step, steps = 1, []
    while step <= len(bounds):
        steps.append(step)
        step *= 2
    return F.aggregate(
        F.array(*[F.lit(s) for s in reversed(steps)]),
        F.lit(0),
        lambda at, jump: at
        + F.when(F.coalesce(F.get(table, at + jump - 1) <= value, F.lit(False)), jump).otherwise(F.lit(0)),
    )


def slice_count(spark: SparkSession) -> int:
    """Several slices per shuffle partition, so that hashing them spreads evenly."""
    return 4 * shuffle_width(spark)


def _marks(slices: int) -> list[float]:
    return [i / slices for i in range(1, slices)]


def range_bounds(df: DataFrame, key: str, slices: int) -> list[float]:
    """Quantile bounds of a numeric key: one small job over that column alone.

    The bounds only balance the slices; any bounds give the same result.
    """
    if slices < 2:
        return []
    row = df.agg(F.percentile_approx(F.col(key).cast("double"), _marks(slices), 10000).alias("b")).first()
    return sorted(set(row["b"] or []))


# Sampled keys per slice: with so many, no slice is likely to hold twice its share.
_SAMPLED = 32
_PLACEABLE = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.StringType, T.BinaryType)


def _key(order_by: Sequence[str]) -> Column:
    """The key as one value; its order is that of its columns, missing values first."""
    if len(order_by) == 1:
        return F.col(order_by[0])
    return F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order_by)])


def slice_of(df: DataFrame, order_by: Sequence[str], slices: int) -> Column:
    """Number of the slice of the order that a row falls into, an expression over ``df``.

    Splitters are composite keys in their own types, taken at even distances from a sorted sample of
    ``_SAMPLED`` keys per slice. The sample goes by a hash of the key, so it is the same in every run, and
    one job fetches the splitters. They only balance the slices: any splitters give the same positions.
    """
    for c in order_by:
        kind = df.schema[c].dataType
        if not isinstance(kind, _PLACEABLE):
            raise ValueError(f"cannot place rows by {c} of type {kind.simpleString()}")
    wanted = _SAMPLED * slices
    keys = df.select(_key(order_by).alias("key"))
    share = df.agg(F.least(F.lit(1.0), F.lit(float(wanted)) / F.greatest(F.count(F.lit(1)), F.lit(1)))).scalar()
    sample = keys.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < share * float(1 << 30))
    ordered = sample.agg(F.sort_array(F.collect_list("key")).alias("keys"))
    at = F.transform(F.sequence(F.lit(1), F.lit(slices - 1)), lambda i: F.floor(i * F.size("keys") / slices).cast("int"))
    even = F.array_distinct(F.array_compact(F.transform(at, lambda i: F.get("keys", i))))
    found = ordered.select(F.to_json(F.when(F.size("keys") > 0, even)).alias("even"), F.size(even).alias("n")).first() if slices > 1 else None
    if found is None or found["even"] is None:
        return F.lit(0)
    kind = T.ArrayType(keys.schema["key"].dataType)
    # Parsed once when the plan is optimised, whatever the number of splitters.
    table = F.from_json(F.lit(found["even"]), kind)
    step, steps = 1, []
    while step <= found["n"]:
        steps.append(step)
        step *= 2
    jumps = F.array(*[F.lit(s) for s in reversed(steps)])
    search = lambda key: F.aggregate(jumps, F.lit(0), lambda at, jump: F.when(F.get(table, at + jump - 1) <= key, at + jump).otherwise(at))
    # The key is put together once per row, as the only element of an array.
    return F.get(F.transform(F.array(_key(order_by)), search), 0)


def with_position(
    df: DataFrame,
    order_by: str | Sequence[str],
    group_by: str | Sequence[str] = (),
    name: str = "position",
    slices: int | None = None,
    digest: bool = False,
    total: str | None = None,
    before: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add the 0-based position of each row in the given order, within its group if any.

    Order columns are numbers, dates, times, flags, texts or bytes, missing values first, and together they
    are unique. With ``digest`` the first one is a hexadecimal digest (``draw_hash``), which needs no
    look at the data. ``total`` names a column for the number of rows in the group; ``before`` names
    columns for sums of whole numbers over the rows before each. A missing group value is a group of
    its own. A group of any size is spread over the slices, so one hot group costs no more than its
    share. Unless ``digest`` is set, splitters are fetched while the plan is built.
    """
    order_by, group_by, before = _columns(order_by), _columns(group_by), dict(before or {})
    slices = slices or max(slice_count(df.sparkSession), 2)
    if digest:
        digits = F.conv(F.substring(order_by[0], 1, _HASH_DIGITS), 16, 10).cast("bigint")
        part = F.floor(digits * slices / (16**_HASH_DIGITS))
    else:
        part = slice_of(df, order_by, slices)
    slice_no, rank, offset, size, count = free_names(df.columns, "_slice", "_rank", "_offset", "_size", "_total")
    added = free_names(df.columns, *[f"_add_{n}" for n in before])
    # Never NULL, or the join below would evaluate each slice once more to filter on it.
    sliced = df.withColumns({slice_no: F.coalesce(part.cast("int"), F.lit(0)), **{a: F.coalesce(v.cast("bigint"), F.lit(0)) for a, v in zip(added, before.values())}})

    keys = [*group_by, slice_no]
    sizes = sliced.groupBy(*keys).agg(F.count(F.lit(1)).alias(size), *[F.sum(a).alias(a) for a in added])
    # Ungrouped, these windows cover one row per slice; grouped, at most that many per group.
    earlier = Window.partitionBy(*group_by).orderBy(slice_no).rowsBetween(Window.unboundedPreceding, -1)
    of = {c: f"_of_{i}" for i, c in enumerate(keys)}
    of = dict(zip(of, free_names([*df.columns, slice_no, rank, *added], *of.values())))
    sums = dict(zip(added, free_names([*df.columns, *added], *[f"_before_{n}" for n in before])))
    offsets = sizes.select(
        *[F.col(c).alias(o) for c, o in of.items()],
        F.coalesce(F.sum(size).over(earlier), F.lit(0)).alias(offset),
        F.sum(size).over(Window.partitionBy(*group_by)).alias(count),
        *[F.coalesce(F.sum(a).over(earlier), F.lit(0)).alias(o) for a, o in sums.items()],
    )
    if not group_by:
        offsets = F.broadcast(offsets)  # one row per slice

    inside = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order_by])
    so_far = {a: F.sum(a).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(a) for a in added}
    same = F.col(slice_no) == F.col(of[slice_no])
    for c in group_by:
        same = same & F.col(c).eqNullSafe(F.col(of[c]))
    placed = sliced.select("*", F.row_number().over(inside).alias(rank), *[v.alias(f"{a}_in") for a, v in so_far.items()]).join(offsets, same)
    return placed.select(
        *df.columns,
        (F.col(offset) + F.col(rank) - 1).cast("bigint").alias(name),
        *([F.col(count).cast("bigint").alias(total)] if total else []),
        *[(F.col(sums[a]) + F.col(f"{a}_in")).cast("bigint").alias(n) for a, n in zip(added, before)],
    )


# Up to this limit Spark trims every map task's rows per group before the shuffle.
GROUP_LIMIT = 1000


def first_in_group(
    df: DataFrame, group_by: Sequence[str], order_by: str, limit: int, descending: bool = False
) -> DataFrame:
    """The first (or last) ``limit`` rows of each group by a unique number, ranked from 1 in ``rank_in_group``.

    Small limits are trimmed in the map tasks; larger ones use positions, which spread a group over
    many tasks. Either way gives the same rows.
    """
    if limit < GROUP_LIMIT:
        order = F.col(order_by).desc() if descending else F.col(order_by).asc()
        ranked = df.withColumn("rank_in_group", F.row_number().over(Window.partitionBy(*group_by).orderBy(order)))
    else:
        lead, at = free_names(df.columns, "_lead", "_at")
        keyed = df.withColumn(lead, -F.col(order_by) if descending else F.col(order_by))
        placed = with_position(keyed, lead, group_by, name=at).drop(lead)
        ranked = placed.withColumn("rank_in_group", F.col(at) + 1).drop(at)
    return ranked.filter(F.col("rank_in_group") <= limit)


def keep_first(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order; NULL keys count as equal.

    Spark trims every map task to one row per key before the shuffle (window group limit), so a
    hot key sends one row per task.
    """
    window = Window.partitionBy(*_columns(keys)).orderBy(*order)
    (place,) = free_names(df.columns, "_rn")
    return df.withColumn(place, F.row_number().over(window)).filter(F.col(place) == 1).drop(place)


def dedup_path(df: DataFrame, order_by: str = "pos") -> DataFrame:
    return keep_first(df, "path", [F.col(order_by).asc()])


def dedup_text(df: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    """Keep the first row per caption; the digest keeps long captions out of the sort keys."""
    order = list(order) if order else [F.col("pos").asc()]
    (digest,) = free_names(df.columns, "_h")
    return keep_first(df.withColumn(digest, F.xxhash64("text")), [digest, "text"], order).drop(digest)


def sort_descending(df: DataFrame, column: str, tie: str = "pos") -> DataFrame:
    return df.orderBy(F.col(column).desc_nulls_last(), F.col(tie).asc())


def sort_ascending(df: DataFrame, column: str, tie: str = "pos") -> DataFrame:
    return df.orderBy(F.col(column).asc_nulls_last(), F.col(tie).asc())


def shuffle(df: DataFrame, seed: int, key: str = "pos") -> DataFrame:
    """Random order that depends only on the seed and each row's key."""
    return df.orderBy(draw_hash(seed, F.col(key)), F.col(key))


def shuffle_position(df: DataFrame, seed: int, key: str | Sequence[str] = "pos", name: str = "position", total: str | None = None) -> DataFrame:
    """Add the 0-based place of each row in a random order that depends only on the seed and the order of the keys.

    The position by key is sent through a keyed permutation, so nothing is sorted by random draws.
    """
    at, n = free_names([*df.columns, name, *([total] if total else [])], "_at", "_n")
    placed = permute(with_position(df, key, name=at, total=n), name, F.col(at), F.col(n), permutation_key(seed))
    return placed.select(*df.columns, name, *([F.col(n).alias(total)] if total else []))


def _ascending(df: DataFrame, column: str, descending: bool) -> list[Column] | None:
    """Columns whose ascending order is that of ``column``, missing values last; None where there are none."""
    kind, value = df.schema[column].dataType, F.col(column)
    fractional = isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType)
    if not descending:
        return [value.isNull(), value]
    if isinstance(kind, T.IntegralType):
        return [value.isNull(), F.bitwise_not(value.cast("bigint"))]
    if isinstance(kind, T.DateType):
        return [value.isNull(), -F.unix_date(value)]
    if isinstance(kind, T.TimestampType):
        return [value.isNull(), F.bitwise_not(F.unix_micros(value))]
    if isinstance(kind, T.NumericType):
        # NaN is the largest number.
        special = F.isnan(value) if fractional else F.lit(False)
        return [F.when(value.isNull(), 2).when(special, 0).otherwise(1), F.when(~special, -value)]
    return None


def ascending_columns(df: DataFrame, by: Sequence[tuple[str, bool]]) -> list[Column] | None:
    """Columns whose ascending order is that of (column, descending) pairs, missing values last; None where there are none."""
    keys = [_ascending(df, c, down) for c, down in by]
    return None if None in keys else [c for pair in keys for c in pair]


def head(df: DataFrame, n: int, order: Sequence[Column] | None = None, by: Sequence[tuple[str, bool]] = (("pos", False),)) -> DataFrame:
    """The first ``n`` rows, sorted. ``by`` lists columns that are unique together, each with whether it descends;
    missing values come last. ``order`` sorts by expressions instead.

    Fewer than ``GROUP_LIMIT`` rows are trimmed in the map tasks and gathered. More are chosen by position
    and sorted by ranges, so that they stay in as many tasks as they fill; only texts that descend and
    ``order`` still gather them.
    """
    if order is None:
        order = [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in by]
        keys = ascending_columns(df, by)
        if n >= GROUP_LIMIT and keys is not None:
            *names, at = free_names(df.columns, *[f"_o{i}" for i in range(len(keys))], "_at")
            placed = with_position(df.withColumns(dict(zip(names, keys))), names, name=at)
            return placed.filter(F.col(at) < n).orderBy(at).drop(*names, at)
    return df.orderBy(*order).limit(n)


def topk(df: DataFrame, column: str, k: int, tie: str = "pos") -> DataFrame:
    """The ``k`` rows of largest ``column``, missing values last, the smaller ``tie`` first among equals."""
    return head(df, k, by=[(column, True), (tie, False)])


def shard(df: DataFrame, shards: int, order_by: str | Sequence[str] = "pos", name: str = "shard") -> DataFrame:
    """Contiguous shards; the first ``n % shards`` are one row longer."""
    at, n = free_names(df.columns, "_at", "_n")
    placed = with_position(df, order_by, name=at, total=n)
    small = F.floor(F.col(n) / shards)
    extra = F.col(n) % shards
    long_rows = extra * (small + 1)
    return placed.withColumn(
        name,
        F.when(F.col(at) < long_rows, F.floor(F.col(at) / (small + 1)))
        .otherwise(extra + F.floor((F.col(at) - long_rows) / F.greatest(small, F.lit(1))))
        .cast("int"),
    ).drop(at, n)


def split_random(
    df: DataFrame,
    key: str = "pos",
    train: float = 0.07,
    val: float = 0.015,
    test: float = 0.015,
    seed: int = 42,
    test_rest: bool = True,
    name: str = "split",
) -> DataFrame:
    """Train, validation and test by seeded random order; sizes are truncated shares of the total.

    With ``test_rest`` the test part takes every remaining row; otherwise rows beyond its share are
    labelled NULL.
    """
    place, n = free_names(df.columns, "_at", "_n")
    placed = shuffle_position(df, seed, key, name=place, total=n)
    n_train, n_val, n_test = (F.floor(F.col(n) * F.lit(part)) for part in (train, val, test))
    at = F.col(place)
    last = F.lit("test") if test_rest else F.when(at < n_train + n_val + n_test, F.lit("test"))
    return placed.withColumn(
        name, F.when(at < n_train, F.lit("train")).when(at < n_train + n_val, F.lit("val")).otherwise(last)
    ).drop(place, n)


def assign_rank_strided(
    df: DataFrame,
    ranks: int,
    order_by: str | Sequence[str] = "pos",
    pad: str = "wrap",
    start_index: int = 0,
    total: int | None = None,
) -> DataFrame:
    """Row i goes to rank i mod ``ranks`` as its (i div ``ranks``)-th row.

    ``pad='wrap'`` repeats leading rows until all ranks hold the same number, ``'drop'`` trims the
    tail, ``'none'`` leaves ranks uneven. ``start_index`` skips rows each rank already consumed.
    """
    if pad not in ("wrap", "drop", "none"):
        raise ValueError(f"unknown pad {pad!r}")
    at, n = free_names(df.columns, "_at", "_n")
    placed = with_position(df, order_by, name=at, total=n)
    rows, place = F.col(n) if total is None else F.lit(total).cast("bigint"), F.col(at)
    if pad == "wrap":
        # With the rows missing to a multiple of the ranks, the first ones come again, and yet again where
        # there are fewer rows than ranks.
        missing = F.pmod(-rows, F.lit(ranks))
        again = F.ceil((missing - place) / F.greatest(rows, F.lit(1))).cast("int")
        times = F.sequence(F.lit(0), F.greatest(again, F.lit(0)))
        placed = placed.select(*df.columns, F.explode(F.transform(times, lambda k: place + k * rows)).alias(at))
    elif pad == "drop":
        placed = placed.filter(place < rows - rows % ranks)
    out = placed.select(
        *df.columns,
        (place % ranks).cast("int").alias("rank"),
        F.floor(place / ranks).cast("bigint").alias("rank_index"),
    )
    return out.filter(F.col("rank_index") >= start_index) if start_index else out


def assign_rank_blocked(df: DataFrame, ranks: int, order_by: str | Sequence[str] = "pos") -> DataFrame:
    """Contiguous blocks of floor(N / ranks) rows; the last rank takes the rest."""
    at, n = free_names(df.columns, "_at", "_n")
    placed = with_position(df, order_by, name=at, total=n)
    block = F.floor(F.col(n) / ranks)
    rank = F.when(block == 0, F.lit(ranks - 1)).otherwise(
        F.least(F.floor(F.col(at) / F.greatest(block, F.lit(1))), F.lit(ranks - 1))
    )
    return placed.withColumn("rank", rank.cast("int")).drop(at, n)


def assign_buffer_rank(
    df: DataFrame, ranks: int, buffer_length: int, order_by: str | Sequence[str] = "pos"
) -> DataFrame:
    """Whole buffers of ``buffer_length`` rows go to one rank, contiguously.

    Buffers beyond a multiple of ``ranks`` and a trailing partial buffer get no rank.
    """
    at, n = free_names(df.columns, "_at", "_n")
    placed = with_position(df, order_by, name=at, total=n)
    per_rank = F.floor(F.floor(F.col(n) / buffer_length) / ranks)
    buffer = F.floor(F.col(at) / buffer_length)
    rank = F.when(buffer < per_rank * ranks, F.floor(buffer / F.greatest(per_rank, F.lit(1))))
    return placed.select(*df.columns, buffer.cast("bigint").alias("buffer"), rank.cast("int").alias("rank"))


def slice_rows(
    df: DataFrame, start: int | None, end: int | None, order_by: str | Sequence[str] = "pos", total: int | None = None
) -> DataFrame:
    """Rows [start, end) in order; negative bounds count from the end as in a Python slice."""
    at, n = free_names(df.columns, "_at", "_n")
    placed = with_position(df, order_by, name=at, total=n)
    rows = F.col(n) if total is None else F.lit(total).cast("bigint")
    bound = lambda edge: F.lit(edge) if edge >= 0 else rows + edge
    keep = F.lit(True)
    if start is not None:
        keep = keep & (F.col(at) >= bound(start))
    if end is not None:
        keep = keep & (F.col(at) < bound(end))
    return placed.filter(keep).drop(at, n)
