"""Resolution / length / shape buckets and the plan of training batches over them.

A bucket configuration is ``{resolution: {frames: (prob, batch_size)}}``, where ``prob`` may be a
pair ``(accept, consider)``. It is small and fixed, so it enters plans as literals or as a broadcast
table of at most resolutions x lengths x shapes rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framesift.functions.aspect import PIXELS, sizes
from framesift.functions.permute import permutation_key, permute
from framesift.functions.rng import uniform
from framesift.operators.ordering import first_in_group, with_position
from framesift.schema import free_names
from framesift.session import compute_once, materialise

BUCKET = ["res", "t", "ar"]
AREA_TOLERANCE = 0.8  # fixed value: a resolution accepts frames from this share of its pixels

Config = Mapping[str, Mapping[int, tuple]]


def ordered_levels(config: Config) -> list[tuple[str, list[tuple[int, object, int | None]]]]:
    """Resolutions by pixels, lengths by frames, both from large to small."""
    for resolution in config:
        if resolution not in PIXELS:
            raise ValueError(f"unknown resolution {resolution!r}")
    names = sorted(config, key=lambda r: PIXELS[r], reverse=True)
    return [(r, [(t, *config[r][t]) for t in sorted(config[r], reverse=True)]) for r in names]


def bucket_rows(config: Config) -> list[tuple]:
    """(res, t, ar, height, width, batch_size, prob, level_id, pixels) of every bucket."""
    rows, level = [], 0
    for res, lengths in ordered_levels(config):
        for t, prob, batch in lengths:
            accept = prob[0] if isinstance(prob, tuple) else prob
            for ar, (h, w) in sizes(res).items():
                rows.append((res, t, ar, h, w, batch, float(accept), level, PIXELS[res]))
            level += 1
    return rows


def num_buckets(config: Config) -> int:
    return sum(len(sizes(res)) * len(lengths) for res, lengths in config.items())


def bucket_table(spark: SparkSession, config: Config) -> DataFrame:
    return spark.createDataFrame(
        bucket_rows(config),
        "res string, t int, ar string, height int, width int, batch_size int, prob double, level_id int, pixels bigint",
    )


def with_bucket_size(df: DataFrame, config: Config) -> DataFrame:
    """Attach the frame size and batch size of each row's bucket."""
    table = bucket_table(df.sparkSession, config).select(
        *BUCKET, F.col("height").alias("bucket_h"), F.col("width").alias("bucket_w"), "batch_size"
    )
    return df.join(F.broadcast(table), BUCKET)


def all_certain(config: Config) -> dict:
    """The same buckets with every possible level accepted for sure."""

    def certain(prob):
        accept = prob[0] if isinstance(prob, tuple) else prob
        return 1.0 if accept > 0 else accept

    return {r: {t: (certain(p), b) for t, (p, b) in d.items()} for r, d in config.items()}


@cache
def ratio_steps(resolution: str) -> tuple[tuple[float, ...], tuple[str, ...]]:
    """Where the nearest ratio changes: sorted names and the shape from which the next one is nearer.

    The steps are the exact doubles at which comparing distances turns, so a chain of comparisons
    picks the same ratio as the smallest distance, the earlier entry of the table winning a tie.
    """
    place = {name: i for i, name in enumerate(sizes(resolution))}
    names = sorted(place, key=float)

    def next_wins(shape: float, low: str, high: str) -> bool:
        to_low, to_high = abs(float(low) - shape), abs(float(high) - shape)
        return to_high < to_low or (to_high == to_low and place[high] < place[low])

    steps = []
    for low, high in zip(names, names[1:]):
        left, right = float(low), float(high)  # low wins at left, high at right
        while math.nextafter(left, math.inf) < right:
            middle = left + (right - left) / 2
            if next_wins(middle, low, high):
                right = middle
            else:
                left = middle
        steps.append(right)
    return tuple(steps), tuple(names)


def _ratio_from_steps(shape: Column, steps: Sequence[float], names: Sequence[str]) -> Column:
    chain = F.when(shape < steps[0], F.lit(names[0]))
    for step, name in zip(steps[1:], names[1:]):
        chain = chain.when(shape < step, F.lit(name))
    return F.when(shape.isNotNull(), chain.otherwise(F.lit(names[-1])))


def _shape(height: Column, width: Column) -> Column:
    return height.cast("double") / F.when(width > 0, width)


def closest_ratio(height: Column, width: Column, resolution: str) -> Column:
    """Name of the nearest aspect ratio; the earlier one in the table wins a tie."""
    return _ratio_from_steps(_shape(height, width), *ratio_steps(resolution))


def even_sizes(height: Column, width: Column, pixels: int, eps: float = 1e-4) -> tuple[Column, Column]:
    """Even height and width of about ``pixels`` pixels in each row's own shape."""
    shape = height.cast("double") / F.when(width > 0, width)

    def to_even(x: Column) -> Column:
        up = F.ceil(x + eps).cast("bigint")
        return F.when(up % 2 == 0, up).otherwise(F.floor(x + eps)).cast("int")

    out_h = to_even(F.sqrt(F.lit(float(pixels)) * shape))
    return out_h, to_even(out_h / shape)


def resolution_from_pixels(pixels: Column, resolutions: Mapping[str, int] = PIXELS, approx: float = AREA_TOLERANCE) -> Column:
    """First listed resolution of which the frame has at least ``approx`` of the pixels."""
    return reduce(
        lambda rest, r: F.when(pixels >= F.lit(resolutions[r] * approx), F.lit(r)).otherwise(rest),
        reversed(list(resolutions)),
        F.lit(None).cast("string"),
    )


def frames_at_most(length: Column, lengths: list[int], interval: int = 1) -> Column:
    """First listed clip length that fits; still images only match length 1."""
    fitting = reduce(
        lambda rest, t: F.when(length >= t * interval, F.lit(t)).otherwise(rest),
        [t for t in reversed(lengths) if t != 1],
        F.lit(None).cast("int"),
    )
    return F.when(length == 1, F.lit(1 if 1 in lengths else None).cast("int")).otherwise(fitting)


def floor_bucket(value: Column, edges: list[float]) -> Column:
    """Largest edge not above the value; the first edge for anything smaller."""
    return reduce(lambda rest, i: F.when(value < edges[i], F.lit(edges[i - 1])).otherwise(rest),
                  range(len(edges) - 1, 0, -1), F.lit(edges[-1]))


def _level_choice(t_col: Column, lengths, first_level: int, interval: int, draw) -> Column:
    """Number of the level at which a resolution accepts a row, or NULL to try the next resolution."""
    nothing = F.lit(None).cast("int")
    image = video = nothing
    # Built from the shortest length up, so that the longest is tested first.
    for offset in range(len(lengths) - 1, -1, -1):
        t, prob, _ = lengths[offset]
        level = first_level + offset
        accept, consider = prob if isinstance(prob, tuple) else (prob, 1.0)
        if accept >= 1:
            taken = F.lit(level)
        elif accept > 0:
            # A pair has spent its first draw on whether to consider the level.
            taken = F.when(draw(level, 2 if isinstance(prob, tuple) else 1) < accept, F.lit(level))
        else:
            taken = nothing
        if t == 1:
            image = taken
            continue
        match = t_col > t * interval
        if consider < 1:
            match = match & ~(draw(level, 1) > consider)
        # A level that rejects still ends the walk: the row moves on to the next resolution.
        video = F.when(match, taken).otherwise(video)
    return F.when(t_col == 1, image).otherwise(video)


def assign_bucket(
    df: DataFrame, config: Config, frame_interval: int = 1, seed: int = 0, key: str = "pos", rng: str = "md5"
) -> DataFrame:
    """Add ``res, t, ar``: the largest bucket that takes the row, or NULLs.

    A projection without shuffle or Python. Draws are keyed by (seed, row key, level).
    """
    pixels = F.col("height").cast("bigint") * F.col("width").cast("bigint")
    t_col = F.col("num_frames")

    def draw(level: int, nth: int) -> Column:
        return uniform(seed, F.col(key), f"{level}#{nth}", method=rng)

    choices, level, level_res, level_t = [], 0, [], []
    for res, lengths in ordered_levels(config):
        choice = _level_choice(t_col, lengths, level, frame_interval, draw)
        choices.append(F.when(pixels >= F.lit(PIXELS[res] * AREA_TOLERANCE), choice))
        level_res += [res] * len(lengths)
        level_t += [t for t, _, _ in lengths]
        level += len(lengths)
    # The level is found once; resolution, length and shape are looked up from it.
    chosen = compute_once(df.withColumn("_level", F.coalesce(*choices)), "_level")
    by_steps: dict[tuple, list[int]] = {}
    for i, res in enumerate(level_res):
        by_steps.setdefault(ratio_steps(res), []).append(i)
    shape = _shape(F.col("height"), F.col("width"))
    ratio = F.coalesce(
        *[F.when(F.col("_level").isin(levels), _ratio_from_steps(shape, *steps)) for steps, levels in by_steps.items()]
    )
    return chosen.select(
        *df.columns,
        F.get(F.array(*[F.lit(r) for r in level_res]), F.col("_level")).alias("res"),
        F.get(F.array(*[F.lit(t) for t in level_t]), F.col("_level")).alias("t"),
        ratio.alias("ar"),
    )


def in_bucket(df: DataFrame) -> DataFrame:
    return df.filter(F.col("res").isNotNull() & F.col("ar").isNotNull())


def cap_per_bucket(df: DataFrame, config: Config, limit: int = 200, frame_interval: int = 1, order_by: str = "pos") -> DataFrame:
    """The first ``limit`` rows of every bucket, each level being accepted for sure."""
    placed = in_bucket(assign_bucket(df, all_certain(config), frame_interval, key=order_by))
    return first_in_group(placed, BUCKET, order_by, limit).drop("rank_in_group")


def bucket_counts(bucketed: DataFrame, config: Config) -> DataFrame:
    """Rows per non-empty bucket with its batch size (at most one row per configured bucket)."""
    return with_bucket_size(in_bucket(bucketed).groupBy(*BUCKET).agg(F.count(F.lit(1)).alias("size")), config)


def bucket_stats(bucketed: DataFrame, config: Config) -> DataFrame:
    """Samples and whole batches per bucket, per shape, per (resolution, length), per kind and in total.

    ``grouping`` names the level of each row.
    """
    counts = bucket_counts(bucketed, config).select(
        *BUCKET,
        F.when(F.col("t") == 1, F.lit("image")).otherwise(F.lit("video")).alias("kind"),
        "size",
        F.floor(F.col("size") / F.col("batch_size")).alias("batches"),
    )
    groups = [["res", "t", "ar", "kind"], ["ar"], ["res", "t", "kind"], ["kind"], []]
    gid = F.grouping_id("res", "t", "ar", "kind")
    names = F.create_map(
        *[x for bits, name in ((0, "bucket"), (13, "shape"), (2, "size"), (14, "kind"), (15, "total")) for x in (F.lit(bits), F.lit(name))]
    )
    rolled = counts.groupingSets(groups, "res", "t", "ar", "kind").agg(
        F.sum("size").alias("samples"), F.sum("batches").alias("batches"), F.count(F.lit(1)).alias("buckets"), gid.alias("_g")
    )
    pixels = F.create_map(*[F.lit(x) for pair in PIXELS.items() for x in pair])
    return (
        rolled.withColumn("grouping", names[F.col("_g").cast("int")])
        .orderBy("_g", F.try_element_at(pixels, F.col("res")).desc_nulls_last(), F.col("t").desc_nulls_last(), "ar")
        .select("grouping", *BUCKET, "kind", "samples", "batches", "buckets")
    )


def num_batches(bucketed: DataFrame, config: Config, replicas: int) -> DataFrame:
    """Whole batches over all buckets, and the steps they give ``replicas`` workers."""
    total = F.sum(F.floor(F.col("size") / F.col("batch_size")))
    return bucket_counts(bucketed, config).agg(F.coalesce(total, F.lit(0)).cast("bigint").alias("batches")).withColumn(
        "steps", F.floor(F.col("batches") / replicas)
    )


class _Plan:
    """What one epoch's plan needs to know about each bucket, from a single counting job.

    There is at most one row per configured bucket, so these facts live on the driver and go back
    into the job as a broadcast table.
    """

    def __init__(self, bucketed: DataFrame, config: Config, drop_last: bool, order_by: str):
        self.spark = bucketed.sparkSession
        batch_of = {(r, t): b for r, d in config.items() for t, (_, b) in d.items()}
        grouped = bucketed.groupBy(*BUCKET).agg(F.count(F.lit(1)).alias("n"), F.min(order_by).alias("first"))
        self.rows, self.total = [], 0
        # Buckets take their turn in order of first appearance.
        for r in sorted(grouped.collect(), key=lambda r: r["first"]):
            batch = batch_of[r["res"], r["t"]]
            rest = r["n"] % batch
            # Either the last rows go, or the first ones come once more.
            kept = r["n"] - rest if drop_last or rest == 0 else r["n"] + min(batch - rest, r["n"])
            # A bucket smaller than its padding still falls short of a batch, which is left out.
            full = kept // batch
            self.rows.append((r["res"], r["t"], r["ar"], batch, r["n"], kept, full, self.total))
            self.total += full

    def table(self) -> DataFrame:
        schema = "res string, t int, ar string, _batch int, _size bigint, _kept bigint, _full bigint, _before bigint"
        return F.broadcast(self.spark.createDataFrame(self.rows, schema))


def plan_batches(
    bucketed: DataFrame,
    config: Config,
    replicas: int = 1,
    shuffle: bool = True,
    seed: int = 0,
    epoch: int = 0,
    drop_last: bool = False,
    repeat_on_pad: bool = False,
    order_by: str = "pos",
    start: int = 0,
) -> DataFrame:
    """(step, rank, bucket, frame size, batch_index, row key) for one epoch; ``order_by`` is unique.

    Rows are numbered inside their bucket; a permutation of those numbers keyed by seed, epoch and bucket
    shuffles them, and they are cut into micro-batches. Micro-batches, numbered bucket by bucket, are put
    in one global order by another permutation and dealt to the ranks step by step. Micro-batches added to
    fill the last step find their bucket used up and stay empty (one row with a NULL key), unless
    ``repeat_on_pad`` gives those of the first visits again. ``start`` skips the steps that cover
    micro-batches already consumed: each row tells its own step, so only rows of the steps left are given out.

    The bucket assignment, one narrow table, is written to the shared folder on the way, since counting and
    numbering both start from it; everything after the numbering is arithmetic on each row.
    """
    draw_seed = seed + epoch
    bucketed = materialise(in_bucket(bucketed).select(*BUCKET, order_by), "bucketed")
    plan = _Plan(bucketed, config, drop_last, order_by)
    c = F.col
    at, place, visit = free_names([order_by, *BUCKET], "_at", "_place", "_visit")
    rows = with_position(bucketed, order_by, BUCKET, name=at).join(plan.table(), BUCKET)
    copies = F.array_compact(F.array(c(at), F.when(c(at) + c("_size") < c("_kept"), c(at) + c("_size"))))
    rows = rows.withColumn(at, F.explode(copies)).filter(c(at) < c("_kept"))
    if shuffle:
        rows = permute(rows, place, c(at), c("_kept"), permutation_key(draw_seed, *[c(b) for b in BUCKET]))
    else:
        rows = rows.withColumn(place, c(at))
    rows = rows.withColumn("_k", F.expr(f"`{place}` div _batch")).filter("_k < _full")
    if shuffle:
        rows = permute(rows, visit, c("_before") + c("_k"), F.lit(plan.total), permutation_key(draw_seed))
    else:
        rows = rows.withColumn(visit, c("_before") + c("_k"))

    uneven = plan.total % replicas
    # To fill the last step, the first micro-batches are visited again: fewer than `replicas` of them.
    missing = min(replicas - uneven, plan.total) if uneven and not drop_last else 0
    steps = (plan.total + missing) // replicas
    visits = F.array_compact(F.array(c(visit), F.when(c(visit) < missing, c(visit) + plan.total)))
    dealt = rows.withColumn(visit, F.explode(visits))
    dealt = dealt.withColumn("step", F.expr(f"`{visit}` div {replicas}")).filter((c("step") < steps) & (c("step") >= start // replicas))
    index = (c(place) % c("_batch")).cast("int")
    empty = (c(visit) >= plan.total) & F.lit(not repeat_on_pad)
    planned = dealt.filter(~empty | (index == 0)).select(
        "step",
        (c(visit) % replicas).cast("int").alias("rank"),
        *BUCKET,
        F.when(~empty, index).alias("batch_index"),
        F.when(~empty, c(order_by)).alias(order_by),
    )
    return with_bucket_size(planned, config).select(
        "step", "rank", *BUCKET, "bucket_h", "bucket_w", "batch_index", order_by
    )


def micro_batch_entry(key: str = "pos") -> Column:
    """The exported form of a planned sample: ``id-t-h-w``."""
    return F.concat_ws("-", F.col(key), F.col("t"), F.col("bucket_h"), F.col("bucket_w"))


def weighted_label(weights: Mapping[str, float], draw: Column, rest: str = "identity") -> Column:
    """Draw a label by weight; what the weights leave of 1 goes to ``rest``."""
    weights = dict(weights)
    weights.setdefault(rest, 1.0 - sum(weights.values()))
    if any(not -1e-6 <= w <= 1 for w in weights.values()):
        raise ValueError("weights must lie in [0, 1]")
    if abs(sum(weights.values()) - 1.0) > 1e-6:
        raise ValueError("weights must sum to 1")
    total, edges = 0.0, []
    for label, weight in weights.items():
        total += weight
        edges.append((label, total))
    return reduce(lambda other, e: F.when(draw < e[1], F.lit(e[0])).otherwise(other), reversed(edges), F.lit(None).cast("string"))
