"""Profiles of a meta table."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framesift.operators.ordering import search_slice, slice_count, with_position
from framesift.schema import present

DEFAULT_FPS = 30


def is_image_row() -> Column:
    return F.coalesce(F.col("num_frames") == 1, F.lit(False))


def profile_split(df: DataFrame) -> DataFrame:
    """Images against videos: rows, frames, whole hours at 30 frames a second."""
    frames = F.coalesce(F.sum("num_frames"), F.lit(0))
    return (
        df.groupBy(is_image_row().alias("is_image"))
        .agg(F.count(F.lit(1)).alias("n"), frames.alias("frames"))
        .withColumn("hours", F.floor(F.col("frames") / (DEFAULT_FPS * 3600)))
    )


def _long(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(column, value) rows without missing values: one pass over the input."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*keep, F.explode(pairs).alias("_p")).select(*keep, "_p.*").filter(present(F.col("value")))


def quantiles(df: DataFrame, columns: Sequence[str], points: Sequence[float]) -> DataFrame:
    """Exact linearly interpolated quantiles as (column, point, value).

    Each column's range is cut into slices, whose sizes tell in which of them a quantile lies. Only
    the values of those few slices are shuffled, counted and summed up; a value that repeats a lot
    is counted where its rows are.
    """
    slices = max(slice_count(df.sparkSession), 2)
    marks = [i / slices for i in range(1, slices)]
    clean = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns])
    bounds = clean.agg(*[F.percentile_approx(c, marks, 10000).alias(c) for c in columns]).first()
    slice_no = F.coalesce(
        *[F.when(F.col("column") == c, search_slice(F.col("value"), sorted(set(bounds[c] or [])))) for c in columns],
        F.lit(0),
    )
    sliced = _long(clean, columns).withColumn("_slice", slice_no)

    # At most columns x slices rows: the driver finds the slices that hold a wanted rank. A point
    # falls between the values of rank floor(h) and ceil(h).
    sizes = sliced.groupBy("column", "_slice").agg(F.count(F.lit(1)).alias("n")).collect()
    totals, firsts, rows = {}, {}, []
    for r in sizes:
        totals[r["column"]] = totals.get(r["column"], 0) + r["n"]
    for r in sorted(sizes, key=lambda r: (r["column"], r["_slice"])):
        first = firsts.get(r["column"], 0)
        firsts[r["column"]] = first + r["n"]
        for p in points:
            h = p * (totals[r["column"]] - 1)
            for rank in {math.floor(h), math.ceil(h)}:
                if first <= rank < first + r["n"]:
                    rows.append((r["column"], r["_slice"], first, float(p), h, rank))
    wanted = df.sparkSession.createDataFrame(
        rows, "column string, _slice int, _first bigint, point double, _h double, _rank bigint"
    )

    counts = (
        sliced.join(F.broadcast(wanted.select("column", "_slice").distinct()), ["column", "_slice"], "left_semi")
        .groupBy("column", "_slice", "value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    inside = Window.partitionBy("column", "_slice").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("_to", F.sum("_n").over(inside))
    place = F.col("_rank") - F.col("_first")
    hits = ranked.join(F.broadcast(wanted), ["column", "_slice"]).filter(
        (place < F.col("_to")) & (place >= F.col("_to") - F.col("_n"))
    )
    ends = hits.groupBy("column", "point", "_h").agg(
        F.max(F.when(F.col("_rank") == F.floor("_h"), F.col("value"))).alias("_lo"),
        F.max(F.when(F.col("_rank") == F.ceil("_h"), F.col("value"))).alias("_hi"),
    )
    value = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_h") - F.floor("_h"))
    return ends.select("column", "point", value.alias("value"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per numeric column."""
    basics = _long(df, columns).groupBy("column").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = (
        quantiles(df, columns, [0.25, 0.5, 0.75])
        .groupBy("column")
        .agg(*[F.max(F.when(F.col("point") == p, F.col("value"))).alias(name) for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    )
    # One row per column on both sides.
    return basics.join(F.broadcast(quartiles), "column", "left").select(
        "column", "n", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 100, by: Column | None = None) -> DataFrame:
    """Equal-width counts between each column's minimum and maximum, the last bin closed.

    Optionally per group (such as images and videos). If all values are equal the range is one unit
    wide around them. Empty bins are not listed.
    """
    kind = (by if by is not None else F.lit("all")).alias("kind")
    values = _long(df.select(kind, *columns), columns, keep=["kind"])
    ends = values.groupBy("kind", "column").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    flat = F.col("_lo") == F.col("_hi")
    ends = ends.select(
        "kind",
        "column",
        F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
        F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"),
    )
    width = (F.col("_hi") - F.col("_lo")) / bins
    spot = F.least(F.floor((F.col("value") - F.col("_lo")) / width), F.lit(bins - 1))
    return (
        values.join(ends, ["kind", "column"])
        .groupBy("kind", "column", spot.cast("int").alias("bin"), "_lo", width.alias("_w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("kind", "column", "bin", (F.col("_lo") + F.col("_w") * F.col("bin")).alias("start"), "n")
    )


def value_counts(df: DataFrame, column: str, ratio: bool = False) -> DataFrame:
    """Rows per value, most frequent first; missing values are not counted."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    if ratio:
        total = df.agg(F.count(F.col(column)).alias("t")).scalar()
        counts = counts.withColumn("ratio", F.col("n") / total)
    return counts.orderBy(F.col("n").desc(), F.col(column).asc())


def caption_duplicates(df: DataFrame, column: str = "text") -> DataFrame:
    """Values that occur more than once, with how many rows deduplication would remove."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .withColumn("removed", F.col("copies") - 1)
    )


def frame_points(points: Sequence[float | int]) -> Column:
    """Frame positions of one video: whole numbers are frames, others are shares of its length."""
    return F.array(
        *[
            F.lit(float(p)) if isinstance(p, int) else F.col("num_frames").cast("double") * F.lit(p)
            for p in points
        ]
    )


def frames_grouped(
    df: DataFrame, points: Sequence[float | int], firsts: Sequence[str], order_by: str = "pos", per_row: int | None = None
) -> DataFrame:
    """One row per path with its frame points in row order and the first non-null value of other columns.

    The array of a path holds all its rows; ``frames_long`` is the form without arrays. With ``per_row`` a
    path has one row for every so many of its rows, numbered from 0 in ``part``: the arrays of its parts,
    one after the other, are those of the path, and the first part with a value has the path's.
    """
    rows, key = df.filter(F.col("path").isNotNull()), ["path"]
    if per_row is not None:
        rows = with_position(rows, [order_by, "num_frames"], key, name="part").withColumn("part", F.expr(f"part div {per_row}"))
        key = ["path", "part"]
    packed = rows.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct(order_by, frame_points(points).alias("pts")))).alias("_rows"),
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order_by))).alias(c) for c in firsts],
    )
    return packed.select(*key, F.flatten(F.transform("_rows", lambda r: r["pts"])).alias("points"), *firsts).orderBy(*key)


def frames_long(df: DataFrame, points: Sequence[float | int], order_by: str = "pos") -> DataFrame:
    """(path, place, point): the same points one by one, for paths of any number of rows."""
    rows = df.filter(F.col("path").isNotNull())
    placed = with_position(rows.select("path", order_by, "num_frames"), order_by, ["path"], name="_at")
    exploded = placed.select("path", "_at", F.posexplode(frame_points(points)).alias("_k", "point"))
    return exploded.select("path", (F.col("_at") * len(points) + F.col("_k")).alias("place"), "point")
