"""Scores from model outputs that arrive as columns."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def match_score(image: Column, text: Column, scale: float = 100.0) -> Column:
    """Scaled cosine similarity."""
    return F.lit(float(scale)) * dot(image, text) / F.nullif(norm(image) * norm(text), F.lit(0.0))


def fold_layers(layers: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[list[float], float]:
    """Linear layers without activation between them are one affine map: (weights, bias)."""
    weight, bias = np.eye(np.asarray(layers[0][0]).shape[1]), np.zeros(np.asarray(layers[0][0]).shape[1])
    for w, b in layers:
        w, b = np.asarray(w, dtype=float), np.asarray(b, dtype=float)
        weight, bias = w @ weight, w @ bias + b
    return [float(x) for x in weight[0]], float(bias[0])


def aesthetic_score(frames: DataFrame, weights: Sequence[float], bias: float, key: str = "path", vector: str = "embedding") -> DataFrame:
    """Mean over a video's frames of the affine score of the normalised frame vector."""
    w = F.array(*[F.lit(float(x)) for x in weights])
    value = dot(F.col(vector), w) / F.nullif(norm(F.col(vector)), F.lit(0.0)) + F.lit(float(bias))
    return frames.groupBy(key).agg(F.avg(value).alias("aes"))


def flow_score(flows: DataFrame, key: str = "path", values: str = "flow_values") -> DataFrame:
    """Mean absolute flow over all frames, pixels and channels of a video."""
    total = F.aggregate(F.col(values), F.lit(0.0), lambda t, x: t + F.abs(x.cast("double")))
    return flows.groupBy(key).agg((F.sum(total) / F.sum(F.size(values))).alias("flow"))


def frame_motion(magnitude: Column, angle: Column, zoom: Column) -> Column:
    """Camera motion between two frames from median flow and the share of outward pixels."""
    return (
        F.when(magnitude < 1.0, F.lit("static"))
        .when(zoom < 0.4, F.lit("zoom out"))
        .when(zoom > 0.6, F.lit("zoom in"))
        .when((angle < 45) | (angle >= 315), F.lit("pan left"))
        .when(angle < 135, F.lit("tilt up"))
        .when(angle < 225, F.lit("pan right"))
        .when(angle < 315, F.lit("tilt down"))
        .otherwise(F.lit("unknown"))
    )


def video_motion(videos: DataFrame, frames: DataFrame, key: str = "path", label: str = "motion") -> DataFrame:
    """One camera motion per video: the strict majority of its frames, or a mixed label.

    Frames are counted per (video, label) first, so a long video is summed up where its frames are.
    """
    counts = frames.groupBy(key, label).agg(F.count(F.lit(1)).alias("n"))
    per_video = counts.groupBy(F.col(key).alias("_key")).agg(
        F.max("n").alias("_top"),
        F.max_by(label, "n").alias("_label"),
        F.sum("n").alias("_all"),
        F.bool_or(F.col(label) == "static").alias("_static"),
        F.bool_or(F.col(label).isin("zoom in", "zoom out")).alias("_zoom"),
    )
    motion = (
        F.when(F.col("_top") * 2 > F.col("_all"), F.col("_label"))
        .when(F.col("_static"), F.lit("unknown"))
        .when(F.col("_zoom"), F.lit("dynamic"))
        .otherwise(F.lit("pan/tilt"))
    )
    return videos.select(key).distinct().join(per_video, F.col(key) == F.col("_key"), "left").select(key, motion.alias("cmotion"))


# What two opposite edges moving this way mean for the camera.
TOP_DOWN_MOTION = {
    "left_left": "pan_right",
    "right_right": "pan_left",
    "down_down": "tilt_up",
    "up_up": "tilt_down",
    "up_down": "zoom_in",
    "down_up": "zoom_out",
    "static_static": "static",
}
LEFT_RIGHT_MOTION = {
    "left_left": "pan_right",
    "right_right": "pan_left",
    "down_down": "tilt_up",
    "up_up": "tilt_down",
    "left_right": "zoom_in",
    "right_left": "zoom_out",
    "static_static": "static",
}


def edge_of(row: Column, col: Column, grid: int = 10) -> Column:
    """Edges ('top', 'down', 'left', 'right') a grid point is tracked for: the middle of each side."""
    middle = grid // 2

    def central(x: Column) -> Column:
        return (x >= middle - 2) & (x < middle + 2)

    return F.array_compact(
        F.array(
            F.when((row == 0) & central(col), F.lit("top")),
            F.when((row == grid - 1) & central(col), F.lit("down")),
            F.when((col == 0) & central(row), F.lit("left")),
            F.when((col == grid - 1) & central(row), F.lit("right")),
        )
    )


def _directions(dx: Column, dy: Column, limit: Column) -> Column:
    sideways = F.when(dx > limit, F.lit("right")).when(dx < -limit, F.lit("left"))
    upright = F.when(dy > limit, F.lit("down")).when(dy < -limit, F.lit("up"))
    moves = F.array_compact(F.array(sideways, upright))
    return F.when(F.size(moves) == 0, F.array(F.lit("static"))).otherwise(moves)


def _edge_pair_motion(first: Column, second: Column, meaning: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in meaning.items() for x in pair])
    found = F.flatten(
        F.transform(first, lambda a: F.transform(second, lambda b: F.try_element_at(table, F.concat_ws("_", a, b))))
    )
    return F.array_compact(found)


def track_motion(points: DataFrame, key: str = "path", grid: int = 10, factor: float = 0.25) -> DataFrame:
    """Camera motion from tracked grid points (key, row, col, dx, dy, height, width).

    The mean displacement of the middle of each frame edge becomes directions; opposite edges
    together tell pans, tilts and zooms. Several motions are joined with ``+`` in alphabetical order.
    """
    edges = points.select(key, "dx", "dy", "height", "width", F.explode(edge_of(F.col("row"), F.col("col"), grid)).alias("edge"))
    # Sums and counts combine in the map tasks; four edges per video make one row.
    aggs = [F.max(F.least("height", "width")).alias("_size")]
    for edge in ("top", "down", "left", "right"):
        for axis in ("dx", "dy"):
            aggs.append(F.avg(F.when(F.col("edge") == edge, F.col(axis))).alias(f"{edge}_{axis}"))
    per_video = edges.groupBy(key).agg(*aggs)
    limit = F.col("_size") * F.lit(float(factor))

    def moves(edge: str) -> Column:
        return _directions(F.col(f"{edge}_dx"), F.col(f"{edge}_dy"), limit)

    found = F.array_sort(
        F.array_distinct(
            F.concat(
                _edge_pair_motion(moves("top"), moves("down"), TOP_DOWN_MOTION),
                _edge_pair_motion(moves("left"), moves("right"), LEFT_RIGHT_MOTION),
            )
        )
    )
    named = per_video.withColumn("_found", found)
    # 'static' gives way to any motion, but a pair of edges without meaning does not remove it.
    moving = F.array_remove(F.col("_found"), "static")
    label = (
        F.when(F.size("_found") == 0, F.lit("Undetermined"))
        .when(F.size(moving) > 0, F.array_join(moving, "+"))
        .otherwise(F.lit("static"))
    )
    return named.select(key, label.alias("cmotion"))


def zoom_factor(dx: Column, dy: Column, xs: Column, ys: Column, height: Column, width: Column) -> Column:
    """Share of pixels that do not move towards the centre; arrays hold one entry per pixel."""
    cx, cy = width / 2, height / 2
    moved = F.transform(
        F.arrays_zip(dx.alias("dx"), dy.alias("dy"), xs.alias("x"), ys.alias("y")),
        lambda p: F.sqrt(F.pow(p["x"] + p["dx"] - cx, 2) + F.pow(p["y"] + p["dy"] - cy, 2))
        >= F.sqrt(F.pow(p["x"] - cx, 2) + F.pow(p["y"] - cy, 2)),
    )
    return F.size(F.filter(moved, lambda out: out)) / F.size(moved)


def array_median(values: Column) -> Column:
    """Median of one row's array."""
    ordered = F.array_sort(F.transform(values, lambda v: v.cast("double")))
    n = F.size(values)
    low, high = F.get(ordered, F.floor((n - 1) / 2).cast("int")), F.get(ordered, F.floor(n / 2).cast("int"))
    return (low + high) / 2
