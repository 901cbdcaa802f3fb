"""From scene lists to a plan of clips to cut."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framesift.functions.paths import dirname, stem
from framesift.schema import require

_TIME = r"\d+:\d+:\d+(?:\.\d+)?"
_PAIR = rf"\(\s*['\"]({_TIME})['\"]\s*,\s*['\"]({_TIME})['\"]\s*,?\s*\)"
_LIST = rf"^\[\s*(?:{_PAIR}\s*(?:,\s*{_PAIR}\s*)*,?\s*)?\]$"

TICKS = 100  # timecodes are kept in hundredths of a second


def ticks(timecode: Column) -> Column:
    """'HH:MM:SS.mmm' in whole hundredths of a second."""
    part = F.split(timecode, ":")
    seconds = (
        F.get(part, F.lit(0)).cast("double") * 3600
        + F.get(part, F.lit(1)).cast("double") * 60
        + F.get(part, F.lit(2)).cast("double")
    )
    return F.bround(seconds * TICKS).cast("bigint")


def parse_scenes(timestamp: Column) -> Column:
    """Scene list text as array of (start, end) in hundredths of a second; NULL if it does not parse."""
    starts = F.regexp_extract_all(timestamp, F.lit(_PAIR), F.lit(1))
    ends = F.regexp_extract_all(timestamp, F.lit(_PAIR), F.lit(2))
    scenes = F.zip_with(starts, ends, lambda s, e: F.struct(ticks(s).alias("start"), ticks(e).alias("end")))
    return F.when(timestamp.rlike(_LIST), scenes)


def drop_invalid_timestamps(df: DataFrame) -> DataFrame:
    return require(df, "timestamp").filter(F.coalesce(F.col("timestamp").rlike(_LIST), F.lit(False)))


def scene_ok(df: DataFrame, flag: str = "ok") -> DataFrame:
    """Keep rows whose scene detection succeeded."""
    return require(df, flag).filter(F.col(flag)).drop(flag)


def resized(height: Column, width: Column, shorter: int | None) -> tuple[Column, Column]:
    """Output size: the shorter side shrinks to ``shorter``, the other keeps shape and is even.

    Never enlarges.
    """
    if shorter is None:
        return height, width
    keep = F.least(height, width) <= shorter
    wide = width > height

    def follow(a: Column, b: Column) -> Column:
        return (F.floor(F.lit(float(shorter)) * a / (b * 2) + 0.5) * 2).cast("int")

    out_h = F.when(keep, height).when(wide, F.lit(shorter)).otherwise(follow(height, width))
    out_w = F.when(keep, width).when(wide, follow(width, height)).otherwise(F.lit(shorter))
    return out_h.cast("int"), out_w.cast("int")


def clip_plan(
    df: DataFrame,
    save_dir: str,
    min_seconds: float | None = 2,
    max_seconds: float | None = 15,
    target_fps: int | None = 30,
    shorter: int | None = None,
) -> DataFrame:
    """One row per clip to cut: where it starts, how long it runs, where it goes and at which size.

    Scene numbers count all scenes, also those too short to cut. Rows with a broken scene list are
    dropped; a table without scene lists yields whole videos as scene 0.
    """
    require(df, "path")
    if "timestamp" in df.columns:
        scenes = df.withColumn("_scenes", parse_scenes(F.col("timestamp"))).filter("_scenes IS NOT NULL")
        rows = scenes.select(*df.columns, F.posexplode("_scenes").alias("scene", "_s"))
        length = F.greatest(F.col("_s.end") - F.col("_s.start"), F.lit(0))
        if min_seconds is not None:
            rows = rows.filter(length >= min_seconds * TICKS)
        if max_seconds is not None:
            length = F.least(length, F.lit(round(max_seconds * TICKS)))
        start, duration = F.col("_s.start") / TICKS, length / TICKS
    else:
        rows = df.withColumn("scene", F.lit(0))
        start = duration = F.lit(None).cast("double")
    folder = F.lit(save_dir.rstrip("/"))
    if "relpath" in df.columns:
        sub = dirname(F.col("relpath"))
        folder = F.when(sub == "", folder).otherwise(F.concat(folder, F.lit("/"), sub))
    name = F.concat(stem(F.col("path")), F.lit("_scene-"), F.col("scene").cast("string"), F.lit(".mp4"))
    columns = [
        "path",
        "scene",
        start.alias("start"),
        duration.alias("duration"),
        F.concat(folder, F.lit("/"), name).alias("clip_path"),
        F.lit(target_fps).cast("int").alias("target_fps"),
    ]
    if {"height", "width"} <= set(df.columns):
        out_h, out_w = resized(F.col("height"), F.col("width"), shorter)
        columns += [out_h.alias("out_h"), out_w.alias("out_w")]
    return rows.select(*columns)


def pending_clips(plan: DataFrame, listing: DataFrame) -> DataFrame:
    """Clips that are not on disk yet."""
    done = listing.select(F.col("path").alias("clip_path"))
    return plan.join(done, "clip_path", "left_anti")
