"""Nested columns: trajectories, frame arrays, annotation and request documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framesift.functions.frames import resample_frames
from framesift.operators.ordering import with_position


def downsample_trajectory(
    df: DataFrame, columns: Sequence[str] = ("state",), target_fps: float = 3, source_fps: float = 60
) -> DataFrame:
    """Thin out per-step arrays to the frames that survive a change of frame rate.

    The video is one step shorter than the trajectory.
    """
    frames = resample_frames(F.size(columns[0]) - 1, target_fps, source_fps)
    thinned = df.withColumn("_at", frames)
    picked = {c: _gather(F.col("_at"), F.col(c)) for c in columns}
    return thinned.withColumns(picked).drop("_at")


def _gather(positions: Column, values: Column) -> Column:
    return F.transform(positions, lambda i: F.get(values, i))


# Fixed value: the task name in annotation documents.
ANNOTATION_TASK = "robot_trajectory_prediction"


def build_annotation(
    df: DataFrame, old_prefix: str, new_prefix: str, order_by: str = "pos", task: str = ANNOTATION_TASK
) -> DataFrame:
    """One JSON document per episode; the episode id is the row's position.

    Needs path, text, state and continuous_gripper_state.
    """
    placed = with_position(df, order_by, name="_at")
    video = F.replace(F.col("path"), F.lit(old_prefix), F.lit(new_prefix))
    document = F.struct(
        F.lit(task).alias("task"),
        F.array("text").alias("texts"),
        F.array(F.struct(video.alias("video_path"))).alias("videos"),
        "state",
        "continuous_gripper_state",
        F.col("_at").cast("string").alias("episode_id"),
    )
    return placed.select(
        F.col("_at").cast("string").alias("episode_id"),
        F.concat(F.col("_at").cast("string"), F.lit(".json")).alias("file"),
        F.to_json(document).alias("json"),
    )


def recording_path(path: Column, media_part: str, video_part: str, raw_part: str, file: str = "trajectory.h5") -> Column:
    """Where the raw recording of a video lies: drop one part, swap another, fixed file name."""
    moved = F.replace(F.replace(path, F.lit(media_part), F.lit("")), F.lit(video_part), F.lit(raw_part))
    return F.concat(F.regexp_replace(moved, r"[^/]*$", ""), F.lit(file))


def build_caption_request(
    df: DataFrame,
    template: str,
    model: str,
    frames: str = "frames",
    need_frames: int | None = None,
    temperature: int = 0,
    max_tokens: int = 1000,
) -> DataFrame:
    """One chat request per video as a JSON line: the prompt, then one image entry per frame.

    Frames are base64 strings. Rows with a repeated frame, or not ``need_frames`` of them, are left
    out.
    """
    text = F.replace(F.lit(template), F.lit("{task_description}"), F.coalesce("text", F.lit("")))

    def entry(kind: str, text: Column, url: Column) -> Column:
        # to_json leaves NULL fields out, so text and image entries can share one type.
        return F.struct(F.lit(kind).alias("type"), text.alias("text"), url.alias("image_url"))

    no_text, no_image = F.lit(None).cast("string"), F.lit(None).cast("struct<url: string>")
    images = F.transform(
        frames,
        lambda f: entry("image_url", no_text, F.struct(F.concat(F.lit("data:image/jpeg;base64,"), f).alias("url"))),
    )
    message = F.struct(F.lit("user").alias("role"), F.concat(F.array(entry("text", text, no_image)), images).alias("content"))
    request = F.struct(
        F.col("path").alias("custom_id"),
        F.lit("POST").alias("method"),
        F.lit("/v1/chat/completions").alias("url"),
        F.struct(
            F.lit(model).alias("model"),
            F.array(message).alias("messages"),
            F.lit(temperature).alias("temperature"),
            F.lit(max_tokens).alias("max_tokens"),
        ).alias("body"),
    )
    keep = F.size(F.array_distinct(F.col(frames))) == F.size(frames)
    if need_frames is not None:
        keep = keep & (F.size(frames) == need_frames)
    return df.filter(keep).select(F.col("path").alias("custom_id"), F.to_json(request).alias("value"))


def parse_nested_list(text: Column, schema: str) -> Column:
    """A printed list (of lists, tuples or strings) as an array; NULL if it does not parse.

    Tuples read as lists. Brackets inside quoted strings stay untouched.
    """
    as_lists = F.regexp_replace(F.regexp_replace(text, r"\(\s*(?=['\"\d\-\[(])", "["), r"(?<=['\"\d\])])\s*,?\s*\)", "]")
    return F.from_json(as_lists, schema)


def explode_frames(df: DataFrame, key: Sequence[str], arrays: Sequence[str]) -> DataFrame:
    """Long form of parallel per-frame arrays: one row per frame."""
    zipped = F.posexplode(F.arrays_zip(*arrays)).alias("frame_idx", "_v")
    return df.select(*key, zipped).select(*key, "frame_idx", *[F.col(f"_v.{a}").alias(a) for a in arrays])


def implode_frames(
    df: DataFrame, key: Sequence[str], values: Sequence[str], index: str = "frame_idx", per_row: int | None = None
) -> DataFrame:
    """The inverse: one row per key with arrays ordered by frame index, however many frames there are.

    With ``per_row`` a key has one row for every so many of its frames, numbered from 0 in ``part``: the
    arrays of its parts, one after the other, are those of the key, and no task holds a whole hot key.
    """
    key = list(key)
    if per_row is not None:
        df = with_position(df, [index, *values], key, name="part").withColumn("part", F.expr(f"part div {per_row}"))
        key = [*key, "part"]
    packed = df.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(index, *values))).alias("_rows"))
    # Extracting a field from an array of structs gives the array of that field.
    return packed.select(*key, *[F.col("_rows").getField(v).alias(v) for v in values])


def all_exist(df: DataFrame, listing: DataFrame, key: str, paths: str) -> DataFrame:
    """Per key, whether every path of its array is in the listing."""
    wanted = df.select(key, F.explode(paths).alias("path"))
    marked = wanted.join(listing.select("path", F.lit(True).alias("_there")).distinct(), "path", "left")
    return marked.groupBy(key).agg(F.bool_and(F.col("_there").isNotNull()).alias("all_exist"))
