"""Media facts: sizes, probe results, conditioning values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framesift.operators.joins import assert_unique

from framesift.schema import TRAIN_COLUMNS, require

IMAGE_FPS = 120  # fixed value: the frame rate that stands for a still image


def aspect_ratio(height: Column, width: Column) -> Column:
    """Height over width; missing when there is no width."""
    return F.when(width > 0, height.cast("double") / width)


def derive_dims(df: DataFrame) -> DataFrame:
    require(df, "height", "width")
    return df.withColumn("resolution", F.col("height").cast("bigint") * F.col("width").cast("bigint")).withColumn(
        "aspect_ratio", aspect_ratio(F.col("height"), F.col("width"))
    )


def filesize_mb(df: DataFrame, length: str = "length") -> DataFrame:
    return require(df, length).withColumn("filesize", F.col(length).cast("double") / 1024 / 1024)


def attach_filesize(df: DataFrame, listing: DataFrame) -> DataFrame:
    """File size in MB from a listing with ``path, length``."""
    sizes = assert_unique(listing.select("path", "length"), "path")
    return filesize_mb(require(df, "path").join(sizes, "path", "left")).drop("length")


def train_columns(df: DataFrame) -> DataFrame:
    """Only the training columns, in the table's own order."""
    return df.select(*[c for c in df.columns if c in TRAIN_COLUMNS])


def attach_media_info(df: DataFrame, probe: DataFrame) -> DataFrame:
    """Frames, size and rate from a probe table (path, num_frames, height, width, fps).

    Rows without a probe result read 0 frames of 0 x 0, so a minimum of one frame removes them. A path
    that was probed twice fails the job.
    """
    facts = derive_dims(
        probe.select("path", *[F.col(c).cast("int").alias(c) for c in ("num_frames", "height", "width")], "fps")
    )
    names = ["num_frames", "height", "width", "aspect_ratio", "fps", "resolution"]
    joined = df.drop(*names).join(assert_unique(facts, "path"), "path", "left")
    counts = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("num_frames", "height", "width")}
    return joined.withColumns(counts).select(*[c for c in df.columns if c not in names], *names)


def conditioning_info(df: DataFrame, frame_interval: int = 1, default_fps: int = 24) -> DataFrame:
    """Aspect ratio and effective frame rate as the training batches see them."""
    rate = F.floor(F.coalesce(F.nanvl(F.col("fps"), F.lit(None)), F.lit(float(default_fps))) / frame_interval)
    return df.withColumn("ar", aspect_ratio(F.col("height"), F.col("width"))).withColumn(
        "cond_fps", F.when(F.col("num_frames") == 1, F.lit(IMAGE_FPS)).otherwise(rate).cast("int")
    )
