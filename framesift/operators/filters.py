"""Row filters. Each is a plain predicate, so scans push it down where the format allows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framesift.functions.paths import is_image
from framesift.schema import present, require

# Fixed value: what a captioning job writes where it failed.
FAILED_CAPTION = "error occured during captioning"


def remove_url(df: DataFrame) -> DataFrame:
    """Drop captions holding a URL; NULL captions stay."""
    return require(df, "text").filter(~F.coalesce(F.col("text").rlike(r"https?://\S+"), F.lit(False)))


def remove_empty_path(df: DataFrame) -> DataFrame:
    return require(df, "path").filter(F.length("path") > 0)


def remove_empty_caption(df: DataFrame) -> DataFrame:
    return require(df, "text").filter(F.length("text") > 0)


def path_subset(df: DataFrame, pattern: str) -> DataFrame:
    """Keep paths in which the regular expression is found."""
    return require(df, "path").filter(F.col("path").rlike(pattern))


def exists(df: DataFrame, listing: DataFrame) -> DataFrame:
    """Keep rows whose path is in a file listing."""
    return require(df, "path").join(listing.select("path"), "path", "left_semi")


def frames_min(df: DataFrame, minimum: int) -> DataFrame:
    """Also the late ``min_frame`` filter, which runs after head and column pruning."""
    return require(df, "num_frames").filter(F.col("num_frames") >= minimum)


def frames_max(df: DataFrame, maximum: int) -> DataFrame:
    return require(df, "num_frames").filter(F.col("num_frames") <= maximum)


def fps_max(df: DataFrame, maximum: float) -> DataFrame:
    """Rows without a frame rate (images) stay."""
    fps = F.col("fps")
    return require(df, "fps").filter((fps <= maximum) | fps.isNull() | F.isnan(fps))


def pixels_max(df: DataFrame, maximum: int) -> DataFrame:
    if "resolution" not in df.columns:
        require(df, "height", "width")
        df = df.withColumn("resolution", F.col("height").cast("bigint") * F.col("width").cast("bigint"))
    return df.filter(F.col("resolution") <= maximum)


def filesize_max(df: DataFrame, maximum_mb: float) -> DataFrame:
    return require(df, "filesize").filter(F.col("filesize") <= maximum_mb)


def score_min(df: DataFrame, column: str, minimum: float) -> DataFrame:
    """Missing scores are dropped, as a comparison with NaN is false."""
    return require(df, column).filter((F.col(column) >= minimum) & present(F.col(column)))


def images_only(df: DataFrame) -> DataFrame:
    return require(df, "path").filter(is_image(F.col("path")))


def videos_only(df: DataFrame) -> DataFrame:
    """Anything that is not an image counts as video, a missing path too."""
    return require(df, "path").filter(~F.coalesce(is_image(F.col("path")), F.lit(False)))


def drop_failed_captions(df: DataFrame, sentinel: str = FAILED_CAPTION) -> DataFrame:
    return require(df, "text").filter(~F.coalesce(F.col("text") == sentinel, F.lit(False)))


def text_density(detections: DataFrame, threshold: float = 0.3, key: str = "path") -> DataFrame:
    """Number of text boxes per item whose confidence passes the threshold."""
    return detections.groupBy(key).agg(F.count_if(F.col("score") > threshold).cast("int").alias("ocr"))


def ocr_max(df: DataFrame, maximum: int) -> DataFrame:
    return require(df, "ocr").filter(F.col("ocr") <= maximum)
