"""File listings and the meta tables derived from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framesift.functions.paths import basename, dirname, extension, relpath, stem
from framesift.schema import IMAGE_EXTENSIONS, LISTED_VIDEO_EXTENSIONS


def list_media(spark: SparkSession, root: str, extensions: Sequence[str] | None = None) -> DataFrame:
    """(path, length) of all files below a folder; file contents are never read.

    Local ``file:`` paths come without their scheme.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    listing = files.select(F.regexp_replace("path", r"^file:/*", "/").alias("path"), "length")
    if extensions is not None:
        listing = listing.filter(extension(F.col("path")).isin([e.lower().lstrip(".") for e in extensions]))
    return listing


def images_to_meta(listing: DataFrame) -> DataFrame:
    images = listing.filter(extension(F.col("path")).isin(IMAGE_EXTENSIONS))
    return images.select(stem(F.col("path")).alias("id"), "path")


def videos_to_meta(listing: DataFrame, root: str) -> DataFrame:
    videos = listing.filter(extension(F.col("path")).isin(LISTED_VIDEO_EXTENSIONS)).select("path").distinct()
    return videos.select("path", stem(F.col("path")).alias("id"), relpath(F.col("path"), root).alias("relpath"))


def split_by_capital(name: Column) -> Column:
    """'BoxingPunchingBag' -> 'Boxing Punching Bag'."""
    return F.regexp_replace(name, r"(?<!^)(\p{Lu})", " $1")


def parent_folder(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def classes_from_dirs(listing: DataFrame) -> DataFrame:
    """Folder name, split at capitals, as caption."""
    return listing.select("path", split_by_capital(parent_folder(F.col("path"))).alias("text"))


def label_by_class(listing: DataFrame, labels: DataFrame) -> DataFrame:
    """Caption from a label table (folder, text): one row per class."""
    return listing.withColumn("folder", parent_folder(F.col("path"))).join(labels, "folder").select("path", "text")


def existing_by_id(info: DataFrame, listing: DataFrame, root: str, prefix: str = "") -> DataFrame:
    """Prompts whose generated video is on disk."""
    path = F.concat(F.lit(root.rstrip("/") + "/" + prefix), F.col("uuid"), F.lit(".mp4"))
    return info.select(path.alias("path"), F.col("prompt").alias("text")).join(listing.select("path"), "path", "left_semi")


def id_to_path(
    df: DataFrame, folder: str, mode: str | None = None, evidence: DataFrame | None = None
) -> DataFrame:
    """``folder/{id}.mp4`` as path, with an ``intact`` flag.

    Mode None trusts every row; '.mp4' needs the file in a listing; '.json' needs a sidecar
    (path, success) whose success is true.
    """
    base = F.concat(F.lit(folder.rstrip("/") + "/"), F.col("id"))
    out = df.withColumn("path", F.concat(base, F.lit(".mp4")))
    if mode is None:
        return out.withColumn("intact", F.lit(True))
    if mode == ".mp4":
        good = evidence.select(F.col("path").alias("_good")).distinct()
        target = F.col("path")
    elif mode == ".json":
        good = evidence.filter(F.col("success")).select(F.col("path").alias("_good")).distinct()
        target = F.concat(base, F.lit(".json"))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    joined = out.withColumn("_target", target).join(good, F.col("_target") == F.col("_good"), "left")
    return joined.withColumn("intact", F.col("_good").isNotNull()).drop("_target", "_good")


def intact_only(df: DataFrame) -> DataFrame:
    return df.filter("intact").drop("intact")


def grandparent(path: Column) -> Column:
    """The folder two levels above a file's own folder."""
    return dirname(dirname(dirname(path)))


def attach_sidecar_json(listing: DataFrame, metadata: DataFrame, default: str = "Unknown Task") -> DataFrame:
    """Videos with the ``current_task`` of the metadata file two folders up.

    ``metadata`` is (path, current_task); the first file name of a folder counts. Videos without one
    are dropped.
    """
    per_folder = metadata.filter(basename(F.col("path")).rlike(r"^metadata.*\.json$")).groupBy(
        dirname(F.col("path")).alias("_folder")
    ).agg(F.min_by(F.coalesce("current_task", F.lit(default)), "path").alias("text"))
    videos = listing.filter(F.col("path").endswith(".mp4")).withColumn("_at", grandparent(F.col("path")))
    return videos.join(per_folder, F.col("_at") == F.col("_folder")).select("path", "text")
