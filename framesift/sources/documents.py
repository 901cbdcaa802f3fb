"""JSON documents next to or in place of meta rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framesift.operators.joins import assert_unique

from framesift.functions.paths import abspath

ANNOTATION_SCHEMA = (
    "task string, texts array<string>, videos array<struct<video_path: string>>, "
    "state array<array<double>>, action array<array<double>>, continuous_gripper_state array<double>, "
    "episode_id string"
)


def read_json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One document per file at any depth, with its path; broken files give NULL fields."""
    reader = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE")
    files = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)
    return files.select(F.regexp_replace(F.col("_metadata.file_path"), r"^file:/*", "/").alias("path"), "*")


def load_sidecar_caption(df: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Caption from the JSON named like the path up to its first dot; '' where there is none.

    ``sidecars`` is (path, caption), a path at most once.
    """
    found = assert_unique(sidecars.select(F.col("path").alias("_json"), F.col("caption").alias("_caption")), "_json")
    keyed = df.withColumn("_want", F.concat(F.substring_index("path", ".", 1), F.lit(".json")))
    joined = keyed.join(found, F.col("_want") == F.col("_json"), "left")
    return joined.withColumn("text", F.coalesce("_caption", F.lit(""))).drop("_want", "_json", "_caption")


def annotations_to_rows(documents: DataFrame, prefix: str = "") -> DataFrame:
    """One row per video of each annotation with its trajectory arrays; missing arrays are empty."""
    def array_or_empty(name: str) -> Column:
        kind = documents.schema[name].dataType.simpleString()
        return F.coalesce(F.col(name), F.array().cast(kind)).alias(name)

    videos = documents.withColumn("_v", F.explode("videos"))
    return videos.select(
        F.concat(F.lit(prefix), F.coalesce(F.col("_v.video_path"), F.lit(""))).alias("path"),
        *[array_or_empty(c) for c in ("state", "action", "continuous_gripper_state")],
    )


def select_json_paths(documents: DataFrame, root: str, path_field: str = "right_mp4_path", folder_field: str = "lab") -> DataFrame:
    """``root/folder/path`` of every document that has both fields, with forward slashes."""
    both = documents.filter(F.col(path_field).isNotNull() & F.col(folder_field).isNotNull())
    inner = F.when(F.col(path_field).startswith("/"), F.col(path_field)).otherwise(
        F.concat_ws("/", F.regexp_replace(folder_field, "/$", ""), path_field)
    )
    return both.select(F.translate(abspath(inner, root), "\\", "/").alias("path"))
