"""The meta table: canonical columns, presence checks and null normalisation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

META_TYPES = {
    "path": T.StringType(),
    "id": T.StringType(),
    "relpath": T.StringType(),
    "text": T.StringType(),
    "num_frames": T.IntegerType(),
    "height": T.IntegerType(),
    "width": T.IntegerType(),
    "aspect_ratio": T.DoubleType(),
    "fps": T.DoubleType(),
    "resolution": T.LongType(),
    "text_len": T.IntegerType(),
    "filesize": T.DoubleType(),
    "aes": T.DoubleType(),
    "flow": T.DoubleType(),
    "match": T.DoubleType(),
    "ocr": T.IntegerType(),
    "cmotion": T.StringType(),
    "timestamp": T.StringType(),
    "intact": T.BooleanType(),
}

# The columns a training job reads.
TRAIN_COLUMNS = [
    "path", "text", "num_frames", "fps", "height", "width", "aspect_ratio", "resolution", "text_len",
]

# File extensions by media kind.
IMAGE_EXTENSIONS = ["jpg", "jpeg", "png", "ppm", "bmp", "pgm", "tif", "tiff", "webp"]
VIDEO_EXTENSIONS = ["mp4", "avi", "mov", "mkv"]
LISTED_VIDEO_EXTENSIONS = ["mp4", "avi", "mov", "mkv", "m2ts"]


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Fail before any job starts if a needed column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df


def nan_to_null(df: DataFrame) -> DataFrame:
    """One missing value only: NaN becomes NULL in every floating column."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floating:
        return df
    return df.select(
        *[F.nanvl(F.col(c), F.lit(None)).alias(c) if c in floating else F.col(c) for c in df.columns]
    )


def conform(df: DataFrame) -> DataFrame:
    """Cast known columns to their canonical types; unknown columns pass through."""
    return nan_to_null(
        df.select(
            *[
                F.expr(f"try_cast(`{c}` AS {META_TYPES[c].simpleString()})").alias(c)
                if c in META_TYPES and df.schema[c].dataType != META_TYPES[c]
                else F.col(c)
                for c in df.columns
            ]
        )
    )


def present(column: Column) -> Column:
    """Neither NULL nor NaN."""
    return column.isNotNull() & ~F.isnan(column)


def free_names(columns: Iterable[str], *wanted: str) -> list[str]:
    """Names like the wanted ones for helper columns, different from each other and from those a table has."""
    taken, names = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        names.append(name)
    return names
