"""Evaluation tables: frame metrics, weighted scorecards, loss tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def psnr(a: Column, b: Column) -> Column:
    """Peak signal-to-noise ratio of two frames with values in [0, 1]; 100 for identical ones."""
    squares = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    mse = F.aggregate(squares, F.lit(0.0), lambda t, s: t + s) / F.size(a)
    return F.when(mse < 1e-10, F.lit(100.0)).otherwise(20 * F.log10(1 / F.sqrt(mse)))


def metric_by_timestamp(df: DataFrame, metric: str = "value", time: str = "t") -> DataFrame:
    """Mean and population deviation per frame position."""
    return df.groupBy(time).agg(F.avg(metric).alias("mean"), F.stddev_pop(metric).alias("std"))


def metric_total(df: DataFrame, batch_size: int, video: str = "video", metric: str = "value", time: str = "t") -> DataFrame:
    """Mean over batches of the per-position means, ``video`` numbering the videos from 0."""
    per_batch = df.groupBy(F.floor(F.col(video) / batch_size).alias("_batch"), time).agg(F.avg(metric).alias("_m"))
    return per_batch.agg(F.avg("_m").alias("total"))


def _gaussian(size: int = 11, sigma: float = 1.5) -> np.ndarray:
    x = np.arange(size) - (size - 1) / 2
    g = np.exp(-(x**2) / (2 * sigma**2))
    return g / g.sum()


def _blur_valid(image: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    rows = np.lib.stride_tricks.sliding_window_view(image, len(kernel), axis=-2) @ kernel
    return np.lib.stride_tricks.sliding_window_view(rows, len(kernel), axis=-1) @ kernel


def frame_ssim(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Structural similarity of two stacks of (channel, height, width) frames, averaged over each frame."""
    c1, c2, k = 0.01**2, 0.03**2, _gaussian()
    ma, mb = _blur_valid(a, k), _blur_valid(b, k)
    va, vb = _blur_valid(a * a, k) - ma * ma, _blur_valid(b * b, k) - mb * mb
    cov = _blur_valid(a * b, k) - ma * mb
    value = ((2 * ma * mb + c1) * (2 * cov + c2)) / ((ma * ma + mb * mb + c1) * (va + vb + c2))
    return value.mean(axis=(-3, -2, -1))


# Numbers of one stack; a single larger frame is a stack of its own.
_STACK = 1 << 20


def ssim(df: DataFrame, keys: Sequence[str], a: str = "a", b: str = "b") -> DataFrame:
    """Similarity per row; frames are flat arrays with their ``channels, height, width``.

    Frames of one shape are worked on together, in stacks of bounded size.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = np.full(len(batch), np.nan)
            shapes = batch.groupby(["channels", "height", "width"]).indices
            for shape, rows in shapes.items():
                shape = tuple(int(n) for n in shape)
                step = max(1, _STACK // int(np.prod(shape)))
                for at in range(0, len(rows), step):
                    some = rows[at : at + step]
                    first, second = (np.stack(batch[c].to_numpy()[some]).astype(float).reshape(-1, *shape) for c in (a, b))
                    values[some] = frame_ssim(first, second)
            yield batch[list(keys)].assign(ssim=values)

    return df.select(*keys, "channels", "height", "width", a, b).mapInPandas(run, f"{fields}, ssim double")


@dataclass(frozen=True)
class Scorecard:
    """How dimensions combine: range and weight of each, the groups, and their weights in the total."""

    dimensions: Mapping[str, tuple[float, float, float]]
    groups: Mapping[str, Sequence[str]]
    group_weights: Mapping[str, float]


# Fixed values: (minimum, maximum, weight) of each video quality dimension.
VIDEO_SCORECARD = Scorecard(
    dimensions={
        "subject consistency": (0.1462, 1.0, 1),
        "background consistency": (0.2615, 1.0, 1),
        "temporal flickering": (0.6293, 1.0, 1),
        "motion smoothness": (0.706, 0.9975, 1),
        "dynamic degree": (0.0, 1.0, 0.5),
        "aesthetic quality": (0.0, 1.0, 1),
        "imaging quality": (0.0, 1.0, 1),
        "object class": (0.0, 1.0, 1),
        "multiple objects": (0.0, 1.0, 1),
        "human action": (0.0, 1.0, 1),
        "color": (0.0, 1.0, 1),
        "spatial relationship": (0.0, 1.0, 1),
        "scene": (0.0, 0.8222, 1),
        "appearance style": (0.0009, 0.2855, 1),
        "temporal style": (0.0, 0.364, 1),
        "overall consistency": (0.0, 0.364, 1),
    },
    groups={
        "quality score": [
            "subject consistency",
            "background consistency",
            "temporal flickering",
            "motion smoothness",
            "aesthetic quality",
            "imaging quality",
            "dynamic degree",
        ],
        "semantic score": [
            "object class",
            "multiple objects",
            "human action",
            "color",
            "spatial relationship",
            "scene",
            "appearance style",
            "temporal style",
            "overall consistency",
        ],
    },
    group_weights={"quality score": 4, "semantic score": 1},
)

# The same for image-to-video; camera motion is reported but in no group.
IMAGE_TO_VIDEO_SCORECARD = Scorecard(
    dimensions={
        "camera motion": (0.0, 1.0, 0.1),
        "i2v subject": (0.1462, 1.0, 1),
        "i2v background": (0.2615, 1.0, 1),
        "subject consistency": (0.1462, 1.0, 1),
        "background consistency": (0.2615, 1.0, 1),
        "motion smoothness": (0.706, 0.9975, 1),
        "dynamic degree": (0.0, 1.0, 0.5),
        "aesthetic quality": (0.0, 1.0, 1),
        "imaging quality": (0.0, 1.0, 1),
        "temporal flickering": (0.6293, 1.0, 1),
    },
    groups={
        "i2v score": ["i2v subject", "i2v background"],
        "quality score": [
            "subject consistency",
            "background consistency",
            "temporal flickering",
            "motion smoothness",
            "aesthetic quality",
            "imaging quality",
            "dynamic degree",
        ],
    },
    group_weights={"i2v score": 1, "quality score": 1},
)


def weighted_scorecard(scores: DataFrame, card: Scorecard, by: str = "model") -> DataFrame:
    """(by, item, score) for every dimension, group and the total of each model.

    ``scores`` is (by, dimension, value). Underscores in names read as spaces; values count with four
    decimals. A model without all dimensions, or an unknown dimension, fails the job.
    """
    spark = scores.sparkSession
    group_of = {d: g for g, members in card.groups.items() for d in members}
    constants = spark.createDataFrame(
        [(d, float(lo), float(hi), float(w), group_of.get(d)) for d, (lo, hi, w) in card.dimensions.items()],
        "dimension string, lo double, hi double, weight double, grp string",
    )
    given = scores.select(
        by, F.replace("dimension", F.lit("_"), F.lit(" ")).alias("dimension"), F.round(F.col("value"), 4).alias("value")
    )
    joined = given.join(F.broadcast(constants), "dimension", "left").withColumn(
        "scaled", (F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.col("weight")
    )
    wide = [F.countDistinct("dimension").alias("_seen"), F.bool_and(F.col("weight").isNotNull()).alias("_known")]
    items: dict[str, Column] = {}
    for i, d in enumerate(card.dimensions):
        wide.append(F.max(F.when(F.col("dimension") == d, F.col("scaled"))).alias(f"_d{i}"))
        items[d] = F.col(f"_d{i}")
    for name, members in card.groups.items():
        total = sum((items[d] for d in members[1:]), items[members[0]])
        items[name] = total / float(sum(card.dimensions[d][2] for d in members))
    weights = card.group_weights
    weighted = [items[g] * float(w) for g, w in weights.items()]
    items["total score"] = sum(weighted[1:], weighted[0]) / float(sum(weights.values()))
    per_model = joined.groupBy(by).agg(*wide)
    complete = F.col("_known") & (F.col("_seen") == len(card.dimensions))
    message = F.concat(F.lit("dimensions missing or unknown for "), F.col(by).cast("string"))
    checked = per_model.filter(F.when(complete, F.lit(True)).otherwise(F.raise_error(message)))
    listed = F.explode(F.array(*[F.struct(F.lit(n).alias("item"), c.alias("score")) for n, c in items.items()]))
    return checked.select(by, listed.alias("_i")).select(by, "_i.item", "_i.score")


def as_percent(score: Column) -> Column:
    """Report form of a score, such as ``79.23%``."""
    return F.concat(F.format_string("%.2f", score * 100), F.lit("%"))


def read_loss_logs(spark, path: str) -> DataFrame:
    """(file, line, value) of log files; ``line`` orders the lines of a file."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n")).alias("line"),
        "value",
    )


_LOSS = r"\(\s*'?([^',()]+)'?\s*,\s*(\d+)\s*\)\s*:\s*([-+0-9.eE]+)"


def losses(logs: DataFrame) -> DataFrame:
    """(res, frames, loss) from the last line of each file, read after ``losses:``."""
    last = logs.groupBy("file").agg(F.max_by("value", "line").alias("value"))
    text = F.substring_index("value", "losses:", -1)
    found = [F.regexp_extract_all(text, F.lit(_LOSS), F.lit(i)) for i in (1, 2, 3)]
    rows = last.select("file", F.explode(F.arrays_zip(*[f.alias(n) for f, n in zip(found, "rtl")])).alias("_l"))
    return rows.select(
        "file",
        F.col("_l.r").alias("res"),
        F.col("_l.t").cast("int").alias("frames"),
        F.round(F.col("_l.l").cast("double"), 4).alias("loss"),
    )


def loss_table(logs: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """One row per resolution with a loss column per clip length; the last file read wins a clash."""
    cells = losses(logs).groupBy("res", "frames").agg(F.max_by("loss", "file").alias("loss"))
    return cells.groupBy("res").pivot("frames", list(lengths)).agg(F.first("loss"))


def bucket_loss(df: DataFrame) -> DataFrame:
    """Per (res, frames): plain mean over time steps of the mean sample loss."""
    per_step = df.groupBy("res", "frames", "t").agg((F.sum("loss") / F.count("loss")).alias("_m"))
    return per_step.groupBy("res", "frames").agg(F.avg("_m").alias("loss"))


def result_integrity(results: DataFrame, infos: DataFrame, key: str = "name") -> DataFrame:
    """Results that lack an info file or whose video list is empty, with the reason."""
    info = infos.groupBy(F.col(key).alias("_key")).agg(F.max(F.size("video_list")).alias("_videos"))
    joined = results.select(key).distinct().join(info, F.col(key) == F.col("_key"), "left")
    problem = F.when(F.col("_key").isNull(), F.lit("no info")).when(F.col("_videos") <= 0, F.lit("no videos"))
    return joined.select(key, problem.alias("problem")).filter("problem IS NOT NULL")
