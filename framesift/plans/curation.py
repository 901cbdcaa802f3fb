"""The curation job: one meta table in, one out.

Stages run in a fixed order whatever order they are asked for in. The plan is lazy from end to end,
so Spark reads only the columns that the chosen stages and outputs need and moves plain filters to
the scan. Sorting is carried as an order key: a later "keep the first" or "head" uses it, and rows
are physically sorted once, at the end.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framesift.functions import captions as text_fn
from framesift.functions import paths as path_fn
from framesift.functions.rng import draw_hash
from framesift.operators import captions, filters, joins, language, media, ordering
from framesift.schema import free_names
from framesift.sources.documents import load_sidecar_caption


@dataclass
class Context:
    """Row order and randomness shared by the stages."""

    key: str
    seed: int
    order: list[Column] = field(default_factory=list)
    # The same order as (column, descending) pairs, unless shuffled.
    by: list[tuple[str, bool]] = field(default_factory=list)
    sorted: bool = False
    shuffled: bool = False

    def __post_init__(self):
        self.order = self.order or [F.col(self.key).asc()]
        self.by = self.by or [(self.key, False)]


def _column(name: str, make: Callable[..., Column]) -> Callable:
    """A stage that replaces one column; flags that are plain True take no argument."""

    def run(df: DataFrame, arg, _: Context) -> DataFrame:
        return df.withColumn(name, make(F.col(name)) if arg is True else make(F.col(name), arg))

    return run


def _plain(fn: Callable[..., DataFrame]) -> Callable:
    return lambda df, arg, _: fn(df) if arg is True else fn(df, arg)


def _lang(df: DataFrame, arg, ctx: Context) -> DataFrame:
    target, profiles, *k = arg
    return language.lang_filter(df, profiles, target, *k, key=ctx.key)


def _merge_cmotion(df: DataFrame, arg, _: Context) -> DataFrame:
    return df.withColumn("text", text_fn.merge_camera_motion(F.col("text"), F.col("cmotion"), "keep" if arg == "keep" else "error"))


def _sort(descending: bool) -> Callable:
    def run(df: DataFrame, column: str, ctx: Context) -> DataFrame:
        first = F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_last()
        ctx.order = [first, *ctx.order]
        ctx.by = [(column, descending), *ctx.by]
        ctx.sorted = True
        return df

    return run


def _shuffle(df: DataFrame, arg, ctx: Context) -> DataFrame:
    ctx.order = [draw_hash(ctx.seed, F.col(ctx.key)), F.col(ctx.key)]
    ctx.shuffled = ctx.sorted = True
    return df


def _head(df: DataFrame, n: int, ctx: Context) -> DataFrame:
    if not ctx.shuffled:
        return ordering.head(df, n, by=ctx.by)
    (digest,) = free_names(df.columns, "_h")
    drawn = df.withColumn(digest, draw_hash(ctx.seed, F.col(ctx.key)))
    return ordering.head(drawn, n, by=[(digest, False), (ctx.key, False)]).drop(digest)


# Stage name -> operator, in the order of execution.
STAGES: list[tuple[str, Callable[[DataFrame, object, Context], DataFrame]]] = [
    ("difference", _plain(joins.difference)),
    ("intersection", _plain(joins.intersection)),
    ("load_caption", _plain(load_sidecar_caption)),
    ("info", _plain(media.attach_media_info)),
    ("ext", _plain(filters.exists)),
    ("remove_url", _plain(filters.remove_url)),
    ("lang", _lang),
    ("remove_empty_path", _plain(filters.remove_empty_path)),
    ("remove_empty_caption", _plain(filters.remove_empty_caption)),
    ("remove_path_duplication", lambda df, _, ctx: ordering.keep_first(df, "path", ctx.order)),
    ("path_subset", _plain(filters.path_subset)),
    ("relpath", _column("path", path_fn.relpath)),
    ("abspath", _column("path", path_fn.abspath)),
    ("path_to_id", lambda df, _, ctx: df.withColumn("id", path_fn.stem(F.col("path")))),
    ("merge_cmotion", _merge_cmotion),
    ("refine_llm_caption", _column("text", text_fn.strip_caption_prefix)),
    ("append_text", _column("text", text_fn.append_text)),
    ("score_to_text", lambda df, _, ctx: captions.add_scores_to_text(df, ctx.seed, ctx.key)),
    ("clean_caption", lambda df, _, ctx: captions.clean_caption(df)),
    ("count_num_token", lambda df, arg, _: captions.count_tokens(df, arg if callable(arg) else None)),
    ("update_text", _plain(joins.update_text)),
    ("sort", _sort(descending=True)),
    ("sort_ascending", _sort(descending=False)),
    ("filesize", _plain(media.attach_filesize)),
    ("fsmax", _plain(filters.filesize_max)),
    ("remove_empty_caption", _plain(filters.remove_empty_caption)),
    ("fmin", _plain(filters.frames_min)),
    ("fmax", _plain(filters.frames_max)),
    ("fpsmax", _plain(filters.fps_max)),
    ("hwmax", _plain(filters.pixels_max)),
    ("aesmin", lambda df, v, _: filters.score_min(df, "aes", v)),
    ("matchmin", lambda df, v, _: filters.score_min(df, "match", v)),
    ("flowmin", lambda df, v, _: filters.score_min(df, "flow", v)),
    ("remove_text_duplication", lambda df, _, ctx: ordering.dedup_text(df, ctx.order)),
    ("img_only", _plain(filters.images_only)),
    ("vid_only", _plain(filters.videos_only)),
    ("shuffle", _shuffle),
    ("head", _head),
]

# Stages after the row set and its order are settled.
FINAL_STAGES = ("train_column", "min_frame", "shard")
STAGE_NAMES = {name for name, _ in STAGES} | set(FINAL_STAGES)


def curate(df: DataFrame, key: str = "pos", seed: int = 42, ordered: bool = True, **stages) -> DataFrame:
    """Run the chosen stages over a meta table with a unique order ``key``.

    Each keyword names a stage; its value is True or the stage's argument (a threshold, a suffix,
    another table). With ``shard=k`` a ``shard`` column tells the parts for a partitioned write.
    """
    unknown = set(stages) - STAGE_NAMES
    if unknown:
        raise ValueError(f"unknown stages {sorted(unknown)}")
    if stages.get("sort") and stages.get("sort_ascending"):
        raise ValueError("sort and sort_ascending exclude each other")
    active = {name: arg for name, arg in stages.items() if arg is not None and arg is not False}
    ctx = Context(key, seed)
    for name, run in STAGES:
        if name in active:
            df = run(df, active[name], ctx)
    if "shard" in active:
        return _sharded(df, active, ctx)
    if ctx.sorted and ordered:
        df = df.orderBy(*ctx.order)
    if "train_column" in active:
        df = media.train_columns(df)
    if "min_frame" in active:
        df = filters.frames_min(df, active["min_frame"])
    return df


def _sharded(df: DataFrame, active: dict, ctx: Context) -> DataFrame:
    """Cut rows, in their final order, into contiguous shards."""
    if "min_frame" in active:
        df = filters.frames_min(df, active["min_frame"])
    if ctx.shuffled:
        (digest,) = free_names(df.columns, "_h")
        df = df.withColumn(digest, draw_hash(ctx.seed, F.col(ctx.key)))
        df = ordering.shard(df, active["shard"], [digest, ctx.key]).drop(digest)
    elif ctx.sorted:
        keys = ordering.ascending_columns(df, ctx.by)
        if keys is None:
            raise ValueError(f"cannot shard by texts in descending order: {ctx.by}")
        names = free_names(df.columns, *[f"_o{i}" for i in range(len(keys))])
        df = ordering.shard(df.withColumns(dict(zip(names, keys))), active["shard"], names).drop(*names)
    else:
        df = ordering.shard(df, active["shard"], ctx.key)
    if "train_column" in active:
        df = df.select("shard", *media.train_columns(df).columns)
    return df
