"""Joins of meta tables, all on equality of path or id.

Which side is broadcast is left to the optimizer's size estimates and adaptive execution.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framesift.functions.captions import NONE_FOUND
from framesift.functions.paths import basename
from framesift.schema import require
from framesift.sources.meta import union_meta


def _same(left: DataFrame, right: DataFrame, key: str = "path") -> Column:
    return left[key].eqNullSafe(right[f"_{key}"])


def _keyed(df: DataFrame, key: str, *others: str) -> DataFrame:
    return df.select(F.col(key).alias(f"_{key}"), *others)


def difference(df: DataFrame, other: DataFrame) -> DataFrame:
    """Rows whose path is not in ``other``; a missing path matches a missing path."""
    right = _keyed(require(other, "path"), "path")
    return require(df, "path").join(right, _same(df, right), "left_anti")


def _with_keys(df: DataFrame, key: str, on_null: str) -> DataFrame:
    """Rows whose missing keys are matched like any value, dropped, or an error."""
    if on_null == "match":
        return df
    if on_null == "drop":
        return df.filter(F.col(key).isNotNull())
    if on_null == "error":
        return df.filter(F.when(F.col(key).isNull(), F.raise_error(F.lit(f"missing {key}"))).otherwise(F.lit(True)))
    raise ValueError(f"on_null is match, drop or error, not {on_null!r}")


def intersection(df: DataFrame, other: DataFrame, on_null: str = "match") -> DataFrame:
    """Inner join on path; takes only the columns ``df`` lacks, in alphabetical order.

    With ``on_null='match'`` each missing path on the left meets each on the right.
    """
    df, other = _with_keys(df, "path", on_null), _with_keys(other, "path", on_null)
    new = sorted(set(require(other, "path").columns) - set(df.columns))
    right = _keyed(other, "path", *new)
    return require(df, "path").join(right, _same(df, right), "inner").drop("_path")


def assert_unique(df: DataFrame, key: str) -> DataFrame:
    """Pass the rows through; fail the job where a key repeats."""
    repeated = F.raise_error(F.concat(F.lit(f"duplicate {key}: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL"))))
    firsts = [F.first(c).alias(c) for c in df.columns if c != key]
    grouped = df.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"), *firsts)
    return grouped.filter(F.when(F.col("_copies") > 1, repeated).otherwise(F.lit(True))).select(*df.columns)


def update_text(df: DataFrame, other: DataFrame) -> DataFrame:
    """Overwrite captions for which ``other`` has a non-null one; path becomes the first column."""
    new = assert_unique(require(other, "path", "text").select("path", "text"), "path")
    right = new.select(F.col("path").alias("_path"), F.col("text").alias("_text"))
    rest = [F.coalesce("_text", "text").alias("text") if c == "text" else F.col(c) for c in df.columns if c != "path"]
    return require(df, "path", "text").join(right, _same(df, right), "left").select("path", *rest)


def column_union(left: DataFrame, right: DataFrame, key: str = "path") -> DataFrame:
    """Full outer join; columns present on both sides are told apart by ``_x`` and ``_y``.

    Written as a left join plus the right rows without partner: adaptive execution can split a hot
    key in either half, but not in a full outer join.
    """
    shared = (set(left.columns) & set(right.columns)) - {key}

    def side(df: DataFrame, key_name: str, suffix: str) -> DataFrame:
        others = [F.col(c).alias(c + suffix if c in shared else c) for c in df.columns if c != key]
        return df.select(F.col(key).alias(key_name), *others)

    l, r = side(left, "_kl", "_x"), side(right, "_kr", "_y")
    matched = l.join(r, F.col("_kl").eqNullSafe(F.col("_kr")), "left").drop("_kr").withColumnRenamed("_kl", key)
    seen = l.select("_kl").distinct()
    alone = r.join(seen, F.col("_kr").eqNullSafe(F.col("_kl")), "left_anti").withColumnRenamed("_kr", key)
    return matched.unionByName(alone, allowMissingColumns=True)


def filter_by_paths(df: DataFrame, wanted: DataFrame) -> DataFrame:
    right = _keyed(require(wanted, "path"), "path")
    return require(df, "path").join(right, _same(df, right), "left_semi")


def match_report(df: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row: distinct wanted keys, rows searched, rows matched, wanted keys without any row."""
    keys = _keyed(wanted, "path").distinct().withColumn("_wanted", F.lit(True))
    per_key = df.groupBy("path").agg(F.count(F.lit(1)).alias("_rows"))
    joined = keys.join(per_key, F.col("_path").eqNullSafe(F.col("path")), "full")
    wanted_key, found = F.col("_wanted").isNotNull(), F.col("_rows").isNotNull()
    return joined.agg(
        F.count_if(wanted_key).alias("wanted_keys"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(wanted_key, F.col("_rows"))), F.lit(0)).alias("matched_rows"),
        F.count_if(wanted_key & ~found).alias("unmatched_keys"),
    )


def unmatched_samples(df: DataFrame, wanted: DataFrame, n: int = 5) -> DataFrame:
    """The first few wanted paths, by name, that no row has."""
    have = _keyed(df, "path")
    keys = wanted.select("path").distinct()
    return keys.join(have, keys["path"].eqNullSafe(have["_path"]), "left_anti").orderBy("path").limit(n)


def semi_by_caption_set(
    df: DataFrame, reference: DataFrame, captions: Column, clean: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Keep rows whose caption occurs, after cleaning, among the reference's caption arrays."""
    wanted = clean(reference.select(F.explode(captions).alias("text"))).filter("text IS NOT NULL").distinct()
    return require(df, "text").join(wanted, "text", "left_semi")


def video_id(path: Column) -> Column:
    """Base name up to its last underscore."""
    return F.regexp_extract(basename(path), r"^(.*)_[^_]*$", 1)


def semi_by_clip(df: DataFrame, catalogue: DataFrame, order_by: str = "pos") -> DataFrame:
    """Keep rows whose (video id, timestamp) is listed; ``catalogue`` is (video_id, timestamps, order).

    A video id that repeats is ruled by its last row.
    """
    last = catalogue.groupBy("video_id").agg(F.max_by("timestamps", order_by).alias("_list"))
    wanted = last.select(F.col("video_id").alias("_vid"), F.explode("_list").alias("_ts")).distinct()
    keyed = require(df, "path", "timestamp").withColumn("_id", video_id(F.col("path")))
    return keyed.join(
        wanted, (F.col("_id") == F.col("_vid")) & (F.col("timestamp") == F.col("_ts")), "left_semi"
    ).drop("_id")


def resume_remaining(df: DataFrame, produced: Sequence[DataFrame]) -> DataFrame:
    """Inputs that no part file holds yet."""
    return difference(df, union_meta([p.select("path") for p in produced]))


def attach_scores(
    df: DataFrame, parts: DataFrame, score: str, order: Sequence[str], key: str = "pos", keep_unscored: bool = True
) -> DataFrame:
    """Join scores written by many ranks; the first score of a row, by ``order``, wins.

    The first score is an aggregate, so map tasks reduce a hot key before the shuffle.
    """
    first = parts.groupBy(F.col(key).alias("_key")).agg(F.min_by(score, F.struct(*order)).alias("_score"))
    joined = df.drop(score).join(first, F.col(key) == F.col("_key"), "left" if keep_unscored else "inner")
    return joined.withColumn(score, F.col("_score")).drop("_key", "_score")


def collate_parts(parts: Sequence[DataFrame], tag: str, missing: str = NONE_FOUND) -> DataFrame:
    """Stack per-rank outputs in rank order and fill in missing tags."""
    stacked = union_meta([p.withColumn("rank", F.lit(i)) for i, p in enumerate(parts)])
    return stacked.withColumn(tag, F.coalesce(F.col(tag), F.lit(missing)))
