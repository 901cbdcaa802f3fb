"""Mixing sources to target weights.

Tokens are summed per source, targets are shares of the whole by weight, and each document is given
out floor(rate) times plus once more with the probability of the remaining fraction, by a draw that
depends on the seed and the document alone. Built-in functions only; one aggregate of the corpus and
one projection over it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framesift.llm.common import first_free, quoted, uniform, words_of
from framesift.session import materialise

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CEILING = 2.0
SEED = 10


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, ceiling: float = CEILING) -> DataFrame:
    """Targets of a table with one row per source (``source``, ``source_size``).

    Sources in order of code points, a missing name last, weigh as ``weights`` says, over and over.
    ``share`` times all sizes is dealt by weight; a target stops at ``ceiling`` times its source's
    size and what is left over is dealt again by weight. That ends at one level per unit of weight:
    in order of (size / weight) the sources below it are full and the others get level times weight.
    The windows run over one row per source, never over documents.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight: Column = F.lit(float(weights[-1]))
    for k, w in enumerate(weights[:-1]):
        weight = F.when(place == k, F.lit(float(w))).otherwise(weight)
    size = F.col("source_size").cast("double")
    before = Window.orderBy(F.col("_size") / F.col("_weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumn("_weight", weight).withColumn("_size", size)
    filled = placed.select(
        "*",
        (F.lit(share) * F.sum("_size").over(everything)).alias("_all"),
        F.sum("_weight").over(everything).alias("_weights"),
        F.coalesce(F.lit(ceiling) * F.sum("_size").over(before), F.lit(0.0)).alias("_given"),
        F.coalesce(F.sum("_weight").over(before), F.lit(0.0)).alias("_gone"),
    ).withColumn("_full", F.lit(ceiling) * F.col("_size") * (F.col("_weights") - F.col("_gone")) < (F.col("_all") - F.col("_given")) * F.col("_weight"))
    level = filled.select(
        "*",
        F.coalesce(F.sum(F.when(F.col("_full"), F.lit(ceiling) * F.col("_size"))).over(everything), F.lit(0.0)).alias("_used"),
        F.sum(F.when(~F.col("_full"), F.col("_weight"))).over(everything).alias("_open"),
    )
    target = F.when(F.col("_full"), F.lit(ceiling) * F.col("_size")).otherwise((F.col("_all") - F.col("_used")) * F.col("_weight") / F.col("_open"))
    return level.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def _planned(docs: DataFrame, names: list[str], seed: int, key: str, text: str, source: str, **shares) -> DataFrame:
    """Documents with size, source size, target and copies under the given names, and a free one for the source."""
    size, source_size, target, copies = names
    own = first_free([*docs.columns, *names], "_source")
    sized = docs.withColumn(size, F.size(words_of(F.col(text))).cast("bigint"))
    sums = sized.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    targets = materialise(source_targets(sums, **shares), "mix").select(F.col("source").alias(own), F.col("source_size").alias("_size"), F.col("target").alias("_target"))
    joined = sized.alias("d").join(targets.alias("t"), F.col(f"d.{quoted(source)}").eqNullSafe(F.col(f"t.{quoted(own)}")))
    total, wanted = F.col("t._size"), F.col("t._target")
    rate = F.when(total > 0, wanted / total).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    drawn = uniform(seed, F.coalesce(F.col(f"d.{quoted(key)}").cast("string"), F.md5(F.col(f"d.{quoted(text)}"))))
    times = whole + F.when(drawn < rate - whole, 1).otherwise(0)
    kept = [F.col(f"d.{quoted(c)}") for c in sized.columns if c.lower() not in (source_size.lower(), target.lower(), copies.lower())]
    return joined.select(*kept, total.alias(source_size), wanted.alias(target), times.cast("bigint").alias(copies))


def plan_mix(docs: DataFrame, seed: int = SEED, key: str = "doc_id", text: str = "text", source: str = "source", **shares) -> DataFrame:
    """Every document once with ``size``, ``source_size``, ``target`` and ``copies``.

    A missing text has size 0, a missing source is a source of its own, a document without an id is drawn by
    its text, repeated rows are separate documents that share their draw, and an empty table gives an
    empty table. Columns of these four names are replaced; all others pass through.

    The targets (one row per source) are written to the shared folder first, so the join sees their
    true size: small ones are broadcast below Spark's own limit, and else adaptive execution splits
    the documents of a hot source.
    """
    return _planned(docs, ["size", "source_size", "target", "copies"], seed, key, text, source, **shares)


def mix(docs: DataFrame, seed: int = SEED, key: str = "doc_id", text: str = "text", source: str = "source", **shares) -> DataFrame:
    """The mixed corpus: each document as often as ``plan_mix`` says, with the columns it came with."""
    names: list[str] = []
    for name in ("_size_of_text", "_size_of_source", "_target_of_source", "_copies"):
        names.append(first_free([*docs.columns, *names], name))
    planned = _planned(docs, names, seed, key, text, source, **shares).filter(F.col(names[3]) > 0)
    return planned.withColumn(names[3], F.explode(F.sequence(F.lit(1), F.col(names[3]).cast("int")))).select(*[F.col(quoted(c)) for c in docs.columns])
