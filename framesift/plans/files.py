"""The curation job from files to files, one named output per shard, with a manifest of what is done.

The manifest is a small table beside the outputs. A run that was cut off is started again with the same
words: shards that the manifest lists are left alone, and where all rows were already curated and cut
into shards, only the missing outputs are written from that. Other inputs or stages start over.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framesift.operators.ordering import with_position
from framesift.plans.curation import curate
from framesift.session import shared_folder
from framesift.sources.meta import ORDER_COLUMNS, read_meta, stage_name, write_meta

_MANIFEST = "job string, shard int, path string, n_rows bigint"
# Stages whose argument is a table, given here by its path.
_TABLES = ("difference", "intersection")
# The row of the manifest that tells where all rows lie, cut into shards.
_ALL = -1


def _fingerprint(spark: SparkSession, paths: Sequence[str], words: dict) -> str:
    """A digest of the input files, by name, size and time, and of the stages."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths)).select("path", "length", "modificationTime")
    one = F.xxhash64("path", "length", "modificationTime")
    seen = files.agg(F.count(F.lit(1)), F.sum(one.cast("decimal(38,0)"))).first()
    said = json.dumps([list(map(str, seen)), list(paths), words], sort_keys=True, default=str)
    return hashlib.sha256(said.encode()).hexdigest()


def _finished(spark: SparkSession, manifest: str, job: str) -> dict[int, tuple[str, int]]:
    """Finished shards of a job: one row per output, a number that the caller chose."""
    try:
        rows = spark.read.schema(_MANIFEST).parquet(manifest).filter(F.col("job") == job).collect()
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return {}
    return {r["shard"]: (r["path"], r["n_rows"]) for r in rows}


def _finish(spark: SparkSession, manifest: str, job: str, shard: int, path: str, n: int) -> None:
    spark.createDataFrame([(job, shard, path, n)], _MANIFEST).coalesce(1).write.mode("append").parquet(manifest)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A written table, unless its folder was emptied since."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing) and "UNABLE_TO_INFER_SCHEMA" not in str(missing):
            raise
        return None


def shard_path(output: str, shard: int) -> str:
    """``a/b.csv`` becomes ``a/b_3.csv``."""
    stem, _, kind = output.rpartition(".")
    return f"{stem}_{shard}.{kind}"


def curate_files(spark: SparkSession, inputs: Sequence[str], output: str | None = None, shards: int = 1, seed: int = 42, fmt: str = "csv", **stages) -> DataFrame:
    """Read the inputs, run the chosen stages, write one output per shard, and return the manifest's rows.

    Stages are those of ``curate``; ``difference`` and ``intersection`` take the path of a table. Rows keep the
    order of the inputs unless a stage sorts or shuffles them. Without ``output`` the name is put together
    from inputs and stages. One shard is written under that name, several as ``name_0`` on, each a
    contiguous part of the rows. All shards are cut in one pass over the inputs.
    """
    for name in _TABLES:
        if name in stages and not isinstance(stages[name], str):
            raise ValueError(f"{name} takes the path of a table here")
    output = output or stage_name(inputs, stages, fmt)
    manifest = f"{output}.manifest"
    tables = [stages[name] for name in _TABLES if name in stages]
    job = _fingerprint(spark, [*inputs, *tables], {**stages, "shards": shards, "seed": seed, "output": output})
    done = _finished(spark, manifest, job)
    wanted = {i: shard_path(output, i) if shards > 1 else output for i in range(shards)}
    missing = [i for i in wanted if i not in done]
    cut = _stored(spark, done[_ALL][0]) if missing and _ALL in done else None
    if missing and cut is None:
        given = {name: read_meta(spark, arg) if name in _TABLES else arg for name, arg in stages.items()}
        rows = with_position(read_meta(spark, inputs, keep_order=True), ORDER_COLUMNS, name="_key").drop(*ORDER_COLUMNS)
        path = f"{shared_folder(spark)}/curated-{uuid.uuid4().hex}"
        curated = curate(rows, key="_key", seed=seed, shard=shards, **given)
        curated.write.partitionBy("shard").parquet(path)
        cut = spark.read.schema(curated.schema).parquet(path)
        _finish(spark, manifest, job, _ALL, path, cut.count())
    for i in missing:
        rows = cut.filter(F.col("shard") == i).drop("shard", "_key")
        write_meta(rows, wanted[i], mode="overwrite")
        _finish(spark, manifest, job, i, wanted[i], rows.count())
    return spark.read.schema(_MANIFEST).parquet(manifest).filter((F.col("job") == job) & (F.col("shard") >= 0)).select("shard", "path", "n_rows")
