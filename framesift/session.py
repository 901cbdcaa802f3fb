"""Session defaults and access to the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = 8, app: str = "framesift", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = builder.config("spark.driver.memory", os.environ.get("FRAMESIFT_DRIVER_MEMORY", "8g"))
    builder = builder.config("spark.sql.shuffle.partitions", str(cores))
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors can read, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting falls back to a fresh temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="framesift-")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


# Parquet writers and readers hold a row group, and a column's page, as a whole. By default they first look
# at its size after a hundred rows; for rows of megabytes they look after each.
LARGE_ROWS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}


def materialise(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage where several later stages start from the same rows. Lost executors cost
    nothing that was written, and readers still prune columns. ``LARGE_ROWS`` as options bounds the
    memory of tasks that write or read rows of megabytes.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A ``materialise`` whose tables are deleted when the block ends, so nothing lazy may leave it that reads them."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def write(df: DataFrame, table: str) -> DataFrame:
        path = f"{folder}/{table}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield write
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs deleted now. Spark deletes those of plans that the driver has
    collected as garbage, which can take it long; between the steps of a large job their files add up.
    The driver keeps hold of the last job until another has run, so a job of one row goes first."""
    spark.range(1).count()
    spark._jvm.System.gc()


def compute_once(df: DataFrame, column: str) -> DataFrame:
    """Keep the optimizer from copying a costly column into every place that reads it.

    Filters on the column move below its projection and evaluate it again, and projections with
    Python functions are merged even where the later one reads the column several times. A one-row
    explode is a boundary that neither crosses.
    """
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.explode(F.array(column)).alias(column)).select(*df.columns)
