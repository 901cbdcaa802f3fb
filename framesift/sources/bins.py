"""Pre-computed feature batches in numbered bins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framesift.operators.ordering import with_position


def assign_bins(
    df: DataFrame, bin_size: int, start_bin: int = 0, batch: str = "batch_no", keep_partial: bool = False
) -> DataFrame:
    """Add ``bin_id`` and ``bin_pos``: ``bin_size`` consecutive batches per bin.

    Batches are numbered from 0 without gaps. A trailing bin that is not full is left out unless
    ``keep_partial``.
    """
    if not keep_partial:
        batches = df.agg((F.coalesce(F.max(batch), F.lit(-1)) + 1).alias("n")).scalar()
        df = df.filter(F.col(batch) < F.floor(batches / bin_size) * bin_size)
    return df.withColumn("bin_id", (F.floor(F.col(batch) / bin_size) + start_bin).cast("bigint")).withColumn(
        "bin_pos", (F.col(batch) % bin_size).cast("int")
    )


def write_bins(df: DataFrame, path: str, mode: str = "error") -> None:
    """Parquet partitioned by bin; rows of a bin are brought together to write one file each."""
    df.repartition("bin_id").sortWithinPartitions("bin_id", "bin_pos").write.mode(mode).partitionBy("bin_id").parquet(path)


def read_bins(spark: SparkSession, path: str) -> DataFrame:
    """Bins as written plus ``buffer``, the place of each bin among those present."""
    df = spark.read.parquet(path)
    places = with_position(df.select("bin_id").distinct(), "bin_id", name="buffer")
    return df.join(places, "bin_id")
