"""Incremental runs: each new input file is processed once, across restarts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def run_new_files(
    spark: SparkSession,
    source: str,
    schema: str,
    transform: Callable[[DataFrame], DataFrame],
    sink: str,
    checkpoint: str,
    file_format: str = "parquet",
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Apply a row-wise stage to the meta files not seen by earlier runs and append its output.

    The checkpoint folder remembers which files are done, so an interrupted or repeated run only
    does the rest. It has to lie in a folder all executors share.
    """
    stream = (
        spark.readStream.schema(schema).format(file_format).option("maxFilesPerTrigger", files_per_batch).load(source)
    )
    return (
        transform(stream)
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
