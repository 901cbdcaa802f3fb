"""Where user Python code plugs in: always in Arrow batches, always with a declared type."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


Errors = type[Exception] | tuple[type[Exception], ...]
# What a function raises over a value it cannot use; a broken function raises other things.
BAD_VALUES: Errors = (ValueError, ArithmeticError)


def apply_column(
    df: DataFrame, func: Callable, column: str, output: str, return_type: str, default: object = None, errors: Errors = BAD_VALUES
) -> DataFrame:
    """``output`` = func(value) for each value of a column; ``default`` where it raises one of ``errors``.

    Anything else it raises fails the job. NULL goes to the function as None.
    """

    def guarded(value):
        try:
            return func(None if value is pd.NA else value)
        except errors:
            return default

    @F.pandas_udf(return_type)
    def run(values: pd.Series) -> pd.Series:
        return pd.Series([guarded(v) for v in values], dtype=object)

    return df.withColumn(output, run(F.col(column)))


def apply_rows(
    df: DataFrame,
    func: Callable[[dict], Mapping],
    inputs: Sequence[str],
    outputs: Mapping[str, str],
    defaults: Mapping[str, object] | None = None,
    errors: Errors = BAD_VALUES,
) -> DataFrame:
    """New columns from several columns of a row; ``defaults`` fill in where the function raises one of ``errors``.

    ``outputs`` maps names to types. Only the inputs travel to Python.
    """
    defaults = dict(defaults or {name: None for name in outputs})

    def guarded(row: dict) -> Mapping:
        try:
            return func(row)
        except errors:
            return defaults

    @F.pandas_udf(f"struct<{', '.join(f'`{n}`: {t}' for n, t in outputs.items())}>")
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        made = [guarded(r) for r in rows.to_dict("records")]
        return pd.DataFrame([{n: m[n] for n in outputs} for m in made], columns=list(outputs))

    kept = [c for c in df.columns if c not in outputs]
    return df.withColumn("_out", run(F.struct(*inputs))).select(*kept, *[F.col(f"_out.{n}").alias(n) for n in outputs])


def map_batches(df: DataFrame, func: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """A stage over whole partitions, streamed as Arrow batches."""
    return df.mapInPandas(func, schema)


def score_with_model(
    df: DataFrame, make_predict: Callable, inputs: Sequence[str], output: str, return_type, batch_size: int = 64, **options
) -> DataFrame:
    """Score rows with a user's model, loaded once per Python worker.

    ``make_predict`` returns a function from numpy batches to predictions. The scores join the
    table in place, so there are no per-worker part files to merge.
    """
    predict = predict_batch_udf(make_predict, return_type=return_type, batch_size=batch_size, **options)
    return df.withColumn(output, predict(*inputs))
