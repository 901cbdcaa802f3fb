"""Reading, joining up and writing meta tables."""

from __future__ import annotations

import json
import posixpath
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framesift.schema import META_TYPES, nan_to_null

ORDER_COLUMNS = ["_src", "_file", "_row"]


def file_format(path: str) -> str:
    for suffix in ("csv", "parquet"):
        if path.rstrip("/").endswith("." + suffix):
            return suffix
    raise ValueError(f"unsupported file format: {path}")


# What a cell of an unknown column may be, as one bit each. Patterns, since casts also take words like 1d.
_WHOLE, _FRACTION, _FLAG, _TEXT = 1, 2, 4, 8
_WHOLE_PATTERN = r"^\s*[+-]?[0-9]{1,18}\s*$"
_FRACTION_PATTERN = r"^\s*[+-]?(([0-9]+\.[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[0-9]+[eE][+-]?[0-9]+)\s*$"
_FRACTION_WORDS = ["nan", "inf", "-inf", "infinity", "-infinity"]


def _kind(cell: Column) -> Column:
    return (
        F.when(cell.isNull(), 0)
        .when(cell.rlike(_WHOLE_PATTERN), _WHOLE)
        .when(cell.rlike(_FRACTION_PATTERN) | F.lower(cell).isin(_FRACTION_WORDS), _FRACTION)
        .when(F.lower(cell).isin("true", "false"), _FLAG)
        .otherwise(_TEXT)
    )


def inferred_types(df: DataFrame, columns: Sequence[str]) -> dict[str, T.DataType]:
    """The narrowest type that all cells of each text column fit: whole number, number, flag or text.

    Kinds of cells are bits that add up in any order, so one aggregate over the table finds the types
    of all columns. A column without a cell stays text.
    """
    if not columns:
        return {}
    found = df.agg(*[F.bit_or(_kind(F.col(f"`{c}`"))).alias(f"k{i}") for i, c in enumerate(columns)]).first()
    types = {_WHOLE: T.LongType(), _FRACTION: T.DoubleType(), _WHOLE | _FRACTION: T.DoubleType(), _FLAG: T.BooleanType()}
    return {c: types.get(found[f"k{i}"], T.StringType()) for i, c in enumerate(columns)}


def _typed_csv(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """CSV cells arrive as strings; give known columns their type."""
    out = []
    for name in df.columns:
        dtype = types.get(name)
        if dtype is None or isinstance(dtype, T.StringType):
            out.append(F.col(f"`{name}`"))
        elif isinstance(dtype, (T.IntegerType, T.LongType)):
            # Whole numbers are often printed as floats (409920.0).
            sql = dtype.simpleString()
            out.append(
                F.expr(
                    f"coalesce(try_cast(`{name}` AS {sql}), "
                    f"try_cast(nanvl(try_cast(`{name}` AS double), NULL) AS {sql}))"
                ).alias(name)
            )
        else:
            out.append(F.expr(f"try_cast(`{name}` AS {dtype.simpleString()})").alias(name))
    return df.select(*out)


_CSV = {"quote": '"', "escape": '"'}


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """(_file, _row, record) of CSV files whose quoted cells may hold line breaks, read by as many tasks as
    their bytes fill; record 0 of each file is its header.

    Each byte range counts its quotes. The sum over the ranges before tells whether a range begins inside
    a cell, and the running count inside it tells the same of every line; lines from one that begins
    outside a cell to the next are a record. Only one row per range goes through one task.
    """
    where = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_range")]
    lines = spark.read.text(path, lineSep="\n").select("value", *where, F.monotonically_increasing_id().alias("_line"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    lines = lines.withColumn("_quotes", quotes)
    inside = Window.partitionBy("_file", "_range").orderBy("_line").rowsBetween(Window.unboundedPreceding, -1)
    counted = lines.withColumn("_before", F.coalesce(F.sum("_quotes").over(inside), F.lit(0)))
    ranges = lines.groupBy("_file", "_range").agg(F.sum("_quotes").alias("_quotes"))
    earlier = Window.partitionBy("_file").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    opened = ranges.select("_file", "_range", (F.coalesce(F.sum("_quotes").over(earlier), F.lit(0)) % 2).alias("_open"))
    placed = counted.join(opened, ["_file", "_range"]).withColumn("_first", ((F.col("_open") + F.col("_before")) % 2 == 0) & ~((F.col("_quotes") == 0) & (F.btrim("value", F.lit(" \t\r")) == "")))
    blank = ((F.col("_open") + F.col("_before")) % 2 == 0) & ~F.col("_first")
    placed = placed.filter(~blank)
    # Records are numbered like lines: those before the range, and those before in it.
    starts = placed.groupBy("_file", "_range").agg(F.count_if("_first").alias("_records"))
    offset = starts.select("_file", "_range", F.coalesce(F.sum("_records").over(earlier), F.lit(0)).alias("_offset"))
    to_here = Window.partitionBy("_file", "_range").orderBy("_line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = placed.withColumn("_nth", F.sum(F.col("_first").cast("bigint")).over(to_here)).join(offset, ["_file", "_range"])
    numbered = numbered.withColumn("_row", F.col("_offset") + F.col("_nth") - 1)
    pieces = F.array_sort(F.collect_list(F.struct("_range", "_line", "value")))
    whole = numbered.groupBy("_file", "_row").agg(pieces.alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda p: p["value"]), "\n")
    return whole.select("_file", "_row", F.regexp_replace(text, "\r$", "").alias("record"))


def _split_csv(spark: SparkSession, path: str) -> DataFrame:
    records = quoted_records(spark, path)
    names = F.from_csv("record", F.lit(", ".join(f"c{i} string" for i in range(2000))), _CSV | {"maxColumns": "3000"})
    header = records.filter("_row = 0").select(F.to_json(names).alias("names")).first()
    if header is None:
        raise ValueError(f"no header in {path}")
    found = {int(k[1:]): name for k, name in json.loads(header["names"]).items()}
    columns = [found.get(i, f"_c{i}") for i in range(max(found) + 1)]
    schema = ", ".join(f"c{i} string" for i in range(len(columns)))
    cells = records.filter("_row > 0").select("_file", "_row", F.from_csv("record", F.lit(schema), _CSV).alias("c"))
    return cells.select(*[F.col(f"c.c{i}").alias(name) for i, name in enumerate(columns)], "_file", (F.col("_row") - 1).alias("_row"))


def read_one(
    spark: SparkSession,
    path: str,
    extra_types: dict[str, T.DataType] | None = None,
    na_words: Sequence[str] = (),
    multi_line: bool | str = True,
    keep_order: bool = False,
    infer: bool = True,
) -> DataFrame:
    """One CSV or Parquet input (globs allowed), chosen by its suffix.

    ``multi_line`` accepts line breaks inside quoted cells, one task per CSV file; ``"split"`` accepts them
    and spreads each file over tasks; False is for files without them, which Spark can split by itself.
    CSV columns that neither the meta table nor ``extra_types`` knows get the type that all their cells
    fit, found in one pass, unless ``infer`` is off. Empty CSV cells are missing, quoted or not.
    """
    if file_format(path) == "parquet":
        df = spark.read.parquet(path)
        if keep_order:
            df = df.select(
                "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
            )
        return nan_to_null(df)
    if multi_line == "split":
        df = _split_csv(spark, path)
        columns = df.columns[:-2]
        df = df if keep_order else df.select(*[F.col(f"`{c}`") for c in columns])
    else:
        df = spark.read.csv(path, header=True, multiLine=multi_line, **_CSV)
        columns = df.columns
        if keep_order:
            # The reader gives no row index: number rows in the order it meets them.
            df = df.select(
                "*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_row")
            )
    cells = {c: F.when(~F.col(f"`{c}`").isin("", *na_words), F.col(f"`{c}`")) for c in columns}
    df = df.withColumns(cells)
    types = {**META_TYPES, **(extra_types or {})}
    if infer:
        types |= inferred_types(df, [c for c in columns if c not in types])
    return nan_to_null(_typed_csv(df, {**types, "_row": T.LongType()} if keep_order else types))


def union_meta(frames: Sequence[DataFrame], tag_source: bool = False) -> DataFrame:
    """Stack tables on the union of their columns; missing cells are NULL."""
    if not frames:
        raise ValueError("no inputs")
    if tag_source:
        frames = [f.withColumn("_src", F.lit(i)) for i, f in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_meta(spark: SparkSession, paths: str | Sequence[str], keep_order: bool = False, **options) -> DataFrame:
    """Read and stack any number of inputs.

    With ``keep_order`` the columns ``_src, _file, _row`` hold the input order: sort by them, or turn
    them into an order key, wherever the operators ask for one.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    return union_meta([read_one(spark, p, keep_order=keep_order, **options) for p in paths], tag_source=keep_order)


def write_meta(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write a directory of CSV (with header) or Parquet files, chosen by suffix.

    ``mode='ignore'`` leaves an existing output alone without running the plan.
    """
    fmt = file_format(path)
    out = df.drop(*ORDER_COLUMNS).write.mode(mode)
    if fmt == "csv":
        out.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    else:
        out.parquet(path)


def write_once(df: DataFrame, path: str) -> None:
    """Produce a stage output unless it is already there."""
    write_meta(df, path, mode="ignore")


def stem_name(path: str) -> str:
    return posixpath.basename(path.rstrip("/")).split(".")[0]


# The suffix each stage leaves on the output name, in the order they are joined.
STAGE_SUFFIXES = {
    "sort": "_sort",
    "sort_ascending": "_sort",
    "info": "_info",
    "video_info": "_vinfo",
    "ext": "_ext",
    "load_caption": "_load{}",
    "relpath": "_relpath",
    "abspath": "_abspath",
    "remove_empty_path": "_noemptypath",
    "remove_empty_caption": "_noempty",
    "remove_url": "_nourl",
    "lang": "_{}",
    "remove_path_duplication": "_noduppath",
    "remove_text_duplication": "_noduptext",
    "path_subset": "_subset",
    "refine_llm_caption": "_llm",
    "clean_caption": "_clean",
    "merge_cmotion": "_cmcaption",
    "count_num_token": "_ntoken",
    "append_text": "_appendtext",
    "score_to_text": "_score2text",
    "update_text": "_update",
    "filesize": "_filesize",
    "fsmax": "_fsmax{}",
    "fmin": "_fmin{}",
    "fmax": "_fmax{}",
    "fpsmax": "_fpsmax{}",
    "hwmax": "_hwmax{}",
    "aesmin": "_aesmin{}",
    "matchmin": "_matchmin{}",
    "flowmin": "_flowmin{}",
    "img_only": "_img",
    "vid_only": "_vid",
    "shuffle": "_shuffled_seed{}",
    "head": "_first_{}_data",
}


def stage_name(inputs: Sequence[str], stages: dict[str, object], fmt: str = "csv") -> str:
    """Default output path: input names joined by '+', one suffix per active stage.

    ``stages`` maps a stage to its argument (True where it takes none); the set-difference input
    under ``difference`` joins the base name.
    """
    name = "+".join(stem_name(p) for p in inputs)
    if stages.get("difference"):
        name += f"-{stem_name(str(stages['difference']))}"
    for stage, suffix in STAGE_SUFFIXES.items():
        value = stages.get(stage)
        if value is not None and value is not False:
            name += suffix.format(value)
    return posixpath.join(posixpath.dirname(inputs[0]), f"{name}.{fmt}")
