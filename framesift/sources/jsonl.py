"""JSON-lines output in parts of limited size."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framesift.operators.ordering import with_position
from framesift.session import materialise

# A span of the text holds about so many parts.
_SPAN_PARTS = 8


def _next_starts(lines: pd.DataFrame, max_lines: int, max_bytes: int) -> np.ndarray:
    """For each line, as the first of a part, the row of the line that starts the next part."""
    starts = lines["start"].to_numpy()
    over = np.searchsorted(starts + lines["size"].to_numpy(), starts + max_bytes, side="right")
    rows = np.arange(len(starts))
    return np.minimum(np.maximum(over, rows + 1), rows + max_lines)


def _entries(max_lines: int, max_bytes: int):
    """Where the parts of a span lead to, for each line that may be the first start in the span."""

    def entries(lines: pd.DataFrame) -> pd.DataFrame:
        lines = lines.sort_values("line")
        own = int(lines["own"].sum())
        exits = _next_starts(lines, max_lines, max_bytes)[:own]
        while (inside := exits < own).any():
            exits = np.where(inside, exits[np.minimum(exits, own - 1)], exits)
        first = lines.iloc[0]
        may = ((lines["line"] < first["line"] + max_lines) & (lines["start"] <= first["start"] + max_bytes)).to_numpy()[:own]
        return pd.DataFrame({"span": first["span"], "line": lines["line"].to_numpy()[:own][may], "leads_to": first["line"] + exits[may]})

    return entries


def _parts(max_lines: int, max_bytes: int):
    """The part of each line of a span, counted from the span's first start; 0 before it."""

    def parts(lines: pd.DataFrame) -> pd.DataFrame:
        lines = lines.sort_values("line")
        own = int(lines["own"].sum())
        starts = np.zeros(own, np.int64)
        entry = lines["entry"].iloc[0]
        if not pd.isna(entry):
            after = _next_starts(lines, max_lines, max_bytes)
            at = int(entry - lines["line"].iloc[0])
            while at < own:
                starts[at] = 1
                at = int(after[at])
        out = lines.iloc[:own]
        return pd.DataFrame({"key": out["key"], "span": out["span"], "local": np.cumsum(starts)})

    return parts


def assign_chunks(
    df: DataFrame,
    order_by: str,
    max_lines: int = 50_000,
    max_bytes: int = 100 * 1024 * 1024,
    slices: int | None = None,
) -> DataFrame:
    """Add ``part`` so that, in the order of the unique key, parts are filled one after the other.

    A line that would be one too many, or would take its part beyond ``max_bytes`` (in UTF-8, with line
    ends), starts the next part. Parts count from 1, or from 2 where the first line alone is too long,
    as that leaves the first part empty. Missing values are empty lines.

    Each line knows the line at which a part that began with it would end, from sums of bytes over the
    lines before. Spans of ``max_bytes`` times eight are followed by themselves, for every line that may
    be the first start in the span; which of them is, comes out of pointer doubling from the first line on,
    in as many rounds as the number of spans has binary digits. Only keys and sizes move; a task holds
    those of one span.
    """
    size = F.coalesce(F.octet_length("value"), F.lit(0)).cast("bigint") + 1
    sized = df.select(F.col(order_by).alias("key"), size.alias("size"))
    placed = with_position(sized, "key", name="line", before={"start": F.col("size")}, slices=slices)
    placed = materialise(placed, "lines")
    width = _SPAN_PARTS * max_bytes
    ends = placed.agg(F.max(F.col("start") + F.col("size")).alias("bytes"), F.min_by("size", "line").alias("first")).first()
    spans = -(-(ends["bytes"] or 0) // width)

    span = F.floor(F.col("start") / width)
    # The lines right behind a span tell where its last part ends.
    behind = (span > 0) & (F.col("start") < span * width + max_bytes)
    copies = F.array_compact(F.array(F.struct(span.alias("span"), F.lit(1).alias("own")), F.when(behind, F.struct((span - 1).alias("span"), F.lit(0).alias("own")))))
    held = placed.select("*", F.inline(copies))
    entries = held.groupBy("span").applyInPandas(_entries(max_lines, max_bytes), "span bigint, line bigint, leads_to bigint")
    jumps = materialise(entries, "entries")
    where = jumps.select("span", "line")
    reached = jumps.filter("line = 0").select("line")
    for _ in range(max(spans - 1, 0).bit_length()):
        reached = reached.union(reached.join(jumps, "line").select(F.col("leads_to").alias("line"))).distinct()
        reached = materialise(reached, "reached")
        far = jumps.select(F.col("line").alias("leads_to"), F.col("leads_to").alias("far"))
        jumps = materialise(jumps.join(far, "leads_to", "left").select("line", F.coalesce("far", "leads_to").alias("leads_to")), "entries")

    entered = where.join(reached, "line").groupBy("span").agg(F.min("line").alias("entry"))
    kind = df.schema[order_by].dataType.simpleString()
    local = held.join(entered, "span", "left").groupBy("span").applyInPandas(_parts(max_lines, max_bytes), f"key {kind}, span bigint, local bigint")
    local = materialise(local, "parts")
    earlier = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    # One row per span.
    offsets = local.groupBy("span").agg(F.max("local").alias("n")).select("span", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    skipped = 1 if (ends["first"] or 0) > max_bytes else 0
    parts = local.join(offsets, "span").select(F.col("key").alias(order_by), (F.col("offset") + F.col("local") + skipped).alias("part"))
    return df.select(order_by, "value").join(parts, order_by).select(order_by, "value", F.col("part").cast("bigint").alias("part"))


def write_jsonl_chunks(df: DataFrame, path: str, order_by: str, **limits) -> None:
    """Write one folder ``part=N`` per part, with its lines in order in one file."""
    chunks = assign_chunks(df, order_by, **limits)
    chunks.repartition("part").sortWithinPartitions("part", order_by).select("value", "part").write.partitionBy("part").text(path)


def write_requests(requests: DataFrame, path: str, mode: str = "error") -> None:
    """One request per line."""
    requests.select("value").write.mode(mode).text(path)
