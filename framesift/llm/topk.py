"""Exact top-k search by inner product, branch and bound over columns.

Vectors are packed into blocks that hold one dimension after the other. For a query, scores grow one
slice of dimensions at a time; after each slice a candidate stays only if its score so far plus the
largest share the rest can add (norm of the query's rest times norm of the candidate's rest) reaches
the k-th best full score known, and the survivors are compacted before the next slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 2048
QUERY_ROWS = 256
SLICE = 16
SHARDS = 24
SCALE = 256.0

_PACKED = "dim int, width int, ids binary, parts binary"


def _usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return df.filter(F.col(key).isNotNull() & x.isNotNull() & finite)


def _packer(rows: int, scale: float):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).cast(pa.int64()).to_numpy(zero_copy_only=False)
            lists = batch.column(1)
            flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            widths = np.diff(lists.offsets.to_numpy())
            starts = np.concatenate([[0], np.cumsum(widths)[:-1]]).astype(np.int64)
            out = {"dim": [], "width": [], "ids": [], "parts": []}
            for dim in np.unique(widths):
                chosen = np.flatnonzero(widths == dim)
                for at in range(0, len(chosen), rows):
                    some = chosen[at : at + rows]
                    parts = np.floor(scale * flat[starts[some][:, None] + np.arange(dim)])
                    out["dim"].append(int(dim))
                    out["width"].append(len(some))
                    out["ids"].append(ids[some].tobytes())
                    out["parts"].append(np.ascontiguousarray(parts.T).tobytes())
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("dim", pa.int32()), ("width", pa.int32()), ("ids", pa.binary()), ("parts", pa.binary())]))

    return pack


def search_block(ids: np.ndarray, columns: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, step: int = SLICE):
    """The k best of one block for each query: (query ids, ids, scores), by score and then smaller id.

    ``columns`` is dimension by candidate, ``queries`` dimension by query, both whole numbers in
    doubles. Products and sums below 2**53 are exact there; larger ones are summed as 64-bit integers
    without bounds, and wrap around as those do.
    """
    dim, n = columns.shape
    reach = np.abs(columns).max(initial=0.0) * np.abs(queries).max(initial=0.0) * max(dim, 1)
    out_q, out_id, out_score = [], [], []

    def keep(q, chosen_ids, scores):
        best = np.lexsort((chosen_ids, -scores))[:k]
        out_q.append(np.full(len(best), q, np.int64))
        out_id.append(chosen_ids[best])
        out_score.append(scores[best].astype(np.int64))

    if reach >= 2.0**53:
        with np.errstate(over="ignore", invalid="ignore"):
            whole = queries.astype(np.int64).T @ columns.astype(np.int64)
        for row, q in enumerate(query_ids):
            others = ids != q
            best = np.lexsort((ids[others], np.invert(whole[row][others])))[:k]
            out_q.append(np.full(len(best), q, np.int64))
            out_id.append(ids[others][best])
            out_score.append(whole[row][others][best])
    else:
        # Dimensions of most mass first, so that the rest is bounded early; the tails of every slice.
        order = np.argsort(-(columns * columns).sum(axis=1), kind="stable")
        columns, queries = columns[order], queries[order]
        cuts = list(range(0, dim, step)) or [0]
        tails = [np.sqrt((columns[c + step :] ** 2).sum(axis=0)) for c in cuts]
        query_tails = [np.sqrt((queries[c + step :] ** 2).sum(axis=0)) for c in cuts]
        first = queries[:step].T @ columns[:step]
        for row, q in enumerate(query_ids):
            alive = np.flatnonzero(ids != q)
            partial = first[row][alive]
            floor = -np.inf
            if len(alive) > k:
                # Full scores of the k that lead after one slice: the k-th best is at least their worst.
                lead = alive[np.argpartition(-partial, k - 1)[:k]]
                floor = (queries[:, row] @ columns[:, lead]).min()
            for i, c in enumerate(cuts):
                if i:
                    partial = partial + queries[c : c + step, row] @ columns[c : c + step, alive]
                if len(alive) > k:
                    bound = partial + query_tails[i][row] * tails[i][alive]
                    stay = bound * (1 + np.copysign(1e-9, bound)) + 1e-6 >= floor
                    alive, partial = alive[stay], partial[stay]
            keep(q, ids[alive], partial)
    if not out_q:
        return (np.empty(0, np.int64),) * 3
    return np.concatenate(out_q), np.concatenate(out_id), np.concatenate(out_score)


def _searcher(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        for batch in batches:
            for row in range(batch.num_rows):
                dim, width, ids, parts, query_width, query_ids, query_parts = (batch.column(c)[row].as_py() for c in range(7))
                found = search_block(
                    np.frombuffer(ids, np.int64),
                    np.frombuffer(parts, np.float64).reshape(dim, width),
                    np.frombuffer(query_ids, np.int64),
                    np.frombuffer(query_parts, np.float64).reshape(dim, query_width),
                    k,
                )
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], schema=schema)

    return search


def exact_top_k(rows: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: float = SCALE) -> DataFrame:
    """For each query the ``k`` rows of highest inner product: query_id, rank, vec_id, score.

    Components count as floor(scale * x). Rows with a missing id, or with a vector that is missing or
    holds a missing or non-finite component, take no part on either side. A query meets every row of
    its own length whose id is not its own; ties go to the smaller id; rows that repeat an id are
    candidates each for itself, while of queries that share an id the one with the smallest vector
    asks. Fewer than ``k`` candidates give fewer rows; empty tables give none. Other columns are not
    read.

    Blocks of candidates are dealt to a fixed number of shards and each block of queries goes to every
    shard, so what moves is the rows once and the queries ``SHARDS`` times; per pair of blocks only
    ``k`` rows a query come out, and the final rank keeps ``k`` per task before it shuffles.
    """
    asked = _usable(queries, key, vector).groupBy(F.col(key).alias("_id")).agg(F.min(vector).alias("_vector"))
    candidates = _usable(rows, key, vector).select(F.col(key).alias("_id"), F.col(vector).alias("_vector"))
    blocks = candidates.mapInArrow(_packer(BLOCK_ROWS, scale), _PACKED).withColumn("shard", F.pmod(F.xxhash64("ids"), F.lit(SHARDS)))
    asks = asked.mapInArrow(_packer(QUERY_ROWS, scale), _PACKED).select(
        "dim", F.col("width").alias("q_width"), F.col("ids").alias("q_ids"), F.col("parts").alias("q_parts"), F.explode(F.array([F.lit(s).cast("bigint") for s in range(SHARDS)])).alias("shard")
    )
    paired = blocks.join(asks, ["dim", "shard"]).select("dim", "width", "ids", "parts", "q_width", "q_ids", "q_parts")
    found = paired.mapInArrow(_searcher(k), "query_id bigint, vec_id bigint, score bigint")
    by_score = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
