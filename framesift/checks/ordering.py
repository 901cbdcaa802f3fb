"""O: order, sampling, sharding, rank assignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from framesift.checks.registry import query
from framesift.checks.sqltext import draw, permutation_key, permuted
from framesift.operators import ordering

_SHOW = ["pos", "path"]


@query("O1_dedup_path", "SELECT pos, path FROM media QUALIFY row_number() OVER (PARTITION BY path ORDER BY pos) = 1")
def o1(t):
    return ordering.dedup_path(t.media).select(_SHOW)


@query(
    "O2_dedup_text_best_score",
    "SELECT pos, aes, text FROM media QUALIFY row_number() OVER (PARTITION BY text ORDER BY aes DESC NULLS LAST, pos) = 1",
)
def o2(t):
    order = [F.col("aes").desc_nulls_last(), F.col("pos").asc()]
    return ordering.dedup_text(t.media, order).select("pos", "aes", "text")


@query(
    "O2_dedup_text_large",
    """SELECT text, path, aes FROM media_big
       QUALIFY row_number() OVER (PARTITION BY text ORDER BY aes DESC NULLS LAST, pos, path, num_frames) = 1""",
)
def o2_big(t):
    order = [F.col("aes").desc_nulls_last(), F.col("pos"), F.col("path"), F.col("num_frames")]
    return ordering.dedup_text(t.media_big, order).select("text", "path", "aes")


@query("O3_sort_descending", "SELECT pos, path, flow FROM media ORDER BY flow DESC NULLS LAST, pos")
def o3(t):
    return ordering.sort_descending(t.media, "flow").select("pos", "path", "flow")


@query("O3_sort_ascending", "SELECT pos, path, aes FROM media ORDER BY aes ASC NULLS LAST, pos")
def o3a(t):
    return ordering.sort_ascending(t.media, "aes").select("pos", "path", "aes")


_SHUFFLED = f"SELECT pos, path, n, {permuted('i', 'n', permutation_key(42))} AS place FROM (SELECT pos, path, row_number() OVER (ORDER BY pos) - 1 AS i, count(*) OVER () AS n FROM media)"


@query("O4_shuffle", f"SELECT place, pos FROM ({_SHUFFLED})")
def o4(t):
    return ordering.shuffle_position(t.media.select("pos"), 42, name="place").select("place", "pos")


@query("O4_shuffle_head", f"SELECT pos, path FROM media ORDER BY {draw(42, 'pos')}, pos LIMIT 100")
def o4h(t):
    return ordering.shuffle(t.media, 42).limit(100).select(_SHOW)


@query("O5_head", "SELECT pos, path FROM media ORDER BY pos LIMIT 250")
def o5(t):
    return ordering.head(t.media, 250).select(_SHOW)


@query(
    "O6_shard",
    """WITH p AS (SELECT pos, path, row_number() OVER (ORDER BY pos) - 1 AS i, count(*) OVER () AS n FROM media)
       SELECT pos, path, CAST(CASE WHEN i < (n % 7) * (n // 7 + 1) THEN i // (n // 7 + 1)
         ELSE n % 7 + (i - (n % 7) * (n // 7 + 1)) // (n // 7) END AS INT) AS shard FROM p""",
)
def o6(t):
    return ordering.shard(t.media, 7).select("pos", "path", "shard")


@query(
    "O6_shard_large",
    """WITH p AS (SELECT *, row_number() OVER (ORDER BY pos, path, text, num_frames) - 1 AS i, count(*) OVER () AS n FROM media_big),
       s AS (SELECT *, CASE WHEN i < (n % 97) * (n // 97 + 1) THEN i // (n // 97 + 1)
         ELSE n % 97 + (i - (n % 97) * (n // 97 + 1)) // (n // 97) END AS shard FROM p)
       SELECT CAST(shard AS INT) AS shard, count(*) AS n, CAST(sum(num_frames) AS BIGINT) AS frames, min(path) AS first_path, max(path) AS last_path FROM s GROUP BY 1""",
)
def o6_big(t):
    placed = ordering.shard(t.media_big, 97, ["pos", "path", "text", "num_frames"])
    return placed.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n"), F.sum("num_frames").alias("frames"), F.min("path").alias("first_path"), F.max("path").alias("last_path")
    )


@query(
    "O7_split_random",
    f"SELECT pos, path, CASE WHEN place < floor(n * 0.07::DOUBLE) THEN 'train' WHEN place < floor(n * 0.07::DOUBLE) + floor(n * 0.015::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM ({_SHUFFLED})",
)
def o7(t):
    return ordering.split_random(t.media).select("pos", "path", "split")


@query("O8_topk", "SELECT pos, path, flow FROM media ORDER BY flow DESC NULLS LAST, pos LIMIT 25")
def o8(t):
    return ordering.topk(t.media, "flow", 25).select("pos", "path", "flow")


@query(
    "O9_assign_rank_strided",
    """WITH p AS (SELECT pos, row_number() OVER (ORDER BY pos) - 1 AS i, count(*) OVER () AS n FROM media),
       w AS (SELECT pos, i FROM p UNION ALL SELECT pos, i + n FROM p WHERE n % 48 > 0 AND i < 48 - n % 48)
       SELECT pos, CAST(i % 48 AS INT) AS rank, CAST(i // 48 AS BIGINT) AS rank_index FROM w WHERE i // 48 >= 3""",
)
def o9(t):
    return ordering.assign_rank_strided(t.media.select("pos"), 48, start_index=3)


@query(
    "O10_assign_rank_blocked",
    """WITH p AS (SELECT pos, row_number() OVER (ORDER BY pos) - 1 AS i, count(*) OVER () AS n FROM media)
       SELECT pos, CAST(least(i // (n // 16), 15) AS INT) AS rank FROM p""",
)
def o10(t):
    return ordering.assign_rank_blocked(t.media.select("pos"), 16)


@query(
    "O11_assign_buffer_rank",
    """WITH p AS (SELECT pos, row_number() OVER (ORDER BY pos) - 1 AS i, count(*) OVER () AS n FROM media)
       SELECT pos, CAST(i // 30 AS BIGINT) AS buffer, CAST(CASE WHEN i // 30 < ((n // 30) // 4) * 4 THEN (i // 30) // ((n // 30) // 4) END AS INT) AS rank FROM p""",
)
def o11(t):
    return ordering.assign_buffer_rank(t.media.select("pos"), 4, 30)


@query("O12_slice", "SELECT pos, path FROM (SELECT *, row_number() OVER (ORDER BY pos) - 1 AS i, count(*) OVER () AS n FROM media) WHERE i >= 100 AND i < n - 40")
def o12(t):
    return ordering.slice_rows(t.media, 100, -40).select(_SHOW)


# Paths of several hosts, so that no prefix is common to all.
_HOSTED = "concat(CASE CAST(l_suppkey % 4 AS INT) WHEN 0 THEN 's3://a/' WHEN 1 THEN 's3://a/b/' WHEN 2 THEN 'https://x.org/' ELSE '/mnt/' END, 'clips/', CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING), '.mp4')"


def _hosted(t):
    return t.lineitem.selectExpr(f"{_HOSTED} AS path", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


_HOSTED_ORDER = ["path", "l_partkey", "l_suppkey"]
_HOSTED_SQL = f"SELECT {_HOSTED} AS path, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem"


@query(
    "O6_shard_by_path",
    f"""WITH p AS (SELECT path, row_number() OVER (ORDER BY path, l_partkey, l_suppkey) - 1 AS i, count(*) OVER () AS n FROM ({_HOSTED_SQL})),
       s AS (SELECT path, CASE WHEN i < (n % 64) * (n // 64 + 1) THEN i // (n // 64 + 1) ELSE n % 64 + (i - (n % 64) * (n // 64 + 1)) // (n // 64) END AS shard FROM p)
       SELECT path, CAST(shard AS INT) AS shard FROM s""",
)
def o6_path(t):
    return ordering.shard(_hosted(t), 64, _HOSTED_ORDER).select("path", "shard")


@query(
    "O9_rank_by_path",
    f"""WITH p AS (SELECT path, row_number() OVER (ORDER BY path, l_partkey, l_suppkey) - 1 AS i FROM ({_HOSTED_SQL})), n AS (SELECT count(*) AS n FROM p),
       w AS (SELECT path, i FROM p UNION ALL SELECT path, i + n FROM p, n WHERE i < (48 - n % 48) % 48)
       SELECT path, CAST(i % 48 AS INT) AS rank, CAST(i // 48 AS BIGINT) AS rank_index FROM w""",
)
def o9_path(t):
    return ordering.assign_rank_strided(_hosted(t), 48, _HOSTED_ORDER).select("path", "rank", "rank_index")


@query(
    "O12_slice_by_path",
    f"""SELECT path, l_partkey FROM (SELECT *, row_number() OVER (ORDER BY path, l_partkey, l_suppkey) - 1 AS i, count(*) OVER () AS n FROM ({_HOSTED_SQL}))
        WHERE i >= 100 AND i < n - 4000""",
)
def o12_path(t):
    return ordering.slice_rows(_hosted(t), 100, -4000, _HOSTED_ORDER).select("path", "l_partkey")


@query(
    "O5_head_large",
    f"SELECT path, l_partkey FROM ({_HOSTED_SQL}) ORDER BY path, l_partkey, l_suppkey LIMIT 30000",
)
def o5_large(t):
    return ordering.head(_hosted(t), 30_000, by=[(c, False) for c in _HOSTED_ORDER]).select("path", "l_partkey")


@query(
    "O8_topk_large",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 30000",
)
def o8_large(t):
    by = [("l_extendedprice", True), *[(c, False) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]]
    return ordering.head(t.lineitem, 30_000, by=by).select("l_orderkey", "l_linenumber", "l_extendedprice")
