"""A: aggregation and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from framesift.checks.buckets import CONFIG, bucketed_sql
from framesift.checks.registry import query
from framesift.operators import buckets, captions, profile

NUMERIC = ["num_frames", "height", "aes", "flow", "match"]
_LONG = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM media WHERE {c} IS NOT NULL" for c in NUMERIC)


@query(
    "A1_profile_split",
    """SELECT coalesce(num_frames = 1, false) AS is_image, count(*) AS n, CAST(coalesce(sum(num_frames), 0) AS BIGINT) AS frames,
       CAST(floor(coalesce(sum(num_frames), 0) / 108000) AS BIGINT) AS hours FROM media_big GROUP BY 1""",
)
def a1(t):
    return profile.profile_split(t.media_big)


@query(
    "A2_describe",
    f"""SELECT "column", count(*) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min,
        round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
        round(quantile_cont(value, 0.75), 6) AS p75, max(value) AS max FROM ({_LONG}) GROUP BY 1""",
)
def a2(t):
    out = profile.describe(t.media, NUMERIC)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p25", "p50", "p75")})


@query(
    "A3_histogram",
    f"""WITH v AS (SELECT CASE WHEN num_frames = 1 THEN 'image' ELSE 'video' END AS kind, * FROM media),
       l AS ({' UNION ALL '.join(f"SELECT kind, '{c}' AS col, CAST({c} AS DOUBLE) AS value FROM v WHERE {c} IS NOT NULL" for c in NUMERIC)}),
       e AS (SELECT kind, col, CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
             CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi FROM l GROUP BY ALL)
       SELECT kind, col AS "column", CAST(least(floor((value - lo) / ((hi - lo) / 100)), 99) AS INT) AS bin,
         round(lo + (hi - lo) / 100 * least(floor((value - lo) / ((hi - lo) / 100)), 99), 6) AS start, count(*) AS n
       FROM l JOIN e USING (kind, col) GROUP BY ALL""",
)
def a3(t):
    kind = F.when(profile.is_image_row(), F.lit("image")).otherwise(F.lit("video"))
    return profile.histogram(t.media, NUMERIC, by=kind).withColumn("start", F.round("start", 6))


@query(
    "A4_value_counts",
    "SELECT cmotion, count(*) AS n, CAST(count(*) AS DOUBLE) / (SELECT count(cmotion) FROM media) AS ratio FROM media WHERE cmotion IS NOT NULL GROUP BY 1",
)
def a4(t):
    return profile.value_counts(t.media, "cmotion", ratio=True)


@query(
    "A5_tag_distribution",
    """SELECT tag, count(*) AS n FROM (SELECT trim(unnest(string_split(replace(cmotion, '/', ',') || ', ' || CAST(height AS VARCHAR), ','))) AS tag FROM media)
       GROUP BY 1""",
)
def a5(t):
    answer = F.concat(F.lit("tags: ["), F.replace("cmotion", F.lit("/"), F.lit(",")), F.lit(", "), F.col("height"), F.lit("]"))
    return captions.tag_distribution(t.media.withColumn("tags", answer), "tags")


@query(
    "A6_bucket_stats",
    f"""WITH b AS ({bucketed_sql()}), c AS (SELECT res, t, ar, CASE WHEN t = 1 THEN 'image' ELSE 'video' END AS kind, count(*) AS size,
          count(*) // any_value(batch_size) AS batches FROM b GROUP BY res, t, ar)
        SELECT 'bucket' AS grouping, res, t, ar, kind, CAST(sum(size) AS BIGINT) AS samples, CAST(sum(batches) AS BIGINT) AS batches, count(*) AS buckets FROM c GROUP BY res, t, ar, kind
        UNION ALL SELECT 'shape', NULL, NULL, ar, NULL, CAST(sum(size) AS BIGINT), CAST(sum(batches) AS BIGINT), count(*) FROM c GROUP BY ar
        UNION ALL SELECT 'size', res, t, NULL, kind, CAST(sum(size) AS BIGINT), CAST(sum(batches) AS BIGINT), count(*) FROM c GROUP BY res, t, kind
        UNION ALL SELECT 'kind', NULL, NULL, NULL, kind, CAST(sum(size) AS BIGINT), CAST(sum(batches) AS BIGINT), count(*) FROM c GROUP BY kind
        UNION ALL SELECT 'total', NULL, NULL, NULL, NULL, CAST(sum(size) AS BIGINT), CAST(sum(batches) AS BIGINT), count(*) FROM c""",
)
def a6(t):
    return buckets.bucket_stats(buckets.assign_bucket(t.media, CONFIG), CONFIG)


@query(
    "A7_frames_grouped",
    """WITH g AS (SELECT path, list(num_frames * 0.25::DOUBLE ORDER BY pos) AS a, list(num_frames * 0.5::DOUBLE ORDER BY pos) AS b,
           arg_min(text, pos) FILTER (WHERE text IS NOT NULL) AS text, arg_min(height, pos) FILTER (WHERE height IS NOT NULL) AS height,
           arg_min(fps, pos) FILTER (WHERE fps IS NOT NULL) AS fps, count(*) AS n FROM media GROUP BY path)
       SELECT path, CAST(i AS INT) AS place,
         CASE i % 3 WHEN 0 THEN a[i // 3 + 1] WHEN 1 THEN b[i // 3 + 1] ELSE 10.0 END AS point, text, height, fps
       FROM g, unnest(range(n * 3)) AS r(i)""",
)
def a7(t):
    out = profile.frames_grouped(t.media, [0.25, 0.5, 10], ["text", "height", "fps"])
    return out.select("path", F.posexplode("points").alias("place", "point"), "text", "height", "fps")


_LINES = "SELECT concat('o', CAST(l_orderkey AS VARCHAR)) AS path, (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey AS pos, CAST(l_quantity AS INT) AS num_frames, concat(l_returnflag, l_linestatus) AS kind FROM lineitem"


def _lines(t, path):
    return t.lineitem.select(path.alias("path"), ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey")).alias("pos"), F.col("l_quantity").cast("int").alias("num_frames"))


@query(
    "A7_frames_grouped_large",
    f"""SELECT kind AS path, count(*) * 2 AS n, list_sum(list(num_frames * 0.5::DOUBLE ORDER BY pos, num_frames)[1:2000]) + least(count(*), 2000) * 3.0::DOUBLE AS head,
          sum(num_frames * 0.5::DOUBLE) + count(*) * 3.0::DOUBLE AS total FROM ({_LINES}) GROUP BY kind""",
)
def a7_large(t):
    """A few paths that hold all rows, their points in order in rows of bounded arrays."""
    out = profile.frames_grouped(_lines(t, F.concat("l_returnflag", "l_linestatus")), [0.5, 3], [], per_row=2000)
    parts = out.select("path", "part", F.size("points").alias("n"), F.aggregate("points", F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0))).alias("total"))
    return parts.groupBy("path").agg(F.sum("n").alias("n"), F.max(F.when(F.col("part") == 0, F.col("total"))).alias("head"), F.sum("total").alias("total"))


@query("A7_frames_grouped_orders", f"SELECT path, count(*) * 2 AS n, sum(num_frames * 0.5::DOUBLE) + count(*) * 3.0::DOUBLE AS total FROM ({_LINES}) GROUP BY path")
def a7_orders(t):
    """Very many paths, each with the few rows of an order."""
    out = profile.frames_grouped(_lines(t, F.concat(F.lit("o"), "l_orderkey")), [0.5, 3], [])
    return out.select("path", F.size("points").cast("bigint").alias("n"), F.aggregate("points", F.lit(0.0), lambda a, x: a + x).alias("total"))


@query(
    "A7_frames_long_hot",
    f"""WITH placed AS (SELECT kind, num_frames, row_number() OVER (PARTITION BY kind ORDER BY pos) - 1 AS ord FROM ({_LINES}))
        SELECT kind AS path, (ord * 2 + k) // 1000 AS thousand, count(*) AS n, sum(CASE k WHEN 0 THEN num_frames * 0.5::DOUBLE ELSE 3.0::DOUBLE END) AS total FROM placed, unnest(range(2)) AS r(k) GROUP BY ALL""",
)
def a7_hot(t):
    """A few paths that hold all rows, in the form without arrays."""
    rows = profile.frames_long(_lines(t, F.concat("l_returnflag", "l_linestatus")), [0.5, 3])
    return rows.groupBy("path", F.expr("place div 1000").alias("thousand")).agg(F.count(F.lit(1)).alias("n"), F.sum("point").alias("total"))


@query(
    "A7_frames_long",
    """WITH placed AS (SELECT path, num_frames, row_number() OVER (PARTITION BY path ORDER BY pos) - 1 AS ord FROM media)
       SELECT path, ord * 2 + k AS place, CASE k WHEN 0 THEN num_frames * 0.5::DOUBLE ELSE 3.0::DOUBLE END AS point FROM placed, unnest(range(2)) AS r(k)""",
)
def a7_long(t):
    return profile.frames_long(t.media, [0.5, 3])


@query(
    "A8_caption_duplicates",
    "SELECT text, count(*) AS copies, count(*) - 1 AS removed FROM media GROUP BY text HAVING count(*) > 1",
)
def a8(t):
    return profile.caption_duplicates(t.media)


@query("A8_path_duplicates", "SELECT path, count(*) AS copies, count(*) - 1 AS removed FROM media_big GROUP BY path HAVING count(*) > 1")
def a8p(t):
    return profile.caption_duplicates(t.media_big, "path")
