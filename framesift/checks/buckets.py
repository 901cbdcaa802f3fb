"""B: buckets and batch planning."""

from __future__ import annotations

from pyspark.sql import functions as F

from framesift.checks.registry import query
from framesift.checks.sqltext import permutation_key, permuted, uniform
from framesift.functions.aspect import PIXELS, sizes
from framesift.functions.rng import uniform as spark_uniform
from framesift.operators import buckets

CONFIG = {
    "144p": {1: (1.0, 4), 51: (1.0, 2)},
    "480p": {1: (1.0, 2), 51: (0.5, 2), 102: ((1.0, 0.33), 1)},
    "720p": {51: (1.0, 1)},
}
_BATCH = {(r, t): b for r, d in CONFIG.items() for t, (_, b) in d.items()}
_RATIOS = ", ".join(
    f"('{r}', {i}, '{name}', {h}, {w})" for r in CONFIG for i, (name, (h, w)) in enumerate(sizes(r).items())
)


def _choice_sql(seed: int, interval: int, certain: bool) -> str:
    u1, u2 = uniform(seed, "pos", "'1#1'"), uniform(seed, "pos", "'2#1'")
    consider = "true" if certain else f"NOT ({u1} > 0.33)"
    accept = "true" if certain else f"{u2} < 0.5"
    i = interval
    return f"""CASE
        WHEN px >= 737280 AND num_frames > {51 * i} THEN '720p/51'
        WHEN px >= 327936 AND num_frames = 1 THEN '480p/1'
        WHEN px >= 327936 AND num_frames > {102 * i} AND {consider} THEN '480p/102'
        WHEN px >= 327936 AND num_frames > {51 * i} AND {accept} THEN '480p/51'
        WHEN px >= 29491.2 AND num_frames = 1 THEN '144p/1'
        WHEN px >= 29491.2 AND num_frames > {51 * i} THEN '144p/51' END"""


def bucketed_sql(view: str = "media", seed: int = 0, interval: int = 1, certain: bool = False) -> str:
    batch = " ".join(f"WHEN '{r}/{t}' THEN {b}" for (r, t), b in _BATCH.items())
    return f"""SELECT x.*, r.name AS ar, r.h AS bucket_h, r.w AS bucket_w FROM (
          SELECT *, split_part(choice, '/', 1) AS res, CAST(split_part(choice, '/', 2) AS INT) AS t,
            CASE choice {batch} END AS batch_size
          FROM (SELECT *, {_choice_sql(seed, interval, certain)} AS choice
                FROM (SELECT *, CAST(height AS BIGINT) * width AS px FROM {view})) WHERE choice IS NOT NULL) x
        JOIN (VALUES {_RATIOS}) AS r(res, idx, name, h, w) ON r.res = x.res
        QUALIFY row_number() OVER (PARTITION BY pos, path, text, num_frames ORDER BY abs(CAST(r.name AS DOUBLE) - CAST(height AS DOUBLE) / width), idx) = 1"""


_TABLE = ", ".join(
    f"('{r}', {t}, '{a}', {h}, {w}, {b}, {level}, {px})"
    for r, t, a, h, w, b, _, level, px in buckets.bucket_rows(CONFIG)
)


@query(
    "B1_bucket_table",
    f"""WITH b AS ({bucketed_sql()}), c AS (SELECT res, t, ar, count(*) AS n FROM b GROUP BY ALL)
        SELECT res, CAST(t AS INT) AS t, ar, CAST(h AS INT) AS height, CAST(w AS INT) AS width, CAST(bs AS INT) AS batch_size, CAST(level AS INT) AS level_id, CAST(px AS BIGINT) AS pixels, coalesce(n, 0) AS samples
        FROM (VALUES {_TABLE}) AS v(res, t, ar, h, w, bs, level, px) LEFT JOIN c USING (res, t, ar)""",
)
def b1(t):
    table = buckets.bucket_table(t.spark, CONFIG).drop("prob")
    counts = buckets.in_bucket(buckets.assign_bucket(t.media, CONFIG)).groupBy(*buckets.BUCKET).agg(F.count(F.lit(1)).alias("samples"))
    return table.join(counts, buckets.BUCKET, "left").fillna(0, ["samples"])


@query("B2_assign_bucket", f"SELECT pos, path, res, t, ar FROM ({bucketed_sql()})")
def b2(t):
    return buckets.in_bucket(buckets.assign_bucket(t.media, CONFIG)).select("pos", "path", *buckets.BUCKET)


@query("B2_assign_bucket_large", f"SELECT res, t, ar, count(*) AS n, CAST(sum(num_frames) AS BIGINT) AS frames FROM ({bucketed_sql('media_big', seed=7, interval=2)}) GROUP BY ALL")
def b2_big(t):
    placed = buckets.in_bucket(buckets.assign_bucket(t.media_big, CONFIG, frame_interval=2, seed=7))
    return placed.groupBy(*buckets.BUCKET).agg(F.count(F.lit(1)).alias("n"), F.sum("num_frames").alias("frames"))


@query(
    "B3_closest_ratio",
    f"""SELECT pos, r.name AS ar FROM media JOIN (VALUES {_RATIOS}) AS r(res, idx, name, h, w) ON r.res = '480p'
        WHERE width > 0
        QUALIFY row_number() OVER (PARTITION BY pos ORDER BY abs(CAST(r.name AS DOUBLE) - CAST(height AS DOUBLE) / width), idx) = 1
        UNION ALL SELECT pos, NULL FROM media WHERE width = 0""",
)
def b3(t):
    return t.media.select("pos", buckets.closest_ratio(F.col("height"), F.col("width"), "480p").alias("ar"))


@query("B4_bucket_size", f"SELECT pos, res, t, ar, CAST(bucket_h AS INT) AS bucket_h, CAST(bucket_w AS INT) AS bucket_w, CAST(batch_size AS INT) AS batch_size FROM ({bucketed_sql()})")
def b4(t):
    placed = buckets.in_bucket(buckets.assign_bucket(t.media, CONFIG))
    return buckets.with_bucket_size(placed, CONFIG).select("pos", *buckets.BUCKET, "bucket_h", "bucket_w", "batch_size")


@query(
    "B5_cap_per_bucket",
    f"""SELECT pos, res, t, ar FROM ({bucketed_sql(certain=True)})
        QUALIFY row_number() OVER (PARTITION BY res, t, ar ORDER BY pos) <= 20""",
)
def b5(t):
    return buckets.cap_per_bucket(t.media, CONFIG, limit=20).select("pos", *buckets.BUCKET)


def plan_sql(replicas: int, shuffle: bool, drop_last: bool, repeat: bool = False, seed: int = 0, start: int = 0) -> str:
    """The batch plan as one statement with global windows."""
    bucket = "res, t, ar"
    place = permuted("spot", "kept", permutation_key(seed, "res", "t", "ar")) if shuffle else "spot"
    visit = permuted("q", "total", permutation_key(seed)) if shuffle else "q"
    missing = "0" if drop_last else f"CASE WHEN total % {replicas} > 0 THEN least({replicas} - total % {replicas}, total) ELSE 0 END"
    return f"""WITH b AS ({bucketed_sql(seed=seed)}),
      s AS (SELECT *, count(*) OVER (PARTITION BY {bucket}) AS n, row_number() OVER (PARTITION BY {bucket} ORDER BY pos) - 1 AS at0, min(pos) OVER (PARTITION BY {bucket}) AS first_at FROM b),
      p AS (SELECT *, at0 AS spot FROM s {"WHERE at0 < n - n % batch_size" if drop_last else "UNION ALL SELECT *, n + at0 FROM s WHERE n % batch_size > 0 AND at0 < batch_size - n % batch_size"}),
      c AS (SELECT *, count(*) OVER (PARTITION BY {bucket}) AS kept FROM p),
      j AS (SELECT *, kept // batch_size AS full_batches, {place} AS place FROM c),
      totals AS (SELECT {bucket}, any_value(full_batches) AS f, any_value(first_at) AS o FROM j GROUP BY ALL),
      turns AS (SELECT {bucket}, coalesce(sum(f) OVER (ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before, (sum(f) OVER ())::BIGINT AS total FROM totals),
      k AS (SELECT j.*, place // batch_size + before AS q, place % batch_size AS i, total FROM j JOIN turns USING ({bucket}) WHERE place // batch_size < full_batches),
      v AS (SELECT *, {visit} AS p, {missing} AS missing FROM k),
      every AS (SELECT *, p AS at_visit, false AS empty FROM v UNION ALL SELECT *, p + total, {str(not repeat).lower()} FROM v WHERE p < missing)
      SELECT CAST(at_visit // {replicas} AS BIGINT) AS step, CAST(at_visit % {replicas} AS INT) AS rank, res, CAST(t AS INT) AS t, ar, CAST(bucket_h AS INT) AS bucket_h,
        CAST(bucket_w AS INT) AS bucket_w, CASE WHEN NOT empty THEN CAST(i AS INT) END AS batch_index, CASE WHEN NOT empty THEN pos END AS pos
      FROM every WHERE (NOT empty OR i = 0) AND at_visit // {replicas} < (total + missing) // {replicas} AND at_visit // {replicas} >= {start // replicas}"""


def _plan(t, seed=0, **options):
    placed = buckets.assign_bucket(t.media, CONFIG, seed=seed)
    return buckets.plan_batches(placed, CONFIG, seed=seed, **options)


@query("B6_plan_batches_shuffled", plan_sql(8, True, False))
def b6(t):
    return _plan(t, replicas=8)


@query("B6_plan_batches_in_order", plan_sql(3, False, False, seed=5))
def b6_plain(t):
    return _plan(t, seed=5, replicas=3, shuffle=False)


@query("B6_plan_batches_drop_last", plan_sql(8, True, True, seed=3))
def b6_drop(t):
    return _plan(t, seed=3, replicas=8, drop_last=True)


@query("B6_plan_batches_repeat", plan_sql(8, False, False, repeat=True, seed=11))
def b6_repeat(t):
    return _plan(t, seed=11, replicas=8, shuffle=False, repeat_on_pad=True)


@query("B6_micro_batch_entry", f"SELECT step, rank, concat_ws('-', CAST(pos AS VARCHAR), CAST(t AS VARCHAR), CAST(bucket_h AS VARCHAR), CAST(bucket_w AS VARCHAR)) AS entry FROM ({plan_sql(4, True, True)})")
def b6_entry(t):
    return _plan(t, replicas=4, drop_last=True).select("step", "rank", buckets.micro_batch_entry().alias("entry"))


@query("B7_resume_batches", plan_sql(8, True, False, seed=2, start=101))
def b7(t):
    return _plan(t, seed=2, replicas=8, start=101)


@query(
    "B8_num_batches",
    f"""WITH b AS ({bucketed_sql()}), c AS (SELECT count(*) // any_value(batch_size) AS n FROM b GROUP BY res, t, ar)
        SELECT CAST(sum(n) AS BIGINT) AS batches, CAST(sum(n) // 8 AS BIGINT) AS steps FROM c""",
)
def b8(t):
    return buckets.num_batches(buckets.assign_bucket(t.media, CONFIG), CONFIG, 8)


@query(
    "B9_weighted_label",
    f"""SELECT pos, CASE WHEN u < 0.2::DOUBLE THEN 'random' WHEN u < 0.2::DOUBLE + 0.15::DOUBLE THEN 'image_head' ELSE 'identity' END AS mask
        FROM (SELECT pos, {uniform(9, 'pos', "'mask'")} AS u FROM media)""",
)
def b9(t):
    u = spark_uniform(9, F.col("pos"), "mask")
    return t.media.select("pos", buckets.weighted_label({"random": 0.2, "image_head": 0.15}, u).alias("mask"))


_BY_PIXELS = " ".join(f"WHEN px >= {PIXELS[r] * 0.8!r} THEN '{r}'" for r in sorted(PIXELS, key=PIXELS.get, reverse=True))


@query(
    "B10_size_helpers",
    f"""SELECT pos, CASE {_BY_PIXELS} END AS res,
          CAST(CASE WHEN num_frames = 1 THEN 1 WHEN num_frames >= 204 THEN 204 WHEN num_frames >= 102 THEN 102 WHEN num_frames >= 51 THEN 51 END AS INT) AS frames,
          CAST(CASE WHEN num_frames < 51 THEN 0 WHEN num_frames < 102 THEN 51 WHEN num_frames < 204 THEN 102 ELSE 204 END AS INT) AS floored
        FROM (SELECT *, CAST(height AS BIGINT) * width AS px FROM media)""",
)
def b10(t):
    by_size = {r: PIXELS[r] for r in sorted(PIXELS, key=PIXELS.get, reverse=True)}
    return t.media.select(
        "pos",
        buckets.resolution_from_pixels(F.col("height").cast("bigint") * F.col("width"), by_size).alias("res"),
        buckets.frames_at_most(F.col("num_frames"), [204, 102, 51, 1]).alias("frames"),
        buckets.floor_bucket(F.col("num_frames"), [0, 51, 102, 204]).alias("floored"),
    )


@query(
    "B11_ratio_sizes",
    """WITH x AS (SELECT pos, CAST(height AS DOUBLE) / nullif(width, 0) AS a FROM media),
       h AS (SELECT pos, a, sqrt(230400::DOUBLE * a) + 0.0001::DOUBLE AS h0 FROM x),
       e AS (SELECT pos, a, CASE WHEN CAST(ceil(h0) AS BIGINT) % 2 = 0 THEN ceil(h0) ELSE floor(h0) END AS h FROM h),
       w AS (SELECT pos, h, h / a + 0.0001::DOUBLE AS w0 FROM e)
       SELECT pos, CAST(h AS INT) AS out_h, CAST(CASE WHEN CAST(ceil(w0) AS BIGINT) % 2 = 0 THEN ceil(w0) ELSE floor(w0) END AS INT) AS out_w FROM w""",
)
def b11(t):
    out_h, out_w = buckets.even_sizes(F.col("height"), F.col("width"), 230400)
    return t.media.select("pos", out_h.alias("out_h"), out_w.alias("out_w"))
