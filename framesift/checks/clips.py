"""V: scenes, clips and frame choices."""

from __future__ import annotations

from pyspark.sql import functions as F

from framesift.checks.registry import query
from framesift.checks.sqltext import uniform
from framesift.functions import frames
from framesift.functions.rng import uniform as spark_uniform
from framesift.operators import clips


def _joined(column, name):
    return F.array_join(column, ",").alias(name)


_SCENES = """SELECT pos, path, height, width, CAST(s AS INT) AS scene,
    CAST(round((CAST(a[1] AS DOUBLE) * 3600 + CAST(a[2] AS DOUBLE) * 60 + CAST(a[3] AS DOUBLE)) * 100) AS BIGINT) AS start_t,
    CAST(round((CAST(b[1] AS DOUBLE) * 3600 + CAST(b[2] AS DOUBLE) * 60 + CAST(b[3] AS DOUBLE)) * 100) AS BIGINT) AS end_t
  FROM (SELECT *, string_split(tc[2 * s + 1], ':') AS a, string_split(tc[2 * s + 2], ':') AS b
        FROM (SELECT *, regexp_extract_all(timestamp, '\\d+:\\d+:\\d+\\.\\d+') AS tc FROM media WHERE timestamp LIKE '[%]'), unnest(range(2)) AS r(s))"""


@query("V1_parse_scenes", f"SELECT pos, scene, start_t, end_t FROM ({_SCENES})")
def v1(t):
    rows = t.media.select("pos", F.posexplode(clips.parse_scenes(F.col("timestamp"))).alias("scene", "s"))
    return rows.select("pos", "scene", F.col("s.start").alias("start_t"), F.col("s.end").alias("end_t"))


@query(
    "V2_clip_plan",
    f"""SELECT path, scene, start_t / 100.0::DOUBLE AS start, least(greatest(end_t - start_t, 0), 1500) / 100.0::DOUBLE AS duration,
          'clips/' || regexp_replace(split_part(path, '/', -1), '^(.+)\\.[^.]*$', '\\1') || '_scene-' || CAST(scene AS VARCHAR) || '.mp4' AS clip_path,
          CAST(30 AS INT) AS target_fps,
          CAST(CASE WHEN least(height, width) <= 480 THEN height WHEN width > height THEN 480 ELSE floor(480::DOUBLE * height / (width * 2) + 0.5) * 2 END AS INT) AS out_h,
          CAST(CASE WHEN least(height, width) <= 480 THEN width WHEN width > height THEN floor(480::DOUBLE * width / (height * 2) + 0.5) * 2 ELSE 480 END AS INT) AS out_w
        FROM ({_SCENES}) WHERE greatest(end_t - start_t, 0) >= 200""",
)
def v2(t):
    return clips.clip_plan(t.media, "clips", shorter=480)


@query(
    "V2_whole_videos",
    """SELECT path, CAST(0 AS INT) AS scene, CAST(NULL AS DOUBLE) AS start, CAST(NULL AS DOUBLE) AS duration,
         'out/' || regexp_replace(path, '/[^/]*$', '') || '/' || regexp_replace(split_part(path, '/', -1), '^(.+)\\.[^.]*$', '\\1') || '_scene-0.mp4' AS clip_path,
         CAST(30 AS INT) AS target_fps FROM media""",
)
def v2w(t):
    return clips.clip_plan(t.media.select("path", F.col("path").alias("relpath")), "out")


@query(
    "V3_resize_rule",
    """SELECT pos, CAST(CASE WHEN least(height, width) <= 240 THEN height WHEN width > height THEN 240 ELSE floor(240::DOUBLE * height / (width * 2) + 0.5) * 2 END AS INT) AS out_h,
         CAST(CASE WHEN least(height, width) <= 240 THEN width WHEN width > height THEN floor(240::DOUBLE * width / (height * 2) + 0.5) * 2 ELSE 240 END AS INT) AS out_w FROM media""",
)
def v3(t):
    out_h, out_w = clips.resized(F.col("height"), F.col("width"), 240)
    return t.media.select("pos", out_h.alias("out_h"), out_w.alias("out_w"))


_CLIP = "'clips/' || regexp_replace(split_part(path, '/', -1), '^(.+)\\.[^.]*$', '\\1') || '_scene-' || CAST(scene AS VARCHAR) || '.mp4'"


@query(
    "V4_pending_clips",
    f"""WITH plan AS (SELECT {_CLIP} AS clip_path, scene FROM ({_SCENES}) WHERE greatest(end_t - start_t, 0) >= 200)
        SELECT clip_path, scene FROM plan WHERE clip_path NOT IN (
          SELECT 'clips/' || regexp_replace(split_part(path, '/', -1), '^(.+)\\.[^.]*$', '\\1') || '_scene-1.mp4' FROM labelled)""",
)
def v4(t):
    done = t.labelled.select(F.concat(F.lit("clips/"), F.regexp_replace(F.substring_index("path", "/", -1), r"\.[^.]*$", ""), F.lit("_scene-1.mp4")).alias("path"))
    return clips.pending_clips(clips.clip_plan(t.media, "clips"), done).select("clip_path", "scene")


@query("V5_scene_ok", "SELECT pos, path FROM labelled WHERE quality = 1")
def v5(t):
    return clips.scene_ok(t.labelled.withColumn("ok", F.col("quality") == 1)).select("pos", "path")


@query(
    "V6_frames_at_points",
    """SELECT pos, array_to_string([CAST(least(floor(p * num_frames), num_frames - 1) AS INT) FOR p IN [0.1::DOUBLE, 0.5::DOUBLE, 0.9::DOUBLE]], ',') AS frames,
         array_to_string([CAST(least(floor(p * num_frames), num_frames - 1) AS INT) FOR p IN [0.25::DOUBLE, 0.5::DOUBLE]], ',') AS scored FROM media""",
)
def v6(t):
    n = F.col("num_frames")
    return t.media.select(
        "pos",
        _joined(frames.frames_at_points(n, frames.CAPTION_POINTS[3]), "frames"),
        _joined(frames.frames_at_points(n, frames.AESTHETIC_POINTS[2]), "scored"),
    )


@query(
    "V7_frames_fixed",
    """SELECT pos, CAST(i AS INT) AS pair, CAST(least(i * 10, num_frames - 1) AS INT) AS first, CAST(least(i * 10 + 10, num_frames - 1) AS INT) AS second
       FROM media, unnest(range(3)) AS r(i)""",
)
def v7(t):
    pairs = frames.consecutive_pairs(frames.frames_fixed(F.col("num_frames")))
    return t.media.select("pos", F.posexplode(pairs).alias("pair", "p")).select("pos", "pair", "p.first", "p.second")


@query(
    "V8_frames_segment_mid",
    """SELECT pos, array_to_string([CAST(trunc((CAST(num_frames AS DOUBLE) - 1) / 4 / 2) AS INT) + CAST(round_even((CAST(num_frames AS DOUBLE) - 1) / 4 * i, 0) AS INT) FOR i IN range(4)], ',') AS frames FROM media""",
)
def v8(t):
    return t.media.select("pos", _joined(frames.frames_segment_mid(F.col("num_frames"), 4), "frames"))


_EDGE = "CASE WHEN {i} = k THEN num_frames ELSE floor(({i}) * (CAST(num_frames AS DOUBLE) / k)) END"


def _uniform_sql(pick: str) -> str:
    first, last = _EDGE.format(i="i"), f"({_EDGE.format(i='i + 1')} - 1)"
    return f"""SELECT pos, array_to_string(list(CAST(f AS INT) ORDER BY j), ',') AS frames FROM (
          SELECT pos, j, {pick.format(first=first, last=last)} AS f FROM (
            SELECT pos, num_frames, least(12, num_frames) AS k, j, least(j, least(12, num_frames) - 1) AS i
            FROM media, unnest(range(12)) AS r(j) WHERE num_frames > 0)) GROUP BY pos"""


@query("V9_frames_uniform_middle", _uniform_sql("floor(({first} + {last}) / 2)"))
def v9(t):
    rows = t.media.filter("num_frames > 0")
    return rows.select("pos", _joined(frames.frames_uniform(F.col("num_frames"), 12), "frames"))


@query("V9_frames_uniform_random", _uniform_sql(f"floor({{first}} + floor({uniform(3, 'pos', 'CAST(i AS VARCHAR)')} * ({{last}} - {{first}} + 1)))"))
def v9r(t):
    rows = t.media.filter("num_frames > 0")
    draws = F.array(*[spark_uniform(3, F.col("pos"), str(i)) for i in range(12)])
    return rows.select("pos", _joined(frames.frames_uniform(F.col("num_frames"), 12, draws=draws), "frames"))


@query(
    "V9_frames_at_rate",
    """SELECT pos, array_to_string(coalesce(list(CAST(f AS INT) ORDER BY i) FILTER (WHERE f < num_frames), []), ',') AS frames FROM (
         SELECT pos, num_frames, i, round_even((1.0::DOUBLE + i * ((1.0::DOUBLE + 2.0::DOUBLE) - 1.0::DOUBLE)) * fps, 0) AS f
         FROM (SELECT pos, num_frames, fps, CAST(num_frames AS DOUBLE) / fps AS d FROM media WHERE fps > 0),
           unnest(range(CAST(ceil(d / 2.0::DOUBLE) AS BIGINT))) AS r(i)) GROUP BY pos""",
)
def v9f(t):
    rows = t.media.filter("fps > 0 AND num_frames > 0")
    return rows.select("pos", _joined(frames.frames_at_rate(F.col("num_frames"), 0.5, F.col("fps")), "frames"))


@query(
    "V10_resample_frames",
    """SELECT pos, array_to_string(list(CAST(f AS INT) ORDER BY i) FILTER (WHERE f < num_frames), ',') AS frames FROM (
         SELECT pos, num_frames, i, round_even(i * (1.0::DOUBLE / 3) * 60, 0) AS f FROM media,
           unnest(range(CAST(ceil((CAST(num_frames AS DOUBLE) - 1) / 60 / (1.0::DOUBLE / 3)) AS BIGINT))) AS r(i)) GROUP BY pos""",
)
def v10(t):
    rows = t.media.filter("num_frames > 1")
    return rows.select("pos", _joined(frames.resample_frames(F.col("num_frames")), "frames"))


_LIN = "CASE WHEN i = {n} - 1 AND {n} > 1 THEN {last} ELSE floor(i * (CAST({last} - {start} AS DOUBLE) / greatest({n} - 1, 1)) + {start}) END"


@query(
    "V11_temporal_crop",
    f"""SELECT pos, array_to_string(list(CAST({_LIN.format(n='17', start='b', last='(e - 1)')} AS INT) ORDER BY i), ',') AS frames FROM (
          SELECT pos, b, least(b + 51, num_frames) AS e FROM (
            SELECT pos, num_frames, CAST(floor({uniform(4, 'pos', "'crop'")} * (greatest(0, num_frames - 52) + 1)) AS INT) AS b FROM media)),
          unnest(range(17)) AS r(i) WHERE e - b >= 17 GROUP BY pos""",
)
def v11(t):
    crop = frames.temporal_crop(F.col("num_frames"), 17, 3, spark_uniform(4, F.col("pos"), "crop"), on_short="null")
    return t.media.select("pos", crop.alias("f")).filter("f IS NOT NULL").select("pos", _joined(F.col("f"), "frames"))


@query(
    "V12_paired_frames",
    f"""SELECT pos, array_to_string(list(CAST({_LIN.format(n='k', start='0', last='(e - 1)')} AS INT) ORDER BY i), ',') AS frames FROM (
          SELECT pos, CASE WHEN num_frames >= 64 THEN 64 ELSE num_frames END AS e,
            CASE WHEN num_frames >= 64 THEN 32 ELSE CAST(trunc(CAST(num_frames AS DOUBLE) / 64 * 32) AS INT) END AS k FROM media),
          unnest(range(k)) AS r(i) GROUP BY pos""",
)
def v12(t):
    picked = t.media.select("pos", frames.paired_frames(F.col("num_frames"), 32, 2).alias("f")).filter("size(f) > 0")
    return picked.select("pos", _joined(F.col("f"), "frames"))


@query(
    "V13_crop_box",
    """WITH m AS (SELECT pos, height AS h, width AS w, 360 AS th, 640 AS tw FROM media WHERE width > 0),
       s AS (SELECT *, th / h::DOUBLE > tw / w::DOUBLE AS tall FROM m),
       z AS (SELECT *, CASE WHEN tall THEN th ELSE round_even(h * (tw / w::DOUBLE), 0) END AS sh, CASE WHEN tall THEN round_even(w * (th / h::DOUBLE), 0) ELSE tw END AS sw FROM s)
       SELECT pos, CAST(sh AS INT) AS scaled_h, CAST(sw AS INT) AS scaled_w, CAST(CASE WHEN tall THEN 0 ELSE round_even((sh - th) / 2, 0) END AS INT) AS top,
         CAST(CASE WHEN tall THEN round_even((sw - tw) / 2, 0) ELSE 0 END AS INT) AS left FROM z""",
)
def v13(t):
    box = frames.crop_box(F.col("height"), F.col("width"), F.lit(360), F.lit(640))
    return t.media.filter("width > 0").select("pos", box.alias("b")).select("pos", "b.*")
