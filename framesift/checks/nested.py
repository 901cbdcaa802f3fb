"""R: nested columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from framesift.checks.registry import query
from framesift.operators import nested


@query(
    "R1_downsample_trajectory",
    """SELECT vec_id, CAST(k AS INT) AS step, embedding[k * 20 + 1] AS state, CAST(k * 20 AS INT) AS gripper
       FROM embeddings, unnest(range(4)) AS r(k)""",
)
def r1(t):
    rows = t.embeddings.select("vec_id", F.col("embedding").alias("state"), F.sequence(F.lit(0), F.lit(63)).alias("gripper"))
    thin = nested.downsample_trajectory(rows, ["state", "gripper"])
    return nested.explode_frames(thin, ["vec_id"], ["state", "gripper"]).withColumnRenamed("frame_idx", "step")


@query(
    "R2_build_annotation",
    """SELECT CAST(i AS VARCHAR) AS episode_id, CAST(i AS VARCHAR) || '.json' AS file,
         '{"task":"robot_trajectory_prediction","texts":["' || cmotion || '"],"videos":[{"video_path":"' || replace(path, 'videos/', 'raw/videos/') || '"}],"state":[['
           || CAST(match AS VARCHAR) || ',0.5]],"continuous_gripper_state":[' || CAST(match AS VARCHAR) || '],"episode_id":"' || CAST(i AS VARCHAR) || '"}' AS json
       FROM (SELECT *, row_number() OVER (ORDER BY pos) - 1 AS i FROM media)""",
)
def r2(t):
    rows = t.media.select(
        "pos",
        "path",
        F.col("cmotion").alias("text"),
        F.array(F.array(F.col("match"), F.lit(0.5))).alias("state"),
        F.array("match").alias("continuous_gripper_state"),
    )
    return nested.build_annotation(rows, "videos/", "raw/videos/")


@query(
    "R2_recording_path",
    "SELECT pos, regexp_replace(replace('/data/small/recordings/MP4/' || path, '/recordings/MP4', ''), '[^/]*$', '') AS folder FROM media",
)
def r2p(t):
    path = F.concat(F.lit("/data/small/recordings/MP4/"), "path")
    out = nested.recording_path(path, "/recordings/MP4", "/none/", "/raw/")
    return t.media.select("pos", F.regexp_replace(out, "trajectory.h5$", "").alias("folder"))


@query(
    "R3_build_caption_request",
    """SELECT path AS custom_id, '{"custom_id":"' || path || '","method":"POST","url":"/v1/chat/completions","body":{"model":"vlm","messages":[{"role":"user","content":[{"type":"text","text":"Describe: '
         || cmotion || '"},{"type":"image_url","image_url":{"url":"data:image/jpeg;base64,' || md5(concat(path, 'a')) || '"}},{"type":"image_url","image_url":{"url":"data:image/jpeg;base64,' || md5(concat(path, CAST(num_frames // 250 AS VARCHAR))) || '"}}]}],"temperature":0,"max_tokens":1000}}' AS value
       FROM media WHERE num_frames >= 0""",
)
def r3(t):
    frames = F.array(F.md5(F.concat("path", F.lit("a"))), F.md5(F.concat("path", F.expr("CAST(num_frames div 250 AS STRING)"))))
    rows = t.media.withColumn("frames", frames).withColumn("text", F.col("cmotion"))
    return nested.build_caption_request(rows, "Describe: {task_description}", "vlm")


@query(
    "R3_duplicate_frames_dropped",
    "SELECT path AS custom_id FROM media WHERE cmotion <> 'static' AND cmotion <> 'unknown'",
)
def r3d(t):
    second = F.when(F.col("cmotion").isin("static", "unknown"), F.lit("AA")).otherwise(F.lit("BB"))
    rows = t.media.withColumn("frames", F.array(F.lit("AA"), second))
    return nested.build_caption_request(rows, "{task_description}", "vlm", need_frames=2).select("custom_id")


@query(
    "R4_parse_nested_list",
    """SELECT pos, CAST(s AS INT) AS scene, tc[2 * s + 1] AS first, tc[2 * s + 2] AS second
       FROM (SELECT pos, regexp_extract_all(timestamp, '\\d+:\\d+:\\d+\\.\\d+') AS tc FROM media WHERE timestamp LIKE '[%]'), unnest(range(2)) AS r(s)""",
)
def r4(t):
    lists = nested.parse_nested_list(F.col("timestamp"), "array<array<string>>")
    rows = t.media.select("pos", F.posexplode(lists).alias("scene", "s"))
    return rows.select("pos", "scene", F.get("s", F.lit(0)).alias("first"), F.get("s", F.lit(1)).alias("second"))


@query(
    "R5_explode_frames",
    "SELECT vec_id, CAST(i AS INT) AS frame_idx, embedding[i + 1] AS x, embedding[64 - i] AS y FROM embeddings, unnest(range(64)) AS r(i)",
)
def r5(t):
    rows = t.embeddings.select("vec_id", F.col("embedding").alias("x"), F.reverse("embedding").alias("y"))
    return nested.explode_frames(rows, ["vec_id"], ["x", "y"])


@query(
    "R5_implode_frames",
    "SELECT conv_id, count(*) AS turns, string_agg(role, '>' ORDER BY turn) AS roles FROM conversations GROUP BY 1",
)
def r5i(t):
    packed = nested.implode_frames(t.conversations, ["conv_id"], ["role"], index="turn")
    return packed.select("conv_id", F.size("role").cast("bigint").alias("turns"), F.array_join("role", ">").alias("roles"))


@query(
    "R5_implode_frames_large",
    "SELECT l_returnflag, count(*) AS n, sum(l_quantity)::DOUBLE AS total, arg_min(l_quantity, l_orderkey * 8 + l_linenumber)::DOUBLE AS first FROM lineitem GROUP BY 1",
)
def r5_large(t):
    """A few keys that hold all frames, packed in order into rows of bounded arrays."""
    rows = t.lineitem.select("l_returnflag", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("frame_idx"), F.col("l_quantity").cast("double").alias("x"))
    packed = nested.implode_frames(rows, ["l_returnflag"], ["x"], per_row=10_000)
    known = F.filter("x", lambda v: v.isNotNull())
    sums = packed.select("l_returnflag", "part", F.size("x").alias("n"), F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda a, v: a + v)).alias("total"), F.get(known, 0).alias("first"))
    return sums.groupBy("l_returnflag").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min_by("first", F.when(F.col("first").isNotNull(), F.col("part"))).alias("first")
    )


@query(
    "R5_implode_frames_orders",
    "SELECT l_orderkey, count(*) AS n, sum(l_quantity)::DOUBLE AS total, list(l_quantity ORDER BY l_linenumber, l_quantity)[1]::DOUBLE AS first FROM lineitem GROUP BY 1",
)
def r5_orders(t):
    """Very many keys, each with the few frames of an order."""
    rows = t.lineitem.select("l_orderkey", F.col("l_linenumber").alias("frame_idx"), F.col("l_quantity").cast("double").alias("x"))
    packed = nested.implode_frames(rows, ["l_orderkey"], ["x"])
    total = F.aggregate("x", F.lit(0.0), lambda a, v: a + v)
    return packed.select("l_orderkey", F.size("x").cast("bigint").alias("n"), total.alias("total"), F.get("x", 0).alias("first"))


@query(
    "R6_all_exist",
    """WITH f AS (SELECT path FROM labelled)
       SELECT pos, path IN (SELECT path FROM f) AND replace(path, '.mp4', '.jpg') IN (SELECT replace(path, '.mp4', '.jpg') FROM f) AS all_exist FROM media""",
)
def r6(t):
    have = t.labelled.select("path")
    listing = have.union(have.select(F.replace("path", F.lit(".mp4"), F.lit(".jpg")).alias("path")))
    rows = t.media.select("pos", F.array("path", F.replace("path", F.lit(".mp4"), F.lit(".jpg"))).alias("paths"))
    return nested.all_exist(rows, listing, "pos", "paths")
