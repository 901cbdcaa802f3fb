"""C: score computation."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from framesift.checks.registry import query
from framesift.operators import scores

_WEIGHTS, _BIAS = scores.fold_layers(
    [
        (np.array([[((i * 37 + j * 11) % 13 - 6) / 8 for i in range(64)] for j in range(4)]), np.array([0.5, -0.25, 0.125, 0.0])),
        (np.array([[1.0, -0.5, 0.25, 2.0]]), np.array([4.0])),
    ]
)
_VEC = "CAST(embedding AS DOUBLE[])"
_W = "[" + ", ".join(f"{w!r}::DOUBLE" for w in _WEIGHTS) + "]"


@query(
    "C1_match_score",
    """SELECT a.vec_id, round(100 * list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))
         / (sqrt(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[]))) * sqrt(list_dot_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])))), 6) AS match
       FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def c1(t):
    image = t.embeddings
    text = t.embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("text_vector"))
    pairs = image.join(text, "vec_id")
    return pairs.select("vec_id", F.round(scores.match_score(F.col("embedding"), F.col("text_vector")), 6).alias("match"))


@query(
    "C2_aesthetic_score",
    f"""SELECT vec_id // 8 AS path, round(avg(list_dot_product({_VEC}, {_W}) / sqrt(list_dot_product({_VEC}, {_VEC})) + {_BIAS!r}), 6) AS aes
        FROM embeddings GROUP BY 1""",
)
def c2(t):
    frames = t.embeddings.withColumn("path", F.floor(F.col("vec_id") / 8))
    return scores.aesthetic_score(frames, _WEIGHTS, _BIAS).withColumn("aes", F.round("aes", 6))


@query(
    "C3_flow_score",
    f"""SELECT vec_id // 8 AS path, round(sum(list_sum(list_transform({_VEC}, lambda x: abs(x)))) / sum(len(embedding)), 6) AS flow
        FROM embeddings GROUP BY 1""",
)
def c3(t):
    flows = t.embeddings.select(F.floor(F.col("vec_id") / 8).alias("path"), F.col("embedding").alias("flow_values"))
    return scores.flow_score(flows).withColumn("flow", F.round("flow", 6))


_MOTION = """CASE WHEN mag < 1 THEN 'static' WHEN zoom < 0.4::DOUBLE THEN 'zoom out' WHEN zoom > 0.6::DOUBLE THEN 'zoom in'
    WHEN ang < 45 OR ang >= 315 THEN 'pan left' WHEN ang < 135 THEN 'tilt up' WHEN ang < 225 THEN 'pan right' ELSE 'tilt down' END"""


@query("C4_frame_motion", f"SELECT video_id, frame_idx, {_MOTION} AS motion FROM flow_frames")
def c4(t):
    return t.flow_frames.select(
        "video_id", "frame_idx", scores.frame_motion(F.col("mag"), F.col("ang"), F.col("zoom")).alias("motion")
    )


@query(
    "C5_video_motion",
    f"""WITH f AS (SELECT video_id AS path, {_MOTION} AS motion FROM flow_frames WHERE zoom > 0.55::DOUBLE OR mag < 3),
        c AS (SELECT path, motion, count(*) AS n FROM f GROUP BY ALL),
        v AS (SELECT path, max(n) AS top, arg_max(motion, n) AS label, sum(n) AS total, bool_or(motion = 'static') AS st,
              bool_or(motion IN ('zoom in', 'zoom out')) AS zo FROM c GROUP BY path)
        SELECT k.path, CASE WHEN top * 2 > total THEN label WHEN st THEN 'unknown' WHEN zo THEN 'dynamic' ELSE 'pan/tilt' END AS cmotion
        FROM (SELECT DISTINCT c_custkey AS path FROM customer) k LEFT JOIN v USING (path)""",
)
def c5(t):
    frames = t.flow_frames.filter("zoom > 0.55D OR mag < 3").select(
        F.col("video_id").alias("path"), scores.frame_motion(F.col("mag"), F.col("ang"), F.col("zoom")).alias("motion")
    )
    return scores.video_motion(t.customer.select(F.col("c_custkey").alias("path")), frames)


_POINTS = """SELECT user_id AS path, CAST(event_id % 10 AS INT) AS r, CAST((event_id // 10) % 10 AS INT) AS c,
    CAST((event_id * 31 + user_id * 7) % 81 - 40 AS DOUBLE) AS dx, CAST((event_id * 17 + user_id * 3) % 61 - 30 AS DOUBLE) AS dy FROM events"""
_EDGES = ("top", "r = 0 AND c BETWEEN 3 AND 6"), ("down", "r = 9 AND c BETWEEN 3 AND 6"), ("lft", "c = 0 AND r BETWEEN 3 AND 6"), ("rgt", "c = 9 AND r BETWEEN 3 AND 6")


def _moves_sql(edge: str) -> str:
    limit = 10
    side = f"CASE WHEN {edge}_dx > {limit} THEN 'right' WHEN {edge}_dx < -{limit} THEN 'left' END"
    up = f"CASE WHEN {edge}_dy > {limit} THEN 'down' WHEN {edge}_dy < -{limit} THEN 'up' END"
    return f"CASE WHEN {side} IS NULL AND {up} IS NULL THEN ['static'] ELSE list_filter([{side}, {up}], lambda x: x IS NOT NULL) END AS {edge}"


def _pairs_sql(a: str, b: str, meaning: dict) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in meaning.items())
    return f"list_filter(flatten(list_transform({a}, lambda x: list_transform({b}, lambda y: CASE x || '_' || y {cases} END))), lambda z: z IS NOT NULL)"


@query(
    "C6_track_motion",
    f"""WITH p AS ({_POINTS}),
        v AS (SELECT path, {', '.join(f"avg({axis}) FILTER (WHERE {cond}) AS {e}_{axis}" for e, cond in _EDGES for axis in ('dx', 'dy'))}
              FROM p WHERE {' OR '.join(f'({cond})' for _, cond in _EDGES)} GROUP BY path),
        m AS (SELECT path, {', '.join(_moves_sql(e) for e, _ in _EDGES)} FROM v),
        f AS (SELECT path, list_sort(list_distinct(list_concat({_pairs_sql('top', 'down', scores.TOP_DOWN_MOTION)}, {_pairs_sql('lft', 'rgt', scores.LEFT_RIGHT_MOTION)}))) AS found FROM m)
        SELECT path, CASE WHEN len(found) = 0 THEN 'Undetermined'
          WHEN len(list_filter(found, lambda x: x <> 'static')) > 0 THEN array_to_string(list_filter(found, lambda x: x <> 'static'), '+') ELSE 'static' END AS cmotion
        FROM f""",
)
def c6(t):
    points = t.events.selectExpr(
        "user_id AS path",
        "CAST(event_id % 10 AS INT) AS row",
        "CAST((event_id div 10) % 10 AS INT) AS col",
        "CAST((event_id * 31 + user_id * 7) % 81 - 40 AS DOUBLE) AS dx",
        "CAST((event_id * 17 + user_id * 3) % 61 - 30 AS DOUBLE) AS dy",
        "40 AS height",
        "64 AS width",
    )
    return scores.track_motion(points, grid=10, factor=0.25)


@query(
    "C7_zoom_factor",
    f"""WITH e AS (SELECT vec_id, list_transform({_VEC}, lambda x: x * 10) AS dx, list_reverse(list_transform({_VEC}, lambda x: x * 10)) AS dy FROM embeddings),
        p AS (SELECT vec_id, i % 8 AS x, i // 8 AS y, dx[i + 1] AS dx, dy[i + 1] AS dy FROM e, unnest(range(64)) AS r(i))
        SELECT vec_id, CAST(count(*) FILTER (WHERE sqrt(pow(x + dx - 4, 2) + pow(y + dy - 4, 2)) >= sqrt(pow(x - 4, 2) + pow(y - 4, 2))) AS DOUBLE) / 64 AS zoom,
          round(median(sqrt(dx * dx + dy * dy)), 6) AS mag FROM p GROUP BY 1""",
)
def c7(t):
    flow = t.embeddings.select(
        "vec_id",
        F.transform("embedding", lambda x: x.cast("double") * 10).alias("dx"),
        F.reverse(F.transform("embedding", lambda x: x.cast("double") * 10)).alias("dy"),
    )
    grid = F.sequence(F.lit(0), F.lit(63))
    xs, ys = F.transform(grid, lambda i: i % 8), F.transform(grid, lambda i: F.floor(i / 8))
    size = F.zip_with("dx", "dy", lambda a, b: F.sqrt(a * a + b * b))
    return flow.select(
        "vec_id",
        scores.zoom_factor(F.col("dx"), F.col("dy"), xs, ys, F.lit(8), F.lit(8)).alias("zoom"),
        F.round(scores.array_median(size), 6).alias("mag"),
    )
