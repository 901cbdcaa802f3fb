"""E: evaluation tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from framesift.checks.registry import query
from framesift.operators import evaluation as ev

_PAIRS = """SELECT a.vec_id, a.vec_id // 8 AS video, a.vec_id % 8 AS t, CAST(a.embedding AS DOUBLE[]) AS x, CAST(b.embedding AS DOUBLE[]) AS y
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"""
_MSE = "list_sum([(x[i] - y[i]) * (x[i] - y[i]) FOR i IN range(1, 65)]) / 64"
_PSNR = f"CASE WHEN {_MSE} < 1e-10 THEN 100.0::DOUBLE ELSE 20 * log10(1 / sqrt({_MSE})) END"


def _frames(t):
    other = t.embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("y"))
    pairs = t.embeddings.withColumnRenamed("embedding", "x").join(other, "vec_id")
    return pairs.select(
        "vec_id",
        F.floor(F.col("vec_id") / 8).alias("video"),
        (F.col("vec_id") % 8).alias("t"),
        ev.psnr(F.col("x"), F.col("y")).alias("value"),
    )


@query("E1_psnr", f"SELECT vec_id, round({_PSNR}, 6) AS psnr FROM ({_PAIRS})")
def e1(t):
    return _frames(t).select("vec_id", F.round("value", 6).alias("psnr"))


@query("E2_metric_by_timestamp", f"SELECT t, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM (SELECT t, {_PSNR} AS v FROM ({_PAIRS})) GROUP BY t")
def e2(t):
    out = ev.metric_by_timestamp(_frames(t))
    return out.select("t", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query("E3_metric_total", f"SELECT round(avg(m), 6) AS total FROM (SELECT video // 4 AS b, t, avg(v) AS m FROM (SELECT video, t, {_PSNR} AS v FROM ({_PAIRS})) GROUP BY ALL)")
def e3(t):
    return ev.metric_total(_frames(t), 4).select(F.round("total", 6).alias("total"))


_SSIM = """WITH f AS (SELECT vec_id // 3 AS frame, flatten(list(CAST(embedding AS DOUBLE[]) ORDER BY vec_id)) AS a FROM embeddings GROUP BY 1 HAVING count(*) = 3),
  pair AS (SELECT x.frame, x.a, y.a AS b FROM f x JOIN f y ON y.frame = x.frame + 1),
  g AS (SELECT k, exp(-((k - 5) * (k - 5)) / 4.5::DOUBLE) AS w FROM unnest(range(11)) AS r(k)),
  n AS (SELECT k, w / (SELECT sum(w) FROM g) AS w FROM g),
  px AS (SELECT frame, i, j, u.w * v.w AS w, a[(i + u.k) * 16 + j + v.k + 1] AS p, b[(i + u.k) * 16 + j + v.k + 1] AS q
         FROM pair, unnest(range(2)) AS ri(i), unnest(range(6)) AS rj(j), n u, n v),
  m AS (SELECT frame, sum(w * p) AS mp, sum(w * q) AS mq, sum(w * p * p) AS pp, sum(w * q * q) AS qq, sum(w * p * q) AS pq FROM px GROUP BY frame, i, j)
  SELECT frame, round(avg((2 * mp * mq + 0.0001::DOUBLE) * (2 * (pq - mp * mq) + 0.0009::DOUBLE)
    / ((mp * mp + mq * mq + 0.0001::DOUBLE) * (pp - mp * mp + qq - mq * mq + 0.0009::DOUBLE))), 6) AS ssim FROM m GROUP BY frame"""


@query("E4_ssim", _SSIM)
def e4(t):
    """Frames of 12 x 16 pixels from three vectors each."""
    frames = t.embeddings.groupBy(F.floor(F.col("vec_id") / 3).alias("frame")).agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("vec_id", "embedding"))), lambda r: r["embedding"])).alias("a")
    ).filter("size(a) = 192")
    other = frames.select((F.col("frame") - 1).alias("frame"), F.col("a").alias("b"))
    shaped = frames.join(other, "frame").withColumns({"channels": F.lit(1), "height": F.lit(12), "width": F.lit(16)})
    return ev.ssim(shaped, ["frame"]).withColumn("ssim", F.round("ssim", 6))


def _card_rows(card, key: str) -> str:
    names = list(card.dimensions)
    picks = " ".join(f"WHEN {i} THEN '{n.replace(' ', '_')}'" for i, n in enumerate(names))
    return f"CASE CAST({key} % {len(names)} AS INT) {picks} END"


def _card_sql(card) -> str:
    dims = ", ".join(f"('{d}', {lo!r}::DOUBLE, {hi!r}::DOUBLE, {float(w)!r}::DOUBLE)" for d, (lo, hi, w) in card.dimensions.items())
    groups = ", ".join(f"('{g}', '{d}')" for g, members in card.groups.items() for d in members)
    weights = ", ".join(f"('{g}', {float(w)!r}::DOUBLE)" for g, w in card.group_weights.items())
    return f"""WITH v AS (SELECT l_returnflag AS model, replace({_card_rows(card, 'l_partkey')}, '_', ' ') AS dimension, round(avg(l_quantity / 50), 4) AS value FROM lineitem GROUP BY ALL),
      s AS (SELECT model, d.dimension AS item, (value - lo) / (hi - lo) * weight AS score, weight FROM v JOIN (VALUES {dims}) AS d(dimension, lo, hi, weight) ON d.dimension = v.dimension),
      g AS (SELECT model, grp AS item, sum(score) / sum(weight) AS score FROM s JOIN (VALUES {groups}) AS g(grp, dimension) ON g.dimension = s.item GROUP BY ALL),
      w AS (SELECT model, 'total score' AS item, sum(score * weight) / sum(weight) AS score FROM g JOIN (VALUES {weights}) AS w(grp, weight) ON w.grp = g.item GROUP BY ALL)
      SELECT model, item, round(score, 6) AS score FROM (SELECT model, item, score FROM s UNION ALL SELECT * FROM g UNION ALL SELECT * FROM w)"""


def _card(t, card):
    rows = t.lineitem.selectExpr("l_returnflag AS model", f"{_card_rows(card, 'l_partkey')} AS dimension", "l_quantity / 50 AS v")
    scores = rows.groupBy("model", "dimension").agg(F.avg("v").alias("value"))
    return ev.weighted_scorecard(scores, card).withColumn("score", F.round("score", 6))


@query("E5_weighted_scorecard", _card_sql(ev.VIDEO_SCORECARD))
def e5(t):
    return _card(t, ev.VIDEO_SCORECARD)


@query("E6_weighted_scorecard_i2v", _card_sql(ev.IMAGE_TO_VIDEO_SCORECARD))
def e6(t):
    return _card(t, ev.IMAGE_TO_VIDEO_SCORECARD)


_LOG = """concat('step ', CAST(o_orderkey AS STRING), ' losses: {(''144p'', ', CAST(51 * (1 + o_custkey % 2) AS STRING), '): ', CAST(o_orderkey % 9973 AS STRING), '.25, (''480p'', 102): 0.', CAST(1000 + o_orderkey % 997 AS STRING), '}')"""


@query(
    "E7_loss_table",
    """WITH f AS (SELECT o_orderpriority AS file, max(o_orderkey) AS k FROM orders GROUP BY 1),
       l AS (SELECT file, k, o_custkey AS c FROM f JOIN orders ON o_orderkey = k),
       r AS (SELECT file, '144p' AS res, 51 * (1 + c % 2) AS frames, round(k % 9973 + 0.25::DOUBLE, 4) AS loss FROM l
             UNION ALL SELECT file, '480p', 102, round(CAST('0.' || CAST(1000 + k % 997 AS VARCHAR) AS DOUBLE), 4) FROM l)
       SELECT res, arg_max(loss, file) FILTER (WHERE frames = 51) AS "51", arg_max(loss, file) FILTER (WHERE frames = 102) AS "102" FROM r GROUP BY res""",
)
def e7(t):
    logs = t.orders.selectExpr("o_orderpriority AS file", "o_orderkey AS line", f"{_LOG} AS value")
    return ev.loss_table(logs, [51, 102])


@query(
    "E8_bucket_loss",
    """SELECT res, frames, round(avg(m), 6) AS loss FROM (SELECT l_returnflag AS res, CAST(l_linenumber AS INT) AS frames, l_quantity AS t, sum(l_extendedprice) / count(*) AS m FROM lineitem GROUP BY ALL) GROUP BY ALL""",
)
def e8(t):
    rows = t.lineitem.selectExpr("l_returnflag AS res", "l_linenumber AS frames", "l_quantity AS t", "l_extendedprice AS loss")
    return ev.bucket_loss(rows).withColumn("loss", F.round("loss", 6))


@query(
    "E9_result_integrity",
    """SELECT s_name AS name, CASE WHEN s_acctbal < 0 THEN 'no info' ELSE 'no videos' END AS problem FROM supplier WHERE s_acctbal < 5000""",
)
def e9(t):
    infos = t.supplier.filter("s_acctbal >= 0").select(
        F.col("s_name").alias("name"),
        F.when(F.col("s_acctbal") >= 5000, F.array("s_name")).otherwise(F.array().cast("array<string>")).alias("video_list"),
    )
    return ev.result_integrity(t.supplier.select(F.col("s_name").alias("name")), infos)
