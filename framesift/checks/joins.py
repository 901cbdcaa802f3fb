"""J: joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from framesift.checks.registry import query
from framesift.functions.captions import light_clean
from framesift.operators import joins
from framesift.operators.ordering import dedup_path
from framesift.sources.meta import union_meta

_LIGHT = "lower(regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', ''))"


@query("J1_difference", "SELECT pos, path FROM media m WHERE NOT EXISTS (SELECT 1 FROM labelled l WHERE l.path IS NOT DISTINCT FROM m.path)")
def j1(t):
    return joins.difference(t.media, t.labelled).select("pos", "path")


@query("J2_intersection", "SELECT m.pos, m.path, m.text, l.quality, l.toxic FROM media m JOIN labelled l ON m.path IS NOT DISTINCT FROM l.path")
def j2(t):
    return joins.intersection(t.media, t.labelled).select("pos", "path", "text", "quality", "toxic")


_NEW_TEXT = """SELECT DISTINCT ON (path) path, CASE WHEN toxic = 0 THEN concat('label ', CAST(quality AS VARCHAR), ': ', cmotion) END AS text
    FROM labelled ORDER BY path, pos"""


@query(
    "J3_update_text",
    f"SELECT m.path, m.pos, coalesce(n.text, m.text) AS text FROM media m LEFT JOIN ({_NEW_TEXT}) n ON m.path = n.path",
)
def j3(t):
    text = F.when(F.col("toxic") == 0, F.concat(F.lit("label "), F.col("quality"), F.lit(": "), F.col("cmotion")))
    new = dedup_path(t.labelled).select("path", text.alias("text"))
    return joins.update_text(t.media.select("pos", "path", "text"), new)


@query(
    "J4_column_union",
    """SELECT coalesce(a.path, b.path) AS path, a.pos AS pos_x, b.pos AS pos_y, a.aes, b.quality
       FROM (SELECT path, pos, aes FROM media WHERE num_frames > 1) a
       FULL JOIN (SELECT path, pos, quality FROM labelled) b ON a.path IS NOT DISTINCT FROM b.path""",
)
def j4(t):
    left = t.media.filter("num_frames > 1").select("path", "pos", "aes")
    return joins.column_union(left, t.labelled.select("path", "pos", "quality"))


@query("J5_filter_by_paths", "SELECT pos, path FROM media WHERE path IN (SELECT path FROM labelled)")
def j5(t):
    return joins.filter_by_paths(t.media, t.labelled).select("pos", "path")


@query(
    "J5_match_report",
    """WITH wanted AS (SELECT DISTINCT path FROM labelled UNION SELECT 'lost/' || path FROM labelled WHERE toxic = 1)
       SELECT (SELECT count(*) FROM wanted) AS wanted_keys, count(*) AS total_rows,
         count(*) FILTER (WHERE path IN (SELECT path FROM wanted)) AS matched_rows,
         (SELECT count(*) FROM wanted WHERE path NOT IN (SELECT path FROM media)) AS unmatched_keys FROM media""",
)
def j5r(t):
    return joins.match_report(t.media, _wanted(t))


def _wanted(t):
    lost = t.labelled.filter("toxic = 1").select(F.concat(F.lit("lost/"), "path").alias("path"))
    return t.labelled.select("path").union(lost)


@query(
    "J5_unmatched_samples",
    "SELECT DISTINCT 'lost/' || path AS path FROM labelled WHERE toxic = 1 ORDER BY path LIMIT 5",
)
def j5s(t):
    return joins.unmatched_samples(t.media, _wanted(t))


_CAPTION_SETS = "SELECT [text, upper(text)] AS captions FROM documents WHERE source = 'src1'"


@query(
    "J6_semi_by_caption_set",
    f"""WITH refs AS (SELECT unnest(captions) AS text FROM ({_CAPTION_SETS}))
        SELECT pos, path FROM media WHERE {_LIGHT} IN (SELECT {_LIGHT} FROM refs WHERE text IS NOT NULL)""",
)
def j6(t):
    reference = t.documents.filter("source = 'src1'").select(F.array("text", F.upper("text")).alias("captions"))
    clean = lambda df: df.withColumn("text", light_clean(F.col("text")))
    meta = clean(t.media)
    return joins.semi_by_caption_set(meta, reference, F.col("captions"), clean).select("pos", "path")


@query(
    "J7_semi_by_clip",
    """WITH catalogue AS (SELECT regexp_extract(split_part(path, '/', -1), '^(.*)_[^_]*$', 1) AS video_id, arg_max([timestamp, 'x'], pos) AS list
         FROM (SELECT pos, replace(path, 'doc_', concat(cmotion, '_')) AS path, timestamp FROM labelled) GROUP BY 1),
       wanted AS (SELECT video_id, unnest(list) AS timestamp FROM catalogue)
       SELECT pos, path, timestamp FROM (SELECT pos, replace(path, 'doc_', concat(cmotion, '_')) AS path, timestamp FROM media) m
       WHERE EXISTS (SELECT 1 FROM wanted w WHERE w.video_id = regexp_extract(split_part(m.path, '/', -1), '^(.*)_[^_]*$', 1)
         AND w.timestamp = m.timestamp)""",
)
def j7(t):
    renamed = F.replace("path", F.lit("doc_"), F.concat("cmotion", F.lit("_"))).alias("path")
    clips = t.media.select("pos", renamed, "timestamp")
    listed = t.labelled.select("pos", renamed, "timestamp")
    catalogue = listed.select(
        joins.video_id(F.col("path")).alias("video_id"), F.array("timestamp", F.lit("x")).alias("timestamps"), "pos"
    )
    return joins.semi_by_clip(clips, catalogue).select("pos", "path", "timestamp")


@query("J8_resume_remaining", "SELECT pos, path FROM media WHERE path NOT IN (SELECT path FROM labelled WHERE quality = 1) AND path NOT IN (SELECT path FROM labelled WHERE toxic = 1)")
def j8(t):
    parts = [t.labelled.filter("quality = 1"), t.labelled.filter("toxic = 1")]
    return joins.resume_remaining(t.media, parts).select("pos", "path")


_PARTS = """SELECT doc_id AS pos, doc_id AS at, 0 AS rank, CAST(quality AS DOUBLE) AS score FROM labels
    UNION ALL SELECT doc_id, doc_id, 1, CAST(toxic AS DOUBLE) + 10 FROM labels"""


def _parts(t):
    first = t.labels.select(F.col("doc_id").alias("pos"), F.col("doc_id").alias("at"), F.lit(0).alias("rank"), F.col("quality").cast("double").alias("score"))
    second = t.labels.select(F.col("doc_id").alias("pos"), F.col("doc_id").alias("at"), F.lit(1).alias("rank"), (F.col("toxic") + 10).cast("double").alias("score"))
    return first.unionByName(second)


@query("J9_attach_scores_keep", f"SELECT m.pos, m.path, s.score FROM media m LEFT JOIN (SELECT pos, arg_min(score, rank) AS score FROM ({_PARTS}) GROUP BY pos) s USING (pos)")
def j9k(t):
    return joins.attach_scores(t.media, _parts(t), "score", ["at", "rank"]).select("pos", "path", "score")


@query("J9_attach_scores_drop", f"SELECT m.pos, m.path, s.score FROM media m JOIN (SELECT pos, arg_min(score, rank) AS score FROM ({_PARTS}) GROUP BY pos) s USING (pos)")
def j9d(t):
    return joins.attach_scores(t.media, _parts(t), "score", ["at", "rank"], keep_unscored=False).select("pos", "path", "score")


@query(
    "J10_collate_parts",
    """SELECT pos, CAST(0 AS INT) AS rank, coalesce(cmotion, 'NONE_FOUND') AS tag FROM media WHERE num_frames <= 1
       UNION ALL SELECT pos, 1, 'NONE_FOUND' FROM media WHERE num_frames > 1""",
)
def j10(t):
    a = t.media.filter("num_frames <= 1").select("pos", F.col("cmotion").alias("tag"))
    b = t.media.filter("num_frames > 1").select("pos", F.lit(None).cast("string").alias("tag"))
    return joins.collate_parts([a, b], "tag")


@query(
    "J11_set_operations",
    """SELECT 'union' AS op, count(*) AS n FROM (SELECT path FROM media UNION ALL SELECT path FROM labelled)
       UNION ALL SELECT 'except', count(*) FROM media WHERE path NOT IN (SELECT path FROM labelled)
       UNION ALL SELECT 'intersect', count(*) FROM media WHERE path IN (SELECT path FROM labelled)
       UNION ALL SELECT 'distinct', count(DISTINCT path) FROM media""",
)
def j11(t):
    sets = {
        "union": union_meta([t.media.select("path"), t.labelled.select("path")]),
        "except": joins.difference(t.media, t.labelled),
        "intersect": joins.filter_by_paths(t.media, t.labelled),
        "distinct": dedup_path(t.media),
    }
    counts = [df.agg(F.lit(name).alias("op"), F.count(F.lit(1)).alias("n")) for name, df in sets.items()]
    return union_meta(counts)
