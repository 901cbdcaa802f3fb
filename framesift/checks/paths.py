"""P: path and media projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from framesift.checks.registry import query
from framesift.functions import paths
from framesift.operators import media
from framesift.sources import listing

_STEM = "regexp_replace(split_part(path, '/', -1), '^(.+)\\.[^.]*$', '\\1')"


@query("P1_relpath", "SELECT pos, CASE WHEN path LIKE 'videos/d3/%' THEN substr(path, 11) ELSE '../' || substr(path, 8) END AS path FROM media")
def p1(t):
    return t.media.select("pos", paths.relpath(F.col("path"), "videos/d3").alias("path"))


@query("P2_abspath", "SELECT pos, '/data/raw/' || path AS path FROM media")
def p2(t):
    return t.media.select("pos", paths.abspath(F.col("path"), "/data/raw").alias("path"))


@query("P3_path_to_id", f"SELECT pos, {_STEM} AS id FROM media")
def p3(t):
    return t.media.select("pos", paths.stem(F.col("path")).alias("id"))


@query("P4_replace_prefix", "SELECT pos, replace(path, 'videos/', 'clips/') AS path FROM media")
def p4(t):
    return t.media.select("pos", paths.replace_text(F.col("path"), "videos/", "clips/").alias("path"))


@query(
    "P5_id_to_path",
    f"""SELECT pos, 'data/' || {_STEM} || '.mp4' AS path, coalesce(l.quality = 1, false) AS intact
        FROM media LEFT JOIN labels l ON pos = doc_id""",
)
def p5(t):
    ids = t.media.select("pos", paths.stem(F.col("path")).alias("id"))
    # A sidecar per labelled row; a clip is good if its own sidecar reports success.
    own = ids.withColumn("id", F.concat_ws("#", "id", "pos"))
    labels = t.labels.withColumnRenamed("doc_id", "pos").join(own, "pos")
    sidecars = labels.select(
        F.concat(F.lit("data/"), "id", F.lit(".json")).alias("path"), (F.col("quality") == 1).alias("success")
    )
    out = listing.id_to_path(own, "data", ".json", sidecars)
    return out.select("pos", F.regexp_replace("path", r"#\d+", "").alias("path"), "intact")


@query(
    "P5_intact_only",
    f"SELECT DISTINCT 'data/' || {_STEM} || '.mp4' AS path FROM media WHERE {_STEM} IN (SELECT {_STEM} FROM labelled)",
)
def p5b(t):
    ids = t.media.select(paths.stem(F.col("path")).alias("id"))
    present = t.labelled.select(F.concat(F.lit("data/"), paths.stem(F.col("path")), F.lit(".mp4")).alias("path"))
    return listing.intact_only(listing.id_to_path(ids, "data", ".mp4", present)).select("path").distinct()


@query("P6_media_type", "SELECT pos, CASE WHEN path LIKE '%.mp4' THEN 'video' ELSE 'image' END AS kind FROM media")
def p6(t):
    return t.media.select("pos", paths.media_type(F.col("path")).alias("kind"))


@query(
    "P7_derive_dims",
    """SELECT pos, CAST(height AS BIGINT) * width AS resolution,
       CASE WHEN width > 0 THEN CAST(height AS DOUBLE) / width END AS aspect_ratio FROM media""",
)
def p7(t):
    return media.derive_dims(t.media).select("pos", "resolution", "aspect_ratio")


@query("P8_filesize_mb", "SELECT pos, path, CAST(n_chars AS DOUBLE) / 1024 / 1024 AS filesize FROM media JOIN documents ON pos = doc_id")
def p8(t):
    sized = t.media.join(t.documents.select(F.col("doc_id").alias("pos"), F.col("n_chars").alias("length")), "pos")
    return media.filesize_mb(sized).select("pos", "path", "filesize")


@query("P9_train_columns", "SELECT path, text, num_frames, height, width, fps FROM media")
def p9(t):
    return media.train_columns(t.media)


@query(
    "P10_is_url",
    """SELECT page_id, regexp_matches(url, '(?i)^(?:http|ftp)s?://(?:(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\\.)+(?:[A-Z]{2,6}\\.?|[A-Z0-9-]{2,}\\.?)|localhost|\\d{1,3}\\.\\d{1,3}\\.\\d{1,3}\\.\\d{1,3})(?::\\d+)?(?:/?|[/?]\\S+)$') AS is_url
       FROM pages""",
)
def p10(t):
    return t.pages.select("page_id", paths.is_url(F.col("url")).alias("is_url"))


@query(
    "P11_conditioning_info",
    """SELECT pos, CASE WHEN width > 0 THEN CAST(height AS DOUBLE) / width END AS ar,
       CAST(CASE WHEN num_frames = 1 THEN 120 ELSE floor(coalesce(fps, 24) / 4) END AS INT) AS cond_fps FROM media""",
)
def p11(t):
    return media.conditioning_info(t.media, frame_interval=4).select("pos", "ar", "cond_fps")


@query(
    "P12_sample_path",
    """SELECT pos, 'out/sample_' || lpad(CAST(pos AS VARCHAR), CAST(greatest(4, length(CAST(pos AS VARCHAR))) AS INT), '0') || '-' || CAST(pos % 3 AS VARCHAR) AS sample_path,
       'out/' || path AS named_path FROM media""",
)
def p12(t):
    return t.media.select(
        "pos",
        paths.sample_path("out", F.col("pos"), copy=F.col("pos") % 3).alias("sample_path"),
        paths.prompt_sample_path("out", F.col("path")).alias("named_path"),
    )


@query(
    "P13_attach_media_info",
    """WITH probe AS (SELECT DISTINCT ON (path) path, num_frames, height, width, fps FROM labelled ORDER BY path, pos)
       SELECT m.pos, coalesce(p.num_frames, 0) AS num_frames, coalesce(p.height, 0) AS height, coalesce(p.width, 0) AS width,
         CASE WHEN p.width > 0 THEN CAST(p.height AS DOUBLE) / p.width END AS aspect_ratio, p.fps,
         CAST(p.height AS BIGINT) * p.width AS resolution
       FROM media m LEFT JOIN probe p USING (path)""",
)
def p13(t):
    from framesift.operators.ordering import dedup_path

    probe = dedup_path(t.labelled).select("path", "num_frames", "height", "width", "fps")
    out = media.attach_media_info(t.media.select("pos", "path"), probe)
    return out.drop("path")
