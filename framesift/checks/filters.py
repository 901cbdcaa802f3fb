"""F: filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from framesift.checks.registry import query
from framesift.operators import clips, filters, language, media
from framesift.plans.curation import curate

SHOW = ["pos", "path", "num_frames"]
SHOW_SQL = "pos, path, num_frames"


def _with_url(t):
    """Captions of which some mention a page: the text of media rows next to crawled addresses."""
    pages = t.pages.withColumnRenamed("page_id", "pos").select("pos", "url")
    joined = t.media.join(pages, "pos", "left")
    return joined.withColumn("text", F.concat_ws(" ", F.col("text"), F.col("url")))


@query(
    "F1_remove_url",
    """SELECT m.pos, m.path, m.num_frames FROM media m LEFT JOIN pages p ON m.pos = p.page_id
       WHERE NOT regexp_matches(concat_ws(' ', m.text, p.url), 'https?://\\S+')""",
)
def f1(t):
    return filters.remove_url(_with_url(t)).select(SHOW)


_TRIGRAMS = """WITH words AS (
    SELECT doc_id, lang, unnest(string_split_regex(lower(regexp_replace(text, '[^\\p{L}]+', ' ', 'g')), ' ')) AS w
    FROM documents),
  grams AS (
    SELECT doc_id, lang, substr('_' || w || '_', i, 3) AS gram
    FROM words, unnest(range(1, length(w) + 1)) AS r(i) WHERE w <> ''),
  counts AS (SELECT lang, gram, count(*) AS n FROM grams GROUP BY ALL),
  profile AS (SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS r FROM counts
              QUALIFY r <= 300),
  doc_counts AS (SELECT doc_id, gram, count(*) AS n FROM grams GROUP BY ALL),
  hits AS (SELECT d.doc_id, p.lang, sum(d.n * (301 - p.r)) AS score
           FROM doc_counts d JOIN profile p USING (gram) GROUP BY ALL),
  ranked AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) AS r FROM hits)
"""


@query(
    "F2_language_profiles",
    _TRIGRAMS + "SELECT lang, gram, CAST(r AS INT) AS place FROM profile",
)
def f2_profiles(t):
    return language.trigram_profiles(t.documents, "text", "lang")


@query(
    "F2_lang_filter",
    _TRIGRAMS + "SELECT doc_id, lang FROM documents SEMI JOIN (SELECT doc_id FROM ranked WHERE lang = 'en' AND r <= 1) USING (doc_id)",
)
def f2_filter(t):
    docs = t.documents
    profiles = language.trigram_profiles(docs, "text", "lang")
    kept = language.lang_filter(docs, profiles, target="en", k=1, key="doc_id")
    return kept.select("doc_id", "lang")


@query(
    "F2_lang_filter_two_best",
    _TRIGRAMS + "SELECT doc_id, lang FROM documents SEMI JOIN (SELECT doc_id FROM ranked WHERE lang = 'en' AND r <= 2) USING (doc_id)",
)
def f2_two(t):
    """The language stage of the curation job, with its own k."""
    profiles = language.trigram_profiles(t.documents, "text", "lang")
    return curate(t.documents, key="doc_id", lang=("en", profiles, 2)).select("doc_id", "lang")


@query("F3_remove_empty_path", f"SELECT {SHOW_SQL} FROM media WHERE length(path) > 0")
def f3(t):
    return filters.remove_empty_path(t.media).select(SHOW)


@query("F4_remove_empty_caption", f"SELECT {SHOW_SQL} FROM media WHERE length(text) > 0")
def f4(t):
    return filters.remove_empty_caption(t.media).select(SHOW)


@query("F5_path_subset", f"SELECT {SHOW_SQL} FROM media WHERE regexp_matches(path, 'd[35]/doc_\\d*7\\.')")
def f5(t):
    return filters.path_subset(t.media, r"d[35]/doc_\d*7\.").select(SHOW)


@query("F6_exists", f"SELECT {SHOW_SQL} FROM media WHERE path IN (SELECT path FROM labelled)")
def f6(t):
    return filters.exists(t.media, t.labelled).select(SHOW)


@query("F7_frames_range", f"SELECT {SHOW_SQL} FROM media WHERE num_frames >= 17 AND num_frames <= 400")
def f7(t):
    return filters.frames_max(filters.frames_min(t.media, 17), 400).select(SHOW)


@query(
    "F8_min_frame_after_head",
    "SELECT path, num_frames FROM (SELECT * FROM media ORDER BY pos LIMIT 500) WHERE num_frames >= 102",
)
def f8(t):
    from framesift.operators.ordering import head

    return filters.frames_min(head(t.media, 500).select("path", "num_frames"), 102)


@query("F9_fps_max", "SELECT pos, path, fps FROM media WHERE fps <= 30 OR fps IS NULL OR isnan(fps)")
def f9(t):
    return filters.fps_max(t.media, 30).select("pos", "path", "fps")


@query(
    "F10_pixels_max",
    "SELECT pos, path, CAST(height AS BIGINT) * width AS resolution FROM media WHERE CAST(height AS BIGINT) * width <= 409920",
)
def f10(t):
    return filters.pixels_max(t.media, 409920).select("pos", "path", "resolution")


@query(
    "F11_filesize_max",
    """SELECT pos, path, p.bytes / 1024.0 / 1024.0 AS filesize FROM media
       JOIN (SELECT doc_id, CAST(n_chars AS DOUBLE) AS bytes FROM documents) p ON pos = p.doc_id
       WHERE p.bytes / 1024.0 / 1024.0 <= 0.002""",
)
def f11(t):
    sized = t.media.join(t.documents.select(F.col("doc_id").alias("pos"), F.col("n_chars").alias("length")), "pos")
    return filters.filesize_max(media.filesize_mb(sized), 0.002).select("pos", "path", "filesize")


@query("F12_score_min", "SELECT pos, aes, flow, match FROM media WHERE aes >= 4.5 AND flow >= 2 AND match >= 10")
def f12(t):
    out = t.media
    for column, minimum in (("aes", 4.5), ("match", 10), ("flow", 2)):
        out = filters.score_min(out, column, minimum)
    return out.select("pos", "aes", "flow", "match")


@query("F13_images_only", f"SELECT {SHOW_SQL} FROM media WHERE regexp_matches(lower(path), '\\.(jpg|jpeg|png|ppm|bmp|pgm|tif|tiff|webp)$')")
def f13i(t):
    return filters.images_only(t.media).select(SHOW)


@query("F13_videos_only", f"SELECT {SHOW_SQL} FROM media WHERE NOT regexp_matches(lower(path), '\\.(jpg|jpeg|png|ppm|bmp|pgm|tif|tiff|webp)$')")
def f13v(t):
    return filters.videos_only(t.media).select(SHOW)


@query("F14_drop_invalid_timestamps", "SELECT pos, path, timestamp FROM media WHERE timestamp LIKE '[%]'")
def f14(t):
    return clips.drop_invalid_timestamps(t.media).select("pos", "path", "timestamp")


@query(
    "F15_drop_failed_captions",
    "SELECT pos, path, text FROM media WHERE coalesce(text, 'none') <> ''",
)
def f15(t):
    return filters.drop_failed_captions(t.media, sentinel="").select("pos", "path", "text")


@query(
    "F16_text_density",
    """SELECT user_id AS path, CAST(count(*) FILTER (WHERE (event_id * 13) % 101 / 100.0 > 0.3) AS INT) AS ocr
       FROM events GROUP BY user_id HAVING count(*) FILTER (WHERE (event_id * 13) % 101 / 100.0 > 0.3) <= 70""",
)
def f16(t):
    boxes = t.flow_frames.select(F.col("video_id").alias("path"), F.col("zoom").alias("score"))
    return filters.ocr_max(filters.text_density(boxes), 70)
