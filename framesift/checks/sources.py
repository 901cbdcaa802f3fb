"""S: scans, sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from framesift.checks.registry import query
from framesift.operators import nested, ordering
from framesift.session import shared_folder
from framesift.sources import bins, documents, jsonl, listing, meta


def _fresh(t, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name.split('.')[0]}-{uuid.uuid4().hex}" + ("." + name.split(".")[1] if "." in name else "")


@query("S1_read_meta", "SELECT doc_id, text, lang, source, n_chars, row_number() OVER (ORDER BY doc_id) - 1 AS _row FROM documents")
def s1(t):
    return meta.read_meta(t.spark, f"{t.sf_dir}/documents.parquet", keep_order=True).drop("_src", "_file")


_CSV_COLUMNS = ["path", "text", "num_frames", "height", "fps", "aes", "cmotion", "timestamp", "pos"]
# An empty cell is a missing one.
_CSV_SQL = "SELECT path, nullif(text, '') AS text, CAST(num_frames AS INT) AS num_frames, CAST(height AS INT) AS height, fps, aes, cmotion, timestamp, pos FROM media"


@query("S1_read_meta_csv", _CSV_SQL)
def s1c(t):
    path = _fresh(t, "meta.csv")
    meta.write_meta(t.media.select(_CSV_COLUMNS), path)
    return meta.read_meta(t.spark, path)


@query("S1_read_meta_csv_split", _CSV_SQL)
def s1_split(t):
    """Cells with line breaks and quotes, read by byte ranges."""
    path = _fresh(t, "meta.csv")
    meta.write_meta(t.media.select(_CSV_COLUMNS), path)
    return meta.read_meta(t.spark, path, multi_line="split")


@query(
    "S1_read_meta_csv_inferred",
    """SELECT path, CASE WHEN pos % 3 > 0 THEN match * 100 END AS rank_score, CAST(pos % 50 AS BIGINT) AS votes, pos % 2 = 0 AS checked, CAST(pos AS VARCHAR) || 'x' AS code
       FROM media ORDER BY rank_score DESC NULLS LAST, pos LIMIT 300""",
)
def s1_inferred(t):
    """Columns that the meta table does not know, sorted by the number in one of them."""
    rows = t.media.selectExpr("path", "pos", "CASE WHEN pos % 3 > 0 THEN match * 100 END AS rank_score", "pos % 50 AS votes", "pos % 2 = 0 AS checked", "concat(CAST(pos AS STRING), 'x') AS code")
    path = _fresh(t, "scores.csv")
    meta.write_meta(rows, path)
    return ordering.topk(meta.read_meta(t.spark, path), "rank_score", 300).drop("pos")


@query(
    "S2_union_meta",
    """SELECT pos, path, aes, CAST(NULL AS INT) AS quality, CAST(0 AS INT) AS _src FROM media
       UNION ALL SELECT pos, path, CAST(NULL AS DOUBLE), quality, 1 FROM labelled""",
)
def s2(t):
    return meta.union_meta([t.media.select("pos", "path", "aes"), t.labelled.select("pos", "path", "quality")], tag_source=True)


@query("S3_write_meta", "SELECT pos, path, text, num_frames, aes FROM media")
def s3(t):
    path = _fresh(t, "meta.parquet")
    meta.write_meta(t.media.select("pos", "path", "text", "num_frames", "aes"), path)
    return meta.read_meta(t.spark, path)


@query("S4_stage_name", "SELECT DISTINCT lang || '+' || source || '_nourl_aesmin4.5_first_' || 100 || '_data.csv' AS name FROM documents")
def s4(t):
    """Output names for every pair of inputs that occurs in the table."""
    suffix = meta.stage_name(["x/a.csv"], {"remove_url": True, "aesmin": 4.5, "head": 100}).removeprefix("x/a")
    return t.documents.select(F.concat("lang", F.lit("+"), "source", F.lit(suffix)).alias("name")).distinct()


@query("S5_list_media")
def s5(t):
    files = listing.list_media(t.spark, t.sf_dir, ["parquet"])
    return files.select(F.substring_index("path", "/", -1).alias("name"), "length")


_STEM = "regexp_replace(split_part(path, '/', -1), '^(.+)\\.[^.]*$', '\\1')"


@query("S6_images_to_meta", f"SELECT {_STEM} AS id, path FROM media WHERE path LIKE '%.jpg'")
def s6(t):
    return listing.images_to_meta(t.media.select("path"))


@query("S7_videos_to_meta", f"SELECT DISTINCT path, {_STEM} AS id, substr(path, 8) AS relpath FROM media WHERE path LIKE '%.mp4'")
def s7(t):
    return listing.videos_to_meta(t.media.select("path"), "videos")


_FOLDER = "replace(initcap(replace(replace(cmotion, '/', '_'), '_', ' ')), ' ', '')"
_FOLDER_SQL = "list_aggregate([upper(w[1]) || w[2:] FOR w IN string_split(replace(cmotion, '/', '_'), '_')], 'string_agg', '')"


@query(
    "S8_classes_from_dirs",
    f"""SELECT 'train/' || {_FOLDER_SQL} || '/' || CAST(pos AS VARCHAR) || '.avi' AS path, array_to_string([upper(w[1]) || w[2:] FOR w IN string_split(replace(cmotion, '/', '_'), '_')], ' ') AS text FROM media""",
)
def s8(t):
    files = t.media.select(F.expr(f"concat('train/', {_FOLDER}, '/', CAST(pos AS STRING), '.avi')").alias("path"))
    return listing.classes_from_dirs(files)


@query("S9_label_by_class", "SELECT path, 'folder ' || CAST(n_nationkey AS VARCHAR) AS text FROM media JOIN nation ON split_part(path, '/', -2) = 'd' || CAST(n_nationkey AS VARCHAR)")
def s9(t):
    labels = t.nation.select(F.concat(F.lit("d"), "n_nationkey").alias("folder"), F.concat(F.lit("folder "), "n_nationkey").alias("text"))
    return listing.label_by_class(t.media.select("path"), labels)


@query("S10_existing_by_id", "SELECT 'gen/made-' || CAST(m.pos AS VARCHAR) || '.mp4' AS path, m.text FROM media m JOIN labels ON doc_id = m.pos AND quality = 1")
def s10(t):
    files = t.labels.filter("quality = 1").select(F.concat(F.lit("gen/made-"), "doc_id", F.lit(".mp4")).alias("path"))
    info = t.media.select(F.col("pos").cast("string").alias("uuid"), F.col("text").alias("prompt"))
    return listing.existing_by_id(info, files, "gen", "made-")


@query(
    "S11_attach_sidecar_json",
    """SELECT 'lab/' || CAST(doc_id AS VARCHAR) || '/rec/MP4/' || source || '.mp4' AS path,
         CASE WHEN quality = 1 THEN 'task ' || CAST(toxic AS VARCHAR) ELSE 'Unknown Task' END AS text
       FROM documents JOIN labels USING (doc_id)""",
)
def s11(t):
    files = t.documents.select(F.concat(F.lit("lab/"), "doc_id", F.lit("/rec/MP4/"), "source", F.lit(".mp4")).alias("path"))
    task = F.when(F.col("quality") == 1, F.concat(F.lit("task "), "toxic"))
    first = t.labels.select(F.concat(F.lit("lab/"), "doc_id", F.lit("/metadata_a.json")).alias("path"), task.alias("current_task"))
    second = t.labels.select(F.concat(F.lit("lab/"), "doc_id", F.lit("/metadata_b.json")).alias("path"), F.lit("later").alias("current_task"))
    return listing.attach_sidecar_json(files, first.union(second))


@query("S12_load_sidecar_caption", "SELECT pos, path, coalesce(CASE WHEN quality = 1 THEN 'caption of ' || cmotion END, '') AS text FROM media LEFT JOIN labels ON doc_id = pos")
def s12(t):
    own = F.concat(F.lit("x/"), F.col("pos").cast("string"))
    rows = t.media.select("pos", F.col("path").alias("real"), F.concat(own, F.lit(".v1.mp4")).alias("path"))
    caption = F.when(F.col("quality") == 1, F.concat(F.lit("caption of "), "cmotion"))
    sidecars = t.labelled.select(F.concat(own, F.lit(".json")).alias("path"), caption.alias("caption"))
    return documents.load_sidecar_caption(rows, sidecars).select("pos", F.col("real").alias("path"), "text")


@query(
    "S13_annotations_to_rows",
    """SELECT 'dataset/' || v AS path, CAST(CASE WHEN toxic = 1 THEN 2 ELSE 0 END AS INT) AS steps, CAST(0 AS INT) AS actions, CAST(1 AS INT) AS grips
       FROM (SELECT toxic, unnest([path, 'extra/' || path]) AS v FROM labelled)""",
)
def s13(t):
    text = F.to_json(
        F.struct(
            F.array(F.struct(F.col("path").alias("video_path")), F.struct(F.concat(F.lit("extra/"), "path").alias("video_path"))).alias("videos"),
            F.when(F.col("toxic") == 1, F.array(F.array(F.lit(1.0)), F.array(F.lit(2.0)))).alias("state"),
            F.array("match").alias("continuous_gripper_state"),
        )
    )
    docs = t.labelled.select(F.from_json(text, documents.ANNOTATION_SCHEMA).alias("d")).select("d.*")
    rows = documents.annotations_to_rows(docs, "dataset/")
    return rows.select("path", F.size("state").alias("steps"), F.size("action").alias("actions"), F.size("continuous_gripper_state").alias("grips"))


@query("S14_select_json_paths", "SELECT 'data/lab' || CAST(quality AS VARCHAR) || '/' || path AS path FROM labelled WHERE toxic = 0")
def s14(t):
    docs = t.labelled.select(
        F.when(F.col("toxic") == 0, F.replace("path", F.lit("/"), F.lit("\\"))).alias("right_mp4_path"),
        F.concat(F.lit("lab"), "quality").alias("lab"),
    )
    return documents.select_json_paths(docs, "data")


@query(
    "S15_write_jsonl_chunks",
    """WITH RECURSIVE lines AS (SELECT conv_id, turn, role, text, row_number() OVER (ORDER BY conv_id, turn) AS p,
          octet_length(encode(to_json({'conv_id': conv_id, 'turn': turn, 'role': role, 'text': text}))) + 1 AS size FROM conversations),
        filled(p, part, held, used) AS (SELECT p, CASE WHEN size > 20000 THEN 2 ELSE 1 END, 1, size FROM lines WHERE p = 1
          UNION ALL SELECT l.p, CASE WHEN held >= 40 OR used + size > 20000 THEN part + 1 ELSE part END,
            CASE WHEN held >= 40 OR used + size > 20000 THEN 1 ELSE held + 1 END, CASE WHEN held >= 40 OR used + size > 20000 THEN size ELSE used + size END
          FROM filled f JOIN lines l ON l.p = f.p + 1)
        SELECT conv_id, turn, role, text, CAST(part AS BIGINT) AS part FROM lines JOIN filled USING (p)""",
)
def s15(t):
    """Chunks written and read back: every line once, each in its part."""
    lines = t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("at"), F.to_json(F.struct("conv_id", "turn", "role", "text")).alias("value"))
    path = _fresh(t, "chunks")
    jsonl.write_jsonl_chunks(lines, path, "at", max_lines=40, max_bytes=20_000)
    back = t.spark.read.schema("conv_id bigint, turn bigint, role string, text string").option("basePath", path).json(f"{path}/part=*")
    return back.select("conv_id", "turn", "role", "text", F.col("part").cast("bigint").alias("part"))


@query(
    "S16_feature_bins",
    """WITH b AS (SELECT vec_id // 4 AS batch_no, vec_id FROM embeddings), n AS (SELECT max(batch_no) + 1 AS n FROM b)
       SELECT vec_id, batch_no, CAST(batch_no // 10 + 3 AS BIGINT) AS bin_id, CAST(batch_no % 10 AS INT) AS bin_pos, CAST(batch_no // 10 AS BIGINT) AS buffer
       FROM b, n WHERE batch_no < (n // 10) * 10""",
)
def s16(t):
    batches = t.embeddings.select("vec_id", F.floor(F.col("vec_id") / 4).alias("batch_no"))
    path = _fresh(t, "bins")
    bins.write_bins(bins.assign_bins(batches, 10, start_bin=3), path)
    out = bins.read_bins(t.spark, path)
    return out.withColumn("bin_id", F.col("bin_id").cast("bigint"))


@query("S17_write_requests", "SELECT path AS custom_id FROM media WHERE cmotion <> 'static'")
def s17(t):
    second = F.when(F.col("cmotion") == "static", F.lit("AA")).otherwise(F.lit("BB"))
    rows = t.media.withColumn("frames", F.array(F.lit("AA"), second))
    path = _fresh(t, "requests")
    jsonl.write_requests(nested.build_caption_request(rows, "{task_description}", "vlm"), path)
    return t.spark.read.schema("custom_id string").json(path)


@query("S18_write_once", "SELECT pos, path FROM media")
def s18(t):
    path = _fresh(t, "stage.parquet")
    meta.write_once(t.media.select("pos", "path"), path)
    meta.write_once(t.media.select("pos", F.lit("again").alias("path")), path)
    return meta.read_meta(t.spark, path)
