"""U: the curation job and the hooks for user code."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framesift.checks.registry import query
from framesift.checks.sqltext import draw
from framesift.plans import curation, files, hooks
from framesift.session import shared_folder
from framesift.sources import meta


@query(
    "U2_curate",
    """WITH kept AS (SELECT * FROM media WHERE length(text) > 0 AND num_frames >= 17 AND aes >= 4.5
         QUALIFY row_number() OVER (PARTITION BY text ORDER BY aes DESC NULLS LAST, pos) = 1)
       SELECT path, text, num_frames, height, width, fps FROM kept ORDER BY aes DESC NULLS LAST, pos LIMIT 500""",
)
def u2(t):
    return curation.curate(
        t.media, remove_empty_caption=True, sort="aes", fmin=17, aesmin=4.5, remove_text_duplication=True, head=500, train_column=True
    )


@query(
    "U2_curate_all_stages",
    f"""WITH a AS (SELECT * FROM media m WHERE path NOT IN (SELECT path FROM labelled WHERE toxic = 1)
           AND NOT coalesce(regexp_matches(text, 'https?://\\S+'), false) AND length(path) > 0 AND length(text) > 0
         QUALIFY row_number() OVER (PARTITION BY path ORDER BY pos) = 1),
       b AS (SELECT * REPLACE ('/data/' || path AS path, text || ' Camera motion: ' || replace(cmotion, '_', ' ') || '.' AS text) FROM a WHERE cmotion NOT IN ('unknown', 'pan/tilt')
             UNION ALL SELECT * REPLACE ('/data/' || path AS path) FROM a WHERE cmotion IN ('unknown', 'pan/tilt')),
       c AS (SELECT *, regexp_replace(split_part(path, '/', -1), '^(.+)\\.[^.]*$', '\\1') AS id, text || ' Sharp.' AS text2 FROM b),
       d AS (SELECT * FROM c WHERE num_frames >= 2 AND num_frames <= 450 AND (fps <= 30 OR fps IS NULL) AND CAST(height AS BIGINT) * width <= 2073600
               AND aes >= 1 AND match >= 2 AND flow >= 1 AND path LIKE '%.mp4')
       SELECT id, path, text2 AS text, num_frames, fps FROM (SELECT * FROM d ORDER BY {draw(7, 'pos')}, pos LIMIT 200) WHERE num_frames >= 51""",
)
def u2_all(t):
    out = curation.curate(
        t.media,
        seed=7,
        min_frame=51,
        head=200,
        shuffle=True,
        vid_only=True,
        flowmin=1,
        matchmin=2,
        aesmin=1,
        hwmax=2073600,
        fpsmax=30,
        fmax=450,
        fmin=2,
        append_text=" Sharp.",
        merge_cmotion="keep",
        path_to_id=True,
        abspath="/data",
        remove_path_duplication=True,
        remove_empty_caption=True,
        remove_empty_path=True,
        remove_url=True,
        difference=t.labelled.filter("toxic = 1"),
    )
    return out.select("id", "path", "text", "num_frames", "fps")


@query(
    "U2_curate_sharded",
    """WITH p AS (SELECT pos, path, row_number() OVER (ORDER BY coalesce(-aes, 'inf'::DOUBLE), pos) - 1 AS i, count(*) OVER () AS n FROM media WHERE num_frames >= 1)
       SELECT pos, CAST(CASE WHEN i < (n % 6) * (n // 6 + 1) THEN i // (n // 6 + 1) ELSE n % 6 + (i - (n % 6) * (n // 6 + 1)) // (n // 6) END AS INT) AS shard FROM p""",
)
def u2_shard(t):
    return curation.curate(t.media, sort="aes", fmin=1, shard=6).select("pos", "shard")


@query("U1_apply_column", "SELECT pos, CASE WHEN text IS NULL THEN -1 ELSE length(text) END AS size FROM media")
def u1(t):
    return hooks.apply_column(t.media, lambda s: len(s), "text", "size", "long", default=-1, errors=TypeError).select("pos", "size")


@query("U1_apply_rows", "SELECT pos, CASE WHEN width = 0 THEN 0 ELSE height // width END AS ratio, CASE WHEN width = 0 THEN 'bad' ELSE 'good' END AS state FROM media")
def u1r(t):
    out = hooks.apply_rows(
        t.media,
        lambda r: {"ratio": r["height"] // (r["width"] or 1 // 0), "state": "good"},
        ["height", "width"],
        {"ratio": "int", "state": "string"},
        {"ratio": 0, "state": "bad"},
    )
    return out.select("pos", "ratio", "state")


@query("U1_map_batches", "SELECT pos, num_frames * 2 AS doubled FROM media")
def u1m(t):
    def double(batches):
        for batch in batches:
            yield batch.assign(doubled=batch["num_frames"] * 2)[["pos", "doubled"]]

    return hooks.map_batches(t.media.select("pos", "num_frames"), double, "pos bigint, doubled int")


def _brightness():
    def predict(height, width):
        return (height * 2.0 + width).astype("float64")

    return predict


@query("U3_score_with_model", "SELECT pos, path, CAST(height AS DOUBLE) * 2 + width AS score FROM media")
def u3(t):
    from pyspark.sql.types import DoubleType

    return hooks.score_with_model(t.media, _brightness, ["height", "width"], "score", DoubleType(), batch_size=256).select("pos", "path", "score")


@query(
    "U2_files_to_shards",
    """WITH r AS (SELECT path, aes, num_frames, row_number() OVER (ORDER BY pos % 2, pos) AS row FROM media WHERE length(text) > 0 AND num_frames >= 17 AND aes >= 2),
       p AS (SELECT *, row_number() OVER (ORDER BY aes DESC NULLS LAST, row) - 1 AS i, count(*) OVER () AS n FROM r)
       SELECT path, aes, CAST(num_frames AS INT) AS num_frames, CAST(CASE WHEN i < (n % 5) * (n // 5 + 1) THEN i // (n // 5 + 1) ELSE n % 5 + (i - (n % 5) * (n // 5 + 1)) // (n // 5) END AS INT) AS shard FROM p""",
)
def u2_files(t):
    """Two inputs, read back from five named outputs; the second run finds everything done."""
    folder = f"{shared_folder(t.spark)}/{uuid.uuid4().hex}"
    inputs = [f"{folder}/even.parquet", f"{folder}/odd.parquet"]
    for rest, path in enumerate(inputs):
        meta.write_meta(t.media.filter(F.col("pos") % 2 == rest).orderBy("pos").drop("pos"), path)
    output = f"{folder}/best.parquet"
    for _ in range(2):
        shards = files.curate_files(t.spark, inputs, output, shards=5, remove_empty_caption=True, fmin=17, aesmin=2.0, sort="aes")
    parts = [meta.read_meta(t.spark, r["path"]).select("path", "aes", "num_frames", F.lit(r["shard"]).alias("shard")) for r in shards.collect()]
    return reduce(DataFrame.unionByName, parts)
