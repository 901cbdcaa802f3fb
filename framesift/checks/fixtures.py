"""Views over the test tables that look like media metadata.

Every view is a list of SQL expressions understood by Spark and by the oracle engine alike, so both
sides start from the same rows.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

_PATH_ID = "(CASE WHEN doc_id % 23 = 22 THEN doc_id - 1 ELSE doc_id END)"

MEDIA = {
    "pos": "doc_id",
    "path": f"concat('videos/d', CAST({_PATH_ID} % 7 AS STRING), '/doc_', CAST({_PATH_ID} AS STRING), "
    f"CASE WHEN {_PATH_ID} % 5 = 0 THEN '.jpg' ELSE '.mp4' END)",
    "text": "CASE WHEN doc_id % 29 = 0 THEN '' WHEN doc_id % 31 = 0 THEN NULL ELSE text END",
    "num_frames": f"CASE WHEN doc_id % 19 = 0 THEN 0 WHEN {_PATH_ID} % 5 = 0 THEN 1 "
    "ELSE CAST(n_chars % 500 AS INT) + 2 END",
    "height": "CASE CAST(doc_id % 8 AS INT) WHEN 0 THEN 144 WHEN 1 THEN 240 WHEN 2 THEN 360 WHEN 3 THEN 480 "
    "WHEN 4 THEN 720 WHEN 5 THEN 1080 WHEN 6 THEN 1280 ELSE 0 END",
    "width": "CASE CAST(doc_id % 8 AS INT) WHEN 0 THEN 256 WHEN 1 THEN 426 WHEN 2 THEN 640 WHEN 3 THEN 854 "
    "WHEN 4 THEN 1280 WHEN 5 THEN 1920 WHEN 6 THEN 720 ELSE 0 END",
    "fps": f"CAST(CASE WHEN {_PATH_ID} % 5 = 0 THEN NULL WHEN doc_id % 3 = 0 THEN 24 WHEN doc_id % 3 = 1 THEN 30 "
    "ELSE 60 END AS DOUBLE)",
    "aes": "CAST(CASE WHEN doc_id % 17 = 0 THEN NULL ELSE (doc_id * 37) % 101 END AS DOUBLE) / 10",
    "flow": "CAST(CASE WHEN doc_id % 13 = 0 THEN NULL ELSE (doc_id * 53) % 307 END AS DOUBLE) / 10",
    "match": "CAST((doc_id * 29) % 401 AS DOUBLE) / 10",
    "cmotion": "CASE CAST(doc_id % 9 AS INT) WHEN 0 THEN 'static' WHEN 1 THEN 'pan_right' WHEN 2 THEN 'pan_left' "
    "WHEN 3 THEN 'zoom_in' WHEN 4 THEN 'zoom_out' WHEN 5 THEN 'tilt_up' WHEN 6 THEN 'tilt_down' "
    "WHEN 7 THEN 'unknown' ELSE 'pan/tilt' END",
    "timestamp": "CASE WHEN doc_id % 11 = 0 THEN 'broken' ELSE concat('[(''00:00:00.000'', ''00:00:0', "
    "CAST(doc_id % 9 AS STRING), '.500''), (''00:00:10.000'', ''00:00:', CAST(12 + doc_id % 30 AS STRING), "
    "'.250'')]') END",
}

MEDIA_BIG = {
    "pos": "l_orderkey * 8 + l_linenumber",
    "path": "concat('clips/', CAST(l_suppkey AS STRING), '/', CAST(l_orderkey AS STRING), '_', "
    "CAST(l_linenumber AS STRING), '.mp4')",
    "text": "concat(l_returnflag, l_linestatus, ' part ', CAST(l_partkey AS STRING))",
    "num_frames": "CAST(l_quantity AS INT) * 12",
    "height": "CASE CAST(l_partkey % 6 AS INT) WHEN 0 THEN 144 WHEN 1 THEN 240 WHEN 2 THEN 360 WHEN 3 THEN 480 "
    "WHEN 4 THEN 720 ELSE 1080 END",
    "width": "CASE CAST(l_partkey % 6 AS INT) WHEN 0 THEN 256 WHEN 1 THEN 426 WHEN 2 THEN 640 WHEN 3 THEN 854 "
    "WHEN 4 THEN 1280 ELSE 1920 END",
    "fps": "CAST(24 AS DOUBLE)",
    "aes": "CAST((l_partkey * 37) % 101 AS DOUBLE) / 10",
}

FLOW_FRAMES = {
    "video_id": "user_id",
    "frame_idx": "event_id",
    "mag": "value",
    "ang": "CAST((event_id * 7) % 360 AS DOUBLE)",
    "zoom": "CAST((event_id * 13) % 101 AS DOUBLE) / 100",
}

VIEWS = {
    "media": (MEDIA, "documents"),
    "media_big": (MEDIA_BIG, "lineitem"),
    "flow_frames": (FLOW_FRAMES, "events"),
}

# The other side of joins: media rows that carry labels, with two columns media lacks.
LABELLED = "SELECT m.*, l.quality, l.toxic FROM media m JOIN labels l ON m.pos = l.doc_id"


def view_sql(name: str) -> str:
    columns, table = VIEWS[name]
    return f"SELECT {', '.join(f'{expr} AS {alias}' for alias, expr in columns.items())} FROM {table}"


def with_views(sql: str) -> str:
    """Prefix the views a statement mentions as common table expressions."""
    sql = sql.strip()
    wanted = [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]
    ctes = []
    if re.search(r"\blabelled\b", sql):
        ctes.append(f"labelled AS ({LABELLED})")
        if "media" not in wanted:
            wanted.insert(0, "media")
    ctes = [f"{v} AS ({view_sql(v)})" for v in wanted] + ctes
    if not ctes:
        return sql
    head, body = "WITH " + ", ".join(ctes), sql
    if body.upper().startswith("WITH "):
        return f"{head}, {body[5:]}"
    return f"{head} {body}"


class Tables:
    """The parquet tables of one scale-factor folder and the views on them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in VIEWS:
            columns, table = VIEWS[name]
            return getattr(self, table).selectExpr(*[f"{e} AS {a}" for a, e in columns.items()])
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def labelled(self) -> DataFrame:
        labels = self.labels.withColumnRenamed("doc_id", "pos")
        return self.media.join(labels, "pos").select(*MEDIA, "quality", "toxic")
