"""Times headline jobs and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framesift.checks.buckets import CONFIG
from framesift.checks.fixtures import Tables
from framesift.functions.rng import draw_hash
from framesift.operators import buckets, captions, clips, filters, joins, language, ordering, profile, scores
from framesift.plans.curation import curate
from framesift.session import local_session
from framesift.sources import meta

UNIQUE = ["pos", "path", "text", "num_frames"]


def ingest(t: Tables, cores: int, folder: str) -> DataFrame:
    """Write the meta table as a folder of Parquet files, which is how jobs find it."""
    meta.write_meta(t.media_big.repartition(cores), f"{folder}/media.parquet")
    return meta.read_meta(t.spark, f"{folder}/media.parquet")


def jobs(t: Tables, big: DataFrame, cores: int) -> dict:
    labelled = t.orders.select(
        F.concat(F.lit("clips/"), F.col("o_custkey") % 100, F.lit("/"), "o_orderkey", F.lit("_1.mp4")).alias("path"),
        F.col("o_totalprice").alias("quality"),
    )
    # A batch plan wants a unique row key.
    keyed = big.withColumn("pos", F.xxhash64(*UNIQUE))
    spread = t.documents.repartition(cores).select("doc_id", "text", "lang")

    def plan() -> DataFrame:
        return buckets.plan_batches(buckets.assign_bucket(keyed.dropDuplicates(["pos"]), CONFIG, rng="xxhash64"), CONFIG, replicas=64)

    def language_filter() -> DataFrame:
        return language.lang_filter(spread, language.trigram_profiles(spread, "text", "lang"), "en", 1, key="doc_id")

    return {
        "filter_chain": lambda: filters.score_min(filters.frames_min(filters.pixels_max(filters.videos_only(big), 921600), 51), "aes", 4.5),
        "curate": lambda: curate(big, remove_empty_caption=True, sort="aes", fmin=51, aesmin=4.5, remove_text_duplication=True, remove_path_duplication=True, train_column=True),
        "dedup_path": lambda: ordering.dedup_path(big),
        "dedup_text_best": lambda: ordering.dedup_text(big, [F.col("aes").desc_nulls_last(), F.col("pos"), F.col("path")]),
        "intersection": lambda: joins.intersection(big, labelled),
        "difference": lambda: joins.difference(big, labelled),
        "assign_bucket": lambda: buckets.assign_bucket(big, CONFIG, rng="xxhash64"),
        "bucket_stats": lambda: buckets.bucket_stats(buckets.assign_bucket(big, CONFIG, rng="xxhash64"), CONFIG),
        "plan_batches": plan,
        "shard": lambda: ordering.shard(big, 64, UNIQUE),
        "shuffle_positions": lambda: ordering.with_position(big.withColumn("h", draw_hash(1, F.concat_ws("|", *UNIQUE))), ["h", *UNIQUE], digest=True),
        "histogram": lambda: profile.histogram(big, ["num_frames", "height", "aes"]),
        "describe": lambda: profile.describe(big, ["num_frames", "height", "aes"]),
        "video_motion": lambda: scores.video_motion(
            t.flow_frames.select(F.col("video_id").alias("path")),
            t.flow_frames.select(F.col("video_id").alias("path"), scores.frame_motion(F.col("mag"), F.col("ang"), F.col("zoom")).alias("motion")),
        ),
        "clip_plan": lambda: clips.clip_plan(t.media, "clips", shorter=480),
        "language_filter": language_filter,
        "clean_caption": lambda: captions.clean_caption(spread.select("doc_id", "text")),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    only = sys.argv[1:]
    spark = local_session(cores, "bench")
    t = Tables(spark, sf_dir)
    t.media_big.selectExpr("sum(num_frames)").collect()  # starts the engine
    times = {}

    def timed(name, run):
        started = time.perf_counter()
        out = run()
        times[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
        return out

    big = timed("ingest", lambda: ingest(t, cores, tempfile.mkdtemp(prefix="bench-")))
    for name, build in jobs(t, big, cores).items():
        if not only or name in only:
            timed(name, lambda: build().write.format("noop").mode("overwrite").save())
    print(
        json.dumps(
            {
                "metric": "total wall time of curation jobs",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
