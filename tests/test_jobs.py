import time

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from framesift.plans import curation, hooks
from framesift.session import release_shuffles


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [
            (1, "a.mp4", "The video shows a cat", 10, 480, 854, 24.0, 3.0),
            (2, "b.mp4", "a cat", 60, 480, 854, 24.0, 9.0),
            (3, "b.mp4", "dup path", 60, 480, 854, 24.0, 5.0),
            (4, "c.jpg", "a cat", 1, 480, 854, None, 8.0),
            (5, "d.mp4", "", 99, 480, 854, 60.0, 7.0),
            (6, "e.mp4", None, 99, 480, 854, 60.0, None),
        ],
        "pos int, path string, text string, num_frames int, height int, width int, fps double, aes double",
    )


def test_stage_order_does_not_follow_the_flags(table):
    got = curation.curate(table, remove_text_duplication=True, sort="aes", remove_empty_caption=True, remove_path_duplication=True)
    # Row 2 outranks row 4 by score although both captions are equal.
    assert [r["pos"] for r in got.collect()] == [2, 1]


def test_ascending_order_keeps_the_lowest(table):
    got = curation.curate(table, remove_text_duplication=True, sort_ascending="aes", remove_empty_caption=True)
    assert [r["pos"] for r in got.collect()] == [1, 3, 4]


def test_min_frame_runs_after_head(table):
    assert [r["pos"] for r in curation.curate(table, head=3, min_frame=50).collect()] == [2, 3]


def test_empty_captions_go_before_and_after_cleaning(spark):
    df = spark.createDataFrame([(1, "a", "<b></b>"), (2, "b", "ok")], "pos int, path string, text string")
    assert [r["pos"] for r in curation.curate(df, remove_empty_caption=True, clean_caption=True).collect()] == [2]


def test_refine_append_and_train_columns(table):
    got = curation.curate(table, refine_llm_caption=True, append_text=" End.", head=1, train_column=True)
    assert got.columns == ["path", "text", "num_frames", "height", "width", "fps"]
    assert got.first()["text"] == "A cat End."


def test_bad_requests(table):
    with pytest.raises(ValueError):
        curation.curate(table, nonsense=True)
    with pytest.raises(ValueError):
        curation.curate(table, sort="aes", sort_ascending="aes")
    with pytest.raises(ValueError):
        curation.curate(table.drop("aes"), aesmin=1.0)
    with pytest.raises(ValueError):
        curation.curate(table, sort="path", shard=2)


def test_shuffle_is_repeatable(table):
    first = [r["pos"] for r in curation.curate(table, shuffle=True, seed=1).collect()]
    assert first == [r["pos"] for r in curation.curate(table.repartition(3), shuffle=True, seed=1).collect()]
    assert sorted(first) == [1, 2, 3, 4, 5, 6]


def test_shards_follow_the_sort(table):
    got = curation.curate(table, sort="aes", shard=3, train_column=True)
    assert "shard" in got.columns and "aes" not in got.columns
    assert sorted(r["count"] for r in got.groupBy("shard").count().collect()) == [2, 2, 2]
    best = curation.curate(table, sort="aes", shard=3).filter("shard = 0")
    assert sorted(r["pos"] for r in best.collect()) == [2, 4]


def test_plain_filters_run_below_python(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "x", 60)], "pos int, path string, text string, num_frames int")
    df.write.parquet(str(tmp_path / "t"))
    text = plan_of(curation.curate(spark.read.parquet(str(tmp_path / "t")), clean_caption=True, fmin=51))
    assert text.index("ArrowEvalPython") < text.index("PushedFilters")
    assert "GreaterThanOrEqual(num_frames,51)" in text


def test_hooks(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "pos int, text string")
    assert [r["n"] for r in hooks.apply_column(df, len, "text", "n", "int", default=-1, errors=TypeError).orderBy("pos").collect()] == [2, -1]
    out = hooks.apply_rows(df, lambda r: {"a": r["text"] * 2, "b": r["pos"]}, ["text", "pos"], {"a": "string", "b": "int"}, {"a": "bad", "b": 0}, errors=TypeError)
    assert [(r["a"], r["b"]) for r in out.orderBy("pos").collect()] == [("abab", 1), ("bad", 0)]


def test_model_hook(spark):
    def make():
        return lambda x: x * 2.0

    df = spark.range(10).select(F.col("id").cast("double").alias("x"))
    got = hooks.score_with_model(df, make, ["x"], "y", DoubleType(), batch_size=4)
    assert all(r["y"] == 2 * r["x"] for r in got.collect())


def test_hooks_fail_over_errors_that_are_not_named(spark):
    df = spark.createDataFrame([("a",)], "text string")
    with pytest.raises(Exception, match="KeyError"):
        hooks.apply_column(df, lambda v: {}[v], "text", "n", "int").collect()


def test_files_to_files_skips_finished_shards(spark, tmp_path):
    import shutil

    from framesift.plans import files
    from framesift.sources import meta

    schema = "path string, text string, aes double, num_frames int"
    for name, at in (("a", 0), ("b", 50)):
        rows = [(f"v{i}.mp4", f"t{i % 7}" if i % 9 else "", float(i * 37 % 11), i) for i in range(at, at + 50)]
        meta.write_meta(spark.createDataFrame(rows, schema).coalesce(1), f"{tmp_path}/{name}.csv")
    inputs = [f"{tmp_path}/a.csv", f"{tmp_path}/b.csv"]
    run = lambda **more: {r["shard"]: (r["path"], r["n_rows"]) for r in files.curate_files(spark, inputs, shards=3, remove_empty_caption=True, aesmin=3.0, **more).collect()}
    first = run()
    assert first[0][0] == f"{tmp_path}/a+b_noempty_aesmin3.0_0.csv"
    paths = [first[k][0] for k in range(3)]
    got = [[r["path"] for r in meta.read_meta(spark, p, keep_order=True).orderBy("_file", "_row").collect()] for p in paths]
    want = [f"v{i}.mp4" for i in range(100) if i % 9 and i * 37 % 11 >= 3]
    assert sum(got, []) == want and [len(g) for g in got] == [first[k][1] for k in range(3)]
    # A finished shard is left alone, even where its files are gone; a missing one is written again.
    shutil.rmtree(paths[0])
    assert run() == first and not (tmp_path / paths[0].rsplit("/", 1)[1]).exists()
    lines = spark.read.parquet(f"{tmp_path}/a+b_noempty_aesmin3.0.csv.manifest")
    kept = lines.filter("shard <> 2").collect()
    spark.createDataFrame(kept, lines.schema).coalesce(1).write.parquet(f"{tmp_path}/kept")
    shutil.rmtree(f"{tmp_path}/a+b_noempty_aesmin3.0.csv.manifest")
    shutil.copytree(f"{tmp_path}/kept", f"{tmp_path}/a+b_noempty_aesmin3.0.csv.manifest")
    shutil.rmtree(paths[2])
    assert run() == first and [r["path"] for r in meta.read_meta(spark, paths[2]).collect()] == got[2]
    # Other stages start over.
    assert run(head=10)[0][1] == 4
    with pytest.raises(ValueError):
        files.curate_files(spark, inputs, difference=spark.range(1))


def test_release_shuffles_deletes_the_files_of_finished_jobs(spark, tmp_path):
    disk = spark._jsc.sc().env().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {name for k in range(files.size()) if (name := files.apply(k).getName()).startswith("shuffle_")}

    before = shuffled()
    spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().write.parquet(str(tmp_path / "out"))
    made = shuffled() - before
    assert made
    release_shuffles(spark)
    until = time.time() + 30
    while made & shuffled() and time.time() < until:
        time.sleep(0.2)
    assert not made & shuffled()
