import json
import os

import pytest
from conftest import plan_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from framesift import schema
from framesift.functions import paths
from framesift.operators import filters, media
from framesift.sources import bins, documents, jsonl, listing, meta
from framesift.streaming.resume import run_new_files


def test_csv_with_quotes_breaks_and_missing_cells(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text(
        'path,text,num_frames,resolution,fps,note\n'
        'x.mp4,"He said ""hi"", then\nleft",51,409920.0,24.0,n1\n'
        "y.mp4,None,1,,nan,n2\n"
    )
    got = meta.read_meta(spark, str(file)).orderBy("path").collect()
    assert got[0].asDict() == {
        "path": "x.mp4", "text": 'He said "hi", then\nleft', "num_frames": 51, "resolution": 409920, "fps": 24.0, "note": "n1",
    }
    assert got[1]["text"] == "None" and got[1]["resolution"] is None and got[1]["fps"] is None
    assert meta.read_meta(spark, str(file), na_words=["None"]).filter("path = 'y.mp4'").first()["text"] is None


def test_inputs_stack_in_order(spark, tmp_path):
    (tmp_path / "b.csv").write_text("path,aes\nb1,1.5\nb2,2.5\n")
    (tmp_path / "a.csv").write_text("path,flow\na1,3.5\n")
    df = meta.read_meta(spark, [str(tmp_path / "b.csv"), str(tmp_path / "a.csv")], keep_order=True)
    got = df.orderBy(*meta.ORDER_COLUMNS).collect()
    assert [(r["path"], r["aes"], r["flow"]) for r in got] == [("b1", 1.5, None), ("b2", 2.5, None), ("a1", None, 3.5)]
    assert [f.dataType.simpleString() for f in df.select("aes", "flow").schema.fields] == ["double", "double"]


def test_round_trip_and_formats(spark, tmp_path, rows):
    df = spark.createDataFrame([("p", 'a "b", c\nd', 1.5), ("q", None, None)], "path string, text string, aes double")
    for name in ("out.csv", "out.parquet"):
        meta.write_meta(df, str(tmp_path / name))
        assert rows(meta.read_meta(spark, str(tmp_path / name))) == rows(df)
    with pytest.raises(ValueError):
        meta.write_meta(df, str(tmp_path / "out.json"))
    with pytest.raises(ValueError):
        meta.read_meta(spark, "x.xlsx")


def test_existing_output_is_left_alone(spark, tmp_path):
    path = str(tmp_path / "s.parquet")
    meta.write_once(spark.range(3), path)
    broken = spark.range(2).select(F.raise_error(F.lit("must not run")).alias("id"))
    meta.write_once(broken, path)
    assert spark.read.parquet(path).count() == 3


def test_stage_names():
    assert meta.stage_name(["d/a.csv", "d/b.x.csv"], {}) == "d/a+b.csv"
    assert meta.stage_name(["m.csv"], {"difference": "z/old.csv", "fmin": 1, "aesmin": 4.5, "lang": "en", "shuffle": 42}, "parquet") == (
        "m-old_en_fmin1_aesmin4.5_shuffled_seed42.parquet"
    )
    assert meta.stage_name(["m.csv"], {"load_caption": "json", "remove_empty_caption": True, "head": None}) == "m_loadjson_noempty.csv"


def test_nan_becomes_null_and_required_columns(spark):
    df = spark.createDataFrame([(float("nan"), 1.0)], "aes double, flow double")
    assert schema.nan_to_null(df).first()["aes"] is None
    # NaN counts as larger than any number in Spark, yet a score filter must drop it.
    assert filters.score_min(df, "aes", 1).count() == 0
    with pytest.raises(ValueError):
        filters.remove_url(df)


def make_files(root, names):
    for name in names:
        os.makedirs(os.path.dirname(root / name), exist_ok=True)
        (root / name).write_text("12345")


def test_listing(spark, tmp_path, rows):
    make_files(tmp_path, ["a/BoxPunch/x.MP4", "a/BoxPunch/y.tar.mp4", "b/z.jpeg", "b/.hid/w.png", "c.txt", "v.m2ts"])
    root = str(tmp_path)
    all_files = listing.list_media(spark, root)
    assert all_files.filter("length = 5").count() >= 5
    videos = listing.videos_to_meta(all_files, root)
    assert rows(videos, "id", "relpath") == [("v", "v.m2ts"), ("x", "a/BoxPunch/x.MP4"), ("y.tar", "a/BoxPunch/y.tar.mp4")]
    assert ("z", f"{root}/b/z.jpeg") in rows(listing.images_to_meta(all_files))
    folders = listing.classes_from_dirs(listing.list_media(spark, root, [".mp4"]))
    assert {r["text"] for r in folders.collect()} == {"Box Punch"}
    assert "content" not in plan_of(all_files).split("ReadSchema")[-1]


def test_file_sizes_and_existence(spark, tmp_path, rows):
    make_files(tmp_path, ["x.mp4"])
    files = listing.list_media(spark, str(tmp_path))
    df = spark.createDataFrame([(f"{tmp_path}/x.mp4",), ("gone.mp4",)], "path string")
    assert rows(media.attach_filesize(df, files), "filesize") == [(5 / 1024 / 1024,), (None,)]
    assert filters.exists(df, files).count() == 1


def test_sidecars(spark, tmp_path, rows):
    videos = ["s1/r/MP4/a.mp4", "s1/r/MP4/b.mp4", "s2/r/MP4/c.mp4", "s3/r/MP4/d.mp4"]
    make_files(tmp_path, videos)
    (tmp_path / "s1/metadata_1.json").write_text(json.dumps({"current_task": "pick"}, indent=1))
    (tmp_path / "s2/metadata_x.json").write_text("{}")
    (tmp_path / "s2/other.json").write_text(json.dumps({"current_task": "no"}))
    files = listing.list_media(spark, str(tmp_path))
    docs = documents.read_json_documents(spark, str(tmp_path), "current_task string")
    got = listing.attach_sidecar_json(files, docs)
    names = got.select(F.substring_index("path", "/", -1).alias("n"), "text")
    assert rows(names) == [("a.mp4", "pick"), ("b.mp4", "pick"), ("c.mp4", "Unknown Task")]


def test_annotations_and_broken_documents(spark, tmp_path, rows):
    good = {"texts": ["a", "b"], "videos": [{"video_path": "v1"}, {"video_path": "v2"}], "state": [[1, 2.5]]}
    (tmp_path / "g.json").write_text(json.dumps(good, indent=2))
    (tmp_path / "bad.json").write_text("{not json")
    docs = documents.read_json_documents(spark, str(tmp_path), documents.ANNOTATION_SCHEMA)
    got = documents.annotations_to_rows(docs, "data/")
    assert rows(got) == [("data/v1", [[1.0, 2.5]], [], []), ("data/v2", [[1.0, 2.5]], [], [])]


def test_json_paths(spark, rows):
    df = spark.createDataFrame(
        [("L", "a\\b.mp4"), (None, "x"), ("M/", "c.mp4"), ("L", "/abs.mp4")], "lab string, right_mp4_path string"
    )
    assert rows(documents.select_json_paths(df, "root")) == [("/abs.mp4",), ("root/L/a/b.mp4",), ("root/M/c.mp4",)]


def test_sidecar_caption_uses_the_first_dot(spark, rows):
    df = spark.createDataFrame([("d/a.b.mp4",), ("d/c.mp4",)], "path string")
    cards = spark.createDataFrame([("d/a.json", "hi"), ("d/c.json", None)], "path string, caption string")
    assert rows(documents.load_sidecar_caption(df, cards)) == [("d/a.b.mp4", "hi"), ("d/c.mp4", "")]


def test_id_to_path(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    cards = spark.createDataFrame([("f/a.json", True), ("f/b.json", False), ("f/c.json", None)], "path string, success boolean")
    got = listing.id_to_path(df, "f/", ".json", cards)
    assert rows(got, "id", "path", "intact") == [("a", "f/a.mp4", True), ("b", "f/b.mp4", False), ("c", "f/c.mp4", False)]
    assert rows(listing.intact_only(got), "id") == [("a",)]
    with pytest.raises(ValueError):
        listing.id_to_path(df, "f", ".avi")


def sequential(sizes, max_lines, max_bytes):
    part, lines, used, out = 0, 0, 0, []
    for size in sizes:
        if lines >= max_lines or used + size > max_bytes:
            part, lines, used = part + 1, 0, 0
        out.append(part)
        lines, used = lines + 1, used + size
    return out


def filled(sizes, max_lines, max_bytes):
    """Parts filled line by line."""
    part, lines, used, out = 1, 0, 0, []
    for size in sizes:
        if lines >= max_lines or used + size > max_bytes:
            part, lines, used = part + 1, 0, 0
        lines, used = lines + 1, used + size
        out.append(part)
    return out


def test_chunks(spark, tmp_path):
    texts = ["é" * (i * 37 % 50) for i in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "at int, value string").repartition(5)
    sizes = [len(t.encode()) + 1 for t in texts]
    want = filled(sizes, 20, 700)
    for slices in (1, 64):
        got = jsonl.assign_chunks(df, "at", 20, 700, slices=slices).orderBy("at").collect()
        assert [r["part"] for r in got] == want
    jsonl.write_jsonl_chunks(df, str(tmp_path / "out"), "at", max_lines=20, max_bytes=700)
    for part in (1, 2, want[-1]):
        files = [f for f in (tmp_path / "out" / f"part={part}").iterdir() if f.suffix == ".txt"]
        assert [x for f in files for x in f.read_text().splitlines()] == [t for t, p in zip(texts, want) if p == part] and len(files) == 1


@pytest.mark.parametrize(
    ("lengths", "max_lines", "max_bytes"),
    [
        ([5] * 400, 7, 10_000),  # lines alone
        ([i * 7919 % 90 for i in range(900)], 10_000, 100),  # bytes alone, many spans
        ([900, 3, 900, 900, 3, 3, 5000, 1] * 20, 4, 500),  # lines beyond the limit and beyond spans
        ([0] * 50, 1, 1),
        ([3], 5, 100),
    ],
)
def test_chunks_are_filled_in_order(spark, lengths, max_lines, max_bytes):
    df = spark.createDataFrame([(f"k{i:05d}", "x" * n if n else None) for i, n in enumerate(lengths)], "at string, value string").repartition(3)
    got = jsonl.assign_chunks(df, "at", max_lines, max_bytes, slices=5).orderBy("at").collect()
    assert [r["part"] for r in got] == filled([n + 1 for n in lengths], max_lines, max_bytes)


def test_chunks_of_nothing(spark):
    assert jsonl.assign_chunks(spark.createDataFrame([], "at int, value string"), "at").collect() == []


def test_bins(spark, tmp_path, rows):
    df = spark.range(23).withColumnRenamed("id", "batch_no")
    assert bins.assign_bins(df, 5, start_bin=2).agg(F.max("bin_id"), F.count("*")).first() == (5, 20)
    assert bins.assign_bins(df, 5, keep_partial=True).filter("bin_id = 4").count() == 3
    bins.write_bins(bins.assign_bins(df, 5, start_bin=2), str(tmp_path / "bins"))
    got = bins.read_bins(spark, str(tmp_path / "bins"))
    assert rows(got.filter("buffer = 1"), "batch_no", "bin_pos") == [(5 + i, i) for i in range(5)]


@pytest.mark.parametrize("root", ["/a/b", "/a/b/", "/", "/a/x/y", "a/b"])
def test_relpath(spark, root):
    names = ["/a/b/c.mp4", "/a/b", "/a/bc/d", "/", "/x/../a/b/./c", "a/b/z", "q"]
    df = spark.createDataFrame([(n,) for n in names], "path string")
    got = [r["o"] for r in df.select(paths.relpath(F.col("path"), root).alias("o")).collect()]
    # The host's own relpath resolves relative names against the working folder; '/' stands for it here.
    want = [os.path.relpath(os.path.join("/", n), os.path.join("/", root)) for n in names]
    assert got == want


def test_path_parts(spark):
    names = ["a/b.tar.mp4", ".hidden", "x/.dot.mp4", "noext", "a.b/c"]
    df = spark.createDataFrame([(n,) for n in names], "path string")
    got = [r["o"] for r in df.select(paths.stem(F.col("path")).alias("o")).collect()]
    assert got == [os.path.splitext(os.path.basename(n))[0] for n in names]
    assert [r["o"] for r in df.select(paths.abspath(F.col("path"), "/r").alias("o")).collect()] == [os.path.join("/r", n) for n in names]


def test_media_type(spark):
    df = spark.createDataFrame([("a.MOV",), ("b.jpeg",), ("c.txt",)], "path string")
    assert [r["o"] for r in df.select(paths.media_type(F.col("path"), "unknown").alias("o")).collect()] == ["video", "image", "unknown"]
    with pytest.raises(PySparkException):
        df.select(paths.media_type(F.col("path"))).collect()


def test_urls(spark):
    urls = ["http://a.com", "https://localhost:80/x", "ftp://1.2.3.4/?q", "HTTPS://A.B.CO/x y", "a.com", "http://", "x http://a.com"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r["o"] for r in df.select(paths.is_url(F.col("u")).alias("o")).collect()] == [True, True, True, False, False, False, False]


def test_incremental_run_does_each_file_once(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    stage = lambda df: df.filter("num_frames > 1")
    spark.createDataFrame([("a", 5), ("b", 1)], "path string, num_frames int").write.mode("append").parquet(source)
    run_new_files(spark, source, "path string, num_frames int", stage, sink, state).awaitTermination()
    spark.createDataFrame([("c", 9)], "path string, num_frames int").write.mode("append").parquet(source)
    for _ in range(2):
        run_new_files(spark, source, "path string, num_frames int", stage, sink, state).awaitTermination()
    assert sorted(r["path"] for r in spark.read.parquet(sink).collect()) == ["a", "c"]


def test_probe_results(spark, rows):
    df = spark.createDataFrame([("a",), ("b",)], "path string")
    probe = spark.createDataFrame([("a", 10, 720, 1280, 24.0)], "path string, num_frames int, height int, width int, fps double")
    got = media.attach_media_info(df, probe)
    assert rows(got) == [("a", 10, 720, 1280, 0.5625, 24.0, 921600), ("b", 0, 0, 0, None, None, None)]
    assert filters.frames_min(got, 1).count() == 1


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_csv_is_read_alike_by_any_number_of_tasks(spark, tmp_path, end):
    import csv
    import random

    rng = random.Random(1)
    cell = lambda: "".join(rng.choice(["a", "b", " ", '"', "\n", ",", "é", "x\r\ny", "\n\n"]) for _ in range(rng.randint(0, 12)))
    rows = [(f"p{i}", cell(), i * 3, rng.choice([None, 1.5, 7.0]), cell()) for i in range(1200)]
    path = f"{tmp_path}/a.csv"
    with open(path, "w", newline="", encoding="utf-8") as file:
        out = csv.writer(file, lineterminator=end)
        out.writerow(["path", "text", "pos", "rank_score", "", "odd name"])
        out.writerows([*row, "z"] for row in rows)
        file.write(end + " " + end)
    want = [(a, b or None, c, d, e or None, "z") for a, b, c, d, e in rows]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("64m", "3k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = meta.read_one(spark, path, multi_line="split", keep_order=True)
            assert got.dtypes[2:4] == [("pos", "bigint"), ("rank_score", "double")] and got.columns[4:6] == ["_c4", "odd name"]
            assert [tuple(r)[:6] for r in got.orderBy("_row").collect()] == want
            assert [r["_row"] for r in got.orderBy("_row").collect()] == list(range(1200))
        assert spark.read.text(path, lineSep="\n").rdd.getNumPartitions() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_inferred_types(spark, tmp_path):
    cells = {
        "whole": ["1", "-20", "", "007"],
        "part": ["1", "2.5", "", "1e3"],
        "words": ["nan", "1", "", "inf"],
        "flag": ["True", "FALSE", "", "true"],
        "text": ["1d", "2", "", "3"],
        "mixed": ["true", "1", "", "x"],
        "none": ["", "", "", ""],
        "long": ["1" * 30, "1", "", "2"],
    }
    with open(f"{tmp_path}/a.csv", "w") as file:
        file.write(",".join(cells) + "\n" + "\n".join(",".join(row) for row in zip(*cells.values())) + "\n")
    got = meta.read_one(spark, f"{tmp_path}/a.csv")
    kinds = dict(got.dtypes)
    assert kinds == {"whole": "bigint", "part": "double", "words": "double", "flag": "boolean", "text": "string", "mixed": "string", "none": "string", "long": "string"}
    assert [r["whole"] for r in got.collect()] == [1, -20, None, 7] and [r["flag"] for r in got.collect()] == [True, False, None, True]
    assert set(dict(meta.read_one(spark, f"{tmp_path}/a.csv", infer=False).dtypes).values()) == {"string"}
