"""Joins, profiles, scores, nested columns, prompts, evaluation."""

import json
import math

import numpy as np
import pandas as pd
import pytest
from conftest import plan_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from framesift.functions.captions import light_clean
from framesift.operators import clips, evaluation, filters, joins, nested, profile, prompts, scores


@pytest.fixture(scope="module")
def left(spark):
    return spark.createDataFrame(
        [(1, "a", "x", 1.0), (2, "a", "y", 2.0), (3, None, "z", 3.0), (4, "d", None, None)],
        "pos int, path string, text string, aes double",
    )


@pytest.fixture(scope="module")
def right(spark):
    return spark.createDataFrame(
        [("a", "new", 7), (None, "nul", 8), ("q", "other", 9)], "path string, text string, extra int"
    )


def test_missing_paths_match_each_other(left, right, rows):
    assert rows(joins.difference(left, right), "pos") == [(4,)]
    assert rows(joins.filter_by_paths(left, right), "pos") == [(1,), (2,), (3,)]
    got = joins.intersection(left, right)
    assert got.columns == ["pos", "path", "text", "aes", "extra"]
    assert rows(got, "pos", "text", "extra") == [(1, "x", 7), (2, "y", 7), (3, "z", 8)]


def test_difference_and_filter_split_the_table(left, right):
    assert joins.difference(left, right).count() + joins.filter_by_paths(left, right).count() == left.count()


def test_update_text(spark, left, right, rows):
    got = joins.update_text(left, right)
    assert got.columns[0] == "path"
    assert rows(got, "pos", "text") == [(1, "new"), (2, "new"), (3, "nul"), (4, None)]
    empty = spark.createDataFrame([("a", None)], "path string, text string")
    assert rows(joins.update_text(left, empty), "pos", "text")[0] == (1, "x")
    with pytest.raises(PySparkException):
        joins.update_text(left, right.union(right)).collect()


def test_column_union(left, right, rows):
    got = joins.column_union(left, right)
    assert got.columns == ["path", "pos", "text_x", "aes", "text_y", "extra"]
    want = pd.merge(left.toPandas(), right.toPandas(), on="path", how="outer")
    assert got.count() == len(want)
    assert rows(got, "pos", "text_y") == [(1, "new"), (2, "new"), (3, "nul"), (4, None), (None, "other")]


def test_match_report(spark, left, right):
    got = joins.match_report(left, right).first()
    assert got.asDict() == {"wanted_keys": 3, "total_rows": 4, "matched_rows": 3, "unmatched_keys": 1}


def test_clip_catalogue_last_row_wins(spark, rows):
    df = spark.createDataFrame([(1, "d/v_1_0.mp4", "t1"), (2, "d/v_1_1.mp4", "t2"), (3, "d/w_0.mp4", "t1")], "pos int, path string, timestamp string")
    cat = spark.createDataFrame([("v_1", ["t1", "t3"], 0), ("v_1", ["t2"], 1)], "video_id string, timestamps array<string>, pos int")
    assert rows(joins.semi_by_clip(df, cat), "pos") == [(2,)]


def test_caption_set(spark, rows):
    df = spark.createDataFrame([(1, "a b"), (2, "c"), (3, None)], "pos int, text string")
    ref = spark.createDataFrame([(["A B ", None],), (["zzz"],)], "captions array<string>")
    clean = lambda d: d.withColumn("text", light_clean(F.col("text")))
    assert rows(joins.semi_by_caption_set(df, ref, F.col("captions"), clean), "pos") == [(1,)]


def test_first_score_wins(spark, rows):
    df = spark.createDataFrame([(1,), (2,)], "pos int")
    parts = spark.createDataFrame([(1, 5.0, 1, 0), (1, 6.0, 0, 1), (1, 7.0, 0, 0)], "pos int, s double, at int, rank int")
    assert rows(joins.attach_scores(df, parts, "s", ["at", "rank"])) == [(1, 7.0), (2, None)]
    assert rows(joins.attach_scores(df, parts, "s", ["at", "rank"], keep_unscored=False)) == [(1, 7.0)]


@pytest.mark.parametrize("values", [[1.0], [3.0, 3.0, 3.0], [1.0, 2.0, 4.0, 8.0, 8.0, 8.0, 8.0], list(np.linspace(-5, 9, 101) ** 3)])
def test_describe_matches_pandas(spark, values):
    df = spark.createDataFrame([(float(v), i) for i, v in enumerate(values)] + [(float("nan"), 0), (None, 0)], "v double, i int")
    got = profile.describe(df, ["v"]).first()
    want = pd.Series(values).describe()
    for name, key in (("n", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
        if math.isnan(want[key]):
            assert got[name] is None
        else:
            assert got[name] == pytest.approx(want[key]), name


@pytest.mark.parametrize("values", [[2.0, 2.0], [0.0, 0.1, 0.5, 0.99, 1.0], list(range(1000))])
def test_histogram_matches_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    counts, _ = np.histogram(values, bins=10)
    got = {r["bin"]: r["n"] for r in profile.histogram(df, ["v"], bins=10).collect()}
    assert [got.get(i, 0) for i in range(10)] == counts.tolist()


def test_grouped_frames_keep_a_hot_path_whole(spark, rows):
    df = spark.range(2500).select(F.col("id").alias("pos"), F.lit("hot").alias("path"), F.lit(10).alias("num_frames"), F.when(F.col("id") > 3, F.col("id").cast("string")).alias("text"))
    got = profile.frames_grouped(df, [0.5], ["text"]).collect()
    assert [(len(r["points"]), r["text"]) for r in got] == [(2500, "4")]
    assert [r["place"] for r in profile.frames_long(df, [0.5, 2]).orderBy("place").collect()] == list(range(5000))


def test_text_boxes(spark, rows):
    df = spark.createDataFrame([("a", 0.3), ("a", 0.31), ("b", 0.1)], "path string, score double")
    assert rows(filters.text_density(df)) == [("a", 1), ("b", 0)]


def test_folded_layers_equal_the_network():
    rng = np.random.default_rng(1)
    layers = [(rng.normal(size=(8, 5)), rng.normal(size=8)), (rng.normal(size=(3, 8)), rng.normal(size=3)), (rng.normal(size=(1, 3)), rng.normal(size=1))]
    w, b = scores.fold_layers(layers)
    x = y = rng.normal(size=5)
    for weight, bias in layers:
        y = weight @ y + bias
    assert float(np.dot(w, x) + b) == pytest.approx(float(y[0]))


@pytest.mark.parametrize(
    "motions,want",
    [
        (["zoom in"] * 3 + ["static"] * 2, "zoom in"),
        (["zoom in", "static"], "unknown"),
        (["pan left", "tilt up"], "pan/tilt"),
        (["pan left", "zoom out"], "dynamic"),
        ([], "pan/tilt"),
    ],
)
def test_video_motion(spark, motions, want):
    frames = spark.createDataFrame([("v", m) for m in motions], "path string, motion string")
    assert scores.video_motion(spark.createDataFrame([("v",)], "path string"), frames).first()["cmotion"] == want


def edges_to_points(moves):
    spots = {"top": [(0, i) for i in range(3, 7)], "down": [(9, i) for i in range(3, 7)], "left": [(i, 0) for i in range(3, 7)], "right": [(i, 9) for i in range(3, 7)]}
    return [("v", r, c, float(dx), float(dy), 100, 200) for e, (dx, dy) in moves.items() for r, c in spots[e]]


@pytest.mark.parametrize(
    "moves,want",
    [
        ({"top": (-30, 0), "down": (-30, 0), "left": (-30, 0), "right": (-30, 0)}, "pan_right"),
        ({"top": (0, -30), "down": (0, 30), "left": (-30, 0), "right": (30, 0)}, "zoom_in"),
        ({"top": (0, 0), "down": (0, 0), "left": (0, 0), "right": (30, 0)}, "static"),
        ({"top": (-30, 0), "down": (30, 0), "left": (0, 0), "right": (30, 0)}, "Undetermined"),
        ({"top": (30, 30), "down": (30, 30), "left": (0, 0), "right": (0, 0)}, "pan_left+tilt_up"),
    ],
)
def test_track_motion(spark, moves, want):
    df = spark.createDataFrame(edges_to_points(moves), "path string, row int, col int, dx double, dy double, height int, width int")
    assert scores.track_motion(df).first()["cmotion"] == want


@pytest.mark.parametrize(
    "text,want",
    [
        ("[('00:00:01.500', '00:01:00.004')]", [(150, 6000)]),
        ("[]", []),
        ('[("00:00:00", "01:00:00.25")]', [(0, 360025)]),
        ("[('00:00:00.0', '00:00:01.0'), ('00:00:02.0', '00:00:03.0')]", [(0, 100), (200, 300)]),
        ("broken", None),
        ("[('a', 'b')]", None),
        ("[('00:00:00.0')]", None),
        (None, None),
    ],
)
def test_scene_lists(spark, text, want):
    df = spark.createDataFrame([(text,)], "timestamp string")
    got = df.select(clips.parse_scenes(F.col("timestamp")).alias("s")).first()["s"]
    assert (None if got is None else [tuple(s) for s in got]) == want
    assert clips.drop_invalid_timestamps(df).count() == (want is not None)


def test_clip_plan_numbers_all_scenes(spark, rows):
    scenes = "[('00:00:00.0', '00:00:01.0'), ('00:00:01.0', '00:00:30.0')]"
    df = spark.createDataFrame([("in/a.b.mp4", "sub/a.b.mp4", scenes)], "path string, relpath string, timestamp string")
    got = clips.clip_plan(df, "out")
    assert rows(got, "scene", "start", "duration", "clip_path") == [(1, 1.0, 15.0, "out/sub/a.b_scene-1.mp4")]


def test_nested_lists(spark):
    df = spark.createDataFrame([("[[1.5, 2], [3, -4e-1]]", "['it (x) is', 'b']", "[('a', 'b'), ('c', 'd')]", "nope")], "a string, b string, c string, d string")
    got = df.select(
        nested.parse_nested_list(F.col("a"), "array<array<double>>"),
        nested.parse_nested_list(F.col("b"), "array<string>"),
        nested.parse_nested_list(F.col("c"), "array<array<string>>"),
        nested.parse_nested_list(F.col("d"), "array<string>"),
    ).first()
    assert list(got) == [[[1.5, 2.0], [3.0, -0.4]], ["it (x) is", "b"], [["a", "b"], ["c", "d"]], None]


def test_request_is_valid_json(spark):
    df = spark.createDataFrame([('p"1', 'say "hi"\n', ["AA", "BB"]), ("p2", "t", ["AA", "AA"])], "path string, text string, frames array<string>")
    got = nested.build_caption_request(df, "Task: {task_description}!", "m").collect()
    assert len(got) == 1
    doc = json.loads(got[0]["value"])
    assert doc["custom_id"] == 'p"1'
    content = doc["body"]["messages"][0]["content"]
    assert content[0] == {"type": "text", "text": 'Task: say "hi"\n!'}
    assert content[2] == {"type": "image_url", "image_url": {"url": "data:image/jpeg;base64,BB"}}
    assert doc["body"]["temperature"] == 0 and doc["body"]["max_tokens"] == 1000


def test_frames_round_trip(spark, rows):
    df = spark.createDataFrame([("a", [3, 1, 2], [1.0, 2.0, 3.0])], "path string, x array<int>, y array<double>")
    long = nested.explode_frames(df, ["path"], ["x", "y"])
    assert long.count() == 3
    assert rows(nested.implode_frames(long.repartition(3), ["path"], ["x", "y"])) == [("a", [3, 1, 2], [1.0, 2.0, 3.0])]
    many = spark.range(3000).select(F.lit("a").alias("path"), F.col("id").alias("frame_idx"), F.col("id").alias("x"))
    assert nested.implode_frames(many.repartition(5), ["path"], ["x"]).first()["x"] == list(range(3000))


@pytest.mark.parametrize("bad", ['a{"x": 1}', 'a{"reference_path": "b"}{', "a{broken"])
def test_invalid_prompts(spark, bad):
    df = spark.createDataFrame([(bad,)], "prompt string")
    with pytest.raises(PySparkException):
        prompts.split_json_suffix(df).collect()
    assert prompts.split_json_suffix(df, on_invalid="flag").first()["valid"] is False


def test_prompt_loops(spark, rows):
    df = spark.createDataFrame([(1, "|0|a|2|b"), (2, "plain")], "id int, prompt string")
    got = rows(prompts.explode_loops(df, 4), "id", "loop", "prompt")
    assert got == [(1, 0, "a"), (1, 1, "a"), (1, 2, "b"), (1, 3, "b")] + [(2, i, "plain") for i in range(4)]


def test_masks(spark, rows):
    df = spark.createDataFrame([(1, "0;1,2,-3,4,5,0.5"), (2, ""), (3, None)], "id int, mask_strategy string")
    got = rows(prompts.explode_mask_strategy(df).drop("mask_strategy"))
    assert got == [(1, 0, 0, 0, 0, 0, 1, 0.0), (1, 1, 1, 2, -3, 4, 5, 0.5)]
    with pytest.raises(PySparkException):
        prompts.explode_mask_strategy(spark.createDataFrame([(1, "1,2,3,4,5,6,7")], df.schema)).collect()


def test_snap(spark):
    def near(value, point, most):
        steps = value // point
        if value % point > point / 2 and steps < most // point - 1:
            steps += 1
        return steps * point

    df = spark.range(200)
    got = df.select(F.col("id").cast("int").alias("v"), prompts.snap(F.col("id"), 17, 119).alias("s")).collect()
    assert all(r["s"] == near(r["v"], 17, 119) for r in got)
    with pytest.raises(PySparkException):
        df.select(prompts.latent_to_frames(F.col("id")).alias("f")).agg(F.sum("f")).collect()


def test_prepared_prompts(spark, rows):
    df = spark.createDataFrame([(1, '|0| A Dog. |1| A <b>cat</b>{"mask_strategy": "0"}'), (2, "Plain")], "id int, prompt string")
    got = rows(prompts.prepare_prompts(df, "id", 2, aes=6.5), "id", "loop", "prompt", "mask_strategy")
    assert got == [
        (1, 0, "a dog. aesthetic score: 6.5.", "0"),
        (1, 1, "a cat aesthetic score: 6.5.", "0"),
        (2, 0, "plain aesthetic score: 6.5.", ""),
        (2, 1, "plain aesthetic score: 6.5.", ""),
    ]


def test_ssim_by_direct_sums(spark):
    rng = np.random.default_rng(0)
    a, b = rng.random((3, 13, 12)), rng.random((3, 13, 12))
    x = np.arange(11) - 5
    g = np.exp(-(x**2) / (2 * 1.5**2))
    window = np.outer(g / g.sum(), g / g.sum())
    values = []
    for c in range(3):
        for i in range(3):
            for j in range(2):
                p, q = a[c, i : i + 11, j : j + 11], b[c, i : i + 11, j : j + 11]
                mp, mq = (window * p).sum(), (window * q).sum()
                vp, vq, cov = (window * p * p).sum() - mp**2, (window * q * q).sum() - mq**2, (window * p * q).sum() - mp * mq
                values.append(((2 * mp * mq + 1e-4) * (2 * cov + 9e-4)) / ((mp**2 + mq**2 + 1e-4) * (vp + vq + 9e-4)))
    df = spark.createDataFrame([(1, 3, 13, 12, a.ravel().tolist(), b.ravel().tolist()), (2, 3, 13, 12, a.ravel().tolist(), a.ravel().tolist())], "k int, channels int, height int, width int, a array<double>, b array<double>")
    got = {r["k"]: r["ssim"] for r in evaluation.ssim(df, ["k"]).collect()}
    assert got[1] == pytest.approx(np.mean(values)) and got[2] == pytest.approx(1.0)


def test_psnr_of_equal_frames(spark):
    df = spark.createDataFrame([([0.5, 0.5], [0.5, 0.5]), ([0.0, 0.0], [0.1, 0.1])], "a array<double>, b array<double>")
    got = [r["p"] for r in df.select(evaluation.psnr(F.col("a"), F.col("b")).alias("p")).collect()]
    assert got[0] == 100 and got[1] == pytest.approx(20.0)


def test_scorecard_needs_every_dimension(spark):
    card = evaluation.VIDEO_SCORECARD
    full = [("m", d.replace(" ", "_"), hi) for d, (lo, hi, w) in card.dimensions.items()]
    df = spark.createDataFrame(full, "model string, dimension string, value double")
    got = {r["item"]: r["score"] for r in evaluation.weighted_scorecard(df, card).collect()}
    assert got["total score"] == pytest.approx(1.0) and got["dynamic degree"] == 0.5
    for broken in (df.filter("dimension <> 'scene'"), df.union(spark.createDataFrame([("m", "new", 1.0)], df.schema))):
        with pytest.raises(PySparkException):
            evaluation.weighted_scorecard(broken, card).collect()
    assert spark.range(1).select(evaluation.as_percent(F.lit(0.79231)).alias("p")).first()["p"] == "79.23%"


def test_loss_logs(spark, tmp_path, rows):
    (tmp_path / "a.log").write_text("noise\nold losses: {('144p', 1): 9.0}\nfinal losses: {('144p', 1): 0.12345, ('480p', 51): 0.5}\n")
    (tmp_path / "b.log").write_text("losses: {('144p', 51): 1e-2}\n")
    got = evaluation.loss_table(evaluation.read_loss_logs(spark, str(tmp_path)), [1, 51])
    assert rows(got) == [("144p", 0.1235, 0.01), ("480p", None, 0.5)]


def test_filters_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, "a", 5, 1.0)], "pos int, path string, num_frames int, aes double").write.parquet(str(tmp_path / "t"))
    df = filters.score_min(filters.frames_min(spark.read.parquet(str(tmp_path / "t")), 3), "aes", 0.5).select("path")
    text = plan_of(df)
    assert "GreaterThanOrEqual(num_frames,3)" in text and "ReadSchema: struct<path:string,num_frames:int,aes:double>" in text
