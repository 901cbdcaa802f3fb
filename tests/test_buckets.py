import random

import pytest
from pyspark.sql import functions as F

from framesift.functions import aspect
from framesift.operators import buckets

CONFIG = {
    "144p": {1: (1.0, 4), 51: (1.0, 2)},
    "480p": {1: (1.0, 2), 51: (1.0, 2), 102: (0.0, None)},
    "720p": {51: (1.0, 3)},
    "4k": {1: (1.0, 1)},
    "512": {51: (1.0, 1)},
}


def nearest(h, w, res):
    return min(aspect.sizes(res), key=lambda name: abs(float(name) - h / w))


def expected(t, h, w, config, interval=1):
    """The assignment rule for certain probabilities, row by row."""
    for res in sorted(config, key=lambda r: aspect.PIXELS[r], reverse=True):
        if h * w < aspect.PIXELS[res] * 0.8:
            continue
        if t == 1:
            if config[res].get(1, (0,))[0] >= 1:
                return res, 1, nearest(h, w, res)
            continue
        fitting = [n for n in sorted(config[res], reverse=True) if n != 1 and t > n * interval]
        if fitting and config[res][fitting[0]][0] >= 1:
            return res, fitting[0], nearest(h, w, res)
    return None, None, None


def test_assignment_matches_the_rule(spark):
    rng = random.Random(5)
    samples = [(i, rng.choice([0, 1, 2, 51, 52, 102, 103, 300]), rng.randint(1, 3000), rng.randint(1, 4000)) for i in range(1500)]
    df = spark.createDataFrame(samples, "pos int, num_frames int, height int, width int")
    for interval in (1, 3):
        got = buckets.assign_bucket(df, CONFIG, interval).collect()
        for r in got:
            want = expected(r["num_frames"], r["height"], r["width"], CONFIG, interval)
            assert (r["res"], r["t"], r["ar"]) == want, r


def test_nearest_ratio_for_every_resolution(spark):
    rng = random.Random(9)
    shapes = [(rng.randint(1, 4000), rng.randint(1, 4000)) for _ in range(400)]
    # Shapes half-way between two names, where rounding decides.
    shapes += [(s, 1000) for s in (255, 265, 275, 300, 365, 405, 455, 545, 550, 590, 645, 710, 875, 1165, 1415, 1640, 1835, 1945, 2040)]
    df = spark.createDataFrame(shapes, "h int, w int")
    picks = df.select("h", "w", *[buckets.closest_ratio(F.col("h"), F.col("w"), r).alias(r) for r in aspect.PIXELS]).collect()
    for r in picks:
        for res in aspect.PIXELS:
            assert r[res] == nearest(r["h"], r["w"], res), (r["h"], r["w"], res)


def test_a_refused_level_sends_the_row_on(spark, rows):
    df = spark.createDataFrame([(1, 200, 480, 854)], "pos int, num_frames int, height int, width int")
    # 102 frames at 480p is never accepted and ends the walk there.
    assert rows(buckets.assign_bucket(df, CONFIG), "res", "t") == [("512", 51)]


def test_probabilities(spark):
    config = {"144p": {51: (0.25, 1)}, "480p": {51: ((0.5, 0.5), 1)}}
    df = spark.range(8000).select(F.col("id").alias("pos"), F.lit(60).alias("num_frames"), F.lit(480).alias("height"), F.lit(854).alias("width"))
    got = buckets.assign_bucket(df, config, seed=1)
    counts = {r["res"]: r["count"] / 8000 for r in got.groupBy("res").count().collect()}
    assert abs(counts["480p"] - 0.25) < 0.02
    assert abs(counts["144p"] - 0.75 * 0.25) < 0.02
    assert got.subtract(buckets.assign_bucket(df, config, seed=1)).count() == 0


def test_unknown_resolution():
    with pytest.raises(ValueError):
        buckets.bucket_rows({"999p": {1: (1.0, 1)}})


def test_tables():
    assert [len(aspect.sizes(r)) for r in aspect.PIXELS] == [17, 40, 17, 17, 40, 17, 17, 40, 17, 17, 40, 40, 17]
    assert aspect.image_size("720p", "9:16") == (720, 1280)
    assert aspect.image_size("144p", "0.54") == (141, 260)
    assert aspect.image_size("480p", "1.33") == (740, 555)
    assert aspect.image_size("2880", "4.00") == (5760, 1408)
    assert list(aspect.sizes("4k"))[6:8] == ["0.62", "0.56"]
    assert aspect.num_frames("4s") == 102 and aspect.num_frames("33") == 33
    with pytest.raises(ValueError):
        aspect.image_size("256", "9:21")


def brute_plan(rows, config, replicas, drop_last, repeat):
    """Unshuffled plan by plain lists: {(step, rank): [keys]}."""
    members, order = {}, []
    for key, bucket in rows:
        if bucket not in members:
            members[bucket] = []
            order.append(bucket)
        members[bucket].append(key)
    visits = []
    for bucket in order:
        batch = config[bucket[0]][bucket[1]][1]
        rest = len(members[bucket]) % batch
        if rest and drop_last:
            members[bucket] = members[bucket][:-rest]
        elif rest:
            members[bucket] = members[bucket] + members[bucket][: batch - rest]
        visits += [bucket] * (len(members[bucket]) // batch)
    real = len(visits)
    rest = real % replicas
    if rest:
        visits = visits[: real - rest] if drop_last else visits + visits[: replicas - rest]
    used, plan = {}, {}
    for i in range(len(visits) // replicas * replicas):
        bucket = visits[i]
        batch = config[bucket[0]][bucket[1]][1]
        at = used.get(bucket, 0)
        if i == real and repeat:
            used = {}
            at = 0
        elif i > real and repeat:
            at = used.get(bucket, 0)
        plan[i // replicas, i % replicas] = members[bucket][at : at + batch]
        used[bucket] = at + batch
    return plan


@pytest.mark.parametrize("drop_last", [True, False])
@pytest.mark.parametrize("repeat", [True, False])
@pytest.mark.parametrize("replicas", [1, 3, 7])
def test_plan_in_order(spark, drop_last, repeat, replicas):
    rng = random.Random(replicas)
    config = {"144p": {1: (1.0, 4), 51: (1.0, 3)}, "480p": {1: (1.0, 9)}}
    kinds = [("144p", 1, "1.00"), ("144p", 51, "0.56"), ("144p", 51, "1.00"), ("480p", 1, "1.00")]
    # One bucket holds fewer rows than its padding needs.
    rows = [(i, rng.choice(kinds[:3])) for i in range(45)] + [(45, kinds[3]), (46, kinds[3])]
    df = spark.createDataFrame([(k, *b) for k, b in rows], "pos int, res string, t int, ar string")
    got = buckets.plan_batches(df, config, replicas, shuffle=False, drop_last=drop_last, repeat_on_pad=repeat).collect()
    plan = {}
    for r in sorted(got, key=lambda r: (r["step"], r["rank"], r["batch_index"] or 0)):
        plan.setdefault((r["step"], r["rank"]), [])
        if r["pos"] is not None:
            plan[r["step"], r["rank"]].append(r["pos"])
    assert plan == brute_plan(rows, config, replicas, drop_last, repeat)


def test_shuffled_plan_covers_every_row_once(spark):
    config = {"144p": {1: (1.0, 4)}}
    df = spark.range(103).select(F.col("id").alias("pos"), F.lit("144p").alias("res"), F.lit(1).alias("t"), F.lit("1.00").alias("ar"))
    got = buckets.plan_batches(df, config, replicas=2, seed=1).orderBy("step", "rank", "batch_index").collect()
    keys = [r["pos"] for r in got if r["pos"] is not None]
    assert set(keys) == set(range(103)) and len(keys) == 104  # one row pads the last batch
    assert keys != sorted(keys)
    other = buckets.plan_batches(df, config, replicas=2, seed=1, epoch=1).collect()
    assert sorted(map(str, got)) != sorted(map(str, other))


def test_resume_gives_the_same_steps(spark, rows):
    config = {"144p": {1: (1.0, 4)}}
    df = spark.range(103).select(F.col("id").alias("pos"), F.lit("144p").alias("res"), F.lit(1).alias("t"), F.lit("1.00").alias("ar"))
    whole = [r for r in rows(buckets.plan_batches(df, config, replicas=4)) if r[0] >= 2]
    assert rows(buckets.plan_batches(df, config, replicas=4, start=11)) == whole


@pytest.mark.parametrize(("replicas", "drop_last", "repeat"), [(1, False, False), (3, True, False), (5, False, True), (7, False, False)])
def test_shuffled_plan_deals_whole_batches(spark, replicas, drop_last, repeat):
    config = {"144p": {1: (1.0, 4), 51: (1.0, 3)}, "480p": {1: (1.0, 9)}}
    kinds = [("144p", 1, "1.00"), ("144p", 51, "0.56"), ("480p", 1, "1.00")]
    rows = [(i, *kinds[i * 7 % 13 % 3]) for i in range(150)]
    df = spark.createDataFrame(rows, "pos int, res string, t int, ar string")
    got = buckets.plan_batches(df, config, replicas, seed=4, drop_last=drop_last, repeat_on_pad=repeat).collect()
    visits = {}
    for r in got:
        visits.setdefault((r["step"], r["rank"]), []).append(r)
    steps = max(s for s, _ in visits) + 1
    assert set(visits) == {(s, r) for s in range(steps) for r in range(replicas)}
    used = {}
    for batch in visits.values():
        assert len({(r["res"], r["t"], r["ar"]) for r in batch}) == 1
        keys = [r["pos"] for r in batch if r["pos"] is not None]
        size = config[batch[0]["res"]][batch[0]["t"]][1]
        assert len(keys) in (0, size) and sorted(r["batch_index"] for r in batch if r["pos"] is not None) == list(range(len(keys)))
        for k in keys:
            used[k] = used.get(k, 0) + 1
    if not drop_last:
        assert set(used) == set(range(150))
    if not repeat:
        assert sum(used.values()) <= 150 + 2 + 3 + 8


def test_resume_plans_only_the_steps_left(spark):
    config = {"144p": {1: (1.0, 4)}}
    df = spark.range(400).select(F.col("id").alias("pos"), F.lit("144p").alias("res"), F.lit(1).alias("t"), F.lit("1.00").alias("ar"))
    left = buckets.plan_batches(df, config, replicas=5, start=95)
    assert left.count() == 20 and {r["step"] for r in left.collect()} == {19}


def test_cap_per_bucket_above_the_window_limit(spark):
    df = spark.range(3000).select(F.col("id").alias("pos"), F.lit(60).alias("num_frames"), F.lit(144).alias("height"), F.lit(256).alias("width"))
    got = buckets.cap_per_bucket(df, {"144p": {51: (0.5, 1)}}, limit=1500)
    assert sorted(r["pos"] for r in got.collect()) == list(range(1500))


def test_weighted_label_rejects_bad_weights():
    for weights in ({"a": 1.2}, {"a": 0.7, "b": 0.7}, {"a": 0.5, "identity": 0.2}):
        with pytest.raises(ValueError):
            buckets.weighted_label(weights, None)
