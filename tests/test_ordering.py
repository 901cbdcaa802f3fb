import math

import pytest
from conftest import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framesift.functions.permute import permute
from framesift.functions.rng import draw_hash, uniform
from framesift.operators import ordering


def numbered(spark, n, partitions=3):
    return spark.range(n).select((F.col("id") * 7919 % 100003).alias("pos"), (F.col("id") % 5).alias("g")).repartition(partitions)


def test_positions_follow_the_order(spark):
    got = ordering.with_position(numbered(spark, 1000), "pos").collect()
    ordered = sorted(r["pos"] for r in got)
    assert {r["pos"]: r["position"] for r in got} == {p: i for i, p in enumerate(ordered)}


def test_positions_do_not_depend_on_the_slices(spark):
    df = numbered(spark, 300)
    want = ordering.with_position(df, "pos", slices=2).orderBy("pos").collect()
    for slices in (3, 17, 64):
        assert ordering.with_position(df, "pos", slices=slices).orderBy("pos").collect() == want


def test_positions_inside_groups_with_one_hot_group(spark):
    df = spark.range(900).select(F.col("id").alias("pos"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("g"))
    got = ordering.with_position(df, "pos", "g").filter("g = 'hot'").orderBy("pos").collect()
    assert [r["position"] for r in got] == list(range(300))


@pytest.mark.parametrize("common", [5.0, None])
def test_a_common_leading_value_is_cut_by_the_next_column(spark, common):
    value = F.when(F.col("id") % 3 == 0, F.lit(common)).otherwise((F.col("id") % 11).cast("double"))
    df = spark.range(900).select(F.col("id").alias("pos"), value.alias("v"))
    got = ordering.with_position(df, ["v", "pos"], slices=16).collect()
    want = sorted(got, key=lambda r: (r["v"] is not None, r["v"] or 0, r["pos"]))
    assert [r["position"] for r in want] == list(range(900))
    parts = df.withColumn("s", ordering.slice_of(df, ["v", "pos"], 16))
    assert parts.groupBy("s").count().agg(F.max("count")).first()[0] < 2 * 900 / 16


def test_large_whole_numbers_that_share_a_double(spark):
    df = spark.range(64).select((F.lit(2**60) + F.col("id")).alias("pos"), (-F.col("id")).alias("other"))
    got = ordering.with_position(df, ["pos", "other"], slices=4).orderBy("pos").collect()
    assert [r["position"] for r in got] == list(range(64))


def test_hashed_order_positions(spark):
    df = spark.range(500).withColumn("h", draw_hash(1, F.col("id")))
    got = ordering.with_position(df, ["h", "id"], digest=True).orderBy("h", "id").collect()
    assert [r["position"] for r in got] == list(range(500))


def test_rows_never_meet_in_one_partition(spark):
    for df in (ordering.shard(numbered(spark, 50), 3, "pos"), ordering.assign_rank_blocked(numbered(spark, 50), 3, "pos")):
        text = plan_of(df)
        # Only the table of slice sizes may go through one partition.
        for part in text.split("Exchange SinglePartition")[1:]:
            assert "HashAggregate" in part


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(1, 60), k=st.integers(1, 9))
def test_shard_sizes(spark, n, k):
    got = ordering.shard(spark.range(n).withColumnRenamed("id", "pos"), k).orderBy("pos").collect()
    sizes = [sum(r["shard"] == i for r in got) for i in range(k)]
    assert sizes == [n // k + (i < n % k) for i in range(k)]
    assert [r["shard"] for r in got] == sorted(r["shard"] for r in got)


@pytest.mark.parametrize("n,ranks", [(10, 4), (3, 8), (8, 4), (1, 3)])
def test_strided_ranks_wrap(spark, n, ranks):
    got = ordering.assign_rank_strided(spark.range(n).withColumnRenamed("id", "pos"), ranks).collect()
    total = math.ceil(n / ranks) * ranks
    want = [(i % n, i % ranks, i // ranks) for i in range(total)]
    assert sorted((r["pos"], r["rank"], r["rank_index"]) for r in got) == sorted(want)


def test_strided_ranks_drop(spark):
    got = ordering.assign_rank_strided(spark.range(10).withColumnRenamed("id", "pos"), 4, pad="drop").count()
    assert got == 8


def test_blocked_ranks_with_fewer_rows_than_ranks(spark):
    got = ordering.assign_rank_blocked(spark.range(2).withColumnRenamed("id", "pos"), 5).collect()
    assert [r["rank"] for r in got] == [4, 4]


def test_split_sizes(spark):
    df = spark.range(1000).withColumnRenamed("id", "pos")
    counts = {r["split"]: r["count"] for r in ordering.split_random(df).groupBy("split").count().collect()}
    assert counts == {"train": 70, "val": 15, "test": 915}
    counts = {r["split"]: r["count"] for r in ordering.split_random(df, test_rest=False).groupBy("split").count().collect()}
    assert counts == {"train": 70, "val": 15, "test": 15, None: 900}


def test_dedup_keeps_the_first_and_treats_nulls_as_equal(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, None)], "pos int, text string")
    assert rows(ordering.dedup_text(df)) == [(1, "a"), (2, None)]


def test_dedup_trims_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "a")], "pos int, path string")
    text = plan_of(ordering.dedup_path(df))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_sort_puts_missing_scores_last(spark):
    df = spark.createDataFrame([(1, None), (2, 1.0), (3, 5.0)], "pos int, aes double")
    assert [r["pos"] for r in ordering.sort_descending(df, "aes").collect()] == [3, 2, 1]
    assert [r["pos"] for r in ordering.sort_ascending(df, "aes").collect()] == [2, 3, 1]


@pytest.mark.parametrize("method", ["md5", "xxhash64"])
def test_draws_are_uniform_and_repeatable(spark, method):
    df = spark.range(20000).select(uniform(3, F.col("id"), "x", method).alias("u"))
    first = df.agg(F.avg("u"), F.min("u"), F.max("u"), F.sum((F.col("u") < 0.25).cast("int"))).first()
    assert abs(first[0] - 0.5) < 0.01 and 0 <= first[1] and first[2] < 1 and abs(first[3] / 20000 - 0.25) < 0.02
    assert first == df.agg(F.avg("u"), F.min("u"), F.max("u"), F.sum((F.col("u") < 0.25).cast("int"))).first()


def test_slice_counts_from_the_end(spark):
    df = spark.range(10).withColumnRenamed("id", "pos")
    assert [r["pos"] for r in ordering.slice_rows(df, -3, None).orderBy("pos").collect()] == [7, 8, 9]


@pytest.mark.parametrize("limit", [3, 1200])
@pytest.mark.parametrize("descending", [True, False])
def test_first_in_group(spark, limit, descending):
    df = spark.range(4000).select(F.col("id").alias("pos"), (F.col("id") % 3 == 0).cast("int").alias("g"))
    got = ordering.first_in_group(df, ["g"], "pos", limit, descending).collect()
    for g in (0, 1):
        mine = sorted((r["rank_in_group"], r["pos"]) for r in got if r["g"] == g)
        want = sorted((i for i in range(4000) if (i % 3 == 0) == bool(g)), reverse=descending)[:limit]
        assert mine == [(i + 1, p) for i, p in enumerate(want)]


@pytest.mark.parametrize("limit", [999, 1000])
def test_first_in_group_keeps_missing_groups(spark, limit):
    df = spark.range(5000).select(F.col("id").alias("pos"), F.when(F.col("id") % 2 == 0, "g").alias("g"))
    got = ordering.first_in_group(df, ["g"], "pos", limit)
    assert {r["g"]: r["count"] for r in got.groupBy("g").count().collect()} == {"g": limit, None: limit}


def placed(df, order_by, **options):
    return [tuple(r) for r in ordering.with_position(df, order_by, **options).orderBy("position").select("position", *order_by).collect()]


def test_positions_of_texts_dates_and_flags(spark):
    df = spark.range(3000).select(
        F.concat(F.lit("clips/é/"), F.col("id").cast("string")).alias("text"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("day"),
        (F.col("id") % 2 == 0).alias("flag"),
        F.lit(7).alias("same"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 100).alias("lead"),
    )
    for order_by in (["text"], ["day", "text"], ["flag", "text"], ["same", "text"], ["lead", "text"]):
        rows = df.select(*order_by).orderBy(*[F.col(c).asc_nulls_first() for c in order_by]).collect()
        want = [(i, *r) for i, r in enumerate(rows)]
        assert placed(df, order_by, slices=16) == want, order_by
    with pytest.raises(ValueError):
        ordering.with_position(df.select(F.array("lead").alias("lead")), "lead")


def test_slices_follow_the_varied_columns_and_stay_few(spark):
    df = spark.range(20_000).select(F.lit(0).alias("_src"), F.lit("a.csv").alias("_file"), F.col("id").alias("_row"), (F.col("id") % 100).alias("v"))
    for order_by, slices in ((["_src", "_file", "_row"], 32), (["v", "_row"], 256)):
        used = df.select(ordering.slice_of(df, order_by, slices).alias("s")).groupBy("s").count()
        assert used.count() == slices and used.agg(F.max("count")).first()[0] <= 2 * 20_000 / slices


def test_slices_of_paths_without_a_common_prefix(spark):
    host = F.element_at(F.array(*[F.lit(h) for h in ("s3://a/", "s3://a/", "s3://a/b/", "https://x.org/é/", "/")]), (F.col("id") % 5 + 1).cast("int"))
    df = spark.range(20_000).select(F.concat(host, F.lit("clips/"), F.col("id").cast("string")).alias("path")).union(spark.createDataFrame([("~odd",), (None,)], "path string"))
    used = df.select(ordering.slice_of(df, ["path"], 32).alias("s")).groupBy("s").count()
    assert used.count() == 32 and used.agg(F.max("count")).first()[0] < 2 * 20_002 / 32
    got = [r["path"] for r in ordering.with_position(df, "path").orderBy("position").collect()]
    assert got == sorted(got, key=lambda p: (p or "").encode())


def test_sums_before_each_row(spark):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("pos"), (F.col("id") % 3).alias("g"), F.when(F.col("id") % 7 > 0, F.col("id") % 11).alias("size"))
    for group_by in ([], ["g"]):
        sums = {}
        for r in ordering.with_position(df, "pos", group_by, before={"sum": F.col("size")}, slices=9).orderBy("pos").collect():
            group = r["g"] if group_by else None
            assert r["sum"] == sums.get(group, 0)
            sums[group] = sums.get(group, 0) + (r["size"] or 0)


@pytest.mark.parametrize("kind", ["double", "int", "date", "timestamp", "decimal(9,1)", "boolean"])
@pytest.mark.parametrize("n", [7, 1500])
def test_many_first_rows_are_those_of_a_sort(spark, kind, n):
    value = F.when(F.col("id") % 6 > 0, F.col("id") * 7919 % 50)
    value = {"date": F.date_add(F.lit("2024-01-01").cast("date"), value.cast("int")), "timestamp": F.timestamp_seconds(value), "boolean": value > 20}.get(kind, value.cast(kind))
    if kind == "double":
        value = F.when(F.col("id") % 17 == 1, F.lit(float("nan"))).otherwise(value)
    df = spark.range(2500).select(F.col("id").alias("pos"), value.alias("v"), F.lit("own").alias("_o0"), F.lit("own").alias("_at"))
    by = [("v", kind != "boolean"), ("pos", False)]
    order = [F.col("v").desc_nulls_last() if by[0][1] else F.col("v").asc_nulls_last(), F.col("pos")]
    want = list(map(str, df.orderBy(*order).limit(n).collect()))
    got = ordering.head(df, n, by=by)
    assert list(map(str, got.collect())) == want
    if n > 1000:
        assert "Limit" not in plan_of(got)


def test_helper_columns_leave_the_callers_alone(spark):
    own = ["_h", "_rn", "_at", "_n", "_slice", "_rank", "_offset", "_size", "_total", "_lead", "_of_0", "_v"]
    df = spark.range(60).select(F.col("id").alias("pos"), (F.col("id") % 9).cast("string").alias("text"), F.lit("p").alias("path"), *[F.lit(c).alias(c) for c in own])
    for got in (
        ordering.dedup_text(df), ordering.dedup_path(df), ordering.with_position(df, "pos", total="all", before={"sum": F.col("pos")}), ordering.with_position(df, "pos", "text"),
        ordering.shard(df, 3), ordering.split_random(df), ordering.assign_rank_strided(df, 7), ordering.assign_rank_blocked(df, 7),
        ordering.assign_buffer_rank(df, 2, 5), ordering.slice_rows(df, -9, None), ordering.first_in_group(df, ["text"], "pos", 1500), ordering.topk(df, "pos", 1500),
    ):
        row = got.first()
        assert all(row[c] == c for c in own)


def test_sharding_reads_its_input_twice_at_most(spark, tmp_path):
    spark.range(100).withColumnRenamed("id", "pos").write.parquet(str(tmp_path / "t"))
    plan = ordering.shard(spark.read.parquet(str(tmp_path / "t")), 4)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2


def test_permutations_are_permutations(spark):
    for n in (1, 2, 3, 5, 17, 255, 256, 4097):
        df = spark.range(n).select("id", F.lit("own").alias("_x"))
        places = {}
        for key in (0, 7, 2**32 - 1):
            got = permute(df, "p", F.col("id"), F.lit(n), F.lit(key)).orderBy("id").collect()
            places[key] = [r["p"] for r in got]
            assert sorted(places[key]) == list(range(n)) and all(r["_x"] == "own" for r in got)
        if n > 50:
            # Neighbours part, and keys give different orders.
            assert sum(abs(a - b) == 1 for a, b in zip(places[7], places[7][1:])) < n / 10
            assert sum(a == b for a, b in zip(places[0], places[7])) < n / 10


def test_a_filter_on_a_place_does_not_copy_the_rounds(spark):
    placed = permute(spark.range(100), "p", F.col("id"), F.lit(100), F.lit(1)).filter("p >= 90")
    assert len(plan_of(placed)) < 60_000 and placed.count() == 10


def test_shuffled_positions_follow_seed_and_keys_alone(spark):
    df = numbered(spark, 500)
    first = ordering.shuffle_position(df, 1).orderBy("pos").collect()
    assert sorted(r["position"] for r in first) == list(range(500))
    assert first == ordering.shuffle_position(df.repartition(7), 1).orderBy("pos").collect()
    assert first != ordering.shuffle_position(df, 2).orderBy("pos").collect()
