"""Array operators on keys that hold very many rows."""

from framesift.checks.catalogue import ORACLES, QUERIES
from framesift.operators import nested


def test_parts_of_imploded_frames_make_up_the_key(spark):
    long = spark.range(1000).selectExpr("'a' AS path", "1000 - id AS frame_idx", "id * 2 AS x")
    long = long.union(spark.createDataFrame([("b", 5, 7), ("b", None, 8), (None, 1, 9)], "path string, frame_idx long, x long"))
    parts = nested.implode_frames(long.repartition(5), ["path"], ["x"], per_row=300).orderBy("path", "part").collect()
    assert [(r["path"], r["part"], len(r["x"])) for r in parts] == [(None, 0, 1), ("a", 0, 300), ("a", 1, 300), ("a", 2, 300), ("a", 3, 100), ("b", 0, 2)]
    assert [x for r in parts if r["path"] == "a" for x in r["x"]] == [2 * (999 - i) for i in range(1000)]
    assert parts[-1]["x"] == [8, 7]


def _lineitem(spark, tmp_path):
    rows = spark.range(5000).selectExpr(
        "id AS l_orderkey", "id AS l_partkey", "CAST(id % 4 AS INT) AS l_linenumber", "CAST(id % 50 AS DOUBLE) AS l_quantity",
        "IF(id < 4500, 'N', 'R') AS l_returnflag", "'O' AS l_linestatus",
    )
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_imploded_frames_of_hot_keys(spark, tmp_path):
    got = QUERIES["R5_implode_frames_large"](spark, _lineitem(spark, tmp_path)).collect()
    assert sorted(map(tuple, got)) == [("N", 4500, 4500 * 24.5, 0.0), ("R", 500, 500 * 24.5, 0.0)]
    assert "R5_implode_frames_orders" in ORACLES


def test_grouped_frames_of_hot_paths(spark, tmp_path):
    from framesift.operators import profile

    folder = _lineitem(spark, tmp_path)
    got = QUERIES["A7_frames_grouped_large"](spark, folder).select("path", "n", "head", "total").collect()
    head = 2000 * (24.5 * 0.5 + 3)
    assert sorted(map(tuple, got)) == [("NO", 9000, head, 4500 * (24.5 * 0.5 + 3)), ("RO", 1000, head / 4, head / 4)]
    rows = spark.range(7).selectExpr("'p' AS path", "7 - id AS pos", "CAST(id AS INT) AS num_frames", "IF(id < 5, 't' || id, NULL) AS text")
    parts = profile.frames_grouped(rows, [0.5, 3], ["text"], per_row=3).collect()
    assert [x for r in parts for x in r["points"]] == [x for i in range(6, -1, -1) for x in (i * 0.5, 3.0)]
    assert [(r["part"], r["text"]) for r in parts] == [(0, "t4"), (1, "t3"), (2, "t0")]
    assert "A7_frames_grouped_orders" in ORACLES
