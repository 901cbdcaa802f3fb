"""Queries that write their own input do so with as many tasks as the tables fill."""

import glob

import pytest

from framesift.checks.catalogue import QUERIES


@pytest.fixture
def folder(spark, tmp_path, monkeypatch):
    rows = spark.range(400).selectExpr(
        "id AS doc_id", "concat('a \"quoted\"\\ntext ', id) AS text", "'en' AS lang", "'src1' AS source", "CAST(id AS INT) + 20 AS n_chars"
    )
    rows.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    for module in ("checks.sources", "checks.jobs", "plans.files"):
        monkeypatch.setattr(f"framesift.{module}.shared_folder", lambda _: f"{tmp_path}/shared")
    yield tmp_path
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_split_csv_is_written_by_many_tasks(spark, folder):
    got = QUERIES["S1_read_meta_csv_split"](spark, str(folder))
    assert got.filter("text LIKE 'a \"quoted\"\\ntext %'").count() == sum(i % 29 != 0 and i % 31 != 0 for i in range(400))
    assert len(glob.glob(f"{folder}/shared/meta-*.csv/part-*.csv")) > 1


def test_files_to_shards_inputs_are_written_by_many_tasks(spark, folder):
    got = QUERIES["U2_files_to_shards"](spark, str(folder))
    assert got.groupBy("shard").count().count() == 5
    assert len(glob.glob(f"{folder}/shared/*/even.parquet/part-*.parquet")) > 1
