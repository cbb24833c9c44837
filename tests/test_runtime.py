import glob

import pytest
from pyspark.sql import functions as F

from tessera.operators.live import live_entities
from tessera.plans import runtime as R


def test_written_tables_keep_schema_and_empty_ones_can_be_read(spark):
    df = spark.createDataFrame([(1, None, ["a"])], "x bigint, y string, z array<string>")
    back = R.materialize(df)
    assert back.schema.simpleString() == df.schema.simpleString() and back.count() == 1
    assert R.materialize(df.limit(0)).count() == 0
    assert back.inputFiles()[0].startswith("file:") and spark.sparkContext.applicationId in back.inputFiles()[0]


def test_bounds_are_checked(spark):
    assert len(R.bounded_rows(spark.range(5), 5)) == 5
    with pytest.raises(ValueError):
        R.bounded_rows(spark.range(6), 5)
    assert [len(b) for b in R.row_blocks(spark.range(5).coalesce(1), 2)] == [2, 2, 1]
    small, large = spark.range(10), spark.range(10_000_000)
    assert "hint" in R.broadcast_if_small(small)._jdf.queryExecution().logical().toString().lower()
    assert "hint" not in R.broadcast_if_small(large, 1000)._jdf.queryExecution().logical().toString().lower()


def test_few_files_are_dealt_out_and_many_are_left_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    assert R.spread(spark.range(100).coalesce(1)).rdd.getNumPartitions() == cores
    full = spark.range(0, 100, 1, cores + 2)
    assert R.spread(full) is full


def test_live_rows(spark):
    schema = "study_id string, id string, version int, is_deleted boolean, v string, h int"
    rows = [
        ("s", " A-1", 1, False, "old", 0), ("s", "a_1", 3, None, "new", 0), ("s", "a_1", 3, None, "new", 0), ("s", "a_1", 2, True, "mid", 0),
        ("s", "b", 1, False, "x", 0), ("s", "B", 2, True, "x", 0), ("s", "c", None, False, "null version", 0), (None, None, 1, False, "null keys", 0),
        ("s", "tie", 1, False, "p", 0), ("s", "tie", 1, False, "q", 0),
    ]
    got = live_entities(spark.createDataFrame(rows, schema), {"v": F.col("v")})
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("s", "a_1", "new"), ("s", "c", "null version"), (None, None, "null keys"), ("s", "tie", "q")], key=str
    )
    assert live_entities(spark.createDataFrame([], schema), {"v": F.col("v")}).count() == 0


def test_a_hot_key_reaches_the_shuffle_once_a_task(spark):
    df = spark.range(0, 50_000, 1, 4).select(F.lit("s").alias("study_id"), F.lit("hot").alias("id"), F.col("id").cast("int").alias("version"), F.lit(False).alias("is_deleted"))
    plan = live_entities(df, {"w": F.col("version")})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_max" in plan


def test_a_discarded_table_is_gone_and_its_folder_stays(spark):
    kept, gone = R.materialize(spark.range(3)), R.materialize(spark.range(4))
    R.discard(gone)
    assert kept.count() == 3 and not glob.glob(gone._scratch_path.removeprefix("file://"))
    R.discard(spark.range(1))
