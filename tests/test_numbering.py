import pytest
from pyspark.sql import functions as F

from vecloom.operators import numbering


@pytest.fixture
def shuffled(spark):
    return spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("x").alias("w")).repartition(6)


def check_order(df, start):
    rows = sorted((r.vec_id, r.k) for r in df.collect())
    assert [r[0] for r in rows] == list(range(start, start + 5000))
    return [r[1] for r in rows]


def test_ids_follow_the_order(spark, shuffled):
    assert check_order(numbering.assign_ids(shuffled, 11, order_by=["k"], partitions=5), 11) == list(range(5000))


def test_ids_without_order_are_contiguous(spark, shuffled):
    assert sorted(check_order(numbering.assign_ids(shuffled, 1), 1)) == list(range(5000))


def test_small_files_and_the_distributed_path_agree(spark, shuffled, monkeypatch):
    staged = numbering.stage(shuffled.repartitionByRange(4, "k").sortWithinPartitions("k"), "t", rows_per_file=70)
    rows = staged.positioned()
    local = numbering.number_staged(rows, 1, sums={"half": (F.col("k") < 2500).cast("int")})
    assert check_order(local.rows, 1) == list(range(5000))
    assert (local.total, local.sums) == (5000, {"half": 2500})
    monkeypatch.setattr(numbering, "MAX_LOCAL_SEGMENTS", 10)
    spread = numbering.number_staged(rows, 1, sums={"half": (F.col("k") < 2500).cast("int")})
    assert check_order(spread.rows, 1) == list(range(5000))
    assert (spread.total, spread.sums) == (5000, {"half": 2500})


def test_wide_rows_are_not_shuffled(spark, shuffled):
    plan = numbering.assign_ids(shuffled, 1)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_next_id(spark):
    assert numbering.next_id(spark.range(3).select(F.col("id").alias("vec_id"))).first()[0] == 3
    assert numbering.next_id(spark.createDataFrame([], "vec_id bigint")).first()[0] == 1


def test_empty_input(spark):
    assert numbering.assign_ids(spark.createDataFrame([], "k int, w string"), 1).count() == 0
