"""Sources and sinks: partition pruning, record contract, text layouts."""

import pytest
from pyspark.sql import functions as F

from recsmith.sources import io


def _log(spark):
    rows = [(u, i, t, "train" if t % 2 else "test", t % 4) for u in range(3) for i in range(5) for t in range(8)]
    return spark.createDataFrame(rows, "user_id long, item_id long, time_us long, phase string, stage int")


def test_click_logs_stage_filter_prunes_directories(spark):
    base = io.scratch_dir(spark, "t_logs")
    io.write_click_logs(_log(spark), base)
    back = io.read_click_logs(spark, base, max_stage=1)
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "stage" in plan
    assert back.count() == 3 * 5 * 4 and {r.stage for r in back.collect()} == {0, 1}


def test_training_set_contract_rejects_wrong_length(spark):
    good = spark.createDataFrame([(1, [1, 2, 3])], "k long, h array<int>")
    path = io.scratch_dir(spark, "t_ctr")
    io.write_training_set(good, path, {"h": 3})
    assert io.read_training_set(spark, path).count() == 1
    bad = spark.createDataFrame([(1, [1, 2])], "k long, h array<int>")
    with pytest.raises(Exception):
        io.write_training_set(bad, io.scratch_dir(spark, "t_bad"), {"h": 3})


def test_vector_layouts_round_trip(spark):
    df = spark.createDataFrame([(7, [0.5, -1.25, 3.0, 2.0])], "item_id long, vec array<float>")
    p1 = io.scratch_dir(spark, "t_w2v")
    io.write_vectors_text(df, p1, dim=4)
    r = io.read_vectors(spark, p1).collect()[0]
    assert r.item_id == 7 and r.vec == [0.5, -1.25, 3.0, 2.0] and r.declared_count == 1 and r.declared_dim == 4
    p2 = io.scratch_dir(spark, "t_csv")
    io.write_item_vectors_csv(df, p2, split=2)
    r = io.read_item_vectors(spark, p2).collect()[0]
    assert r.text_vec == [0.5, -1.25] and r.image_vec == [3.0, 2.0]


def test_materialize_if_absent_builds_once(spark):
    path = io.scratch_dir(spark, "t_mat")
    calls = []

    def build():
        calls.append(1)
        return spark.range(3).withColumn("x", F.col("id") * 2)

    assert io.materialize_if_absent(spark, path, build).count() == 3
    assert io.materialize_if_absent(spark, path, build).count() == 3
    assert len(calls) == 1


def test_one_dimensional_vectors_round_trip(spark):
    df = spark.createDataFrame([(1, [0.5]), (2, [2.0])], "item_id long, vec array<float>")
    path = io.scratch_dir(spark, "t_dim1")
    io.write_vectors_text(df, path, dim=1)
    assert sorted((r.item_id, r.vec, r.declared_dim) for r in io.read_vectors(spark, path).collect()) == [
        (1, [0.5], 1), (2, [2.0], 1)]


def test_leftovers_of_a_failed_write_are_rebuilt(spark):
    path = io.scratch_dir(spark, "t_left")
    spark.range(9).write.parquet(path)
    jvm = spark.sparkContext._jvm
    mark = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(mark, False)
    assert io.materialize_if_absent(spark, path, lambda: spark.range(2)).count() == 2
