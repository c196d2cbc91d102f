"""The registry, the flagship query and the shape of key plans."""

import __spark_entry__ as entry_module
from pyspark.sql import functions as F

from keelson.functions.storage import stages
from keelson.operators import cleaning, windows
from workload import inputs

SF = "/root/testdata/sf0.001"


def test_registry_is_consistent():
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    assert set(oracles) <= set(queries)
    own = {name for name in queries if not name.startswith("op") and name != "pipeline"}
    assert own <= set(oracles)


def test_flagship_runs(spark):
    assert entry_module.entry(spark).count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_rules_stay_in_the_scan_stage(spark):
    rows = inputs.attribute_filtered(spark, SF)
    text = plan(rows)
    assert "hashpartitioning" not in text and "CartesianProduct" not in text


def test_windows_of_resampled_rows_need_no_shuffle(spark):
    rows = spark.range(100).select(
        F.lit(1).alias("track"), F.col("id").alias("row_index"), F.lit(100).cast("bigint").alias("row_count")
    )
    assert "Exchange" not in plan(windows.sliding_windows(rows, 9, 5))


def test_no_window_takes_a_whole_ship(spark):
    text = plan(cleaning.drop_stationary(inputs.attribute_filtered(spark, SF), inputs.CFG))
    assert "_chunk" in text and "CartesianProduct" not in text and "SinglePartition" not in text


def test_stage_folders_go_with_their_block(spark):
    with stages(spark) as folders:
        entry_module.queries()["clean_partition"](spark, SF).count()
        assert folders
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        assert not path.getFileSystem(hadoop).exists(path)
