"""Session helpers: shared folder, lineage cuts, cluster sizing."""

from pyspark.sql import functions as F

from daygrain.session import MB, cut_lineage, scale_conf, scratch_path, shared_dir


def test_shared_dir_is_the_session_setting(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch_path(spark, "x").startswith(shared_dir(spark) + "/x-")


def test_cut_lineage_keeps_rows(spark):
    df = spark.range(100).withColumn("y", F.col("id") * 2)
    for how in ("checkpoint", "table"):
        cut = cut_lineage(df, how)
        assert sorted(cut.collect()) == sorted(df.collect())
        plan = cut._jdf.queryExecution().optimizedPlan().toString()
        assert "Range" not in plan  # the original plan is gone


def test_scale_conf_sizes_partitions():
    big = scale_conf(100 * (1 << 40), total_cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * (1 << 40) // 10 // (256 * MB)
    small = scale_conf(60 * MB, total_cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert big["spark.sql.files.maxPartitionBytes"] == "512m"
