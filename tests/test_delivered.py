"""A month that is delivered anew."""

from pyspark.sql import functions as F

from tripwright.functions.months import month_to_filename
from tripwright.plans.delivered import redeliver
from tripwright.sources.lineitem import lineitem_trips


def lines(spark, path, files):
    """Order lines of three months, in several files."""
    rows = spark.range(600).selectExpr(
        "id AS l_orderkey", "id % 50 AS l_partkey", "id % 20 AS l_suppkey",
        "int(id % 7 + 1) AS l_linenumber", "double(id % 40 + 5) AS l_quantity",
        "double(id + 1) AS l_extendedprice", "'N' AS l_returnflag", "'O' AS l_linestatus",
        "CAST(add_months(DATE'1998-01-05', int(id % 3)) AS timestamp_ntz) AS l_shipdate",
    )
    rows.repartition(files).write.parquet(f"{path}/lineitem.parquet")


def test_a_month_comes_anew_whole_without_one_task_that_reads_all(spark, tmp_path):
    sf_dir, landing = str(tmp_path / "tables"), str(tmp_path / "landing")
    lines(spark, sf_dir, 6)
    file = month_to_filename("1998-02")
    trips = lineitem_trips(spark, sf_dir).where(F.col("source_file") == file)
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    for keep in (None, F.col("vendor_id") == 1):
        group = f"redeliver {keep}"
        context.setJobGroup(group, "a month")
        redeliver(spark, sf_dir, landing, "1998-02", keep)
        stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
        assert max(tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s)) >= 6
        want = (trips if keep is None else trips.where(keep)).drop("source_file", "loaded_at")
        got = spark.read.parquet(f"{landing}/source_file={file}")
        assert got.schema.names == want.schema.names
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) != []
    context.setLocalProperty("spark.jobGroup.id", None)
