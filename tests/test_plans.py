"""The physical plans hold what the scale of the data needs."""

import pytest
from pyspark.sql import functions as F

from stratalake.operators.incremental import dedup_latest, incremental_filter, utc_day, watermark
from stratalake.operators.star import DimRef, orphans, resolve_keys
from stratalake.operators.upsert import assign_keys, upsert
from stratalake.plans import kpi


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("facts") / "f")
    cols = [F.col("id"), (F.col("id") % 7).alias("k"), F.lit(1.5).cast("decimal(10,2)").alias("a")]
    stamp = F.timestamp_seconds(F.col("id") * 3600).alias("ts")
    spark.range(5000).select(*cols, stamp, utc_day(stamp).alias("day")).write.partitionBy("day").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_dedup_limits_each_key_before_the_shuffle(facts):
    text = plan(dedup_latest(facts, ["k"], "ts"))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1


def test_report_aggregates_before_it_joins(spark, facts, no_broadcast):
    dim = spark.range(7).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("n"))
    lines = plan(kpi.group_kpi(facts, dim, "k", "n", "id", "a")).splitlines()
    join = next(i for i, x in enumerate(lines) if "Join" in x)
    assert any("partial_sum" in x for x in lines[join:])


def test_watermark_reaches_the_scan(spark, facts):
    bound = watermark(facts.where("id < 4000"), "ts")
    scan = plan(incremental_filter(facts.select("id", "ts", "day"), "ts", bound, "day"))
    assert "GreaterThan(ts," in scan and "PartitionFilters: [isnotnull(day" in scan and "(day" in scan
    assert "Subquery" not in scan


def test_small_delta_leaves_the_target_unshuffled(facts):
    text = plan(upsert(facts, facts.where("id < 10"), ["id"]))
    assert "LeftAnti, BuildRight" in text and "hashpartitioning" not in text


def test_large_delta_is_one_join(facts, no_broadcast):
    text = plan(upsert(facts, facts.where("id < 10"), ["id"], broadcast_keys=0))
    assert text.count("Join") == 1 and text.count("hashpartitioning") == 2


def test_hot_and_null_keys_scatter(spark, facts, no_broadcast):
    """Rows without a key, and those with a hot one, stay where they are; no task gets much more than its share."""
    hot = facts.withColumn("k", F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id")))
    dim = spark.range(5000).select(F.col("id").cast("long").alias("k"), (F.col("id") + 1).alias("sk"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = resolve_keys(hot, [DimRef(dim, "k", "sk")], broadcast_rows=0, hot_share=10)
        shuffled = out.where("k is not null and k <> 1").groupBy(F.spark_partition_id()).count().collect()
        keys = facts.select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("k")).repartition(8)
        lone = orphans(keys, dim.where("k < 0"), "k", broadcast_rows=0).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r["count"] for r in shuffled) < 2 * 1666 / 8
    assert sum(r["count"] for r in lone) == 5000 and max(r["count"] for r in lone) < 2 * 5000 / 8
    assert out.count() == 5000 and out.where("k = 1 and sk = 2").count() == hot.where("k = 1").count()


def test_key_numbering_never_ranks_all_rows_in_one_task(facts):
    text = plan(assign_keys(facts.select("id"), "id", "sk", buckets=16))
    single = [x for x in text.splitlines() if "SinglePartition" in x]
    assert len(single) == 1  # the bucket sizes
    assert "BroadcastHashJoin" in text
