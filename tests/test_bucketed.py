"""Bucketed tables: no exchange on the table itself, and the same rows as the other ways."""

import uuid

import pytest
from pyspark.sql import functions as F

from stratalake.operators.bucketed import lookup_bucketed, merge_bucketed, write_bucketed
from stratalake.operators.upsert import upsert


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def named(spark, tmp_path):
    made = []

    def name():
        made.append(f"t_{uuid.uuid4().hex[:10]}")
        return made[-1], str(tmp_path / made[-1])

    yield name
    for table in made:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


@pytest.fixture(autouse=True)
def as_on_a_cluster(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_shuffles_neither_side(spark, named):
    facts = spark.range(20_000).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 300).alias("k"))
    dim = spark.range(250).select(F.col("id").alias("nk"), (F.col("id") + 1000).alias("sk"))
    both = [write_bucketed(df, *named(), [key], 16) for df, key in ((facts, "k"), (dim, "nk"))]
    got = lookup_bucketed(*both, "k", "nk", "sk")
    assert "Exchange" not in plan(got)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        map(tuple, facts.join(dim, F.col("k") == F.col("nk"), "left").select("id", "k", "sk").collect()), key=str
    )


def test_merge_shuffles_the_delta_only(spark, named):
    target = spark.range(20_000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    delta = spark.range(19_000, 21_000).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    held = write_bucketed(target, *named(), ["k"], 16)
    joined = upsert(held, delta.repartition(16, "k"), ["k"], unique_rows=2000, broadcast_keys=-1, target_rows=1)
    assert plan(joined).count("Exchange") == plan(joined).count("REPARTITION_BY_NUM") == 1
    for _ in range(2):
        held = merge_bucketed(held, delta, ["k"], *named(), 16)
        assert sorted(map(tuple, held.collect())) == sorted(map(tuple, upsert(target, delta, ["k"]).collect()))
        assert len(held.inputFiles()) == 16  # a bucket stays one file
    with pytest.raises(ValueError):
        merge_bucketed(held, delta.union(delta), ["k"], *named(), 16)
