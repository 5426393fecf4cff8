"""Operators on hand-made and random rows, checked against plain Python."""

import random
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators import quality
from stratalake.operators.incremental import dedup_latest, incremental_filter, watermark
from stratalake.operators.sizing import fits_broadcast
from stratalake.operators.star import DimRef, hot_keys, load_dimension, load_fact, orphans, resolve_keys, with_match
from stratalake.operators.upsert import PIECE, assign_keys, check_source, fold, keyed_upsert, upsert, with_surrogate_keys
from stratalake.plans import kpi

few = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
row_lists = st.lists(st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 3)), max_size=25)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def newest(r):
    return tuple((x is None, x if x is not None else 0) for x in r[1:])


@few
@given(row_lists)
def test_dedup_latest(spark, data):
    df = spark.createDataFrame(data, "k int, t int, v int")
    want = {}
    for r in data:
        if r[0] not in want or newest(r) > newest(want[r[0]]):
            want[r[0]] = r
    assert rows(dedup_latest(df, ["k"], "t")) == sorted(want.values(), key=repr)


@few
@given(row_lists, row_lists, st.sampled_from([0, 1_000_000]))
def test_upsert(spark, target, source, limit):
    old = {r[0]: r for r in target}
    new = {r[0]: r for r in source}
    t = spark.createDataFrame(list(old.values()), "k int, a int, b int")
    s = spark.createDataFrame(list(new.values()), "k int, a int, b int")
    once = upsert(t, s, ["k"], broadcast_keys=limit, factor=0)
    assert rows(once) == sorted({**old, **new}.values(), key=repr)
    assert rows(upsert(once, s, ["k"], broadcast_keys=limit, factor=0)) == rows(once)
    part = {k: (k, r[1], old[k][2]) if k in old else r for k, r in new.items()}
    assert rows(upsert(t, s, ["k"], update=["a"], broadcast_keys=limit, factor=0)) == sorted({**old, **part}.values(), key=repr)


def test_upsert_source_lacks_columns(spark):
    t = spark.createDataFrame([(1, "x", 5)], "k int, a string, b int")
    s = spark.createDataFrame([(1, "y"), (2, "z")], "k int, a string")
    for limit in (0, 10):
        assert rows(upsert(t, s, ["k"], broadcast_keys=limit, factor=0)) == [(1, "y", 5), (2, "z", None)]
    with pytest.raises(ValueError):
        upsert(t, s, ["k"], update=["b"])
    assert rows(upsert(t.where("false"), s, ["k"])) == [(1, "y", None), (2, "z", None)]


def test_upsert_insert_list(spark):
    t = spark.createDataFrame([(1, "x", 5)], "k int, a string, b int")
    s = spark.createDataFrame([(1, "y", 6), (2, "z", 7)], "k int, a string, b int")
    for limit in (0, 10):
        assert rows(upsert(t, s, ["k"], update=["a"], insert=["b"], broadcast_keys=limit, factor=0)) == [(1, "y", 5), (2, None, 7)]
    assert rows(upsert(t.where("false"), s, ["k"], insert=["b"])) == [(1, None, 6), (2, None, 7)]


def test_size_check_counts_rows_and_text(spark):
    df = spark.range(10).select(F.repeat(F.lit("x"), 100).alias("s"), "id")
    assert fits_broadcast(df, 10) and not fits_broadcast(df, 9) and not fits_broadcast(df, 10, 999)


def test_upsert_two_keys(spark):
    t = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "k int, j string, v int")
    s = spark.createDataFrame([(1, "b", 9), (2, "a", 8)], "k int, j string, v int")
    for limit in (0, 10):
        assert rows(upsert(t, s, ["k", "j"], broadcast_keys=limit, factor=0)) == [(1, "a", 1), (1, "b", 9), (2, "a", 8)]


def test_check_source(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "k int, v int")
    with pytest.raises(ValueError, match="rows for one value"):
        check_source(df, ["k"])
    with pytest.raises(ValueError, match="NULL"):
        check_source(df.select(F.expr("nullif(k, 2)").alias("k")).distinct(), ["k"])
    assert check_source(df, ["v"]) == 3
    assert check_source(df.where("false"), ["v"]) == 0


def test_assign_keys_is_dense_and_repeatable(spark):
    df = spark.range(5000).select(F.concat(F.lit("N"), "id").alias("nk"))
    first = {r.nk: r.sk for r in assign_keys(df, "nk", "sk", 7, buckets=64).collect()}
    assert sorted(first.values()) == list(range(8, 5008))
    again = assign_keys(df.repartition(5, F.rand(1)), "nk", "sk", 7, buckets=64)
    assert {r.nk: r.sk for r in again.collect()} == first


def test_with_surrogate_keys_both_paths(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "nk string, sk long")
    source = spark.createDataFrame([("b", 9), ("c", 8), ("d", 7)], "nk string, v int")
    for limit in (0, 10):
        got = {r.nk: r.sk for r in with_surrogate_keys(source, target, "nk", "sk", 3, limit, factor=0).collect()}
        assert got["b"] == 2 and sorted([got["c"], got["d"]]) == [3, 4]


def test_load_dimension(spark):
    dim = spark.createDataFrame([], "sk long, nk string, name string")
    src = spark.createDataFrame([("a", "A", "VALID"), ("b", "B", "INVALID")], "nk string, name string, status string")
    once = load_dimension(dim, src, "nk", "sk", ["name"], promote_if=F.col("status") == "VALID")
    assert rows(once) == [(1, "a", "A")]
    twice = load_dimension(once, src.withColumn("name", F.lit("Z")), "nk", "sk", ["name"])
    assert rows(twice) == [(1, "a", "Z"), (2, "b", "Z")]
    with pytest.raises(ValueError):
        load_dimension(dim, src.unionByName(src), "nk", "sk", ["name"])


def skewed(spark, n=6000):
    """A third of the rows carry one key, a third none."""
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id") % 97 + 10)
    return spark.range(n).select("id", key.cast("int").alias("k"))


def test_resolve_keys_skewed(spark):
    facts = skewed(spark)
    dim = spark.range(1, 60).select(F.col("id").cast("int").alias("k"), (F.col("id") + 1000).alias("sk"))
    want = rows(facts.join(dim, "k", "left").select("id", "k", "sk"))
    assert hot_keys(facts, "k", 10) == [1]
    for limit in (0, 1000):
        got = resolve_keys(facts, [DimRef(dim, "k", "sk")], broadcast_rows=limit, hot_share=10)
        assert rows(got.select("id", "k", "sk")) == want


def test_orphans_and_matches_split_the_rows(spark):
    facts = skewed(spark)
    dim = spark.createDataFrame([(i,) for i in (1, 12, 13, 13)], "d int")
    for limit in (0, 1000):
        lost, found = (f(facts, dim, "k", "d", broadcast_rows=limit) for f in (orphans, with_match))
        assert {r.k for r in found.collect()} == {1, 12, 13}
        assert rows(lost.unionByName(found)) == rows(facts)


def test_load_fact_keeps_rows_and_keys(spark):
    fact = spark.createDataFrame([], "sk long, nk string, dk long, v int")
    dim = spark.createDataFrame([("d", 5)], "d string, dk long")
    src = spark.createDataFrame([("x", "d", 1), ("y", "?", 2)], "nk string, d string, v int")
    once = load_fact(fact, src, [DimRef(dim, "d", "dk")], "nk", "sk", ["v"])
    first = {r.nk: (r.sk, r.dk, r.v) for r in once.collect()}
    assert first["x"][1:] == (5, 1) and first["y"][1:] == (None, 2)
    later = load_fact(once, src.withColumn("v", F.lit(7)), [DimRef(dim, "d", "dk")], "nk", "sk", ["v"])
    assert {r.nk: (r.sk, r.v) for r in later.collect()} == {k: (v[0], 7) for k, v in first.items()}


def test_watermark_types(spark):
    ts = datetime(2024, 3, 31, 2, 30, 0, 123456)
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame([("2024-03-31 02:30:00.123456",), ("2024-01-01 00:00:00",)], "s string")
        df = df.select(F.col("s").cast(kind).alias("t"))
        assert rows(df.select((F.col("t") == watermark(df, "t")).alias("e"))) == [(False,), (True,)]
        assert incremental_filter(df, "t", watermark(df.where("false"), "t")).count() == 2
        assert incremental_filter(df, "t", watermark(df, "t")).count() == 0
    assert ts.microsecond == 123456


def test_split_bad_is_a_partition_and_first_rule_wins(spark):
    df = spark.createDataFrame([("a", "x"), (None, "01-01-2024"), (" ", None), ("b", "01-01-2024")], "id string, d string")
    both = [quality.missing_id_rule("id"), quality.invalid_date_rule("d")]
    good, bad = quality.split_bad(df, both)
    assert rows(good) == [("b", "01-01-2024")]
    assert sorted(r.error_reason for r in bad.collect()) == ["Invalid Visit Date"] + ["Missing Patient ID"] * 2
    unknown = quality.Rule("n", F.col("d") == "x", "is x")  # NULL test counts as not fired
    good, bad = quality.split_bad(df, [unknown])
    assert (good.count(), bad.count()) == (3, 1)


def test_require_and_assert_schema(spark):
    df = spark.createDataFrame([("a", "1"), (None, "2"), ("  ", "3")], "k string, v string")
    assert rows(quality.require(df, ["k", "v"])) == [("a", "1")]
    schema = T.StructType(
        [T.StructField("k", T.StringType(), False, {"max_length": 1}), T.StructField("v", T.IntegerType())]
    )
    assert quality.assert_schema(df.where("k = 'a'"), schema).first() == ("a", 1)
    with pytest.raises(ValueError, match="k: 1 rows break not_null; k: 1 rows break max_length"):
        quality.assert_schema(df, schema)


def test_kpi_semantics(spark):
    fact = spark.createDataFrame(
        [(1, 1, 10.0), (2, 1, None), (3, 2, 5.0), (4, None, 9.0), (5, 9, 1.0), (None, 3, 7.0)], "v int, k int, a double"
    ).withColumn("a", F.col("a").cast("decimal(10,2)"))
    dim = spark.createDataFrame([(1, "Same"), (2, "Same"), (3, "Other"), (4, "None")], "k int, n string")
    got = kpi.group_kpi(fact, dim, "k", "n", "v", "a", sort=["total_visits"]).collect()
    assert [tuple(r) for r in got] == [("Same", 3, 15), ("Other", 0, 7)]
    assert rows(kpi.average_kpi(fact, dim, "k", "n", "a")) == [("Other", 7.0), ("Same", 7.5)]
    assert [r.a for r in kpi.alerts(fact, "a", 7, ["v"]).collect()] == [10, 9]


def test_peak(spark):
    days = ["2024-01-01"] * 3 + ["2024-01-02"] * 3 + ["2024-01-03"] + [None] * 9
    daily = kpi.trend(spark.createDataFrame([(x,) for x in days], "d string"), "d")
    assert [r.d for r in kpi.peak(daily, 1, "d").collect()] == ["2024-01-01"]
    assert sorted(r.d for r in kpi.peak_ties(daily, "d").collect()) == ["2024-01-01", "2024-01-02"]


def test_random_second_loads(spark):
    """Five random deltas in a row give what a dictionary gives."""
    rng = random.Random(5)
    state, table = {}, spark.createDataFrame([], "k int, v int, sk long")
    for _ in range(3):
        delta = {rng.randrange(40): rng.randrange(100) for _ in range(15)}
        src = spark.createDataFrame(list(delta.items()), "k int, v int")
        keyed = with_surrogate_keys(src, table, "k", "sk", len(delta))
        table = spark.createDataFrame(upsert(table, keyed, ["k"], unique_rows=len(delta)).collect(), table.schema)
        held = dict(state)
        state = {**{k: (v, sk) for k, (v, sk) in state.items()}}
        got = {r.k: (r.v, r.sk) for r in table.collect()}
        assert {k: v for k, (v, _) in got.items()} == {**{k: v for k, (v, _) in held.items()}, **delta}
        assert all(got[k][1] == sk for k, (_, sk) in held.items())
        assert sorted(sk for _, sk in got.values()) == list(range(1, len(got) + 1))
        state = got


def test_one_part_is_dealt_to_many_tasks(spark):
    """Rows of one folder meet by key in pieces, and new ones are numbered where they are."""
    side = lambda a, b: spark.range(a, b).select(F.concat(F.lit("n"), "id").alias("nk"), F.lit(0).alias("p"), (F.col("id") % 7).alias("v"))
    target = side(0, 300).withColumn("sk", F.lit(1000) - F.substring("nk", 2, 9).cast("long"))
    sizes = [r[0] for r in fold(target, side(200, 900), ["nk"], "p", 1).groupBy(PIECE).count().select("count").collect()]
    assert len(sizes) >= 16 and max(sizes) < 120 and sum(sizes) == 900
    merged = keyed_upsert(target, side(200, 900), "nk", "sk", "p", 1, 1000, 1000, images=True)
    got = {r.nk: r.sk for r in merged.rows.collect()}
    assert merged.new == 600 and {got[f"n{i}"] for i in range(300, 900)} == set(range(1001, 1601))
    assert all(got[f"n{i}"] == 1000 - i for i in range(300))
    assert "hashpartitioning(nk" not in merged.rows._jdf.queryExecution().executedPlan().toString()
    assert merged.changes.count() == 700 and merged.changes.where("old is null").count() == 600
