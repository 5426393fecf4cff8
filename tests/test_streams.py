"""Streams give what the batch operators give, and a restart adds nothing twice."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.sources.csv_layer import physical_schema, stream_csv_layer
from stratalake.sources.store import TableStore
from stratalake.streaming.streams import stream_alerts, stream_daily_counts, stream_dedup, stream_orphans, stream_upsert

SCHEMA = T.StructType().add("k", "long").add("ts", "timestamp").add("v", "double")


def put(spark, folder, rows):
    df = spark.createDataFrame(rows, "k long, s string, v double")
    df.select("k", F.col("s").cast("timestamp").alias("ts"), "v").coalesce(1).write.mode("append").parquet(folder)


def source(spark, folder, **options):
    return spark.readStream.schema(SCHEMA).options(**options).parquet(folder)


def test_upsert_over_restarts(spark, tmp_path, root):
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    store = TableStore(spark, root)
    store.create("clean", "t", SCHEMA)

    def run():
        stream_upsert(source(spark, folder), store, "clean", "t", ["k"], "ts", checkpoint).awaitTermination()
        return sorted((r.k, r.v) for r in store.read("clean", "t").collect())

    put(spark, folder, [(1, "2024-01-01 01:00:00", 1.0), (1, "2024-01-01 02:00:00", 2.0), (2, "2024-01-01 01:00:00", 3.0)])
    assert run() == [(1, 2.0), (2, 3.0)]
    assert run() == [(1, 2.0), (2, 3.0)]
    put(spark, folder, [(2, "2024-01-01 05:00:00", 9.0), (3, "2024-01-01 01:00:00", 4.0)])
    assert run() == [(1, 2.0), (2, 9.0), (3, 4.0)]
    # an older event that comes late changes nothing, and rows without a key are set aside
    put(spark, folder, [(2, "2024-01-01 04:00:00", 7.0), (None, "2024-01-01 04:00:00", 1.0), (None, "2024-01-01 05:00:00", 2.0)])
    assert run() == [(1, 2.0), (2, 9.0), (3, 4.0)]
    assert sorted(r.v for r in store.read("clean", "t_rejected").collect()) == [1.0, 2.0]


def test_upsert_by_folders_with_files_out_of_order(spark, tmp_path, root):
    folder = str(tmp_path / "in")
    store = TableStore(spark, root)
    store.create("clean", "t", SCHEMA, parts=4, part_keys=["k"])
    for hour in (5, 2, 4, 1, 3):
        put(spark, folder, [(k, f"2024-01-01 0{hour}:00:00", float(hour * 10 + k)) for k in range(hour)])
    stream = source(spark, folder, maxFilesPerTrigger=1)
    stream_upsert(stream, store, "clean", "t", ["k"], "ts", str(tmp_path / "cp")).awaitTermination()
    assert sorted((r.k, r.v) for r in store.read("clean", "t").collect()) == [(k, 50.0 + k) for k in range(5)]


def test_alerts(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, folder, [(i, "2024-01-01 00:00:00", float(i)) for i in range(10)])
    for _ in range(2):
        stream_alerts(source(spark, folder), "v", 6.0, out, str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == [7, 8, 9]


def test_dedup_with_a_hot_key(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(1, "2024-01-01 00:00:00", 1.0)] * 50 + [(i, "2024-01-01 00:10:00", 1.0) for i in range(2, 30)] * 2
    put(spark, folder, rows)
    put(spark, folder, rows)
    options = {"maxFilesPerTrigger": 1}
    stream_dedup(source(spark, folder, **options), ["k"], "ts", "1 hour", out, str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == list(range(1, 30))


def test_dedup_keeps_the_copy_that_is_on_time(spark, tmp_path):
    """A copy behind the watermark does not take the place of the one that is not."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, folder, [(1, "2024-01-02 00:00:00", 1.0)])
    put(spark, folder, [(2, "2024-01-02 00:30:00", 1.0)])
    put(spark, folder, [(7, "2024-01-01 00:00:00", 1.0), (7, "2024-01-02 01:00:00", 2.0)])
    stream = source(spark, folder, maxFilesPerTrigger=1)
    stream_dedup(stream, ["k"], "ts", "1 hour", out, str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == [1, 2, 7]


def test_daily_counts_leave_out_the_open_day(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, folder, [(i, f"2024-01-0{1 + i % 3} 12:00:00", 1.0) for i in range(30)])
    stream_daily_counts(source(spark, folder), "ts", "1 hour", out, str(tmp_path / "cp")).awaitTermination()
    got = sorted((str(r.day)[:10], r.total_visits) for r in spark.read.parquet(out).collect())
    assert got == [("2024-01-01", 10), ("2024-01-02", 10)]


def test_csv_stream_reads_a_file_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("id,v\n1,NULL\n2, x \n4,much too long\n")
    for name in ("", "b.csv"):
        if name:
            (folder / name).write_text("id,v\n3,y\n")
        both = stream_csv_layer(spark.readStream, str(folder), physical_schema(["id", "v"]), ["id", "v"], limits={"v": 5})
        for rows, to in zip(both, ("out", "bad")):
            sink = rows.writeStream.format("parquet").option("path", str(tmp_path / to)).trigger(availableNow=True)
            sink.option("checkpointLocation", str(tmp_path / f"cp-{to}")).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("id").collect()
    assert [(r.id, r.v, r.file_name) for r in got] == [("1", None, "a.csv"), ("2", "x", "a.csv"), ("3", "y", "b.csv")]
    assert [r.line for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["4,much too long"]


def test_upsert_onto_rows_held_before(spark, tmp_path, root):
    """The table's own rows are the first state: an older event changes nothing."""
    folder = str(tmp_path / "in")
    store = TableStore(spark, root)
    store.create("clean", "t", SCHEMA, parts=4, part_keys=["k"])
    put(spark, str(tmp_path / "held"), [(k, "2024-01-01 05:00:00", 1.0) for k in range(20)])
    store.merge("clean", "t", spark.read.schema(SCHEMA).parquet(str(tmp_path / "held")), ["k"])
    put(spark, folder, [(1, "2024-01-01 04:00:00", 2.0), (2, "2024-01-01 06:00:00", 3.0), (50, "2024-01-01 01:00:00", 4.0)])
    stream_upsert(source(spark, folder), store, "clean", "t", ["k"], "ts", str(tmp_path / "cp")).awaitTermination()
    got = {r.k: r.v for r in store.read("clean", "t").collect()}
    assert len(got) == 21 and (got[1], got[2], got[50]) == (1.0, 3.0, 4.0)


def test_upsert_ties_and_nulls(spark, tmp_path, root):
    """As the batch form: NULL above all, then the greatest of the other columns."""
    folder = str(tmp_path / "in")
    store = TableStore(spark, root)
    store.create("clean", "t", SCHEMA)
    put(spark, folder, [(1, None, 1.0), (1, "2024-01-01 06:00:00", 9.0), (2, "2024-01-01 06:00:00", 3.0)])
    put(spark, folder, [(2, "2024-01-01 06:00:00", 4.0), (2, "2024-01-01 06:00:00", None), (3, "2024-01-01 06:00:00", 4.0)])
    stream = source(spark, folder, maxFilesPerTrigger=1)
    stream_upsert(stream, store, "clean", "t", ["k"], "ts", str(tmp_path / "cp")).awaitTermination()
    assert sorted((r.k, r.v) for r in store.read("clean", "t").collect() if r.v is not None) == [(1, 1.0), (3, 4.0)]


def test_upsert_finds_the_latest_without_the_table(spark, tmp_path, root):
    """Only the folders of the keys that came are read, and only to be written anew."""
    folder = str(tmp_path / "in")
    store = TableStore(spark, root)
    store.create("clean", "t", SCHEMA, parts=64, part_keys=["k"])
    run = lambda: stream_upsert(source(spark, folder), store, "clean", "t", ["k"], "ts", str(tmp_path / "cp")).awaitTermination()
    put(spark, folder, [(k, "2024-01-01 05:00:00", 1.0) for k in range(500)])
    run()
    before = set(store.read("clean", "t").inputFiles())
    put(spark, folder, [(7, "2024-01-01 06:00:00", 2.0)])
    run()
    assert len(before - set(store.read("clean", "t").inputFiles())) == 1
    assert store.read("clean", "t").where("v = 2").collect()[0].k == 7


def test_orphans_with_late_matches(spark, tmp_path):
    """A bill whose visit comes within the wait is none; late, keyless and never matching bills are."""
    bills, visits, out = (str(tmp_path / x) for x in ("bills", "visits", "out"))
    put(spark, bills, [(1, "2024-01-01 00:00:00", 1.0), (2, "2024-01-01 00:00:00", 2.0), (3, "2024-01-01 00:00:00", 3.0), (None, "2024-01-01 00:00:00", 4.0)])
    put(spark, bills, [(9, "2024-01-02 12:00:00", 9.0)])
    put(spark, visits, [(1, "2023-12-31 23:30:00", 0.0), (3, "2024-01-01 05:00:00", 0.0)])
    put(spark, visits, [(2, "2024-01-01 01:30:00", 0.0), (8, "2024-01-02 12:00:00", 0.0)])
    options = {"maxFilesPerTrigger": 1}
    run = lambda: stream_orphans(
        source(spark, bills, **options), "ts", source(spark, visits, **options), "ts", "k", "k", "2 HOURS", "1 hour", out, str(tmp_path / "cp")
    ).awaitTermination()
    run()
    assert sorted(r.v for r in spark.read.parquet(out).collect()) == [3.0, 4.0]  # 9 may still find its visit
    put(spark, bills, [(9, "2024-01-03 12:00:00", 10.0)])
    put(spark, visits, [(8, "2024-01-03 12:00:00", 0.0)])
    run()
    assert sorted(r.v for r in spark.read.parquet(out).collect()) == [3.0, 4.0, 9.0]
