"""Streaming queries: each runs over all the data present and hands back what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.registry.ingest import COLUMNS, FILE_SCHEMA, RAW_SCHEMA, bill_files, loaded_columns, stamp
from stratalake.registry.roles import table
from stratalake.session import work_dir
from stratalake.sources.csv_layer import stream_csv_layer
from stratalake.sources.store import TableStore
from stratalake.streaming.streams import (
    as_event_time,
    stream_alerts,
    stream_daily_counts,
    stream_dedup,
    stream_orphans,
    stream_upsert,
)

ALERT_OVER = 100.0


def _events(spark, d):
    """The events table as a stream of its files.

    A file source wants a folder or a pattern; as a pattern the name fits both a
    single file and a folder of files.
    """
    schema = table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/events[.]parquet")
    return stream.withColumn("ts", as_event_time("ts"))


def _back(df):
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def incremental_upsert(spark, d):
    """Latest event per user, merged into a table from several files, the later events first, a file at a time."""
    work = work_dir(spark, "stream-upsert")
    store = TableStore(spark, f"{work}/store")
    events = table(spark, d, "events")
    events.repartitionByRange(4, F.desc("ts")).write.parquet(f"{work}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/in")
    stream = stream.withColumn("ts", as_event_time("ts"))
    store.create("clean", "last_event", stream.schema, parts=4, part_keys=["user_id"])
    stream_upsert(stream, store, "clean", "last_event", ["user_id"], "ts", f"{work}/checkpoint").awaitTermination()
    return _back(store.read("clean", "last_event"))


def high_value_alerts(spark, d):
    work = work_dir(spark, "stream-alerts")
    stream_alerts(_events(spark, d), "value", ALERT_OVER, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return _back(spark.read.parquet(f"{work}/out"))


def dedup_copies(spark, d):
    """Purchases are delivered three times over, all else twice."""
    work = work_dir(spark, "stream-dedup")
    events = table(spark, d, "events")
    sent = events.unionByName(events).unionByName(events.where(F.col("event_type") == "purchase"))
    sent.write.parquet(f"{work}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{work}/in").withColumn("ts", as_event_time("ts"))
    stream_dedup(stream, ["event_id"], "ts", "1 hour", f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return _back(spark.read.parquet(f"{work}/out"))


def daily_counts(spark, d):
    work = work_dir(spark, "stream-daily")
    stream_daily_counts(_events(spark, d), "ts", "1 hour", f"{work}/out", f"{work}/checkpoint").awaitTermination()
    counts = spark.read.parquet(f"{work}/out")
    return counts.select(F.col("day").cast("timestamp_ntz").cast("date").alias("day"), "total_visits")


def csv_once(spark, d):
    """A file stream run twice over the same folder: the checkpoint keeps files from loading again."""
    folder = bill_files(spark, d, "stream-bills")
    work = work_dir(spark, "stream-csv")
    for _run in range(2):
        rows, _ = stream_csv_layer(spark.readStream, folder, FILE_SCHEMA, loaded_columns(), load_ts=stamp())
        sink = rows.writeStream.format("parquet").option("path", f"{work}/raw").trigger(availableNow=True)
        sink.option("checkpointLocation", f"{work}/checkpoint").start().awaitTermination()
    return spark.read.schema(RAW_SCHEMA).parquet(f"{work}/raw").select(*COLUMNS)


WAIT_HOURS = 6


def orphan_purchases(spark, d):
    """Purchases without a click of the same user within some hours, as far as the watermarks have come."""
    work = work_dir(spark, "stream-orphans")
    schema = table(spark, d, "events").schema
    table(spark, d, "events").repartition(4, "user_id").write.parquet(f"{work}/in")
    events = spark.readStream.schema(schema).parquet(f"{work}/in").withColumn("ts", as_event_time("ts"))
    kinds = [events.where(F.col("event_type") == kind) for kind in ("purchase", "click")]
    stream_orphans(
        kinds[0], "ts", kinds[1], "ts", "user_id", "user_id", f"{WAIT_HOURS} HOURS", "1 hour", f"{work}/out", f"{work}/checkpoint"
    ).awaitTermination()
    return _back(spark.read.schema(events.schema).parquet(f"{work}/out"))


QUERIES = {
    "stream_orphan_rows": orphan_purchases,
    "stream_incremental_upsert": incremental_upsert,
    "stream_high_value_alerts": high_value_alerts,
    "stream_dedup": dedup_copies,
    "stream_daily_counts": daily_counts,
    "stream_csv_load_once": csv_once,
}

# A row is given out once no match can come any more: the watermark, in whole milliseconds, has passed its span.
_PASSED_SQL = f"""(SELECT date_trunc('milliseconds', least(max(ts) FILTER (event_type = 'purchase'), max(ts) FILTER (event_type = 'click')))
    - INTERVAL 1 HOUR - INTERVAL {WAIT_HOURS} HOUR FROM events)"""
ORACLE = {
    "stream_orphan_rows": f"""SELECT * FROM events p WHERE event_type = 'purchase' AND ts < {_PASSED_SQL} AND NOT EXISTS (
        SELECT 1 FROM events c WHERE c.event_type = 'click' AND c.user_id = p.user_id
        AND c.ts BETWEEN p.ts - INTERVAL {WAIT_HOURS} HOUR AND p.ts + INTERVAL {WAIT_HOURS} HOUR)""",
    "stream_incremental_upsert": """SELECT event_id, ts, user_id, event_type, value, props FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS pos FROM events)
        WHERE pos = 1""",
    "stream_high_value_alerts": f"SELECT * FROM events WHERE value > {ALERT_OVER}",
    "stream_dedup": "SELECT * FROM events",
    "stream_daily_counts": """SELECT CAST(ts AS DATE) AS day, count(*) AS total_visits FROM events GROUP BY 1
        HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
    "stream_csv_load_once": """SELECT 'B' || CAST(o_orderkey AS VARCHAR) AS bill_id,
        CAST(o_custkey AS VARCHAR) AS patient_id,
        CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(12,2)) END AS bill_amount,
        strftime(o_orderdate, '%d-%m-%Y') AS bill_date, CASE o_orderpriority WHEN '1-URGENT' THEN NULL
        WHEN '2-HIGH' THEN 'high, very' WHEN '3-MEDIUM' THEN NULL ELSE o_orderpriority END AS note FROM orders""",
}
