"""Structured Streaming forms of the batch operators.

Each function starts a query and returns it. By default a query takes in all
data present and stops; ``continuous=True`` keeps it running. The checkpoint
folder holds what has been read, so a restarted query goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from stratalake.sources.files import exists
from stratalake.sources.staging import stage_observed, stage_scope
from stratalake.sources.store import TableStore

# Keeps the state of a query on the executors' disks and in the checkpoint, not in their memory.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@dataclass(frozen=True)
class Running:
    """Queries that belong together."""

    queries: Sequence[StreamingQuery]

    def awaitTermination(self) -> None:
        for query in self.queries:
            query.awaitTermination()

    def stop(self) -> None:
        for query in self.queries:
            query.stop()


def as_event_time(col: str) -> Column:
    """Watermarks need a ``timestamp``; a zone-less one is read in the session zone."""
    return F.col(col).cast("timestamp")


def _start(writer: DataStreamWriter, checkpoint: str, continuous: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer if continuous else writer.trigger(availableNow=True)).start()


def _to_files(rows: DataFrame, out: str, checkpoint: str, continuous: bool) -> StreamingQuery:
    return _start(rows.writeStream.format("parquet").option("path", out).outputMode("append"), checkpoint, continuous)


def _greatest_row(columns: Sequence[str], order_col: str) -> Column:
    """The whole row with the greatest ``order_col``, ties by the other columns, NULL above all: as one maximum."""
    first = [order_col, *[c for c in columns if c != order_col]]
    return F.max(F.struct(*[x for c in first for x in (F.col(c).isNull().alias(f"{c}_null"), F.col(c))]))


def stream_upsert(
    stream: DataFrame,
    store: TableStore,
    layer: str,
    table: str,
    keys: Sequence[str],
    order_col: str,
    checkpoint: str,
    continuous: bool = False,
    state_store: str = ROCKSDB,
) -> Running:
    """Merge each micro-batch into an existing table; the row with the greatest ``order_col`` stays.

    The latest row of each key is the state of the query, an aggregate that is kept in the state store, so no file of
    the table is read to find it. A batch gives the rows of the keys it held, and only the folders those fall into are written.
    It holds within a batch, between batches and against what the table held
    before, whose rows are the state's first ones; ties are settled by the other columns. So files may come in any
    order, and a batch that is replayed after a failure changes nothing. Rows with
    a NULL in a key go to the table ``<table>_rejected``, by a query of their own, each batch once.
    """
    spark = stream.sparkSession
    columns, schema = store.read(layer, table).columns, store.read(layer, table).schema
    rejected, rest = f"{table}_rejected", [c for c in columns if c not in keys]
    if not store.exists(layer, rejected):
        store.create(layer, rejected, schema)
    if not exists(spark, f"{checkpoint}-held"):
        store.read(layer, table).write.parquet(f"{checkpoint}-held")
    keyless = reduce(or_, [F.col(k).isNull() for k in keys])
    held = spark.readStream.schema(schema).parquet(f"{checkpoint}-held")
    rows = stream.select(*columns)
    latest = held.unionByName(rows.where(~keyless)).groupBy(*keys).agg(_greatest_row(rest, order_col).alias("row"))
    latest = latest.select(*[F.col(c) if c in keys else F.col(f"row.{c}").alias(c) for c in columns])

    def merge(batch: DataFrame, batch_id: int) -> None:
        with stage_scope(spark):
            changed, found = stage_observed(batch, f"{table}-batch", rows=F.count(F.lit(1)), **store.touching(layer, table))
            if found["rows"]:
                store.merge(layer, table, changed, keys, unique_rows=found["rows"], staged=True, touched=store.touched(found))

    def set_aside(batch: DataFrame, batch_id: int) -> None:
        load = f"{checkpoint}-{batch_id}"
        if load not in store.loads(layer, rejected):
            store.append(layer, rejected, batch, load)

    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, state_store)
    try:
        main = _start(latest.writeStream.outputMode("update").foreachBatch(merge), checkpoint, continuous)
        aside = _start(rows.where(keyless).writeStream.foreachBatch(set_aside), f"{checkpoint}-rejected", continuous)
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)
    return Running([main, aside])


def stream_alerts(
    stream: DataFrame, amount: str, threshold: float, out: str, checkpoint: str, continuous: bool = False
) -> StreamingQuery:
    """Append rows strictly above the threshold to parquet files as they arrive. No state."""
    return _to_files(stream.where(F.col(amount) > threshold), out, checkpoint, continuous)


def stream_dedup(
    stream: DataFrame,
    keys: Sequence[str],
    event_time: str,
    delay: str,
    out: str,
    checkpoint: str,
    continuous: bool = False,
) -> StreamingQuery:
    """Drop re-sent records that come within ``delay`` of the first one; the first is kept.

    State is one entry per key for the length of the watermark delay. For "the
    latest wins" use :func:`stream_upsert`.
    """
    once = stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
    return _to_files(once, out, checkpoint, continuous)


def stream_daily_counts(
    stream: DataFrame, event_time: str, delay: str, out: str, checkpoint: str, continuous: bool = False
) -> StreamingQuery:
    """day, total_visits; a day is written once the watermark has passed its end.

    Days are UTC days, in any session zone.
    """
    daily = (
        stream.withWatermark(event_time, delay)
        .groupBy(F.window(event_time, "1 day").alias("w"))
        .agg(F.count(F.lit(1)).alias("total_visits"))
        .select(F.col("w.start").alias("day"), "total_visits")
    )
    return _to_files(daily, out, checkpoint, continuous)


def stream_orphans(
    rows: DataFrame,
    row_time: str,
    lookup: DataFrame,
    lookup_time: str,
    key: str,
    lookup_key: str,
    wait: str,
    delay: str,
    out: str,
    checkpoint: str,
    continuous: bool = False,
    state_store: str = ROCKSDB,
) -> StreamingQuery:
    """Rows for which no row of ``lookup`` came within ``wait`` before or after them, among them rows without a key.

    A left outer join of two streams, each with a watermark of ``delay``: a row is kept as state until the watermarks have passed the time
    in which its match may still come, then it is written. State is what came in during the wait and the delays.
    """
    spark = rows.sparkSession
    names = rows.columns
    left = rows.withWatermark(row_time, delay).alias("l")
    right = lookup.select(F.col(lookup_key).alias("__key"), F.col(lookup_time).alias("__time")).withWatermark("__time", delay).alias("r")
    span = F.expr(f"__time BETWEEN l.{row_time} - INTERVAL {wait} AND l.{row_time} + INTERVAL {wait}")
    joined = left.join(right, (F.col(f"l.{key}") == F.col("__key")) & span, "left_outer")
    found = joined.where(F.col("__key").isNull()).select(*[F.col(f"l.{c}").alias(c) for c in names])
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, state_store)
    try:
        return _to_files(found, out, checkpoint, continuous)
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)
