"""Records with line ends inside quotes, from files that are split all the same.

Whether a line begins inside quotes depends on all quotes before it in its file. The lines are read as
text, so Spark splits the files; the quotes of each split are counted, and the parity
in front of a split is a prefix sum over the splits before it. Each task then joins the lines of its own
records. Only records that go on in another split, at most two per split, are put together by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators.sizing import fits_broadcast
from stratalake.sources.staging import stage

_META = ["file_path", "file_name", "file_size", "file_modification_time"]
_TEXT = "path string, block long, seq long, value string, begins boolean, ends boolean"


def quoted_records(lines: DataFrame) -> DataFrame:
    """``value`` and ``_metadata`` of each record but the first of each file, which is its header.

    ``lines`` is a text file frame cut at each ``\\n``. Blank lines between records are dropped. A quote that is
    never closed makes the rest of its file one record.
    """
    meta = F.col("_metadata")
    lines = lines.select("value", *[meta[c].alias(c) for c in _META], meta["file_block_start"].alias("block"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    splits = lines.groupBy(F.col("file_path").alias("path"), "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = "over (partition by path order by block rows between unbounded preceding and 1 preceding)"
    splits = stage(splits.selectExpr("path", "block", f"coalesce(sum(odd) {before}, 0) % 2 = 1 as inside"), "splits")
    if not fits_broadcast(splits):
        raise ValueError("too many splits in one read: raise spark.sql.files.maxPartitionBytes")
    # a join that keeps the lines where and in the order they are
    found = lines.withColumn("path", F.col("file_path")).join(F.broadcast(splits), ["path", "block"])
    files = [F.col(c) for c in _META]
    schema = f"{_TEXT}, file_path string, file_name string, file_size long, file_modification_time timestamp"
    pieces = found.select("path", "block", "value", "inside", *files).mapInArrow(_joined, schema)
    whole = pieces.where("begins and ends and not (block = 0 and seq = 0)").select("value", *_META)
    parts = stage(pieces.where("not (begins and ends)"), "split-records")
    order = "over (partition by path order by block, seq)"
    parts = parts.selectExpr("*", f"sum(int(begins)) {order} as record", f"block = 0 and seq = 0 as head")
    joined = parts.groupBy("path", "record").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "seq", "value"))), lambda p: p["value"]), "\n").alias("value"),
        F.max("head").alias("head"), *[F.first(c).alias(c) for c in _META],
    )
    records = whole.union(joined.where("not head").select("value", *_META))
    records = records.select(F.rtrim("value", F.lit("\r")).alias("value"), F.struct(*_META).alias("_metadata"))
    return records.where(F.trim("value") != "")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records from lines; those that begin before their split or end after it are marked."""
    where, seq, inside, begins, held, meta = None, 0, False, True, [], []

    def piece(ends: bool):
        return [*where, seq, "\n".join(held), begins, ends, *meta]

    for batch in batches:
        done = []
        counts = pc.count_substring(batch.column("value"), '"').to_pylist()
        columns = [batch.column(c).to_pylist() for c in ("path", "block", "value", "inside", *_META)]
        for n, path, block, value, first, *own in zip(counts, *columns):
            if (path, block) != where:
                if held:
                    done.append(piece(False))
                where, seq, inside, begins, held = (path, block), 0, first, not first, []
            meta = own
            held.append(value)
            if n % 2:
                inside = not inside
            if not inside:
                done.append(piece(True))
                seq, begins, held = seq + 1, True, []
        if done:
            yield _batch(done, batch)
    if held:
        yield _batch([piece(False)], batch)


def _batch(rows: list, like: pa.RecordBatch) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
    kinds += [like.schema.field(c).type for c in _META]
    names = [c.split()[0] for c in _TEXT.split(", ")] + _META
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
