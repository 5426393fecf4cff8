"""A result written out, and what was staged on the way to it released; batches of bounded size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratalake.sources.staging import read_staged, stage_scope, write_staged


def settled(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The frame that ``build`` returns, as a table in the shared work folder.

    For small results of jobs that stage much: the staged tables give their
    space back before the next step takes some, also inside a scope, which then releases the result.
    """
    with stage_scope(spark, apart=True):
        df = build()
        path = write_staged(df, label)
    return read_staged(df, path)


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH_DEFAULT, BATCH_BYTES = "67108864b", "8m"


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that hands Python at most ``BATCH_BYTES`` at a time, unless it was set otherwise.

    Rows are whole documents, and each task holds a batch several times: as Spark's buffers, which double as they
    grow, on their way in and out, and in Python with what is computed from it.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        conf.set(_BATCH, BATCH_BYTES)
    return df
