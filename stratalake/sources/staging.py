"""Intermediate results written once and read back, which also cuts their lineage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from stratalake.session import work_dir
from stratalake.sources.files import delete

_scope: ContextVar[list[str] | None] = ContextVar("stage_scope", default=None)


PACKED = "zstd"  # for what is wide and read once or twice: fewer bytes for a little more time


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is written inside go when it is written, not when the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stage(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """``df`` as a parquet table in the shared work folder.

    Reading it back costs a scan instead of another run of the plan, and a lost
    executor takes nothing with it. Inside :func:`stage_scope` its files are
    released at the end of the scope; elsewhere they stay, as the frame returned
    may be read at any time.
    """
    return read_staged(df, write_staged(df, label, compression))


def write_staged(df: DataFrame, label: str, compression: str | None = None) -> str:
    """The path of ``df``, written."""
    path = work_dir(df.sparkSession, label)
    with tidy(df.sparkSession):
        (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return path


def read_staged(df: DataFrame, path: str) -> DataFrame:
    """``df``, from where it was written; the present scope releases it."""
    paths = _scope.get()
    if paths is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def observed(df: DataFrame, **measures: Column) -> tuple[DataFrame, Observation]:
    """``df``, and its aggregates as they are counted while it is written: no pass of their own.

    Only what is written next counts: the measures are taken in the last stage, where
    each partition is counted once, also if a task runs again.
    """
    found = Observation()
    return df.observe(found, *[c.alias(name) for name, c in measures.items()]), found


def stage_observed(df: DataFrame, label: str, compression: str | None = None, **measures: Column) -> tuple[DataFrame, dict]:
    """:func:`stage`, and the measures by name."""
    counted, found = observed(df, **measures)
    return stage(counted, label, compression), found.get


@contextmanager
def stage_scope(spark: SparkSession, apart: bool = False) -> Iterator[None]:
    """Release what is staged inside, once the results have been written elsewhere.

    An inner scope leaves its stages to the outer one, unless it is ``apart``.
    """
    if _scope.get() is not None and not apart:
        yield
        return
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in paths:
            delete(spark, path)
