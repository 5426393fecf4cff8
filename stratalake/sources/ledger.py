"""Load history: which files a table has already taken in."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.sizing import BROADCAST_BYTES, BROADCAST_ROWS
from stratalake.sources.csv_layer import FILE, REJECTED, read_csv_rows
from stratalake.sources.store import TableStore

_FILE = ["path", "length", "modified"]
LEDGER_SCHEMA = (
    T.StructType()
    .add("path", "string")
    .add("length", "long")
    .add("modified", "timestamp")
    .add("target", "string")
    .add("load_timestamp", "timestamp")
)

REJECT_SCHEMA = T.StructType().add("line", "string").add("file_name", "string").add("load_timestamp", "timestamp")
_ASIDE = "rejected"  # the side of a raw table that holds the lines which could not be loaded


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """path, length and change time of each file under a directory, prefix glob or file.

    The content column is not selected, so no file is opened. Paths are written as Spark's ``_metadata.file_path``, odd
    characters as in a URL.
    """
    kind = spark.read.format("binaryFile")
    try:
        found = kind.load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], T.StructType(LEDGER_SCHEMA.fields[:3]))
    file = F.col("_metadata")
    return found.select(file["file_path"].alias("path"), file["file_size"].alias("length"), file["file_modification_time"].alias("modified"))


def new_files(listing: DataFrame, ledger: DataFrame, force: bool = False) -> DataFrame:
    """Listed files the ledger lacks; a file changed since its load counts as new."""
    if force:
        return listing
    return listing.join(ledger.select(*_FILE), _FILE, "left_anti")


class FileLoader:
    """Loads CSV files into raw tables of a store, each file once unless forced.

    A load has a name. Its files are noted first, then its rows and rejected lines are written together;
    the raw table's pointer makes all of it valid at once. What a load that died has left is never read, and the load is
    simply done again. A raw table that was emptied or made anew has no loads, so its files load again.
    """

    def __init__(self, store: TableStore, ledger: tuple[str, str] = ("raw", "load_ledger")):
        self.store = store
        self.ledger = ledger
        if not store.exists(*ledger):
            store.create(*ledger, LEDGER_SCHEMA)

    def history(self, layer: str, table: str) -> DataFrame:
        """The files that the table's present loads took in."""
        loads = self.store.loads(layer, table) if self.store.exists(layer, table) else []
        return self.store.read(*self.ledger, loads=set(loads))

    def rejected(self, layer: str, table: str) -> DataFrame:
        """The lines of the table's files that could not be loaded (``REJECT_SCHEMA``)."""
        schema = T.StructType([T.StructField(REJECTED, T.StringType()), *REJECT_SCHEMA.fields[1:]])
        return self.store.read_side(layer, table, _ASIDE, schema).withColumnRenamed(REJECTED, "line")

    def load(
        self, layer: str, table: str, path: str, schema: T.StructType, columns, load_ts: Column, force: bool = False, **csv_options
    ) -> int:
        """Append the files' rows to ``layer.table`` and note the files; returns how many.

        ``path`` may be one file or a glob such as ``dir/visits*``. The files to load stay a table: the reader
        gets the path as it was given and the oldest change time among them, and rows of other files
        fall out in a join with that table. Each file is parsed once; the numbers of rows loaded and set aside are counted on the way
        and kept as marks of the table.
        """
        load = uuid.uuid4().hex
        fresh = new_files(list_files(self.store.spark, path), self.history(layer, table), force)
        fresh = fresh.select("*", F.lit(f"{layer}.{table}").alias("target"), load_ts.alias("load_timestamp"))
        oldest = F.min(F.unix_micros("modified"))
        noted = self.store.append(*self.ledger, fresh, load, measures={"oldest": oldest, "text": F.sum(F.octet_length("path").cast("long"))})
        if not noted["rows"]:
            return 0
        files = self.store.read(*self.ledger, loads={load}).select(*_FILE)
        before = datetime.fromtimestamp(noted["oldest"] // 1_000_000 - 1, timezone.utc)
        rows = read_csv_rows(self.store.spark, path, schema, columns, load_ts, modified_after=before, **csv_options)
        small = noted["rows"] <= BROADCAST_ROWS and noted["text"] <= BROADCAST_BYTES
        on = [F.col(FILE)[c] == files[c] for c in _FILE]
        rows = rows.join(F.broadcast(files) if small else files, on, "left_semi").drop(FILE)
        line = F.col(REJECTED)
        counts = {"set_aside": F.count(line)}
        marks = {"last_load": load, "files": noted["rows"]}
        self.store.append(layer, table, rows, load, marks, F.when(line.isNotNull(), _ASIDE), counts)
        return noted["rows"]


def glob_for(directory: str, prefix: str) -> str:
    """Every file whose name starts with ``prefix``."""
    return f"{directory.rstrip('/')}/{prefix}*"


def file_in(directory: str, name: str) -> str:
    """Exactly one file."""
    return f"{directory.rstrip('/')}/{name}"
