"""Tables as parquet files below ``<root>/<layer>/<table>/``: create, read, append, merge, replace.

Every write goes to a folder of its own, and a small JSON pointer then names the folders that are
the table. The pointer has two slots, written in turn: a writer that dies, before the pointer or in it, leaves the
old content, so a write is done as a whole or not at all and can be done again. Tables that
are merged by key are split into folders by a hash of the key; a merge writes only
the folders its rows fall into, to a new place. What the last pointer no longer names stays for one more write, for
those still reading, and is then removed.

A write may carry the name of a ``load`` and ``marks``; both become visible with it. Files are only reached through
Spark and its file system, so any that Spark knows will do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.upsert import PIECE, check_source, piece, upsert, upsert_parts
from stratalake.sources.files import delete, folders, read_text, write_text
from stratalake.sources.staging import PACKED, observed, stage, stage_scope, tidy

WRITE, PART, SIDE = "__write", "__part", "__side"
OWN = "rows"  # the side that is the table itself
_BITS = 48  # folders noted in one number
MANY_PARTS = 64  # of more folders a task writes a few only, so that files stay few


class TableStore:
    """Create, read and write the tables of a layered warehouse.

    One writer at a time per table. A store remembers the pointers it has read or
    written; :meth:`refresh` makes it look again for what another one wrote.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._pointers: dict[tuple[str, str], dict] = {}

    def refresh(self) -> None:
        self._pointers.clear()

    # -- reading ---------------------------------------------------------

    def exists(self, layer: str, table: str) -> bool:
        return self._pointer(layer, table) is not None

    def read(self, layer: str, table: str, loads: Collection[str] | None = None) -> DataFrame:
        """The present content, or that of some loads."""
        pointer = self._known(layer, table)
        wanted = [w for w in _own(pointer) if loads is None or w.get("load") in loads]
        return self._files(layer, table, pointer, wanted).select(*_schema(pointer).names)

    def read_side(self, layer: str, table: str, side: str, schema: T.StructType) -> DataFrame:
        """The rows that were set aside under a name when they were appended."""
        pointer = self._known(layer, table)
        writes = [w for w in pointer["writes"] if w.get("side") == side]
        return self._files(layer, table, pointer | {"schema": schema.jsonValue()}, writes).select(*schema.names)

    def matching(
        self, layer: str, table: str, source: DataFrame, keys: Sequence[str], touched: Collection[int] | None = None
    ) -> DataFrame:
        """The rows that hold a key of ``source``; of a table split by the keys only their folders are read (``touched``, if known)."""
        pointer = self._known(layer, table)
        writes = _own(pointer)
        if pointer["parts"] and pointer["part_keys"] == list(keys):
            touched = _touched(source, keys, pointer["parts"]) if touched is None else touched
            writes = [w for w in writes if w["part"] in touched]
        held = self._files(layer, table, pointer, writes).select(*_schema(pointer).names)
        return held.join(source.select(*keys).distinct(), list(keys), "left_semi").select(*_schema(pointer).names)

    def rows(self, layer: str, table: str, loads: Collection[str] | None = None) -> int:
        """How many rows the table, or some loads of it, has, as counted when they were written."""
        return sum(w["rows"] for w in _own(self._known(layer, table)) if loads is None or w.get("load") in loads)

    def loads(self, layer: str, table: str) -> list[str]:
        """The names of the loads that the table has taken in, in order."""
        return list(self._known(layer, table)["loads"])

    def marks(self, layer: str, table: str) -> dict:
        """What the writes noted beside the rows."""
        return dict(self._known(layer, table)["marks"])

    def register_view(self, layer: str, table: str, name: str | None = None) -> None:
        """Offer the present content to SQL as a temporary view."""
        self.read(layer, table).createOrReplaceTempView(name or f"{layer}_{table}")

    # -- writing ---------------------------------------------------------

    def create(
        self,
        layer: str,
        table: str,
        schema: T.StructType,
        partition_by: Sequence[str] = (),
        parts: int | None = None,
        part_keys: Sequence[str] = (),
    ) -> None:
        """Create the table, or replace it by an empty one.

        ``partition_by`` splits the files by columns; ``parts`` into so many
        folders by a hash of ``part_keys``, for a table that is merged by them.
        """
        pointer = {"schema": schema.jsonValue(), "partition_by": list(partition_by), "parts": parts, "part_keys": list(part_keys)}
        self._point(layer, table, {**pointer, "writes": [], "loads": [], "marks": {}})

    def publish(self, layer: str, table: str, df: DataFrame, load: str | None = None, marks: Mapping | None = None) -> None:
        """Replace the content, and the columns, in the same layout; ``df`` may read the table."""
        pointer = self._known(layer, table) | {"schema": df.schema.jsonValue()}
        writes, _ = self._write(layer, table, pointer, df)
        self._point(layer, table, pointer | {"writes": writes}, load, marks)

    def append(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        load: str | None = None,
        marks: Mapping | None = None,
        side: Column | None = None,
        measures: Mapping[str, Column] | None = None,
    ) -> dict:
        """Add rows, matched by name, and return the ``measures`` and the number of ``rows``, taken as they are written.

        Rows for which ``side`` is a name are set aside under it, with all columns of ``df``, in the same write.
        The measures are kept as marks. Without rows and marks the table stays as it is.
        """
        pointer = self._known(layer, table)
        if pointer["parts"]:
            raise ValueError(f"{layer}.{table} is split by key: merge into it")
        fields = _schema(pointer).fields
        more = [c for c in df.columns if side is not None and c not in _schema(pointer).names]
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in fields], *more)
        load = load or uuid.uuid4().hex
        writes, found = self._write(layer, table, pointer, rows, load, side, measures)
        if writes or marks:
            kept = {**(marks or {}), **{m: found[m] for m in measures or {} if found[m] is not None}}
            self._point(layer, table, pointer | {"writes": pointer["writes"] + writes}, load, kept)
        return found

    def merge(
        self,
        layer: str,
        table: str,
        source: DataFrame,
        keys: Sequence[str],
        update: Sequence[str] | None = None,
        insert: Sequence[str] | None = None,
        unique_rows: int | None = None,
        staged: bool = False,
        touched: Collection[int] | None = None,
        build: Callable[[DataFrame, DataFrame, int], tuple[DataFrame, Mapping]] | None = None,
        load: str | None = None,
        marks: Mapping | None = None,
    ) -> None:
        """Upsert ``source`` (see :func:`~stratalake.operators.upsert.upsert`).

        It is read several times, and so written out first unless it is ``staged`` already.

        In a table split by the same keys only the folders that the source's
        keys hash to are read and written anew; ``touched`` names them if they are known (:meth:`touching`).
        ``build`` makes another merge than an upsert: from those folders' rows, the source, both with their folder in
        ``PART``, and how many the former are, it makes the new rows and marks; it sees to unique keys itself.
        """
        pointer = self._known(layer, table)
        with stage_scope(self.spark):
            source = source if staged else stage(source, f"{table}-source")
            if not pointer["parts"] or pointer["part_keys"] != list(keys):
                merged = upsert(self.read(layer, table), source, keys, update, insert, unique_rows, target_rows=self.rows(layer, table))
                writes, _ = self._write(layer, table, pointer, merged)
                self._point(layer, table, pointer | {"writes": writes}, load, marks)
                return
            if unique_rows is None and build is None:
                check_source(source, keys)
            if touched is None:
                touched = _touched(source, keys, pointer["parts"]) if pointer["writes"] else ()
            old, kept = ([w for w in pointer["writes"] if (w["part"] in touched) == is_old] for is_old in (True, False))
            held = self._files(layer, table, pointer, old).select(*_schema(pointer).names, PART)
            source = source.withColumn(PART, _part(keys, pointer["parts"]))
            more: Mapping = {}
            if build is not None:
                merged, more = build(held, source, sum(w["rows"] for w in old))
            elif old:
                merged = upsert_parts(held, source, keys, PART, pointer["parts"], update, insert)
            else:
                merged = upsert(held, source, keys, update, insert, unique_rows or 0, target_rows=0)
            # what comes from a fold is dealt by part already
            writes, _ = self._write(layer, table, pointer, merged, dealt=build is not None or bool(old))
            self._point(layer, table, pointer | {"writes": kept + writes}, load, {**(marks or {}), **more})

    def fold_in(
        self,
        layer: str,
        table: str,
        source: DataFrame,
        keys: Sequence[str],
        touched: Collection[int],
        settle: Callable[[], Mapping | None],
        load: str | None = None,
    ) -> None:
        """Upsert ``source``, which is read once and may be dealt by the keys already: each key once, all columns given.

        A full join takes it as it is dealt, so only the rows of the folders in ``touched`` are shuffled for it. When the rows are written,
        ``settle`` says what to note as marks, or None if there is nothing to take in; if it raises, the table stays as it was.
        """
        pointer, keys = self._known(layer, table), list(keys)
        if not pointer["parts"] or pointer["part_keys"] != keys:
            raise ValueError(f"{layer}.{table} is not split by {keys}")
        names = _schema(pointer).names
        old, kept = ([w for w in pointer["writes"] if (w["part"] in touched) == is_old] for is_old in (True, False))
        merged = source.select(*names)
        if old:
            rest = [c for c in names if c not in keys]
            new = merged.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in rest], F.lit(True).alias("__there"))
            value = lambda c: F.when(F.col("__there"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c)
            both = self._files(layer, table, pointer, old).select(*names).join(new, keys, "full")
            merged = both.select(*[F.col(c) if c in keys else value(c) for c in names])
        spread = pointer["parts"] <= MANY_PARTS
        if spread:
            merged = merged.withColumn(PART, _part(keys, pointer["parts"]))
        writes, _ = self._write(layer, table, pointer, merged, dealt=spread)
        try:
            marks = settle()
        except Exception:
            self._discard(layer, table, writes)
            raise
        if marks is None:
            self._discard(layer, table, writes)
        else:
            self._point(layer, table, pointer | {"writes": kept + writes}, load, marks)

    def _discard(self, layer: str, table: str, writes: Sequence[Mapping]) -> None:
        for folder in {w["path"].split("/")[0] for w in writes}:
            delete(self.spark, self._path(layer, table, folder))

    def touching(self, layer: str, table: str) -> dict[str, Column]:
        """Measures of a merge's source from which :meth:`touched` reads the folders it falls into."""
        pointer = self._known(layer, table)
        if not pointer["parts"]:
            return {}
        part = _part(pointer["part_keys"], pointer["parts"])
        bit = F.pow(F.lit(2.0), part % _BITS).cast("long")
        words = range(-(-pointer["parts"] // _BITS))
        return {f"folders{i}": F.bit_or(F.when(F.floor(part / _BITS) == i, bit).otherwise(0)) for i in words}

    @staticmethod
    def touched(measured: Mapping) -> set[int] | None:
        """The folders, from what :meth:`touching` measured; None if it measured nothing."""
        words = {int(k[7:]): v or 0 for k, v in measured.items() if k.startswith("folders")}
        return {_BITS * i + b for i, word in words.items() for b in range(_BITS) if word >> b & 1} if words else None

    def mark(self, layer: str, table: str, marks: Mapping) -> None:
        """Note something beside the rows."""
        self._point(layer, table, self._known(layer, table), marks=marks)

    def truncate(self, layer: str, table: str) -> None:
        """Empty the table; its columns and layout stay."""
        self._point(layer, table, self._known(layer, table) | {"writes": [], "loads": [], "marks": {}})

    def drop_column(self, layer: str, table: str, col: str) -> None:
        """Take one column out of the table; files written before are not read for it any more."""
        pointer = self._known(layer, table)
        schema = T.StructType([f for f in _schema(pointer).fields if f.name != col])
        self._point(layer, table, pointer | {"schema": schema.jsonValue()})

    # -- files -----------------------------------------------------------

    def _path(self, layer: str, table: str, name: str) -> str:
        return f"{self.root}/{layer}/{table}/{name}"

    def _known(self, layer: str, table: str) -> dict:
        pointer = self._pointer(layer, table)
        if pointer is None:
            raise LookupError(f"no table {layer}.{table} in {self.root}")
        return pointer

    def _pointer(self, layer: str, table: str) -> dict | None:
        if (layer, table) not in self._pointers:
            found = []
            for slot in (0, 1):
                try:
                    found.append(json.loads(read_text(self.spark, self._path(layer, table, f"pointer-{slot}.json")) or "null"))
                except json.JSONDecodeError:  # a writer died in this slot; the other one holds
                    pass
            found = [p for p in found if p]
            if not found:
                return None
            self._pointers[layer, table] = max(found, key=lambda p: p["turn"])
        return self._pointers[layer, table]

    def _point(self, layer: str, table: str, pointer: dict, load: str | None = None, marks: Mapping | None = None) -> None:
        before = self._pointer(layer, table) or {"turn": -1, "writes": [], "left": []}
        named = {w["path"] for w in pointer["writes"]}
        pointer = pointer | {
            "turn": before["turn"] + 1,
            "left": [w["path"] for w in before["writes"] if w["path"] not in named],
            "loads": pointer["loads"] + ([load] if load else []),
            "marks": {**pointer["marks"], **(marks or {})},
        }
        write_text(self.spark, self._path(layer, table, f"pointer-{pointer['turn'] % 2}.json"), json.dumps(pointer))
        self._pointers[layer, table] = pointer
        for path in before["left"]:
            delete(self.spark, self._path(layer, table, path))

    def _write(
        self,
        layer: str,
        table: str,
        pointer: dict,
        df: DataFrame,
        load: str | None = None,
        side: Column | None = None,
        measures: Mapping[str, Column] | None = None,
        dealt: bool = False,
    ) -> tuple[list[dict], dict]:
        """Write rows to a new folder: its entries for the pointer (none without rows), and what was measured on the way."""
        name, note = f"{WRITE}={uuid.uuid4().hex[:12]}", {"load": load} if load else {}
        path, parts, own = self._path(layer, table, name), pointer["parts"], f"{SIDE}={OWN}"
        counts = {"every": F.count(F.lit(1)), **({} if side is None else {"rows": F.count_if(side.isNull())})}
        if parts and not dealt:
            keys = pointer["part_keys"]
            df = df.withColumns({PART: _part(keys, parts), PIECE: piece(df, keys, parts)}).repartition(PART, PIECE).drop(PIECE)
        counted, observation = observed(df, **counts, **(measures or {}))
        out = counted if side is None else counted.withColumn(SIDE, F.coalesce(side, F.lit(OWN)))
        folders_by = [PART] if parts else [*([] if side is None else [SIDE]), *pointer["partition_by"]]
        with tidy(self.spark):
            out.write.option("compression", PACKED).partitionBy(*folders_by).parquet(path if parts or side is not None else f"{path}/{own}")
        found = {"rows": observation.get["every"], **observation.get}
        if not found["every"]:
            delete(self.spark, path)
            return [], found
        made = [f for f in folders(self.spark, path) if f.startswith((PART, SIDE))]
        # keys are hashed, so the rows of the parts are even; only their sum is exact
        sizes = [found["rows"] * (i + 1) // len(made) - found["rows"] * i // len(made) for i in range(len(made))]
        if parts:
            return [{"path": f"{name}/{f}", "part": int(f.split("=")[1]), "rows": n, **note} for f, n in zip(made, sizes)], found
        return [{"path": f"{name}/{f}", "side": f.split("=")[1], "rows": found["rows"], **note} for f in made], found

    def _files(self, layer: str, table: str, pointer: dict, writes: Sequence[Mapping]) -> DataFrame:
        schema = _schema(pointer)
        # columns that only lay out the files, read from their paths
        layout = [T.StructField(WRITE, T.StringType())]
        layout.append(T.StructField(PART, T.IntegerType()) if pointer["parts"] else T.StructField(SIDE, T.StringType()))
        if not writes:
            return self.spark.createDataFrame([], T.StructType([*schema.fields, *layout]))
        base = self._path(layer, table, "").rstrip("/")
        reader = self.spark.read.schema(T.StructType([*schema.fields, *layout])).option("basePath", base)
        return reader.parquet(*[f"{base}/{w['path']}" for w in writes])


def _schema(pointer: Mapping) -> T.StructType:
    return T.StructType.fromJson(pointer["schema"])


def _own(pointer: Mapping) -> list[dict]:
    """The writes that are the table itself."""
    return [w for w in pointer["writes"] if w.get("side", OWN) == OWN]


def _touched(source: DataFrame, keys: Sequence[str], parts: int) -> set[int]:
    """The folders the source's keys fall into: at most ``parts`` numbers."""
    return {r[0] for r in source.select(_part(keys, parts)).distinct().collect()}


def _part(keys: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int").alias(PART)
