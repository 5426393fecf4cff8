"""The visit warehouse: files -> raw -> validated -> star schema -> reports."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.rules import BAD, INVALID, VALID, VALIDATED, RowCheck, negative_status, validate_struct
from stratalake.functions.rules import register_validation, text_status
from stratalake.functions.text import present
from stratalake.functions.values import amount, parse_amounts, std_date, total
from stratalake.operators.changes import adjust, differing, net_changes
from stratalake.operators.incremental import EPOCH, dedup_latest, incremental_filter, utc_day
from stratalake.operators.quality import Rule, assert_schema, conform, missing_id_rule, quality_measures, require, split_bad
from stratalake.operators.quality import quality_rows, violation_measures
from stratalake.operators.sizing import BROADCAST_ROWS
from stratalake.operators.star import DimRef, resolve_keys
from stratalake.operators.upsert import keyed_upsert
from stratalake.plans import kpi
from stratalake.plans.tables import CLEAN, CSV_PADDING, DEFINITIONS, RAW, VALIDATED as VALIDATED_LAYER
from stratalake.plans.tables import file_columns, schema_of
from stratalake.sources.csv_layer import physical_schema
from stratalake.sources.ledger import REJECT_SCHEMA, FileLoader, file_in, glob_for
from stratalake.sources.staging import PACKED, observed, stage, stage_observed, stage_scope
from stratalake.sources.store import PART, TableStore

# The visit checks, their labels, and the alert limit.
AMOUNTS = ("consultation_fee", "medicine_cost", "lab_cost")
VISIT_CHECK = RowCheck(
    id_col="patient_id",
    date_col="visit_date",
    amounts=AMOUNTS,
    lookups=(
        ("patient_id", "MISSING_PATIENT"),
        ("doctor_id", "MISSING_DOCTOR"),
        ("department_id", "MISSING_DEPARTMENT"),
    ),
)
ALERT_LIMIT = 1500
# The delivered files, and whether a file is taken in again on every load.
DELIVERY = {
    "raw_patient_visits": ("RAW_PATIENT_VISITS", False),
    "raw_diagnosis": ("RAW_DIAGNOSIS.csv", False),
    "raw_billing": ("RAW_BILLING.csv", True),
    "raw_dim_patient": ("RAW_DIM_PATIENT.csv", True),
    "raw_dim_doctor": ("RAW_DIM_DOCTOR.csv", True),
}
MERGE_KEYS = {
    "validated_patient_visits": "visit_id",
    "validated_dim_patient": "patient_id",
    "validated_dim_doctor": "doctor_id",
    "validated_billing": "bill_id",
    "validated_diagnosis": "diagnosis_id",
    "dim_patient": "patient_id",
    "dim_doctor": "doctor_id",
    "fact_patient_visits": "visit_id",
    "pending_keys": "visit_id",
}
# The status columns of the validated tables, and the words they may hold.
_RECORD, _BILLING = {"record_status": (VALID, INVALID, VALIDATED)}, {"billing_status": (VALID, INVALID)}
STATUSES = {
    "validated_patient_visits": {**_BILLING, **_RECORD},
    "validated_dim_patient": _RECORD,
    "validated_dim_doctor": _RECORD,
    "validated_billing": {**_BILLING, **_RECORD},
    "validated_diagnosis": _RECORD,
}
# Lines of any file that could not be loaded.
REJECTS = "rejected_lines"
# The dimensions of the fact: table, natural key, surrogate key.
DIMENSIONS = (("dim_patient", "patient_id", "patient_key"), ("dim_doctor", "doctor_id", "doctor_key"))
FACT, PENDING, CHANGES = "fact_patient_visits", "pending_keys", "fact_changes"
# So many rows for each folder surely fall into all folders.
MANY_ROWS = 10_000
# Layout only: raw tables are split by load day, so that the watermark skips whole directories.
LOAD_DAY = "load_date"


@dataclass(frozen=True)
class Feed:
    """How one validated table is made from its raw table.

    ``derived`` columns follow from ``columns`` that come before them, so they never decide which row of a key is the latest,
    and are made of that one only.
    """

    source: str
    target: str
    key: str
    required: Sequence[str]
    columns: Mapping[str, Column]
    derived: Mapping[str, Column]


def _kept() -> dict[str, tuple[str, dict[str, Column]]]:
    """Reports kept up to date: what they are grouped by, and the sums over the fact's rows of a group."""
    charges = F.col("total_charges")
    return {
        "visits_by_doctor": ("doctor_key", {"visits": F.lit(1), "revenue": charges, "amounts": charges.isNotNull().cast("long")}),
        "visits_by_patient": ("patient_key", {"visits": F.lit(1)}),
        "visits_by_day": ("visit_date", {"visits": F.lit(1)}),
    }


def _time(micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros))


def _unresolved() -> Column:
    """Whether a row names a patient or doctor whose key is not known."""
    return F.coalesce(*[F.when(F.col(key).isNull() & present(natural), True) for _, natural, key in DIMENSIONS], F.lit(False))


def _trimmed(*cols: str) -> dict[str, Column]:
    return {c: F.trim(F.col(c)) for c in cols}


def _feeds() -> dict[str, Feed]:
    v = F.col("__v")
    return {
        "patients": Feed(
            "raw_dim_patient",
            "validated_dim_patient",
            "patient_id",
            ("patient_id", "full_name"),
            _trimmed("patient_id", "full_name", "city"),
            {"record_status": F.lit(VALID)},
        ),
        "doctors": Feed(
            "raw_dim_doctor",
            "validated_dim_doctor",
            "doctor_id",
            ("doctor_id", "doctor_name"),
            _trimmed("doctor_id", "doctor_name", "department"),
            {"record_status": F.lit(VALID)},
        ),
        "visits": Feed(
            "raw_patient_visits",
            "validated_patient_visits",
            "visit_id",
            ("visit_id", "patient_id"),
            {
                **_trimmed("visit_id", "patient_id", "doctor_id", "department_id"),
                "visit_date": v["visit_date"],
                **{c: amount(c) for c in AMOUNTS},
            },
            {"total_charges": total(AMOUNTS), "billing_status": negative_status(AMOUNTS), "record_status": F.lit(VALIDATED)},
        ),
        "billing": Feed(
            "raw_billing",
            "validated_billing",
            "bill_id",
            ("bill_id", "visit_id"),
            {
                **_trimmed("bill_id", "visit_id"),
                "bill_amount": F.col("bill_amount"),
                "bill_date": std_date("bill_date"),
            },
            {"billing_status": negative_status(["bill_amount"]), "record_status": F.lit(VALIDATED)},
        ),
        "diagnoses": Feed(
            "raw_diagnosis",
            "validated_diagnosis",
            "diagnosis_id",
            ("diagnosis_id", "visit_id", "diagnosis"),
            _trimmed("diagnosis_id", "visit_id", "diagnosis", "notes"),
            {"record_status": text_status("diagnosis")},
        ),
    }


class VisitWarehouse:
    """All loads and reports over one store.

    ``watermark_policy``: ``merge_time`` compares raw load times with the time
    of the last merge; ``source_time`` with the newest raw load time a merge has
    taken in, so rows stamped before the last merge but after that time are still picked up;
    ``by_load`` takes in the raw loads that the target has not taken in yet, each once, whatever their rows' times.
    ``quarantine_policy``: ``incremental`` skips rows already quarantined,
    ``append`` writes all bad raw rows on every run.
    ``clock`` gives one time per load step. The merged tables are split into
    ``parts`` folders by natural key, and a merge rewrites only those its rows fall
    into: choose so many that a folder is a few GB at most. With ``keep_reports`` each merge into the fact notes what it
    changed, and :meth:`refresh_reports` brings the sums behind the reports up to date from that alone.

    Every step is done as a whole or not at all, with the note of what it took in; a load that died is done again.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        watermark_policy: str = "merge_time",
        quarantine_policy: str = "incremental",
        clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
        parts: int = 8,
        keep_reports: bool = False,
    ):
        if watermark_policy not in ("merge_time", "source_time", "by_load"):
            raise ValueError("watermark_policy is 'merge_time', 'source_time' or 'by_load'")
        if quarantine_policy not in ("incremental", "append"):
            raise ValueError("quarantine_policy is 'incremental' or 'append'")
        self.spark = spark
        self.store = TableStore(spark, root)
        self.watermark_policy = watermark_policy
        self.quarantine_policy = quarantine_policy
        self.clock = clock
        self.parts = parts
        self.keep_reports = keep_reports

    # -- tables ----------------------------------------------------------

    def create_tables(self, only: Collection[str] | None = None) -> None:
        """Create or replace every table, or the named ones, empty; files load again into a new raw table."""
        for layer, table in DEFINITIONS:
            if only is None or table in only:
                self._create(layer, table)
        if self.keep_reports and only is None:
            self._create_reports()

    def _create(self, layer: str, table: str) -> None:
        schema = schema_of(layer, table)
        if layer == RAW:
            schema = T.StructType([*schema.fields, T.StructField(LOAD_DAY, T.DateType())])
            self.store.create(layer, table, schema, [LOAD_DAY])
        elif table in MERGE_KEYS:
            self.store.create(layer, table, schema, parts=self.parts, part_keys=[MERGE_KEYS[table]])
        else:
            self.store.create(layer, table, schema)

    def _create_reports(self) -> None:
        """The changes of the fact, and for each kept report its sums."""
        fact = schema_of(CLEAN, FACT)
        image = T.StructType([T.StructField(f.name, f.dataType) for f in fact.fields if f.name not in ("visit_key", "visit_id")])
        self.store.create(CLEAN, CHANGES, T.StructType().add("visit_id", "string").add("old", image).add("new", image))
        blank = self.spark.createDataFrame([], fact)
        for name, (by, sums) in _kept().items():
            self.store.create(CLEAN, name, blank.groupBy(by).agg(*[F.sum(c).alias(s) for s, c in sums.items()]).schema)

    def table(self, layer: str, name: str) -> DataFrame:
        """Current content, without layout columns."""
        if (layer, name) == (RAW, REJECTS):
            return self._rejected()
        df = self.store.read(layer, name)
        return df.drop(LOAD_DAY) if layer == RAW else df

    def _rejected(self) -> DataFrame:
        """Lines that could not be loaded, of all raw tables."""
        loader = FileLoader(self.store)
        out = self.spark.createDataFrame([], T.StructType([*REJECT_SCHEMA.fields, T.StructField("target", T.StringType())]))
        for layer, table in DEFINITIONS:
            if layer == RAW and self.store.exists(RAW, table):
                out = out.unionByName(loader.rejected(RAW, table).withColumn("target", F.lit(f"{RAW}.{table}")))
        return out

    def truncate_raw(self, table: str = "raw_patient_visits") -> None:
        """Empty a raw table, so that its files load again. Never part of a load: rows not yet merged would be lost."""
        self.store.truncate(RAW, table)

    def register_sql(self) -> None:
        """Temporary views ``<layer>_<table>`` and the SQL function ``validate_visit``."""
        for layer, name in DEFINITIONS:
            self.table(layer, name).createOrReplaceTempView(f"{layer}_{name}")
        register_validation(self.spark, "validate_visit", VISIT_CHECK)

    def _now(self) -> int:
        """Microseconds."""
        return round(self.clock().timestamp() * 1_000_000)

    # -- files to raw ----------------------------------------------------

    def load_files(self, table: str, path: str, force: bool = False, **csv_options) -> int:
        """Load CSV files into a raw table, each once unless forced; returns the number loaded.

        Lines that cannot be loaded are kept: the table ``rejected_lines`` of the raw layer shows them.
        """
        now = _time(self._now())
        columns: dict[str, Column | None] = dict.fromkeys(file_columns(table))
        if table == "raw_billing":
            columns["bill_amount"] = amount("bill_amount")
        columns[LOAD_DAY] = utc_day(now)
        schema = physical_schema(file_columns(table), CSV_PADDING[table])
        limits = {f.name: f.metadata["max_length"] for f in schema_of(RAW, table).fields if "max_length" in f.metadata}
        limits = {c: n for c, n in limits.items() if c in file_columns(table)}
        return FileLoader(self.store).load(RAW, table, path, schema, columns, now, force, limits=limits, **csv_options)

    def load_directory(self, directory: str) -> dict[str, int]:
        """Load the five delivered files; a name without an ending stands for all files that start with it."""
        loaded = {}
        for table, (name, force) in DELIVERY.items():
            path = file_in(directory, name) if "." in name else glob_for(directory, name)
            loaded[table] = self.load_files(table, path, force)
        return loaded

    # -- raw to validated ------------------------------------------------

    def _bound(self, target: str) -> Column:
        """The raw load time up to which the target has taken rows in."""
        marks = self.store.marks(VALIDATED_LAYER, target)
        seen = marks.get("newest" if self.watermark_policy == "source_time" else "merged_at")
        return F.lit(EPOCH).cast("timestamp") if seen is None else _time(seen)

    def _new_loads(self, source: str, target: str) -> list[str]:
        """The raw loads that the target has not taken in: those of the one less those of the other."""
        taken = set(self.store.marks(VALIDATED_LAYER, target).get("taken", ()))
        return [load for load in self.store.loads(RAW, source) if load not in taken]

    def _new_raw(self, source: str, target: str) -> tuple[DataFrame, dict]:
        """The raw rows to take in, and the marks that say so."""
        if self.watermark_policy == "by_load":
            rows = self.store.read(RAW, source, loads=set(self._new_loads(source, target)))
            return rows, {"taken": self.store.loads(RAW, source)}
        return incremental_filter(self.store.read(RAW, source), "load_timestamp", self._bound(target), LOAD_DAY), {}

    def _checked(self, raw: DataFrame) -> DataFrame:
        """Raw visits with their amounts read and the validation struct ``__v``.

        Not written out: the good rows are read from it once, and the filter for bad ones goes before the parsing.
        """
        return parse_amounts(raw, AMOUNTS).withColumn("__v", validate_struct(VISIT_CHECK))

    def validate(self, feed_name: str) -> DataFrame:
        """Merge the new raw rows of one feed into its validated table.

        Order: required columns and watermark, then latest per trimmed key, then
        upsert. A later row that fails a filter never hides an earlier good one.
        """
        with stage_scope(self.spark):
            feed = _feeds()[feed_name]
            fresh, marks = self._new_raw(feed.source, feed.target)
            return self._validate(feed, self._checked(fresh) if feed_name == "visits" else fresh, self._now(), marks)

    def _validate(self, feed: Feed, fresh: DataFrame, now: int, marks: Mapping) -> DataFrame:
        rows = require(fresh, feed.required)
        if "__v" in fresh.columns:
            rows = rows.where(F.col("__v.status") != BAD)
        shaped = rows.select(
            *[e.alias(c) for c, e in feed.columns.items()],
            F.col("file_name").alias("source_file_name"),
            F.col("load_timestamp").alias("__loaded"),
        )
        schema = schema_of(VALIDATED_LAYER, feed.target)
        # all that has to be known of the rows is counted while they are merged; a broken constraint leaves the table as it was
        delta, observation = observed(
            dedup_latest(shaped, [feed.key], "__loaded").withColumns(feed.derived),
            rows=F.count(F.lit(1)),
            newest=F.unix_micros(F.max("__loaded")),
            **violation_measures(schema),
            **quality_measures(STATUSES[feed.target]),
        )

        def settle() -> Mapping | None:
            found = observation.get
            if not found["rows"]:
                return marks or None
            assert_schema(delta, schema, found)
            quality = quality_rows(STATUSES[feed.target], found)
            return {**marks, "newest": found["newest"], "merged_at": now, "quality": quality}

        source = conform(delta.withColumn("load_ts", _time(now)), schema)
        keys = require(fresh, feed.required).select(feed.columns[feed.key].alias(feed.key))
        n = self.store.rows(RAW, feed.source, set(self._new_loads(feed.source, feed.target))) if "taken" in marks else 0
        self.store.fold_in(VALIDATED_LAYER, feed.target, source, [feed.key], self._touched(VALIDATED_LAYER, feed.target, keys, n), settle)
        return self.store.read(VALIDATED_LAYER, feed.target)

    def _touched(self, layer: str, table: str, keys: DataFrame, rows: int = 0) -> Collection[int]:
        """The folders of a table that these keys fall into; none of an empty table.

        Of keys that are known to be many (``rows`` at least) it is all folders, without a look at them.
        """
        if not self.store.rows(layer, table):
            return set()
        if rows >= MANY_ROWS * self.parts:
            return self._every()
        counted, found = observed(keys, **self.store.touching(layer, table))
        counted.write.format("noop").mode("overwrite").save()
        return self.store.touched(found.get) or set()

    def last_quality(self, target: str) -> DataFrame:
        """Rows per status of the last merge into a validated table, as counted while they were written."""
        names = list(STATUSES[target])
        rows = self.store.marks(VALIDATED_LAYER, target).get("quality", [])
        return self.spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{c} string" for c in names) + ", row_count long")

    def quarantine(self, rules: Sequence[Rule] | None = None) -> DataFrame:
        """Copy bad raw visits, ids as delivered, beside what could be read from them."""
        with stage_scope(self.spark):
            if self.quarantine_policy == "incremental":
                raw, marks = self._new_raw("raw_patient_visits", "bad_patient_data")
            else:
                raw, marks = self.store.read(RAW, "raw_patient_visits"), {}
            return self._quarantine(self._checked(raw), self._now(), marks, rules)

    def _quarantine(self, raw: DataFrame, now: int, marks: Mapping, rules: Sequence[Rule] | None = None) -> DataFrame:
        target = "bad_patient_data"
        _, bad = split_bad(raw, rules or [missing_id_rule("patient_id")])
        v = F.col("__v")
        rows = bad.select(
            "visit_id",
            "patient_id",
            "doctor_id",
            "department_id",
            F.col("visit_date").alias("visit_date_raw"),
            v["visit_date"].alias("visit_date_std"),
            *AMOUNTS,
            v["total_charges"].alias("total_charges"),
            "error_reason",
            F.lit(BAD).alias("record_status"),
            F.col("file_name").alias("source_file_name"),
            _time(now).alias("load_ts"),
        )
        if self.watermark_policy == "source_time":
            marks = {**marks, "newest": raw.agg(F.unix_micros(F.max("load_timestamp"))).first()[0]}
        rows = conform(rows, schema_of(VALIDATED_LAYER, target))
        self.store.append(VALIDATED_LAYER, target, rows, marks=marks, measures={"merged_at": F.unix_micros(F.max("load_ts"))})
        return self.store.read(VALIDATED_LAYER, target)

    def _take_visits(self) -> None:
        """:meth:`quarantine` and :meth:`validate` of the visits, which are read and parsed once for both."""
        feed, bad = _feeds()["visits"], "bad_patient_data"
        if self.watermark_policy == "by_load":
            if self.quarantine_policy == "append" or self._new_loads(feed.source, feed.target) != self._new_loads(feed.source, bad):
                self.quarantine()
                self.validate("visits")
                return
            with stage_scope(self.spark):
                fresh, marks = self._new_raw(feed.source, feed.target)
                both = self._checked(fresh)
                self._quarantine(both, self._now(), marks)
                self._validate(feed, both, self._now(), marks)
            return
        with stage_scope(self.spark):
            since_bad = self._bound(bad) if self.quarantine_policy == "incremental" else F.lit(EPOCH).cast("timestamp")
            since_good = self._bound(feed.target)
            raw = self.store.read(RAW, feed.source)
            both = self._checked(incremental_filter(raw, "load_timestamp", F.least(since_bad, since_good), LOAD_DAY))
            self._quarantine(incremental_filter(both, "load_timestamp", since_bad), self._now(), {})
            self._validate(feed, incremental_filter(both, "load_timestamp", since_good), self._now(), {})

    # -- validated to star -----------------------------------------------

    def _promotable(self, source: str, target: str, since_last: bool) -> DataFrame | None:
        """The validated rows to merge into a table of the star; None if nothing is new."""
        rows = self.store.read(VALIDATED_LAYER, source)
        seen = self.store.marks(CLEAN, target).get("merged_at")
        if not since_last or seen is None:
            return rows
        newest = self.store.marks(VALIDATED_LAYER, source).get("merged_at")
        return incremental_filter(rows, "load_ts", _time(seen)) if newest is not None and newest > seen else None

    def load_dim(
        self, dim: str, source: str, natural_key: str, key_col: str, attrs: Sequence[str], since_last: bool = False
    ) -> DataFrame:
        """Load one dimension from its validated table.

        The whole table is merged again on each run; ``since_last`` limits that
        to rows merged since the dimension's own last load.
        """
        promoted = self._promotable(source, dim, since_last)
        if promoted is not None:
            now = self._now()
            rows = promoted.where(F.col("record_status") == VALID).select(natural_key, *attrs, _time(now).alias("load_ts"))
            self._merge_keyed(dim, rows, natural_key, key_col, source, {"merged_at": now}, None if since_last else self._every())
        return self.store.read(CLEAN, dim)

    def _every(self) -> range:
        """All folders of a merged table."""
        return range(self.parts)

    def _merge_keyed(self, table, rows, natural_key, key_col, source, marks, touched, note=None, load=None, beside=None, noting=None) -> None:
        """Merge rows into a table of the star, numbering the new ones; ``note`` gets what was changed.

        ``noting`` gets the merged rows' natural keys with the column ``beside``, and how often that is set.
        """
        top = self.store.marks(CLEAN, table).get("top_key", 0)

        def build(held: DataFrame, fresh: DataFrame, held_rows: int):
            n = held_rows + self.store.rows(VALIDATED_LAYER, source)
            merged = keyed_upsert(held, fresh, natural_key, key_col, PART, self.parts, n, top, images=note is not None, beside=beside)
            if noting is not None:
                noting(merged.beside, merged.noted)
            if note is not None:
                note(merged.changes)
            return merged.rows, {"top_key": top + merged.new}

        self.store.merge(CLEAN, table, rows, [natural_key], staged=True, touched=touched, build=build, load=load, marks=marks)

    def load_dims(self, since_last: bool = False) -> None:
        patient = ["full_name", "city", "source_file_name"]
        doctor = ["doctor_name", "department", "source_file_name"]
        self.load_dim("dim_patient", "validated_dim_patient", "patient_id", "patient_key", patient, since_last)
        self.load_dim("dim_doctor", "validated_dim_doctor", "doctor_id", "doctor_key", doctor, since_last)

    def load_visits_fact(self, promote_if: Column | None = None, since_last: bool = False) -> DataFrame:
        """Validated visits with their dimension keys; rows flagged ``INVALID`` go in too.

        Pass a stricter ``promote_if`` to keep those out. ``since_last`` merges only
        visits validated since the last load. Visits whose patient or doctor is not known yet are noted as
        pending; :meth:`resolve_pending` gives them their keys when the dimension row has come.
        """
        promoted = self._promotable("validated_patient_visits", FACT, since_last)
        if promoted is None:
            return self.store.read(CLEAN, FACT)
        now, load = self._now(), uuid.uuid4().hex
        promoted = promoted.where(F.col("record_status") == VALIDATED if promote_if is None else promote_if)
        promoted = promoted.select("visit_id", *[natural for _, natural, _ in DIMENSIONS], "visit_date", "total_charges", "source_file_name")
        dims = [DimRef(self.store.read(CLEAN, d), natural, key, rows=self.store.rows(CLEAN, d)) for d, natural, key in DIMENSIONS]
        pending = F.when(_unresolved(), F.struct(*[natural for _, natural, _ in DIMENSIONS])).alias("pending")
        rows = resolve_keys(promoted, dims).select(
            "visit_id", *[key for *_, key in DIMENSIONS], "visit_date", "total_charges", "source_file_name", _time(now).alias("load_ts"), pending
        )
        # what the last merge took in is new to the star
        last = sum(row[-1] for row in self.store.marks(VALIDATED_LAYER, "validated_patient_visits").get("quality", ()))
        touched = self._touched(CLEAN, FACT, promoted.select("visit_id"), last) if since_last else self._every()
        self._merge_keyed(
            FACT, rows, "visit_id", "visit_key", "validated_patient_visits", {"merged_at": now}, touched, self._noting(load), load,
            "pending", lambda merged, n: self._note_pending(merged, n, since_last),
        )
        return self.store.read(CLEAN, FACT)

    # -- keys that come later ---------------------------------------------

    def _note_pending(self, merged: DataFrame, pending: int, since_last: bool) -> None:
        """Replace the pending rows of these visits (``visit_id`` and ``pending``); before the fact itself, so that none is ever missing."""
        if not self.store.exists(CLEAN, PENDING):
            self._create(CLEAN, PENDING)
        held = self.store.rows(CLEAN, PENDING)
        if not pending and not held:
            return
        rows = merged.where("pending is not null").select("visit_id", "pending.*")
        seen = self._top_keys()  # what these rows were looked up in
        if since_last and held:
            before = self.store.read(CLEAN, PENDING)
            rows, seen = rows.unionByName(before.join(merged.select("visit_id"), "visit_id", "left_anti")), {}
        self.store.publish(CLEAN, PENDING, rows, marks=seen)

    def _top_keys(self) -> dict[str, int]:
        """The highest key in use of each dimension, by the key's name."""
        return {key: self.store.marks(CLEAN, dim).get("top_key", 0) for dim, _, key in DIMENSIONS}

    def resolve_pending(self) -> int:
        """Give visits their keys whose patient or doctor has come since; returns how many visits changed.

        Only dimension rows that are newer than the last time are joined, with the pending rows alone, and only the
        folders of the visits found are written.
        """
        if not self.store.exists(CLEAN, PENDING):
            return 0
        tops, seen = self._top_keys(), self.store.marks(CLEAN, PENDING)
        if not self.store.rows(CLEAN, PENDING) or all(tops[k] <= seen.get(k, 0) for k in tops):
            return 0
        now, load = self._now(), uuid.uuid4().hex
        with stage_scope(self.spark):
            pending = self.store.read(CLEAN, PENDING)
            hits = pending
            for dim, natural, key in DIMENSIONS:
                newer = self.store.read(CLEAN, dim).where(F.col(key) > seen.get(key, 0)).select(natural, F.col(key).alias(f"new_{key}"))
                small = tops[key] - seen.get(key, 0) <= BROADCAST_ROWS  # keys are dense, and names of 50 characters at most
                hits = hits.join(F.broadcast(newer) if small else newer, natural, "left")
            any_found = F.coalesce(*[F.col(f"new_{key}") for *_, key in DIMENSIONS]).isNotNull()
            hits, found = stage_observed(hits.where(any_found), "late-keys", rows=F.count(F.lit(1)), **self.store.touching(CLEAN, FACT))
            if found["rows"]:
                self._set_keys(hits, now, load, self.store.touched(found))
            # a row leaves when both of its keys are known, now or from before
            fact = self.store.matching(CLEAN, FACT, pending, ["visit_id"]).select("visit_id", *tops)
            left = pending.join(fact, "visit_id").where(_unresolved()).select(*pending.columns)
            self.store.publish(CLEAN, PENDING, left, marks=tops)
        return found["rows"]

    def _set_keys(self, hits: DataFrame, now: int, load: str, touched: Collection[int]) -> None:
        """Set the keys found on the rows of the fact that lack them."""
        held = self.store.matching(CLEAN, FACT, hits, ["visit_id"], touched)
        both = held.join(hits.select("visit_id", *[f"new_{key}" for *_, key in DIMENSIONS]), "visit_id")
        keys = {key: F.coalesce(F.col(key), F.col(f"new_{key}")) for *_, key in DIMENSIONS}
        changed = stage(both.withColumns({**{f"old_{c}": F.col(c) for c in keys}, **keys, "load_ts": _time(now)}), "with-keys", PACKED)
        old = [F.col(f"old_{c}").alias(c) if c in keys else F.col(c) for c in held.columns if c != "visit_key"]
        new = [F.col(c) for c in held.columns if c != "visit_key"]
        if (note := self._noting(load)) is not None:
            note(changed.select("visit_id", F.struct(*old).alias("old"), F.struct(*new).alias("new")))
        rows = changed.select(*held.columns)
        self.store.merge(CLEAN, FACT, rows, ["visit_id"], unique_rows=1, staged=True, touched=touched, load=load)

    def run(self, directory: str, since_last: bool = False) -> None:
        """Everything from the delivered files to the star schema, in order.

        With ``since_last`` the star takes only what was validated since its last load; keys that were missing then are set as their
        dimension rows come.
        """
        self.load_directory(directory)
        for feed in ("patients", "doctors"):
            self.validate(feed)
        self._take_visits()
        for feed in ("billing", "diagnoses"):
            self.validate(feed)
        self.load_dims(since_last)
        if since_last:
            self.resolve_pending()
        self.load_visits_fact(since_last=since_last)
        if self.keep_reports:
            self.refresh_reports()

    # -- reports kept up to date ------------------------------------------

    def _noting(self, load: str) -> Callable[[DataFrame], None] | None:
        """Notes the changes of a merge under its name, before the merge itself: without it they are never read."""
        if not self.keep_reports:
            return None
        if not self.store.exists(CLEAN, CHANGES):
            self._create_reports()
        columns = [f.name for f in self.store.read(CLEAN, CHANGES).schema["new"].dataType.fields]

        def note(changes: DataFrame) -> None:
            images = [F.when(F.col(i).isNotNull(), F.struct(*[F.col(f"{i}.{c}").alias(c) for c in columns])).alias(i) for i in ("old", "new")]
            rows = differing(changes.select("visit_id", *images), ["load_ts", "source_file_name"])
            self.store.append(CLEAN, CHANGES, rows, load)

        return note

    def refresh_reports(self) -> None:
        """Bring the sums behind the reports up to date: rows that changed are taken off as they were and added as they are."""
        merges = self.store.loads(CLEAN, FACT)
        for name, (by, sums) in _kept().items():
            taken = set(self.store.marks(CLEAN, name).get("taken", ()))
            fresh = {load for load in merges if load not in taken}
            if not fresh:
                continue
            net = net_changes(self.store.read(CLEAN, CHANGES, loads=fresh), by, sums)
            held = self.store.read(CLEAN, name)
            self.store.publish(CLEAN, name, adjust(held, net, by, list(sums), "visits"), marks={"taken": merges})

    def kept_sums(self, by: str) -> DataFrame:
        """The kept sums per ``by``: ``doctor_key``, ``patient_key`` or ``visit_date``."""
        return self.store.read(CLEAN, next(name for name, (key, _) in _kept().items() if key == by))

    def kept_doctor_productivity(self) -> DataFrame:
        """:meth:`doctor_productivity` from the kept sums."""
        return kpi.group_sums(self.kept_sums("doctor_key"), self._dim("dim_doctor"), "doctor_key", "doctor_name", True, ["total_visits", "total_revenue"])

    def kept_department_performance(self) -> DataFrame:
        """:meth:`department_performance` from the kept sums."""
        return kpi.group_sums(self.kept_sums("doctor_key"), self._dim("dim_doctor"), "doctor_key", "department", True, ["total_revenue"])

    def kept_repeat_patients(self) -> DataFrame:
        """:meth:`repeat_patients` from the kept sums."""
        return kpi.group_sums(self.kept_sums("patient_key"), self._dim("dim_patient"), "patient_key", "full_name", False, ["total_visits"])

    def kept_daily_trend(self) -> DataFrame:
        """:meth:`daily_trend` from the kept sums."""
        return self.kept_sums("visit_date").select("visit_date", F.col("visits").alias("total_visits"))

    # -- reports ---------------------------------------------------------

    def _fact(self) -> DataFrame:
        return self.store.read(CLEAN, "fact_patient_visits")

    def _dim(self, name: str) -> DataFrame:
        return self.store.read(CLEAN, name)

    def doctor_productivity(self) -> DataFrame:
        return kpi.group_kpi(
            self._fact(),
            self._dim("dim_doctor"),
            "doctor_key",
            "doctor_name",
            "visit_id",
            "total_charges",
            sort=["total_visits", "total_revenue"],
        )

    def average_revenue_per_visit(self) -> DataFrame:
        return kpi.average_kpi(self._fact(), self._dim("dim_doctor"), "doctor_key", "doctor_name", "total_charges")

    def high_billing_alerts(self, limit: float = ALERT_LIMIT) -> DataFrame:
        return kpi.alerts(self._fact(), "total_charges", limit, ["visit_id"])

    def department_performance(self) -> DataFrame:
        return kpi.group_kpi(
            self._fact(),
            self._dim("dim_doctor"),
            "doctor_key",
            "department",
            "visit_id",
            "total_charges",
            sort=["total_revenue"],
        )

    def top_departments(self, n: int = 3) -> DataFrame:
        return kpi.top_n(self.department_performance(), "total_revenue", n, "department")

    def repeat_patients(self) -> DataFrame:
        return kpi.group_kpi(
            self._fact(), self._dim("dim_patient"), "patient_key", "full_name", "visit_key", sort=["total_visits"]
        )

    def daily_trend(self) -> DataFrame:
        return kpi.trend(self._fact(), "visit_date")

    def peak_days(self, n: int = 1) -> DataFrame:
        return kpi.peak(self.daily_trend(), n, "visit_date")
