"""Incremental, dedup, upsert, star-load and lookup queries.

First loads and deltas are cut from the tables by their own dates, states and
balances, as a feed would: orders before a day are the earlier load, orders in
some states come again changed, and so on.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from stratalake.functions.rules import BAD, VALIDATED, validate_struct
from stratalake.functions.values import amount, parse_amounts
from stratalake.operators.incremental import dedup_latest, incremental_filter, watermark
from stratalake.operators.quality import require
from stratalake.operators.star import DimRef, load_dimension, load_fact, orphans, resolve_keys, with_match
from stratalake.operators.upsert import assign_keys, upsert
from stratalake.plans import kpi
from stratalake.plans.visits import AMOUNTS, VISIT_CHECK, VisitWarehouse
from stratalake.registry.roles import DOCTOR_SQL, MONEY, RAW_SQL, STATUS_SQL, amount_sql, date_sql, doctor_dim
from stratalake.registry.roles import missing_sql, raw_visits, sum_sql, table
from stratalake.session import work_dir
from stratalake.sources.staging import stage

# -- dedup and watermark ---------------------------------------------------

_LINE = ["l_orderkey", "l_linenumber"]
_LINE_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LINE_REST += ["l_returnflag", "l_linestatus"]


def dedup_lines(spark, d):
    return dedup_latest(table(spark, d, "lineitem"), _LINE, "l_shipdate", _LINE_REST)


def dedup_events(spark, d):
    return dedup_latest(table(spark, d, "events"), ["user_id"], "ts", ["event_id"])


def dedup_hot_key(spark, d):
    """A handful of keys share all the rows."""
    return dedup_latest(table(spark, d, "events"), ["event_type"], "ts", ["event_id"])


def dedup_trimmed_key(spark, d):
    rows = raw_visits(spark, d).withColumn("visit_id", F.trim("visit_id")).select("visit_id", "visit_date", "lab_cost")
    return dedup_latest(rows, ["visit_id"], "visit_date")


def new_events(spark, d):
    events = table(spark, d, "events")
    loaded = events.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    return incremental_filter(events, "ts", watermark(loaded, "ts"))


def new_events_empty_target(spark, d):
    events = table(spark, d, "events")
    loaded = events.where(F.col("value") < 0)
    return incremental_filter(events, "ts", watermark(loaded, "ts"))


# -- upsert ----------------------------------------------------------------

_EARLY = "1999-01-01"


def _orders(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast(MONEY).alias("price"), "o_orderdate"
    )


def _loaded_orders(spark, d):
    return _orders(spark, d).where(F.col("o_orderdate") < F.lit(_EARLY).cast("timestamp_ntz"))


def _order_delta(spark, d):
    """Open orders changed, and all orders of the later days."""
    late = F.col("o_orderdate") >= F.lit(_EARLY).cast("timestamp_ntz")
    changed = _orders(spark, d).where((F.col("o_orderstatus") != "F") | late)
    return changed.withColumn("price", (F.col("price") + 100).cast(MONEY))


def upsert_orders(spark, d):
    """The path for a small delta, taken here whatever its share of the target."""
    return upsert(_loaded_orders(spark, d), _order_delta(spark, d), ["o_orderkey"], factor=0)


def upsert_orders_large(spark, d):
    """The path for a delta too large to broadcast."""
    return upsert(_loaded_orders(spark, d), _order_delta(spark, d), ["o_orderkey"], broadcast_keys=0)


def _some_columns(spark, d, **how):
    delta = _order_delta(spark, d).withColumn("o_orderstatus", F.lit("X")).drop("o_custkey")
    return upsert(_loaded_orders(spark, d), delta, ["o_orderkey"], update=["price"], **how)


def upsert_some_columns(spark, d):
    return _some_columns(spark, d, factor=0)


def upsert_some_columns_large(spark, d):
    return _some_columns(spark, d, broadcast_keys=0)


def upsert_twice(spark, d):
    delta = _order_delta(spark, d)
    return upsert(upsert(_loaded_orders(spark, d), delta, ["o_orderkey"]), delta, ["o_orderkey"])


def merge_visits(spark, d):
    """Filter, rank, keep one, upsert: visits of the later days, and negative ones again, onto those before a day."""
    rows = require(raw_visits(spark, d), ["visit_id", "patient_id"])
    rows = parse_amounts(rows, AMOUNTS).withColumn("v", validate_struct(VISIT_CHECK)).where(F.col("v.status") != BAD)
    shaped = rows.select(
        F.trim("visit_id").alias("visit_id"),
        F.trim("patient_id").alias("patient_id"),
        F.col("v.visit_date").alias("visit_date"),
        *[amount(c).alias(c) for c in AMOUNTS],
        F.col("v.total_charges").alias("total_charges"),
        F.col("v.status").alias("billing_status"),
    )
    latest = stage(dedup_latest(shaped, ["visit_id"], "visit_date"), "visits")
    before = latest.where(F.col("visit_date") < F.lit(_EARLY).cast("date")).withColumn("billing_status", F.lit("OLD"))
    undated_or_late = ~F.coalesce(F.col("visit_date") < F.lit(_EARLY).cast("date"), F.lit(False))
    return upsert(before, latest.where((F.col("billing_status") == "INVALID") | undated_or_late), ["visit_id"])


# -- star ------------------------------------------------------------------


def _customers(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")


def _customer_dim(spark, d):
    """Customers with money in the account, loaded earlier under an old name."""
    early = _customers(spark, d).where(F.col("c_acctbal") > 0).withColumn("c_name", F.lit("old"))
    keyed = assign_keys(early, "c_custkey", "customer_key")
    return stage(keyed.select("customer_key", "c_custkey", "c_name", "c_mktsegment"), "customer-dim")


def _reloaded_dim(spark, d, dim):
    return load_dimension(
        dim, _customers(spark, d), "c_custkey", "customer_key", ["c_name"], promote_if=F.col("c_mktsegment") != "MACHINERY"
    )


def dimension_load(spark, d):
    return _reloaded_dim(spark, d, _customer_dim(spark, d)).select("c_custkey", "c_name", "c_mktsegment")


def surrogate_key_properties(spark, d):
    k = F.col("customer_key")
    return assign_keys(_customers(spark, d), "c_custkey", "customer_key", start_after=100).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct(k).alias("keys"),
        F.min(k).alias("lowest"),
        F.max(k).alias("highest"),
    )


def surrogate_key_stable(spark, d):
    """Keys held before a second load against the same customers' keys after it, and the new ones."""
    dim = _customer_dim(spark, d)
    held = dim.select("c_custkey", F.col("customer_key").alias("before"))
    both = _reloaded_dim(spark, d, dim).join(held, "c_custkey", "left")
    known = F.col("before").isNotNull()
    return both.agg(
        F.count_if(known & (F.col("before") != F.col("customer_key"))).alias("changed_keys"),
        F.count_if(~known).alias("new_keys"),
        (F.max("customer_key") - F.max("before")).alias("key_growth"),
        F.countDistinct("customer_key").alias("keys"),
    )


def _part_dim(spark, d):
    """Parts above a size: visits to the smaller ones find no patient."""
    parts = table(spark, d, "part").where(F.col("p_size") > 10)
    return stage(assign_keys(parts.select("p_partkey", "p_brand"), "p_partkey", "patient_key"), "part-dim")


def _supplier_dim(spark, d):
    rows = table(spark, d, "supplier").where(F.col("s_acctbal") >= 0)
    return stage(assign_keys(rows.select("s_suppkey", "s_name"), "s_suppkey", "doctor_key"), "supplier-dim")


def _visits(spark, d):
    return (
        table(spark, d, "lineitem")
        .select(
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("visit_id"),
            "l_partkey",
            "l_suppkey",
            F.col("l_extendedprice").cast(MONEY).alias("total_charges"),
            F.col("l_shipdate").cast("date").alias("visit_date"),
        )
        .transform(lambda v: stage(dedup_latest(v, ["visit_id"], "visit_date"), "visits"))
    )


def _dim_refs(spark, d):
    return [
        DimRef(_part_dim(spark, d), "p_partkey", "patient_key", "l_partkey"),
        DimRef(_supplier_dim(spark, d), "s_suppkey", "doctor_key", "l_suppkey"),
    ]


def _natural(keyed, dims):
    """Surrogate keys turned back into the natural ones, to compare with plain SQL."""
    for ref in dims:
        keyed = keyed.join(ref.dim.select(ref.key_col, ref.natural_key), ref.key_col, "left")
    return keyed.select("visit_id", "p_partkey", "s_suppkey", "total_charges", "visit_date")


def resolve_dimension_keys(spark, d):
    dims = _dim_refs(spark, d)
    return _natural(resolve_keys(_visits(spark, d), dims), dims)


def resolve_dimension_keys_large(spark, d):
    """The path for dimensions too large to broadcast; a supplier above 1/50 of the rows counts as hot."""
    dims = _dim_refs(spark, d)
    return _natural(resolve_keys(_visits(spark, d), dims, broadcast_rows=0, hot_share=50), dims)


def fact_load(spark, d):
    """Visits before a day, then all of them, into one fact."""
    dims, visits = _dim_refs(spark, d), _visits(spark, d)
    first = visits.where(F.col("visit_date") < F.lit(_EARLY).cast("date"))
    held = assign_keys(resolve_keys(first, dims), "visit_id", "visit_key").select(
        "visit_key", "visit_id", "patient_key", "doctor_key", "visit_date", F.lit(0).cast(MONEY).alias("total_charges")
    )
    measures = ["visit_date", "total_charges"]
    fact = load_fact(stage(held, "fact"), visits, dims, "visit_id", "visit_key", measures, trusted=True)
    return _natural(fact, dims)


def lookup_orphans(spark, d):
    return orphans(table(spark, d, "orders"), _solvent(spark, d), "o_custkey", "c_custkey")


def lookup_valid(spark, d):
    return with_match(table(spark, d, "orders"), _solvent(spark, d), "o_custkey", "c_custkey")


def lookup_orphans_large(spark, d):
    return orphans(table(spark, d, "orders"), _solvent(spark, d), "o_custkey", "c_custkey", broadcast_rows=0)


def lookup_valid_large(spark, d):
    return with_match(table(spark, d, "orders"), _solvent(spark, d), "o_custkey", "c_custkey", broadcast_rows=0)


def _solvent(spark, d):
    return table(spark, d, "customer").where(F.col("c_acctbal") >= 0)


# -- all layers ------------------------------------------------------------


def _deliver(rows, folder: str, name: str, padding: int) -> None:
    """One delivered file (a folder of packed parts, each small enough for a task): the columns, then unnamed ones."""
    blank = [F.lit(None).cast("string").alias(f"_x{i}") for i in range(padding)]
    out = rows.select("*", *blank).write.options(header=True, compression="gzip", maxRecordsPerFile=1_000_000)
    out.option("zlib.compress.level", "BEST_SPEED").csv(f"{folder}/{name}")


def _line(*numbers: int):
    """Whether a visit is one of these lines of its order."""
    visit = F.rtrim("visit_id")
    return reduce(or_, [visit.endswith(f"-{n}") for n in numbers])


def _first_delivery(spark, d):
    """Visits of the first two lines of each order."""
    return raw_visits(spark, d).where(_line(1, 2))


def _second_delivery(spark, d):
    """Those of the other lines, and of the first ones again with another cost and department."""
    visits = raw_visits(spark, d)
    again = visits.where(_line(1))
    again = again.withColumns({"lab_cost": F.lit("7"), "department_id": F.lit("DEP-X")})
    return visits.where(~_line(1, 2)).unionByName(again)


def _bills(spark, d):
    """A bill for each order; those of one status are negative, and some have an unreadable date."""
    day, price = F.col("o_orderdate"), F.col("o_totalprice").cast(MONEY)
    text = F.when(F.col("o_orderstatus") == "F", F.date_format(day, "dd-MM-yyyy")).when(
        F.col("o_orderpriority") == "5-LOW", F.lit("31-02-2020")
    )
    return table(spark, d, "orders").select(
        F.concat(F.lit("B"), F.col("o_orderkey")).alias("bill_id"),
        F.concat(F.col("o_orderkey"), F.lit("-1")).alias("visit_id"),
        F.when(F.col("o_orderstatus") == "P", -price).otherwise(price).cast("string").alias("bill_amount"),
        F.coalesce(text, F.date_format(day, "yyyy-MM-dd")).alias("bill_date"),
    )


def _diagnoses(spark, d):
    """A diagnosis for each order; some are missing."""
    return table(spark, d, "orders").select(
        F.concat(F.lit("G"), F.col("o_orderkey")).alias("diagnosis_id"),
        F.concat(F.col("o_orderkey"), F.lit("-1")).alias("visit_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("diagnosis"),
        F.col("o_orderstatus").alias("notes"),
    )


def _deliver_rest(spark, d, files: str, patients) -> None:
    """All feeds but the visits; ``patients`` are those delivered."""
    doctors = doctor_dim(spark, d).select(F.concat(F.lit("D"), F.col("doctor_key")).alias("doctor_id"), "doctor_name", "department")
    _deliver(patients, files, "RAW_DIM_PATIENT.csv", 2)
    _deliver(doctors, files, "RAW_DIM_DOCTOR.csv", 3)
    _deliver(_bills(spark, d), files, "RAW_BILLING.csv", 2)
    _deliver(_diagnoses(spark, d), files, "RAW_DIAGNOSIS.csv", 2)


def _patients(spark, d):
    return table(spark, d, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey")).alias("patient_id"), F.col("p_name").alias("full_name"), F.col("p_type").alias("city")
    )


def _deliver_visits(visits, files: str, name: str) -> None:
    _deliver(visits.withColumn("total_bill", F.lit(None).cast("string")), files, f"{name}.csv", 0)


def _two_loads(spark, d) -> VisitWarehouse:
    """Five feeds delivered as files, all layers; then a second delivery of visits, and all layers again."""
    work = work_dir(spark, "visit-layers")
    files = f"{work}/files"
    _deliver_rest(spark, d, files, _patients(spark, d))
    wh = VisitWarehouse(spark, f"{work}/warehouse")
    wh.create_tables()
    for name, visits in (("RAW_PATIENT_VISITS_1", _first_delivery), ("RAW_PATIENT_VISITS_2", _second_delivery)):
        _deliver_visits(visits(spark, d), files, name)
        wh.run(files)
    return wh


def _late_and_changed(spark, d) -> VisitWarehouse:
    """Two deliveries taken in by load, the star by what is new: half of the patients come with the second one only."""
    work = work_dir(spark, "late-keys")
    files, late = f"{work}/files", f"{work}/late"
    patients = _patients(spark, d)
    odd = F.substring("patient_id", 2, 20).cast("long") % 2 == 1
    _deliver_rest(spark, d, files, patients.where(odd))
    _deliver(patients.where(~odd), late, "RAW_DIM_PATIENT.csv", 2)
    wh = VisitWarehouse(spark, f"{work}/warehouse", watermark_policy="by_load", keep_reports=True)
    wh.create_tables()
    _deliver_visits(_first_delivery(spark, d), files, "RAW_PATIENT_VISITS_1")
    wh.run(files, since_last=True)
    _deliver_visits(_second_delivery(spark, d), late, "RAW_PATIENT_VISITS_2")
    wh.run(late, since_last=True)
    return wh


def late_dimension_keys(spark, d):
    """The fact of :func:`_late_and_changed`: visits of the first load have got the keys of patients of the second."""
    return _natural_fact(_late_and_changed(spark, d))


def kept_reports(spark, d):
    """Four reports from sums that each merge adjusted by what it changed."""
    wh = _late_and_changed(spark, d)
    money = F.col("total_revenue").cast("decimal(18,2)").alias("total_revenue")
    none = F.lit(None).cast("decimal(18,2)").alias("total_revenue")

    def rows(report, name, label, revenue):
        return report.select(F.lit(name).alias("report"), F.col(label).cast("string").alias("label"), "total_visits", revenue)

    return (
        rows(wh.kept_doctor_productivity(), "doctor", "doctor_name", money)
        .unionByName(rows(wh.kept_department_performance(), "department", "department", money))
        .unionByName(rows(wh.kept_repeat_patients(), "patient", "full_name", none))
        .unionByName(rows(wh.kept_daily_trend(), "day", "visit_date", none))
    )


def intake_by_load(spark, d):
    """A delivery that is stamped before the one already merged: taken in once, rows and quarantine, whatever its time."""
    work = work_dir(spark, "by-load")
    visits = raw_visits(spark, d)
    early = F.trim("visit_id").rlike("-[12]$")
    wh = VisitWarehouse(spark, f"{work}/warehouse", watermark_policy="by_load")
    wh.create_tables(["raw_patient_visits", "validated_patient_visits", "bad_patient_data"])
    for day, rows in ((9, visits.where(early)), (3, visits.where(~early))):
        wh.clock = lambda day=day: datetime(2024, 6, day, tzinfo=timezone.utc)
        _deliver_visits(rows, f"{work}/files", f"RAW_PATIENT_VISITS_{day}")
        wh.load_files("raw_patient_visits", f"{work}/files/RAW_PATIENT_VISITS_{day}.csv")
        for _ in range(2):
            wh.quarantine()
            wh.validate("visits")
    good = wh.table("validated", "validated_patient_visits").select("visit_id", "total_charges", F.lit("validated").alias("outcome"))
    bad = wh.table("validated", "bad_patient_data").select(F.trim("visit_id").alias("visit_id"), "total_charges", F.lit("quarantine").alias("outcome"))
    return good.unionByName(bad)


def _natural_fact(wh: VisitWarehouse):
    """The fact with surrogate keys turned back into natural ones."""
    fact = wh.table("clean", "fact_patient_visits")
    for dim, key, natural in (("dim_patient", "patient_key", "patient_id"), ("dim_doctor", "doctor_key", "doctor_id")):
        fact = fact.join(wh.table("clean", dim).select(key, natural), key, "left")
    return fact.select("visit_id", "patient_id", "doctor_id", "visit_date", "total_charges")


def visit_layers(spark, d):
    """Visits, quarantined rows, bills and diagnoses by group, after two loads."""
    wh = _two_loads(spark, d)

    def group(table_name, label, money):
        return wh.table("validated", table_name).groupBy(label.alias("department")).agg(
            F.count(F.lit(1)).alias("total_visits"), F.sum(money).cast("decimal(18,2)").alias("total_revenue")
        )

    report = wh.department_performance().withColumn("total_revenue", F.col("total_revenue").cast("decimal(18,2)"))
    bad = group("bad_patient_data", F.lit("(quarantine)"), "total_charges")
    bills = group("validated_billing", F.concat(F.lit("bills "), "billing_status"), "bill_amount")
    notes = group("validated_diagnosis", F.concat(F.lit("diagnoses "), "notes"), F.lit(None).cast("decimal(10,2)"))
    return report.unionByName(bad).unionByName(bills).unionByName(notes)


def second_load_fact(spark, d):
    """The fact after two loads, surrogate keys turned back into natural ones."""
    return _natural_fact(_two_loads(spark, d))


def _one_feed(spark, d, raw: str, feed: str, rows):
    """One feed from its file to its validated table."""
    work = work_dir(spark, feed)
    _deliver(rows, f"{work}/files", "feed.csv", 2)
    wh = VisitWarehouse(spark, f"{work}/warehouse")
    wh.create_tables([raw, f"validated_{feed}"])
    wh.load_files(raw, f"{work}/files/feed.csv")
    wh.validate("diagnoses" if feed == "diagnosis" else feed)
    return wh.table("validated", f"validated_{feed}")


def validated_billing(spark, d):
    bills = _one_feed(spark, d, "raw_billing", "billing", _bills(spark, d))
    return bills.select("bill_id", "visit_id", "bill_amount", "bill_date", "billing_status", "record_status")


def validated_diagnoses(spark, d):
    found = _one_feed(spark, d, "raw_diagnosis", "diagnosis", _diagnoses(spark, d))
    return found.select("diagnosis_id", "visit_id", "diagnosis", "notes", "record_status")


# -- SQL -------------------------------------------------------------------


def _latest_sql(source: str, keys: str, order: str, cols: str = "*") -> str:
    return f"""SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS pos
        FROM {source}) WHERE pos = 1"""


def _desc(*cols: str) -> str:
    return ", ".join(f"{c} DESC NULLS FIRST" for c in cols)


_ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS price, o_orderdate
    FROM orders"""
_OLD_SQL = f"(SELECT * FROM ({_ORDERS_SQL}) WHERE o_orderdate < TIMESTAMP '{_EARLY}')"
_DELTA_SQL = f"""(SELECT * REPLACE (CAST(price + 100 AS DECIMAL(12,2)) AS price) FROM ({_ORDERS_SQL})
    WHERE o_orderstatus <> 'F' OR o_orderdate >= TIMESTAMP '{_EARLY}')"""
_UPSERT_SQL = f"""SELECT * FROM {_OLD_SQL} o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {_DELTA_SQL})
    UNION ALL SELECT * FROM {_DELTA_SQL}"""
_SOME_SQL = f"""SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, t.o_custkey AS o_custkey,
    CASE WHEN t.o_orderkey IS NULL THEN 'X' ELSE t.o_orderstatus END AS o_orderstatus,
    coalesce(s.price, t.price) AS price, coalesce(t.o_orderdate, s.o_orderdate) AS o_orderdate
    FROM {_OLD_SQL} t FULL JOIN {_DELTA_SQL} s ON t.o_orderkey = s.o_orderkey"""

_LINES_SQL = """(SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS visit_id, l_partkey,
    l_suppkey, CAST(l_extendedprice AS DECIMAL(12,2)) AS total_charges, CAST(l_shipdate AS DATE) AS visit_date
    FROM lineitem)"""
_VISITS_SQL = _latest_sql(
    _LINES_SQL,
    "visit_id",
    _desc("visit_date", "l_partkey", "l_suppkey", "total_charges"),
    "visit_id, l_partkey, l_suppkey, total_charges, visit_date",
)
_RESOLVED_SQL = f"""SELECT visit_id, p_partkey, s_suppkey, total_charges, visit_date FROM ({_VISITS_SQL})
    LEFT JOIN (SELECT p_partkey FROM part WHERE p_size > 10) ON l_partkey = p_partkey
    LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) ON l_suppkey = s_suppkey"""

_MONEY_COLS = ", ".join(f"{amount_sql(c)} AS {c}" for c in AMOUNTS)
_SHAPED_SQL = f"""(SELECT trim(visit_id) AS visit_id, trim(patient_id) AS patient_id, trim(doctor_id) AS doctor_id,
    trim(department_id) AS department_id, {date_sql('visit_date')} AS visit_date, {_MONEY_COLS},
    {sum_sql()} AS total_charges, {STATUS_SQL} AS status
    FROM {RAW_SQL} WHERE NOT {missing_sql('patient_id')})"""
_MERGED_SQL = _latest_sql(
    _SHAPED_SQL,
    "visit_id",
    _desc("visit_date", "patient_id", *AMOUNTS, "total_charges", "status"),
    f"visit_id, patient_id, visit_date, {', '.join(AMOUNTS)}, total_charges, status AS billing_status",
)
_TWICE_SQL = f"""(SELECT *, CASE WHEN regexp_matches(trim(visit_id), '-[12]$') THEN 1 ELSE 2 END AS load_no, false AS again FROM {RAW_SQL}
    UNION ALL SELECT * REPLACE ('7' AS lab_cost, 'DEP-X' AS department_id), 2, true FROM {RAW_SQL} WHERE regexp_matches(trim(visit_id), '-1$'))"""
_LAYERS_SQL = f"""(SELECT trim(visit_id) AS visit_id, trim(patient_id) AS patient_id,
    CASE WHEN NOT {missing_sql('doctor_id')} THEN trim(doctor_id) END AS doctor_id, trim(department_id) AS department_id,
    {date_sql('visit_date')} AS visit_date, {_MONEY_COLS}, {sum_sql()} AS total_charges, load_no, again,
    CASE WHEN {STATUS_SQL} = 'INVALID' THEN 'INVALID' ELSE 'VALID' END AS status
    FROM {_TWICE_SQL} WHERE NOT {missing_sql('patient_id')})"""
_LAYERS_LATEST_SQL = _latest_sql(
    _LAYERS_SQL,
    "visit_id",
    _desc("load_no", "patient_id", "doctor_id", "department_id", "visit_date", *AMOUNTS, "total_charges", "status"),
)
_BILLS_SQL = f"""(SELECT 'B' || o_orderkey AS bill_id, o_orderkey || '-1' AS visit_id,
    CAST(CASE WHEN o_orderstatus = 'P' THEN -1 ELSE 1 END * CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(10,2)) AS bill_amount,
    CASE WHEN o_orderstatus = 'F' OR o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS bill_date,
    CASE WHEN o_orderstatus = 'P' AND o_totalprice > 0 THEN 'INVALID' ELSE 'VALID' END AS billing_status,
    'VALIDATED' AS record_status FROM orders)"""
_DIAGNOSES_SQL = """(SELECT 'G' || o_orderkey AS diagnosis_id, o_orderkey || '-1' AS visit_id, o_orderpriority AS diagnosis,
    o_orderstatus AS notes, 'VALID' AS record_status FROM orders WHERE o_orderpriority <> '5-LOW')"""
_REST = "c_custkey, c_name, c_mktsegment"

QUERIES = {
    "dedup_latest": dedup_lines,
    "dedup_latest_events": dedup_events,
    "dedup_latest_hot_key": dedup_hot_key,
    "dedup_latest_trimmed_key": dedup_trimmed_key,
    "incremental_filter": new_events,
    "incremental_filter_empty_target": new_events_empty_target,
    "upsert_update_insert": upsert_orders,
    "upsert_large_delta": upsert_orders_large,
    "upsert_some_columns": upsert_some_columns,
    "upsert_some_columns_large_delta": upsert_some_columns_large,
    "upsert_idempotent": upsert_twice,
    "merge_visits": merge_visits,
    "dimension_load": dimension_load,
    "surrogate_key_properties": surrogate_key_properties,
    "surrogate_key_stable": surrogate_key_stable,
    "resolve_dimension_keys": resolve_dimension_keys,
    "resolve_dimension_keys_large": resolve_dimension_keys_large,
    "fact_load_resolve_keys": fact_load,
    "lookup_validation_orphans": lookup_orphans,
    "lookup_validation_valid": lookup_valid,
    "lookup_validation_orphans_large": lookup_orphans_large,
    "lookup_validation_valid_large": lookup_valid_large,
    "visit_layers_end_to_end": visit_layers,
    "second_load_fact": second_load_fact,
    "late_dimension_keys": late_dimension_keys,
    "kept_reports": kept_reports,
    "intake_by_load": intake_by_load,
    "validated_billing": validated_billing,
    "validated_diagnoses": validated_diagnoses,
}

_LINE_COLS = ", ".join([*_LINE, *_LINE_REST, "l_shipdate"])
_EVENT_COLS = "event_id, ts, user_id, event_type, value, props"
_ORPHANS_SQL = "SELECT * FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)"
_FOUND_SQL = "SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)"

ORACLE = {
    "dedup_latest": _latest_sql("lineitem", ", ".join(_LINE), _desc("l_shipdate", *_LINE_REST), _LINE_COLS),
    "dedup_latest_events": _latest_sql("events", "user_id", "ts DESC, event_id DESC", _EVENT_COLS),
    "dedup_latest_hot_key": _latest_sql("events", "event_type", "ts DESC, event_id DESC", _EVENT_COLS),
    "dedup_latest_trimmed_key": _latest_sql(
        f"(SELECT trim(visit_id) AS visit_id, visit_date, lab_cost FROM {RAW_SQL})",
        "visit_id",
        _desc("visit_date", "lab_cost"),
        "visit_id, visit_date, lab_cost",
    ),
    "incremental_filter": """SELECT * FROM events
        WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-16')""",
    "incremental_filter_empty_target": "SELECT * FROM events",
    "upsert_update_insert": _UPSERT_SQL,
    "upsert_large_delta": _UPSERT_SQL,
    "upsert_some_columns": _SOME_SQL,
    "upsert_some_columns_large_delta": _SOME_SQL,
    "upsert_idempotent": _UPSERT_SQL,
    "merge_visits": f"""WITH m AS ({_MERGED_SQL})
        SELECT * REPLACE (CASE WHEN billing_status <> 'INVALID' AND visit_date < DATE '{_EARLY}' THEN 'OLD'
            ELSE billing_status END AS billing_status) FROM m""",
    "dimension_load": f"""SELECT {_REST} FROM (SELECT c_custkey, c_acctbal, c_mktsegment AS seg,
        CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name ELSE 'old' END AS c_name,
        CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS c_mktsegment FROM customer)
        WHERE c_acctbal > 0 OR seg <> 'MACHINERY'""",
    "surrogate_key_properties": """SELECT count(*) AS row_count, count(DISTINCT c_custkey) AS keys, CAST(101 AS BIGINT) AS lowest,
        100 + count(*) AS highest FROM customer""",
    "surrogate_key_stable": """SELECT CAST(0 AS BIGINT) AS changed_keys,
        count(*) FILTER (c_acctbal <= 0 AND c_mktsegment <> 'MACHINERY') AS new_keys,
        count(*) FILTER (c_acctbal <= 0 AND c_mktsegment <> 'MACHINERY') AS key_growth,
        count(*) FILTER (c_acctbal > 0 OR c_mktsegment <> 'MACHINERY') AS keys FROM customer""",
    "resolve_dimension_keys": _RESOLVED_SQL,
    "resolve_dimension_keys_large": _RESOLVED_SQL,
    "fact_load_resolve_keys": _RESOLVED_SQL,
    "lookup_validation_orphans": _ORPHANS_SQL,
    "lookup_validation_valid": _FOUND_SQL,
    "lookup_validation_orphans_large": _ORPHANS_SQL,
    "lookup_validation_valid_large": _FOUND_SQL,
    "visit_layers_end_to_end": f"""SELECT department, count(*) AS total_visits,
        CAST(sum(total_charges) AS DECIMAL(18,2)) AS total_revenue
        FROM ({_LAYERS_LATEST_SQL}) v JOIN {DOCTOR_SQL} d ON v.doctor_id = 'D' || CAST(d.doctor_key AS VARCHAR)
        GROUP BY department
        UNION ALL SELECT '(quarantine)', count(*), CAST(sum({sum_sql()}) AS DECIMAL(18,2))
        FROM {_TWICE_SQL} WHERE {missing_sql('patient_id')}
        UNION ALL SELECT 'bills ' || billing_status, count(*), CAST(sum(bill_amount) AS DECIMAL(18,2)) FROM {_BILLS_SQL} GROUP BY 1
        UNION ALL SELECT 'diagnoses ' || notes, count(*), NULL FROM {_DIAGNOSES_SQL} GROUP BY 1""",
    "second_load_fact": f"""SELECT visit_id, patient_id, doctor_id, visit_date, total_charges FROM ({_LAYERS_LATEST_SQL})""",
    "late_dimension_keys": f"""SELECT visit_id, patient_id, doctor_id, visit_date, total_charges FROM ({_LAYERS_LATEST_SQL})""",
    "kept_reports": f"""WITH v AS ({_LAYERS_LATEST_SQL}), d AS (SELECT v.*, doctor_name, department
            FROM v JOIN {DOCTOR_SQL} d ON v.doctor_id = 'D' || CAST(d.doctor_key AS VARCHAR))
        SELECT 'doctor' AS report, doctor_name AS label, count(*) AS total_visits,
            CAST(sum(total_charges) AS DECIMAL(18,2)) AS total_revenue FROM d GROUP BY doctor_name
        UNION ALL SELECT 'department', department, count(*), CAST(sum(total_charges) AS DECIMAL(18,2)) FROM d GROUP BY department
        UNION ALL SELECT 'patient', p_name, count(*), NULL FROM v JOIN part ON patient_id = 'P' || p_partkey GROUP BY p_name
        UNION ALL SELECT 'day', CAST(visit_date AS VARCHAR), count(*), NULL FROM v GROUP BY visit_date""",
    "intake_by_load": f"""SELECT visit_id, total_charges, 'validated' AS outcome FROM (
            SELECT *, row_number() OVER (PARTITION BY visit_id ORDER BY
                {_desc("patient_id", "doctor_id", "department_id", "visit_date", *AMOUNTS, "total_charges", "status")}) AS pos
            FROM {_LAYERS_SQL} WHERE NOT again) WHERE pos = 1
        UNION ALL SELECT trim(visit_id), {sum_sql()}, 'quarantine' FROM {RAW_SQL} WHERE {missing_sql('patient_id')}""",
    "validated_billing": f"SELECT * FROM {_BILLS_SQL}",
    "validated_diagnoses": f"SELECT * FROM {_DIAGNOSES_SQL}",
}
