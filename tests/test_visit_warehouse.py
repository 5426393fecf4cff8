"""The whole load on a small set of hand-made files, then second loads on top."""

from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratalake.operators.quality import quality_summary
from stratalake.plans import kpi, visits
from stratalake.plans.visits import STATUSES, VisitWarehouse

# Small deliveries: a key twice in a file, blank rows, unnamed columns, keys without a match, unreadable values.
VISITS = """VISIT_ID,PATIENT_ID,DOCTOR_ID,DEPARTMENT_ID,VISIT_DATE,CONSULTATION_FEE,MEDICINE_COST,LAB_COST,TOTAL_BILL
A-1,pt-1,dr-1,north,03-01-2023,120,30,50,200
A-2,pt-2,dr-2,south,04-01-2023,80.50,19.50,0,100
A-3,pt-3,dr-1,north,2023-01-05,300,10,,310
A-4,pt-1,dr-3,east,13-13-2023,60,40,20,120
A-5,pt-4,dr-2,south,07-01-2023,-50,25,25,0
A-6,pt-9,dr-9,west,08-01-2023,900,700,100,
A-7,pt-2,dr-3,east,08-01-2023,45,x,5,50"""
BILLS = """BILL_ID,VISIT_ID,BILL_AMOUNT,BILL_DATE,,
b1,A-1,200,03-01-2023,,
b2,A-2,100,2023-01-04,,
b3,A-5,-75,07-01-2023,,
b4,A-9,40,32-01-2023,,
b5,A-6,,08-01-2023,,
,,,,,"""
DIAGNOSES = """DIAGNOSIS_ID,VISIT_ID,DIAGNOSIS,NOTES,,
g1,A-1,Sprain,left ankle,,
g2,A-2,Cough,,,
g3,A-9,Fever,unknown visit,,
g4,A-3,,no text,,
,,,,,"""
PATIENTS = """PATIENT_ID,FULL_NAME,CITY,,
pt-1,Ada Berg,Oslo,,
pt-2,Bo Dahl,Hamar,,
pt-3,Cy Eng,Narvik,,
pt-4,Di Foss,Oslo,,
pt-5,Ed Gran,Molde,,
pt-2,Bo Dahl,Bergen,,
,,,,"""
DOCTORS = """DOCTOR_ID,DOCTOR_NAME,DEPARTMENT,,,
dr-1,Ina Holm,Skin,,,
dr-2,Jo Lie,Heart,,,
dr-3,Kim Moe,Bone,,,
dr-4,Lea Nes,Ear,,,
dr-2,Jo Lie,Eye,,,
,,,,,"""
FILES = {
    "RAW_PATIENT_VISITS.csv": VISITS,
    "RAW_BILLING.csv": BILLS,
    "RAW_DIAGNOSIS.csv": DIAGNOSES,
    "RAW_DIM_PATIENT.csv": PATIENTS,
    "RAW_DIM_DOCTOR.csv": DOCTORS,
}


class Clock:
    """One hour later on each reading."""

    def __init__(self):
        self.now = datetime(2024, 6, 1, tzinfo=timezone.utc)

    def __call__(self):
        self.now += timedelta(hours=1)
        return self.now


def put(directory, name, text):
    (directory / name).write_text(text.replace("\n", "\r\n") + "\r\n", newline="")


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("load")
    files = base / "files"
    files.mkdir()
    for name, text in FILES.items():
        put(files, name, text)
    wh = VisitWarehouse(spark, str(base / "warehouse"), clock=Clock())
    wh.create_tables()
    wh.run(str(files))
    return wh, files


def by(df, key, *cols):
    return {r[key]: tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect()}


def test_row_counts(loaded):
    wh, _ = loaded
    counts = {
        "raw": [("raw_patient_visits", 7), ("raw_billing", 6), ("raw_diagnosis", 5)]
        + [("raw_dim_patient", 7), ("raw_dim_doctor", 6), ("rejected_lines", 0)],
        "validated": [("validated_dim_patient", 5), ("validated_dim_doctor", 4), ("validated_patient_visits", 7)]
        + [("validated_billing", 5), ("validated_diagnosis", 3), ("bad_patient_data", 0)],
        "clean": [("dim_patient", 5), ("dim_doctor", 4), ("fact_patient_visits", 7)],
    }
    for layer, tables in counts.items():
        for name, n in tables:
            assert wh.table(layer, name).count() == n, name


def test_raw_keeps_text_and_lineage(loaded):
    wh, _ = loaded
    raw = wh.table("raw", "raw_patient_visits")
    row = raw.where("visit_id = 'A-6'").first()
    assert row.total_bill is None and row.visit_date == "08-01-2023"
    assert row.file_name == "RAW_PATIENT_VISITS.csv"
    assert raw.select("load_timestamp").distinct().count() == 1
    assert dict(wh.table("raw", "raw_billing").dtypes)["bill_amount"] == "decimal(10,2)"


def test_visit_values(loaded):
    wh, _ = loaded
    got = by(wh.table("validated", "validated_patient_visits"), "visit_id", "total_charges", "visit_date", "billing_status")
    totals = {"A-1": 200, "A-2": 100, "A-3": 310, "A-4": 120, "A-5": 0, "A-6": 1700, "A-7": 50}
    assert {k: v[0] for k, v in got.items()} == totals
    assert {k for k, v in got.items() if v[1] is None} == {"A-4"}
    assert got["A-1"][1] == date(2023, 1, 3) and got["A-3"][1] == date(2023, 1, 5)
    assert {k for k, v in got.items() if v[2] == "INVALID"} == {"A-5"}


def test_billing(loaded):
    wh, _ = loaded
    got = by(wh.table("validated", "validated_billing"), "bill_id", "billing_status", "bill_date", "bill_amount")
    assert {k for k, v in got.items() if v[0] == "INVALID"} == {"b3"}
    assert {k for k, v in got.items() if v[1] is None} == {"b4"}
    assert got["b5"] == ("VALID", date(2023, 1, 8), None)


def test_fact_keys_and_columns(loaded):
    wh, _ = loaded
    fact = wh.table("clean", "fact_patient_visits")
    assert "department_key" not in fact.columns
    assert sorted(r.visit_key for r in fact.collect()) == list(range(1, 8))
    assert [r.visit_id for r in fact.where("patient_key is null or doctor_key is null").collect()] == ["A-6"]


def test_reports(loaded):
    wh, _ = loaded
    assert [tuple(r) for r in wh.doctor_productivity().collect()] == [
        ("Ina Holm", 2, Decimal(510)),
        ("Kim Moe", 2, Decimal(170)),
        ("Jo Lie", 2, Decimal(100)),
    ]
    # dr-2 is delivered twice at one time; the tie-breaker (greatest values first) keeps Heart.
    assert [tuple(r) for r in wh.department_performance().collect()] == [("Skin", 2, 510), ("Bone", 2, 170), ("Heart", 2, 100)]
    assert [r.department for r in wh.top_departments().collect()] == ["Skin", "Bone", "Heart"]
    assert [r.visit_id for r in wh.high_billing_alerts().collect()] == ["A-6"]
    assert [r.total_visits for r in wh.repeat_patients().collect()] == [2, 2, 1, 1]
    assert by(wh.average_revenue_per_visit(), "doctor_name", "avg_revenue_per_visit")["Kim Moe"] == Decimal("85.00000000")
    trend = by(wh.daily_trend(), "visit_date", "total_visits")
    assert trend.pop(None) == 1 and sorted(trend.values()) == [1, 1, 1, 1, 2]
    assert wh.peak_days().collect()[0].visit_date == date(2023, 1, 8)


def test_sql_surface(loaded):
    wh, _ = loaded
    wh.register_sql()
    got = wh.spark.sql(
        "SELECT visit_id, validate_visit(patient_id, doctor_id, department_id, visit_date, "
        "consultation_fee, medicine_cost, lab_cost).total_charges AS t FROM raw_raw_patient_visits"
    )
    assert by(got, "visit_id", "t")["A-6"] == 1700


def test_second_load(loaded):
    """Changed, new, bad and negative rows; keys stay, quarantine fills, reruns change nothing."""
    wh, files = loaded
    keys_before = by(wh.table("clean", "fact_patient_visits"), "visit_id", "visit_key")
    head = VISITS.split("\n")[0]
    rows = [
        "A-1 ,pt-1,dr-1,north,2023-01-09,500,30,50,0",  # changed, padded id
        "A-20,pt-77,dr-1,north,03-02-2023,-10,x,20,0",  # new, negative, unknown patient, unreadable cost
        "A-2,,dr-2,south,05-01-2023,1,1,1,3",  # bad: must not replace the good A-2
        "A-21, NULL ,dr-2,south,05-01-2023,7,1,1,3",  # bad
        "A-22,pt-3",  # short: the rest is NULL
        'A-23,"pt-3,dr-1,north',  # an open quote: set aside
    ]
    put(files, "RAW_PATIENT_VISITS_2.csv", "\n".join([head, *rows]))
    put(files, "RAW_DIM_DOCTOR.csv", "DOCTOR_ID,DOCTOR_NAME,DEPARTMENT,,,\ndr-1,Ina Vik,Surgery,,,\ndr-30,  ,Surgery,,,\n")
    loads = wh.load_directory(str(files))
    assert loads["raw_patient_visits"] == 1  # only the new file
    assert loads["raw_diagnosis"] == 0
    assert loads["raw_billing"] == 1  # forced
    rejected = wh.table("raw", "rejected_lines").collect()
    assert [(r.line[:4], r.target, r.file_name) for r in rejected] == [("A-23", "raw.raw_patient_visits", "RAW_PATIENT_VISITS_2.csv")]
    wh.validate("doctors")
    wh.quarantine()
    visits = by(
        wh.validate("visits"), "visit_id", "total_charges", "billing_status", "visit_date", "consultation_fee"
    )
    assert len(visits) == 9
    assert visits["A-1"] == (580, "VALID", date(2023, 1, 9), 500)
    assert visits["A-20"] == (10, "INVALID", date(2023, 2, 3), -10)
    assert visits["A-2"][0] == 100 and visits["A-22"] == (0, "VALID", None, None)
    bad = wh.table("validated", "bad_patient_data")
    assert sorted((r.visit_id, r.patient_id, r.total_charges, r.error_reason) for r in bad.collect()) == [
        ("A-2", None, 3, "Missing Patient ID"),
        ("A-21", None, 9, "Missing Patient ID"),
    ]
    wh.load_dims()
    fact = wh.load_visits_fact()
    keys = by(fact, "visit_id", "visit_key")
    assert {k: keys[k] for k in keys_before} == keys_before and {keys["A-20"], keys["A-22"]} == {8, 9}
    assert fact.where("visit_id = 'A-20'").first().patient_key is None
    assert by(wh.table("clean", "dim_doctor"), "doctor_id", "doctor_key", "doctor_name")["dr-1"][1] == "Ina Vik"
    # Nothing new: same content again
    before = sorted(map(str, wh.table("validated", "validated_patient_visits").collect()))
    wh.quarantine()
    wh.validate("visits")
    assert sorted(map(str, wh.table("validated", "validated_patient_visits").collect())) == before
    assert bad.count() == 2
    wh.load_visits_fact(since_last=True)
    assert by(wh.table("clean", "fact_patient_visits"), "visit_id", "visit_key") == keys


def test_truncate_or_create_and_reload(spark, tmp_path):
    """The load history goes with the rows: every file loads again, once."""
    put(tmp_path, "RAW_PATIENT_VISITS.csv", VISITS)
    wh = VisitWarehouse(spark, str(tmp_path / "w"), clock=Clock(), watermark_policy="source_time", parts=2)
    tables = ["raw_patient_visits", "validated_patient_visits"]
    wh.create_tables(tables)
    load = lambda: wh.load_files("raw_patient_visits", str(tmp_path / "RAW_PATIENT_VISITS*"))
    assert load() == 1 and load() == 0
    wh.validate("visits")
    wh.truncate_raw()
    assert wh.table("raw", "raw_patient_visits").count() == 0
    assert load() == 1 and load() == 0 and wh.table("raw", "raw_patient_visits").count() == 7
    wh.create_tables(tables)
    assert load() == 1 and load() == 0 and wh.table("raw", "raw_patient_visits").count() == 7
    assert wh.validate("visits").count() == 7


def test_day_folders_do_not_depend_on_the_session_zone(spark, tmp_path):
    put(tmp_path, "v.csv", VISITS)
    zone = spark.conf.get("spark.sql.session.timeZone")
    late = lambda: datetime(2024, 6, 2, 3, tzinfo=timezone.utc)
    wh = VisitWarehouse(spark, str(tmp_path / "w"), clock=late, parts=2)
    wh.create_tables(["raw_patient_visits", "validated_patient_visits"])
    try:
        wh.clock = lambda: datetime(2024, 6, 2, 1, tzinfo=timezone.utc)
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        wh.load_files("raw_patient_visits", str(tmp_path / "v.csv"))
        wh.validate("visits")
        put(tmp_path, "w.csv", VISITS.replace("A-", "B-"))
        wh.clock = late  # still the day before in Los Angeles
        wh.load_files("raw_patient_visits", str(tmp_path / "w.csv"))
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert wh.validate("visits").count() == 14
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_large_totals_are_kept(spark, tmp_path):
    head = VISITS.split("\n")[0]
    put(tmp_path, "v.csv", f"{head}\nV1,p,d,x,01-01-2024,60000000,60000000,1,0")
    wh = VisitWarehouse(spark, str(tmp_path / "w"), clock=Clock(), parts=2)
    wh.create_tables(["raw_patient_visits", "validated_patient_visits"])
    wh.load_files("raw_patient_visits", str(tmp_path / "v.csv"))
    assert wh.validate("visits").first().total_charges == 120000001
    fact = spark.range(4).select(F.lit(1).alias("k"), F.col("id").alias("v"), F.lit("9999999999999999.00").cast("decimal(18,2)").alias("a"))
    dim = spark.range(1, 2).select(F.col("id").cast("int").alias("k"), F.lit("n").alias("n"))
    assert kpi.group_kpi(fact, dim, "k", "n", "v", "a").first().total_revenue == 4 * 9999999999999999


def test_quarantine_policies(spark, tmp_path):
    head = VISITS.split("\n")[0]
    for policy, marks, want in (("append", "merge_time", 2), ("incremental", "merge_time", 1), ("incremental", "source_time", 1)):
        root = tmp_path / f"{policy}-{marks}"
        root.mkdir()
        put(root, "v.csv", f"{head}\nV1,,D1,X,01-01-2024,1,2,3,6\nV2,P2,D1,X,01-01-2024,1,2,3,6")
        wh = VisitWarehouse(spark, str(root / "w"), marks, policy, Clock(), parts=2)
        wh.create_tables(["raw_patient_visits", "bad_patient_data"])
        wh.load_files("raw_patient_visits", str(root / "v.csv"))
        for _ in range(2):
            wh.quarantine()
        assert wh.table("validated", "bad_patient_data").count() == want


def test_merge_by_folders(spark, tmp_path):
    wh = VisitWarehouse(spark, str(tmp_path / "w"), clock=Clock(), parts=4)
    wh.create_tables(["raw_patient_visits", "validated_patient_visits"])
    for i, text in enumerate((VISITS, VISITS.replace("A-1", "B-1"))):
        put(tmp_path, f"{i}.csv", text)
        wh.load_files("raw_patient_visits", str(tmp_path / f"{i}.csv"))
        assert wh.validate("visits").count() == (7, 8)[i]


def test_source_time_watermark_keeps_late_rows(spark, tmp_path):
    """A raw row stamped before the last merge but seen after it: lost by merge time, kept by source time."""
    late = F.lit("2024-06-01 01:30:00").cast("timestamp")
    got = {}
    for policy in ("merge_time", "source_time"):
        wh = VisitWarehouse(spark, str(tmp_path / policy), watermark_policy=policy, clock=Clock())
        wh.create_tables(["raw_patient_visits", "validated_patient_visits"])
        put(tmp_path, "RAW_PATIENT_VISITS.csv", VISITS)
        wh.load_files("raw_patient_visits", str(tmp_path / "RAW_PATIENT_VISITS.csv"))  # stamped 01:00
        wh.validate("visits")  # merged 02:00
        raw = wh.store.read("raw", "raw_patient_visits").where("visit_id = 'A-1'")
        wh.store.append("raw", "raw_patient_visits", raw.withColumns({"visit_id": F.lit("A-100"), "load_timestamp": late}))
        got[policy] = wh.validate("visits").count()
    assert got == {"merge_time": 7, "source_time": 8}


HEAD = VISITS.split("\n")[0]


def warehouse(spark, root, **options):
    wh = VisitWarehouse(spark, str(root / "w"), clock=Clock(), **{"parts": 4, **options})
    wh.create_tables()
    files = root / "files"
    files.mkdir(exist_ok=True)
    for name, text in FILES.items():
        put(files, name, text)
    return wh, files


def jobs(spark):
    return int(str(spark.sparkContext._jsc.sc().dagScheduler().nextJobId()))


def test_intake_by_load_takes_each_load_once(spark, tmp_path):
    """A load stamped before the one already merged, and one row of it older still."""
    wh, files = warehouse(spark, tmp_path, watermark_policy="by_load")
    wh.clock = lambda: datetime(2024, 6, 9, tzinfo=timezone.utc)
    wh.load_files("raw_patient_visits", str(files / "RAW_PATIENT_VISITS.csv"))
    assert wh.validate("visits").count() == 7
    put(files, "late.csv", f"{HEAD}\nL-1,pt-1,dr-1,north,01-01-2023,1,2,3,6\nL-2,,dr-1,north,01-01-2023,1,2,3,6")
    wh.clock = lambda: datetime(2024, 6, 3, tzinfo=timezone.utc)
    wh.load_files("raw_patient_visits", str(files / "late.csv"))
    for _ in range(2):
        wh.quarantine()
        assert wh.validate("visits").count() == 8
        assert [r.visit_id for r in wh.table("validated", "bad_patient_data").collect()] == ["L-2"]
    taken = wh.store.marks("validated", "validated_patient_visits")["taken"]
    assert taken == wh.store.loads("raw", "raw_patient_visits") and len(taken) == 2


class Died(Exception):
    pass


@pytest.mark.parametrize("table", ["bad_patient_data", "fact_patient_visits", "fact_changes"])
def test_a_run_that_died_is_done_again(spark, tmp_path, monkeypatch, table):
    """Dead before the table's pointer is written; the run is repeated and nothing is there twice or missing."""
    wh, files = warehouse(spark, tmp_path, watermark_policy="by_load", keep_reports=True)
    put(files, "RAW_PATIENT_VISITS_2.csv", f"{HEAD}\nB-1,,dr-1,north,03-01-2023,1,2,3,6\nB-2,pt-55,dr-1,north,03-01-2023,1,2,3,6")
    real = type(wh.store)._point

    def point(self, layer, name, *args, **kwargs):
        if name == table:
            raise Died
        return real(self, layer, name, *args, **kwargs)

    with monkeypatch.context() as m:
        m.setattr(type(wh.store), "_point", point)
        with pytest.raises(Died):
            wh.run(str(files), since_last=True)
    wh.store.refresh()
    wh.run(str(files), since_last=True)
    assert wh.table("validated", "bad_patient_data").count() == 1
    assert wh.table("raw", "raw_patient_visits").count() == 9
    fact = wh.table("clean", "fact_patient_visits")
    assert fact.count() == 8 and sorted(r.visit_key for r in fact.collect()) == list(range(1, 9))
    assert {r.visit_id for r in wh.table("clean", "pending_keys").collect()} == {"A-6", "B-2"}
    same_reports(wh)


def same_reports(wh):
    pairs = [
        (wh.kept_doctor_productivity(), wh.doctor_productivity()),
        (wh.kept_department_performance(), wh.department_performance()),
        (wh.kept_repeat_patients(), wh.repeat_patients()),
    ]
    for kept, full in pairs:
        assert [tuple(r) for r in kept.collect()] == [tuple(r) for r in full.collect()]
    assert by(wh.kept_daily_trend(), "visit_date", "total_visits") == by(wh.daily_trend(), "visit_date", "total_visits")


def test_late_dimension_rows_and_kept_reports(spark, tmp_path):
    wh, files = warehouse(spark, tmp_path, parts=64, keep_reports=True)
    wh.run(str(files), since_last=True)
    same_reports(wh)
    pending = wh.table("clean", "pending_keys")
    assert [tuple(r) for r in pending.collect()] == [("A-6", "pt-9", "dr-9")]
    held = set(wh.store.read("clean", "fact_patient_visits").inputFiles())
    keys = by(wh.table("clean", "fact_patient_visits"), "visit_id", "visit_key")

    # the patient comes, the doctor does not: one folder is written
    put(files, "RAW_DIM_PATIENT.csv", f"{PATIENTS}\npt-9,Ny Nord,Oslo,,")
    wh.run(str(files), since_last=True)
    fact = wh.table("clean", "fact_patient_visits")
    row = fact.where("visit_id = 'A-6'").first()
    assert row.patient_key is not None and row.doctor_key is None and row.total_charges == 1700
    assert len(held - set(wh.store.read("clean", "fact_patient_visits").inputFiles())) == 1
    assert wh.table("clean", "pending_keys").count() == 1
    same_reports(wh)

    # the doctor comes; a visit changes its doctor, its charges and its date, and another comes without a known patient
    put(files, "RAW_DIM_DOCTOR.csv", f"{DOCTORS}\ndr-9,Pi Rud,Eye,,,")
    put(files, "RAW_PATIENT_VISITS_2.csv", f"{HEAD}\nA-1,pt-2,dr-2,north,09-01-2023,x,,,0\nA-30,pt-80,dr-1,north,03-01-2023,5,5,5,15")
    wh.run(str(files), since_last=True)
    fact = wh.table("clean", "fact_patient_visits")
    assert fact.where("visit_id = 'A-6'").first().doctor_key is not None
    assert [r.visit_id for r in wh.table("clean", "pending_keys").collect()] == ["A-30"]
    after = by(fact, "visit_id", "visit_key")
    assert {k: after[k] for k in keys} == keys and after["A-30"] == 8
    same_reports(wh)
    assert wh.resolve_pending() == 0

    # everything merged again: nothing is counted twice
    wh.run(str(files))
    same_reports(wh)
    assert by(wh.table("clean", "fact_patient_visits"), "visit_id", "visit_key") == after


def test_a_pending_visit_that_changes_its_patient(spark, tmp_path):
    wh, files = warehouse(spark, tmp_path)
    wh.run(str(files), since_last=True)
    put(files, "RAW_PATIENT_VISITS_2.csv", f"{HEAD}\nA-6,pt-1,dr-1,west,08-01-2023,900,700,100,")
    wh.run(str(files), since_last=True)
    assert wh.table("clean", "pending_keys").count() == 0
    put(files, "RAW_DIM_PATIENT.csv", f"{PATIENTS}\npt-9,Ny Nord,Oslo,,")
    wh.run(str(files), since_last=True)
    patient = by(wh.table("clean", "dim_patient"), "patient_id", "patient_key")
    assert wh.table("clean", "fact_patient_visits").where("visit_id = 'A-6'").first().patient_key == patient["pt-1"]


def test_quality_of_a_load_is_counted_as_it_is_written(spark, tmp_path):
    wh, files = warehouse(spark, tmp_path)
    wh.run(str(files))
    for target, status in STATUSES.items():
        full = quality_summary(wh.table("validated", target), list(status))
        assert sorted(map(tuple, wh.last_quality(target).collect()), key=str) == sorted(map(tuple, full.collect()), key=str)
    put(files, "RAW_PATIENT_VISITS_2.csv", f"{HEAD}\nC-1,pt-1,dr-1,west,08-01-2023,-1,,,\nC-2,pt-1,\"dr-1,west")
    wh.load_directory(str(files))
    wh.validate("visits")
    assert [tuple(r) for r in wh.last_quality("validated_patient_visits").collect()] == [("INVALID", "VALIDATED", 1)]
    assert wh.store.marks("raw", "raw_patient_visits")["set_aside"] == 1


def test_jobs_of_a_load(spark, tmp_path):
    wh, files = warehouse(spark, tmp_path)
    before = jobs(spark)
    wh.run(str(files), since_last=True)
    first = jobs(spark) - before
    put(files, "RAW_PATIENT_VISITS_2.csv", f"{HEAD}\nC-1,pt-1,dr-1,west,08-01-2023,1,,,")
    before = jobs(spark)
    wh.run(str(files), since_last=True)
    second = jobs(spark) - before
    assert first <= 60 and second <= 60


def test_many_rows_are_merged_without_a_look_at_the_folders(spark, tmp_path, monkeypatch):
    """A large delivery falls into all folders; its keys are not read once more to find that out."""
    wh, files = warehouse(spark, tmp_path, watermark_policy="by_load")
    wh.run(str(files), since_last=True)
    changed = [line.replace("03-01-2023", "02-02-2023") for line in VISITS.split("\n")]
    put(files, "RAW_PATIENT_VISITS_2.csv", "\n".join([*changed, "B-1,pt-1,dr-1,north,03-02-2023,1,2,3,"]))
    monkeypatch.setattr(visits, "MANY_ROWS", 0.1, raising=False)
    monkeypatch.setattr(type(wh.store), "touching", lambda *a: pytest.fail("looked at the keys"))
    wh.load_files("raw_patient_visits", f"{files}/RAW_PATIENT_VISITS_2.csv")
    wh._take_visits()
    wh.load_visits_fact(since_last=True)
    fact = {r.visit_id: str(r.visit_date) for r in wh.table("clean", "fact_patient_visits").collect()}
    assert len(fact) == 8 and fact["A-1"] == "2023-02-02" and fact["B-1"] == "2023-02-03"
