"""Report queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratalake.plans import kpi
from stratalake.registry.roles import DOCTOR_SQL, FACT_SQL, doctor_dim, table, visit_fact
from stratalake.sources.staging import stage

# Chosen so that about one line in seven raises an alert.
ALERT_OVER = 90000


def _money(df):
    """Sums in the type the SQL gives."""
    return df.withColumn("total_revenue", F.col("total_revenue").cast("decimal(18,2)"))


def _positions(df):
    """``df`` with the place of each row in its order.

    Rows are numbered inside each partition; the partitions' sizes, the only
    thing that meets in one task, shift them.
    """
    rows = stage(df.withColumn("at", F.monotonically_increasing_id()), "ordered")
    part, place = F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = rows.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = rows.withColumn("place", place).withColumn("part", part).join(F.broadcast(sizes), "part")
    return placed.select(*df.columns, (F.col("before") + F.col("place") + 1).alias("position"))


def _department_kpi(spark, d):
    return kpi.group_kpi(
        visit_fact(spark, d),
        doctor_dim(spark, d),
        "doctor_key",
        "department",
        "order_id",
        "total_charges",
        sort=["total_revenue"],
    )


def department_performance(spark, d):
    return _positions(_money(_department_kpi(spark, d)))


def top3_departments(spark, d):
    return _money(kpi.top_n(_department_kpi(spark, d), "total_revenue", 3, "department"))


def doctor_productivity(spark, d):
    found = kpi.group_kpi(
        visit_fact(spark, d),
        doctor_dim(spark, d),
        "doctor_key",
        "doctor_name",
        "order_id",
        "total_charges",
        sort=["total_visits", "total_revenue"],
    )
    return _positions(_money(found))


def avg_revenue_per_visit(spark, d):
    return kpi.average_kpi(visit_fact(spark, d), doctor_dim(spark, d), "doctor_key", "doctor_name", "total_charges")


def high_billing_alerts(spark, d):
    ties = ["order_id", "line_no", "doctor_key", "visit_date"]
    return _positions(kpi.alerts(visit_fact(spark, d), "total_charges", ALERT_OVER, ties))


def repeat_patients(spark, d):
    visits = table(spark, d, "orders").select(F.col("o_custkey").alias("patient_key"), "o_orderkey")
    patients = table(spark, d, "customer").select(
        F.col("c_custkey").alias("patient_key"), F.col("c_name").alias("full_name")
    )
    return _positions(kpi.group_kpi(visits, patients, "patient_key", "full_name", "o_orderkey", sort=["total_visits"]))


def daily_visit_trend(spark, d):
    return kpi.trend(table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("visit_date")), "visit_date")


def peak_load(spark, d):
    return kpi.peak(daily_visit_trend(spark, d), 5, "visit_date")


def peak_load_ties(spark, d):
    return kpi.peak_ties(daily_visit_trend(spark, d), "visit_date").select("visit_date", "total_visits")


def _grouped(by: str) -> str:
    return f"""SELECT {by}, count(order_id) AS total_visits, CAST(sum(total_charges) AS DECIMAL(18,2)) AS total_revenue
        FROM {FACT_SQL} f JOIN {DOCTOR_SQL} d USING (doctor_key) GROUP BY {by}"""


def _ordered(sql: str, order: str) -> str:
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({sql})"


_TREND = "SELECT CAST(o_orderdate AS DATE) AS visit_date, count(*) AS total_visits FROM orders GROUP BY 1"

QUERIES = {
    "kpi_department_performance": department_performance,
    "kpi_top3_departments": top3_departments,
    "kpi_doctor_productivity": doctor_productivity,
    "kpi_avg_revenue_per_visit": avg_revenue_per_visit,
    "kpi_high_billing_alerts": high_billing_alerts,
    "kpi_repeat_patients": repeat_patients,
    "kpi_daily_visit_trend": daily_visit_trend,
    "kpi_peak_load": peak_load,
    "kpi_peak_load_ties": peak_load_ties,
}

ORACLE = {
    "kpi_department_performance": _ordered(_grouped("department"), "total_revenue DESC, department"),
    "kpi_top3_departments": _grouped("department") + " ORDER BY total_revenue DESC, department LIMIT 3",
    "kpi_doctor_productivity": _ordered(_grouped("doctor_name"), "total_visits DESC, total_revenue DESC, doctor_name"),
    # whole numbers, so that the rounding is exact: q is the average in units of 10^-8
    "kpi_avg_revenue_per_visit": f"""SELECT doctor_name, CAST(CASE WHEN s < 0 THEN '-' ELSE '' END || CAST(q // 100000000 AS VARCHAR)
            || '.' || lpad(CAST(q % 100000000 AS VARCHAR), 8, '0') AS DECIMAL(30,8)) AS avg_revenue_per_visit
        FROM (SELECT doctor_name, s, (abs(s) * 2000000 + n) // (2 * n) AS q FROM (
            SELECT doctor_name, CAST(sum(total_charges) * 100 AS HUGEINT) AS s, CAST(count(total_charges) AS HUGEINT) AS n
            FROM {FACT_SQL} f JOIN {DOCTOR_SQL} d USING (doctor_key) GROUP BY doctor_name) WHERE n > 0)""",
    "kpi_high_billing_alerts": _ordered(
        f"SELECT * FROM {FACT_SQL} WHERE total_charges > {ALERT_OVER}",
        "total_charges DESC, order_id, line_no, doctor_key, visit_date",
    ),
    "kpi_repeat_patients": _ordered(
        """SELECT c_name AS full_name, count(o_orderkey) AS total_visits
        FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_name""",
        "total_visits DESC, full_name",
    ),
    "kpi_daily_visit_trend": _TREND,
    "kpi_peak_load": _TREND + " ORDER BY total_visits DESC, visit_date LIMIT 5",
    "kpi_peak_load_ties": f"WITH t AS ({_TREND}) SELECT * FROM t WHERE total_visits = (SELECT max(total_visits) FROM t)",
}
