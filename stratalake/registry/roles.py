"""The given tables in the roles of the visit warehouse.

lineitem stands for visits (suppliers are the doctors, parts the patients),
a supplier's region for the department. Lines that share an order and line
number are re-sent visits. For the quality rules the lines are turned into
delivered text; which of them are dirty, and how, follows from their own
attributes. Each frame has a SQL twin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def total_charges(precision: str = "decimal(10,2)"):
    parts = [F.col(c).cast(precision) for c in ("l_extendedprice", "l_quantity", "l_tax")]
    return (parts[0] + parts[1] + parts[2]).cast(precision)


TOTAL_SQL = (
    "CAST(CAST(l_extendedprice AS DECIMAL(10,2)) + CAST(l_quantity AS DECIMAL(10,2)) "
    "+ CAST(l_tax AS DECIMAL(10,2)) AS DECIMAL(10,2))"
)


def visit_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_suppkey").alias("doctor_key"),
        F.col("l_shipdate").cast("date").alias("visit_date"),
        total_charges().alias("total_charges"),
    )


FACT_SQL = f"""(SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_suppkey AS doctor_key,
    CAST(l_shipdate AS DATE) AS visit_date, {TOTAL_SQL} AS total_charges FROM lineitem)"""


def doctor_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("doctor_key"),
            F.col("s_name").alias("doctor_name"),
            F.col("r_name").alias("department"),
        )
    )


DOCTOR_SQL = """(SELECT s_suppkey AS doctor_key, s_name AS doctor_name, r_name AS department
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def raw_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered text: padded ids, missing ids, three date styles, unreadable and negative amounts."""
    flag, status, tax, discount = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_tax"), F.col("l_discount")
    visit = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    fee = F.col("l_extendedprice").cast(MONEY).cast("string")
    ship = F.col("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(
        F.when(flag == "R", F.concat(F.lit("  "), visit, F.lit(" "))).otherwise(visit).alias("visit_id"),
        F.when((tax == 0.0) & (status == "O"), F.when(flag == "A", F.lit("   ")).when(flag == "N", F.lit("")))
        .otherwise(F.concat(F.lit("P"), F.col("l_partkey").cast("string")))
        .alias("patient_id"),
        F.when((tax == 0.01) & (flag == "N"), F.lit(" "))
        .otherwise(F.concat(F.lit("D"), F.col("l_suppkey").cast("string")))
        .alias("doctor_id"),
        F.when(discount != 0.0, F.concat(F.lit("DEP-"), status)).alias("department_id"),
        F.when(flag == "A", F.date_format(ship, "dd-MM-yyyy"))
        .when(flag == "N", F.date_format(ship, "yyyy-MM-dd"))
        .otherwise(F.date_format(ship, "MM-dd-yyyy"))
        .alias("visit_date"),
        F.when((flag == "R") & (status == "F"), F.concat(F.lit("-"), fee)).otherwise(fee).alias("consultation_fee"),
        F.when(discount == 0.05, F.lit("n/a"))
        .otherwise(F.col("l_quantity").cast(MONEY).cast("string"))
        .alias("medicine_cost"),
        F.when(tax != 0.02, tax.cast(MONEY).cast("string")).alias("lab_cost"),
    )


RAW_SQL = """(SELECT
    CASE WHEN l_returnflag = 'R' THEN '  ' || vid || ' ' ELSE vid END AS visit_id,
    CASE WHEN l_tax = 0.0 AND l_linestatus = 'O'
         THEN CASE WHEN l_returnflag = 'A' THEN '   ' WHEN l_returnflag = 'N' THEN '' END
         ELSE 'P' || CAST(l_partkey AS VARCHAR) END AS patient_id,
    CASE WHEN l_tax = 0.01 AND l_returnflag = 'N' THEN ' ' ELSE 'D' || CAST(l_suppkey AS VARCHAR) END AS doctor_id,
    CASE WHEN l_discount <> 0.0 THEN 'DEP-' || l_linestatus END AS department_id,
    CASE l_returnflag WHEN 'A' THEN strftime(l_shipdate, '%d-%m-%Y') WHEN 'N' THEN strftime(l_shipdate, '%Y-%m-%d')
         ELSE strftime(l_shipdate, '%m-%d-%Y') END AS visit_date,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN '-' || fee ELSE fee END AS consultation_fee,
    CASE WHEN l_discount = 0.05 THEN 'n/a' ELSE CAST(CAST(l_quantity AS DECIMAL(12,2)) AS VARCHAR) END AS medicine_cost,
    CASE WHEN l_tax <> 0.02 THEN CAST(CAST(l_tax AS DECIMAL(12,2)) AS VARCHAR) END AS lab_cost
    FROM (SELECT *, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS vid,
                 CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS fee FROM lineitem))"""


def missing_sql(c: str) -> str:
    return f"({c} IS NULL OR trim({c}) = '')"


def date_sql(c: str) -> str:
    return f"CAST(coalesce(try_strptime({c}, '%d-%m-%Y'), try_strptime({c}, '%Y-%m-%d')) AS DATE)"


def amount_sql(c: str) -> str:
    return f"TRY_CAST({c} AS DECIMAL(10,2))"


def sum_sql(cols=("consultation_fee", "medicine_cost", "lab_cost")) -> str:
    return "CAST(" + " + ".join(f"coalesce({amount_sql(c)}, 0)" for c in cols) + " AS DECIMAL(12,2))"


NEGATIVE_SQL = " OR ".join(f"coalesce({amount_sql(c)} < 0, false)" for c in ("consultation_fee", "medicine_cost", "lab_cost"))
STATUS_SQL = f"CASE WHEN {missing_sql('patient_id')} THEN 'BAD' WHEN {NEGATIVE_SQL} THEN 'INVALID' ELSE 'VALID' END"
LOOKUP_SQL = (
    f"CASE WHEN {missing_sql('patient_id')} THEN 'MISSING_PATIENT' WHEN {missing_sql('doctor_id')} "
    f"THEN 'MISSING_DOCTOR' WHEN {missing_sql('department_id')} THEN 'MISSING_DEPARTMENT' ELSE 'OK' END"
)
