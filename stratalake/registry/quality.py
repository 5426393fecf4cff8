"""Quality-rule queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.rules import negative_status, register_validation, text_status, validate_struct
from stratalake.functions.text import null_tokens, trim_columns
from stratalake.functions.values import amount, parse_amounts, std_date, total
from stratalake.operators.quality import invalid_date_rule, missing_id_rule, quality_summary, require, split_bad
from stratalake.operators.quality import violations
from stratalake.plans.visits import AMOUNTS, VISIT_CHECK
from stratalake.registry.roles import LOOKUP_SQL, MONEY, NEGATIVE_SQL, RAW_SQL, STATUS_SQL, amount_sql, date_sql
from stratalake.registry.roles import missing_sql, raw_visits, sum_sql, table


def validate_visits_struct(spark, d):
    rows = parse_amounts(raw_visits(spark, d), AMOUNTS)
    return rows.select("visit_id", validate_struct(VISIT_CHECK).alias("v")).select("visit_id", "v.*")


def validate_visits_sql_function(spark, d):
    register_validation(spark, "validate_visit", VISIT_CHECK)
    raw_visits(spark, d).createOrReplaceTempView("delivered_visits")
    args = ", ".join(VISIT_CHECK.columns())
    return spark.sql(f"SELECT visit_id, v.* FROM (SELECT visit_id, validate_visit({args}) AS v FROM delivered_visits)")


def _dates(spark, d):
    day = F.col("o_orderdate")
    text = (
        F.when(F.col("o_orderstatus") == "F", F.date_format(day, "dd-MM-yyyy"))
        .when(F.col("o_orderstatus") == "O", F.date_format(day, "yyyy-MM-dd"))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit("2024-13-01"))
        .when(F.col("o_orderpriority") != "1-URGENT", F.date_format(day, "MM-dd-yyyy"))
    )
    return table(spark, d, "orders").select("o_orderkey", text.alias("text_date"))


_DATES_SQL = """(SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%d-%m-%Y')
    WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN o_orderpriority = '5-LOW' THEN '2024-13-01'
    WHEN o_orderpriority <> '1-URGENT' THEN strftime(o_orderdate, '%m-%d-%Y') END AS text_date FROM orders)"""


def standardize_dates(spark, d):
    return _dates(spark, d).select("o_orderkey", "text_date", std_date("text_date").alias("visit_date"))


def total_charges(spark, d):
    return raw_visits(spark, d).select("visit_id", *AMOUNTS, total(AMOUNTS).alias("total_charges"))


def billing_status(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey",
        F.col("c_acctbal").cast(MONEY).alias("bill_amount"),
        negative_status(["c_acctbal"]).alias("billing_status"),
    )


def component_status(spark, d):
    return raw_visits(spark, d).select("visit_id", negative_status(AMOUNTS).alias("billing_status"))


def _quarantined(bad):
    v = validate_struct(VISIT_CHECK)
    return bad.select(
        "visit_id",
        "patient_id",
        "doctor_id",
        "department_id",
        F.col("visit_date").alias("visit_date_raw"),
        v["visit_date"].alias("visit_date_std"),
        *[amount(c).alias(c) for c in AMOUNTS],
        v["total_charges"].alias("total_charges"),
        "error_reason",
    )


def quarantine_bad_rows(spark, d):
    rows = parse_amounts(raw_visits(spark, d), AMOUNTS)
    return _quarantined(split_bad(rows, [missing_id_rule("patient_id")])[1])


def quarantine_with_date_rule(spark, d):
    rules = [missing_id_rule("patient_id"), invalid_date_rule("visit_date")]
    return _quarantined(split_bad(parse_amounts(raw_visits(spark, d), AMOUNTS), rules)[1])


def good_rows(spark, d):
    return split_bad(raw_visits(spark, d), [missing_id_rule("patient_id")])[0]


def required_columns_filter(spark, d):
    return require(raw_visits(spark, d), ["visit_id", "patient_id", "doctor_id"])


def clean_text(spark, d):
    return trim_columns(raw_visits(spark, d), ["visit_id", "patient_id", "doctor_id", "department_id"])


def quality_summary_visits(spark, d):
    v = parse_amounts(raw_visits(spark, d), AMOUNTS).select(validate_struct(VISIT_CHECK).alias("v")).select("v.*")
    return quality_summary(v, ["status", "lookup_status"])


def _tokens(spark, d):
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("NULL"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit(" null "))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit(""))
        .otherwise(F.concat(F.lit(" "), F.col("o_orderpriority")))
    )
    return table(spark, d, "orders").select("o_orderkey", text.alias("note"))


_TOKENS_SQL = """(SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'NULL' WHEN '2-HIGH' THEN ' null '
    WHEN '3-MEDIUM' THEN '' ELSE ' ' || o_orderpriority END AS note FROM orders)"""


def null_token_normalize(spark, d):
    return _tokens(spark, d).select("o_orderkey", null_tokens("note").alias("note"))


def diagnosis_status(spark, d):
    return _tokens(spark, d).select("o_orderkey", text_status("note").alias("record_status"))


# Declared lengths that some of the delivered texts break.
_DECLARED = T.StructType(
    [
        T.StructField("visit_id", T.StringType(), False, {"max_length": 8}),
        T.StructField("patient_id", T.StringType(), False, {"max_length": 4}),
        T.StructField("department_id", T.StringType(), False),
        T.StructField("visit_date", T.StringType(), True, {"max_length": 10}),
    ]
)


def schema_violations(spark, d):
    return violations(raw_visits(spark, d), _DECLARED)


_VISIT_SQL = f"""SELECT visit_id, {date_sql('visit_date')} AS visit_date, {LOOKUP_SQL} AS lookup_status,
    {sum_sql()} AS total_charges, {STATUS_SQL} AS status FROM {RAW_SQL}"""


def _quarantine_sql(reason: str) -> str:
    return f"""SELECT * FROM (SELECT visit_id, patient_id, doctor_id, department_id, visit_date AS visit_date_raw,
        {date_sql('visit_date')} AS visit_date_std, {', '.join(f'{amount_sql(c)} AS {c}' for c in AMOUNTS)},
        {sum_sql()} AS total_charges, {reason} AS error_reason FROM {RAW_SQL}) WHERE error_reason IS NOT NULL"""


_MISSING = f"WHEN {missing_sql('patient_id')} THEN 'Missing Patient ID'"

QUERIES = {
    "validate_visits_struct": validate_visits_struct,
    "validate_visits_sql_function": validate_visits_sql_function,
    "standardize_dates": standardize_dates,
    "total_charges": total_charges,
    "billing_status": billing_status,
    "component_billing_status": component_status,
    "quarantine_bad_rows": quarantine_bad_rows,
    "quarantine_with_date_rule": quarantine_with_date_rule,
    "good_rows": good_rows,
    "required_columns_filter": required_columns_filter,
    "clean_text": clean_text,
    "quality_summary": quality_summary_visits,
    "null_token_normalize": null_token_normalize,
    "diagnosis_status": diagnosis_status,
    "schema_violations": schema_violations,
}

ORACLE = {
    "validate_visits_struct": _VISIT_SQL,
    "validate_visits_sql_function": _VISIT_SQL,
    "standardize_dates": f"SELECT o_orderkey, text_date, {date_sql('text_date')} AS visit_date FROM {_DATES_SQL}",
    "total_charges": f"SELECT visit_id, {', '.join(AMOUNTS)}, {sum_sql()} AS total_charges FROM {RAW_SQL}",
    "billing_status": """SELECT c_custkey, CAST(c_acctbal AS DECIMAL(12,2)) AS bill_amount,
        CASE WHEN c_acctbal < 0 THEN 'INVALID' ELSE 'VALID' END AS billing_status FROM customer""",
    "component_billing_status": f"""SELECT visit_id,
        CASE WHEN {NEGATIVE_SQL} THEN 'INVALID' ELSE 'VALID' END AS billing_status FROM {RAW_SQL}""",
    "quarantine_bad_rows": _quarantine_sql(f"CASE {_MISSING} END"),
    "quarantine_with_date_rule": _quarantine_sql(
        f"CASE {_MISSING} WHEN {date_sql('visit_date')} IS NULL THEN 'Invalid Visit Date' END"
    ),
    "good_rows": f"SELECT * FROM {RAW_SQL} WHERE NOT {missing_sql('patient_id')}",
    "required_columns_filter": f"""SELECT * FROM {RAW_SQL} WHERE NOT {missing_sql('visit_id')}
        AND NOT {missing_sql('patient_id')} AND NOT {missing_sql('doctor_id')}""",
    "clean_text": f"""SELECT trim(visit_id) AS visit_id, trim(patient_id) AS patient_id, trim(doctor_id) AS doctor_id,
        trim(department_id) AS department_id, visit_date, {', '.join(AMOUNTS)} FROM {RAW_SQL}""",
    "quality_summary": f"SELECT status, lookup_status, count(*) AS row_count FROM ({_VISIT_SQL}) GROUP BY ALL",
    "null_token_normalize": f"""SELECT o_orderkey, CASE WHEN trim(note) NOT IN ('NULL', 'null', '') THEN trim(note) END
        AS note FROM {_TOKENS_SQL}""",
    "diagnosis_status": f"""SELECT o_orderkey, CASE WHEN {missing_sql('note')} THEN 'INVALID' ELSE 'VALID' END
        AS record_status FROM {_TOKENS_SQL}""",
    "schema_violations": f"""WITH r AS (SELECT * FROM {RAW_SQL})
        SELECT 'visit_id' AS column_name, 'not_null' AS rule, count(*) FILTER (visit_id IS NULL) AS violations FROM r
        UNION ALL SELECT 'visit_id', 'max_length', count(*) FILTER (length(visit_id) > 8) FROM r
        UNION ALL SELECT 'patient_id', 'not_null', count(*) FILTER (patient_id IS NULL) FROM r
        UNION ALL SELECT 'patient_id', 'max_length', count(*) FILTER (length(patient_id) > 4) FROM r
        UNION ALL SELECT 'department_id', 'not_null', count(*) FILTER (department_id IS NULL) FROM r
        UNION ALL SELECT 'visit_date', 'max_length', count(*) FILTER (length(visit_date) > 10) FROM r""",
}
