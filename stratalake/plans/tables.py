"""Columns of the visit warehouse, layer by layer.

Fixed values: the table and column names, types and text lengths are those the
reports and loads expect.
"""

from __future__ import annotations

from pyspark.sql import types as T

RAW, VALIDATED, CLEAN = "raw", "validated", "clean"


def _text(name: str, length: int, nullable: bool = True) -> T.StructField:
    return T.StructField(name, T.StringType(), nullable, {"max_length": length})


def _money(name: str, digits: int = 10) -> T.StructField:
    return T.StructField(name, T.DecimalType(digits, 2))


def _date(name: str) -> T.StructField:
    return T.StructField(name, T.DateType())


def _key(name: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, T.LongType(), nullable)


_LINEAGE_RAW = [_text("file_name", 50), T.StructField("load_timestamp", T.TimestampType())]
_LINEAGE = [_text("source_file_name", 255), T.StructField("load_ts", T.TimestampType())]

DEFINITIONS = {
    (RAW, "raw_patient_visits"): [
        _text("visit_id", 50),
        _text("patient_id", 50),
        _text("doctor_id", 50),
        _text("department_id", 50),
        _text("visit_date", 50),
        _text("consultation_fee", 50),
        _text("medicine_cost", 50),
        _text("lab_cost", 50),
        _text("total_bill", 50),
        *_LINEAGE_RAW,
    ],
    (RAW, "raw_diagnosis"): [
        _text("diagnosis_id", 50),
        _text("visit_id", 50),
        _text("diagnosis", 255),
        _text("notes", 500),
        *_LINEAGE_RAW,
    ],
    (RAW, "raw_billing"): [
        _text("bill_id", 50),
        _text("visit_id", 50),
        _money("bill_amount"),
        _text("bill_date", 50),
        *_LINEAGE_RAW,
    ],
    (RAW, "raw_dim_patient"): [
        _text("patient_id", 50),
        _text("full_name", 255),
        _text("city", 100),
        *_LINEAGE_RAW,
    ],
    (RAW, "raw_dim_doctor"): [
        _text("doctor_id", 50),
        _text("doctor_name", 255),
        _text("department", 100),
        *_LINEAGE_RAW,
    ],
    (VALIDATED, "validated_patient_visits"): [
        _text("visit_id", 50, nullable=False),
        _text("patient_id", 50, nullable=False),
        _text("doctor_id", 50),
        _text("department_id", 50),
        _date("visit_date"),
        _money("consultation_fee"),
        _money("medicine_cost"),
        _money("lab_cost"),
        _money("total_charges", 12),
        _text("billing_status", 20),
        _text("record_status", 30),
        *_LINEAGE,
    ],
    (VALIDATED, "validated_dim_patient"): [
        _text("patient_id", 50, nullable=False),
        _text("full_name", 255, nullable=False),
        _text("city", 100),
        _text("record_status", 30),
        *_LINEAGE,
    ],
    (VALIDATED, "validated_dim_doctor"): [
        _text("doctor_id", 50, nullable=False),
        _text("doctor_name", 255, nullable=False),
        _text("department", 100),
        _text("record_status", 30),
        *_LINEAGE,
    ],
    (VALIDATED, "validated_billing"): [
        _text("bill_id", 50, nullable=False),
        _text("visit_id", 50, nullable=False),
        _money("bill_amount"),
        _date("bill_date"),
        _text("billing_status", 20),
        _text("record_status", 30),
        *_LINEAGE,
    ],
    (VALIDATED, "validated_diagnosis"): [
        _text("diagnosis_id", 50, nullable=False),
        _text("visit_id", 50, nullable=False),
        _text("diagnosis", 255, nullable=False),
        _text("notes", 500),
        _text("record_status", 30),
        *_LINEAGE,
    ],
    (VALIDATED, "bad_patient_data"): [
        _text("visit_id", 50),
        _text("patient_id", 50),
        _text("doctor_id", 50),
        _text("department_id", 50),
        _text("visit_date_raw", 50),
        _date("visit_date_std"),
        _money("consultation_fee"),
        _money("medicine_cost"),
        _money("lab_cost"),
        _money("total_charges", 12),
        _text("error_reason", 255),
        _text("record_status", 30),
        *_LINEAGE,
    ],
    (CLEAN, "dim_patient"): [
        _key("patient_key", nullable=False),
        _text("patient_id", 50, nullable=False),
        _text("full_name", 255),
        _text("city", 100),
        *_LINEAGE,
    ],
    (CLEAN, "dim_doctor"): [
        _key("doctor_key", nullable=False),
        _text("doctor_id", 50, nullable=False),
        _text("doctor_name", 255),
        _text("department", 100),
        *_LINEAGE,
    ],
    (CLEAN, "fact_patient_visits"): [
        _key("visit_key", nullable=False),
        _text("visit_id", 50, nullable=False),
        _key("patient_key"),
        _key("doctor_key"),
        _date("visit_date"),
        _money("total_charges", 12),
        *_LINEAGE,
    ],
    # visits whose patient or doctor was not known when they were loaded
    (CLEAN, "pending_keys"): [_text("visit_id", 50, nullable=False), _text("patient_id", 50), _text("doctor_id", 50)],
}

# Unnamed columns after the named ones in the delivered files.
CSV_PADDING = {"raw_patient_visits": 0, "raw_diagnosis": 2, "raw_billing": 2, "raw_dim_patient": 2, "raw_dim_doctor": 3}


def schema_of(layer: str, table: str) -> T.StructType:
    """The declared schema; text lengths are in the field metadata as ``max_length``.

    ``total_charges`` is two digits wider than the amounts it adds up, so that no total is lost.
    """
    return T.StructType(DEFINITIONS[layer, table])


def file_columns(table: str) -> list[str]:
    """Named CSV columns of a raw table, in file order."""
    return schema_of(RAW, table).names[:-2]
