"""Column functions on hand-made values."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratalake.functions import rules, text, values


def one(spark, rows, expr, schema="s string"):
    df = spark.createDataFrame([(r,) for r in rows], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_missing_and_present_are_opposites(spark):
    rows = [None, "", "   ", "\t", "x", " x "]
    assert one(spark, rows, text.missing("s")) == [True, True, True, False, False, False]
    assert one(spark, rows, text.present("s")) == [False, False, False, True, True, True]


def test_null_tokens(spark):
    rows = ["NULL", " null ", "", None, "Null", " a "]
    assert one(spark, rows, text.null_tokens("s")) == [None, None, None, None, "Null", "a"]


def test_std_date(spark):
    rows = ["15-01-2024", "2024-01-15", "02-20-2024", "2024-13-01", "30-02-2024", "29-02-2024", "5-3-2024"]
    want = [date(2024, 1, 15), date(2024, 1, 15), None, None, None, date(2024, 2, 29), None]
    assert one(spark, rows, values.std_date("s")) == want
    assert one(spark, [None, "", " 05-03-2024", "05-03-2024\n", "05-03-20244"], values.std_date("s")) == [None] * 5


@pytest.mark.parametrize("fmt", ["dd-MM-yyyy", "yyyy-MM-dd", "yyyy.MM.dd", "MM/dd/yyyy", "dd MMM yyyy", "yyyyMMdd"])
def test_parse_date_agrees_with_the_general_parser(spark, fmt):
    rows = ["15-01-2024", "2024-01-15", "31-04-2024", "2023-02-29", "2024.02.29", "12/31/1999", "13/31/1999"]
    rows += ["05 Mar 2024", "20240305", "20241305", "x", "", "1-1-2024", "99-99-9999", "01-01-9999"]
    assert one(spark, rows, values.parse_date("s", fmt)) == one(spark, rows, F.try_to_date("s", fmt))


def test_amount(spark):
    rows = ["1.005", "abc", " 5 ", "1e3", "123456789", "-0.5", None, ""]
    want = [Decimal("1.01"), None, Decimal(5), Decimal(1000), None, Decimal("-0.5"), None, None]
    assert one(spark, rows, values.amount("s")) == want


def test_total_and_negative(spark):
    df = spark.createDataFrame([("1", None, "x"), ("-1", "2.50", ""), (None, None, None)], "a string, b string, c string")
    cols = ["a", "b", "c"]
    assert [r[0] for r in df.select(values.total(cols)).collect()] == [1, Decimal("1.50"), 0]
    assert [r[0] for r in df.select(rules.negative_status(cols)).collect()] == ["VALID", "INVALID", "VALID"]
    parsed = values.parse_amounts(df, cols)
    assert [r[0] for r in parsed.select(values.total(cols)).collect()] == [1, Decimal("1.50"), 0]


CHECK = rules.RowCheck("p", "d", ["a", "b"], [("p", "MISSING_PATIENT"), ("q", "MISSING_DOCTOR")])
ROWS = [
    ("P", "Q", "01-02-2024", "1", "2"),
    (" ", "Q", "2024-02-01", "-1", "2"),
    ("P", None, "x", "-1", "x"),
    ("P", "", None, None, None),
    (None, None, "02-20-2024", "5", "-9"),
]
EXPECTED = [
    (date(2024, 2, 1), "OK", Decimal(3), "VALID"),
    (date(2024, 2, 1), "MISSING_PATIENT", Decimal(1), "BAD"),
    (None, "MISSING_DOCTOR", Decimal(-1), "INVALID"),
    (None, "MISSING_DOCTOR", Decimal(0), "VALID"),
    (None, "MISSING_PATIENT", Decimal(-4), "BAD"),
]


def test_validation_struct_and_sql_function_agree(spark):
    df = spark.createDataFrame(ROWS, "p string, q string, d string, a string, b string")
    struct = df.select(rules.validate_struct(CHECK).alias("v")).select("v.*")
    assert [tuple(r) for r in struct.collect()] == EXPECTED
    rules.register_validation(spark, "check_row", CHECK)
    df.createOrReplaceTempView("check_rows")
    by_sql = spark.sql(f"SELECT v.* FROM (SELECT check_row({', '.join(CHECK.columns())}) AS v FROM check_rows)")
    assert [tuple(r) for r in by_sql.collect()] == EXPECTED
    assert struct.schema.simpleString() == by_sql.schema.simpleString()


def test_text_status(spark):
    assert one(spark, [None, " ", "flu"], rules.text_status("s")) == ["INVALID", "INVALID", "VALID"]


def test_a_rule_in_sql_needs_names():
    from stratalake.functions.tree import Given, Value, call, node

    assert node("a b").sql() == "`a b`" and Value("it's \\d").sql() == "'it\\'s \\\\d'" and Value(None).sql() == "NULL"
    assert call("if", Value(True), 1, False).sql() == "if(TRUE, 1, FALSE)"
    with pytest.raises(ValueError):
        Given(None).sql()
