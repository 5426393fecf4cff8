"""File ingestion and table-store queries. The files are written from the given tables first."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.values import amount
from stratalake.operators.bucketed import lookup_bucketed, merge_bucketed, write_bucketed
from stratalake.registry.roles import MONEY, table
from stratalake.session import work_dir
from stratalake.sources.csv_layer import physical_schema, read_csv_layer
from stratalake.sources.ledger import FileLoader, file_in, list_files
from stratalake.sources.store import TableStore

BUCKETS = 8
COLUMNS = ["bill_id", "patient_id", "bill_amount", "bill_date", "note"]
FILE_SCHEMA = physical_schema(COLUMNS, padding=2)
RAW_SCHEMA = T.StructType(
    [
        T.StructField("bill_id", T.StringType()),
        T.StructField("patient_id", T.StringType()),
        T.StructField("bill_amount", T.DecimalType(12, 2)),
        T.StructField("bill_date", T.StringType()),
        T.StructField("note", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("load_timestamp", T.TimestampType()),
    ]
)


def loaded_columns():
    """The amount is typed on the way in, the rest stays text."""
    return {**dict.fromkeys(COLUMNS), "bill_amount": amount("bill_amount", 12, 2)}


def stamp():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def _bills(spark, d):
    """Orders as delivered text: a comma in the text, padding, null tokens, two unnamed columns."""
    priority = F.col("o_orderpriority")
    note = (
        F.when(priority == "1-URGENT", F.lit("null"))
        .when(priority == "2-HIGH", F.lit("high, very"))
        .when(priority == "3-MEDIUM", F.lit(""))
        .otherwise(F.concat(F.lit("  "), priority, F.lit(" ")))
    )
    money = F.when(F.col("o_orderstatus") == "P", F.lit("NULL")).otherwise(
        F.col("o_totalprice").cast(MONEY).cast("string")
    )
    return table(spark, d, "orders").select(
        F.concat(F.lit("B"), F.col("o_orderkey").cast("string")).alias("bill_id"),
        F.col("o_custkey").cast("string").alias("patient_id"),
        money.alias("bill_amount"),
        F.date_format("o_orderdate", "dd-MM-yyyy").alias("bill_date"),
        note.alias("note"),
        F.lit(None).cast("string").alias("_x1"),
        F.lit(None).cast("string").alias("_x2"),
        "o_orderstatus",
    )


def _write_csv(rows, folder: str) -> str:
    """CSV files with a header line each and CRLF line ends; padding is kept."""
    out = rows.write.option("header", True).option("lineSep", "\r\n")
    out.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    return folder


def bill_files(spark, d, label: str) -> str:
    return _write_csv(_bills(spark, d).drop("o_orderstatus"), work_dir(spark, label))


def _files_with_short_lines(spark, d) -> list[str]:
    """Open orders are delivered with their first two fields only."""
    folder = work_dir(spark, "bills-short")
    is_open = F.col("o_orderstatus") == "O"
    whole = _bills(spark, d).where(~is_open).drop("o_orderstatus")
    short = _bills(spark, d).where(is_open).select("bill_id", "patient_id")
    return [_write_csv(whole, f"{folder}/whole"), _write_csv(short, f"{folder}/short")]


def csv_ingest_roundtrip(spark, d):
    good, _ = read_csv_layer(spark, bill_files(spark, d, "bills"), FILE_SCHEMA, loaded_columns(), stamp())
    named = F.col("file_name").endswith(".csv").alias("from_csv")
    return good.select(*COLUMNS, named, F.col("load_timestamp").cast("timestamp_ntz").alias("load_timestamp"))


def _strictly(spark, d):
    paths = _files_with_short_lines(spark, d)
    return read_csv_layer(spark, paths, FILE_SCHEMA, loaded_columns(), stamp(), short_lines="reject")


def csv_ingest_skip_bad_rows(spark, d):
    return _strictly(spark, d)[0].select(*COLUMNS)


def csv_ingest_rejected_lines(spark, d):
    return _strictly(spark, d)[1].select("line")


def csv_ingest_pad_short_rows(spark, d):
    paths = _files_with_short_lines(spark, d)
    return read_csv_layer(spark, paths, FILE_SCHEMA, loaded_columns(), stamp())[0].select(*COLUMNS)


def csv_ingest_every_line(spark, d):
    """Right, short, long and broken lines offered to one table: each is loaded or set aside."""
    folder = work_dir(spark, "bills-mixed")
    orders, status = table(spark, d, "orders"), F.col("o_orderstatus")
    fields = F.concat_ws(",", F.concat(F.lit("B"), F.col("o_orderkey")), F.col("o_custkey"))
    line = (
        F.when(status == "O", fields)
        .when(status == "P", F.concat(fields, F.lit(",1,d,n,,,more,fields")))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(fields, F.lit(',1,d,"open')))
        .otherwise(F.concat(fields, F.lit(",1,d,n,,")))
    )
    # one column without quoting: every line as it is, below a header of its own
    lines = orders.select(line.alias(",".join([*COLUMNS, "", ""])))
    lines.write.option("header", True).option("quote", "").option("sep", "\t").csv(folder)
    store = TableStore(spark, work_dir(spark, "bills-mixed-store"))
    store.create("raw", "bills", RAW_SCHEMA)
    loader = FileLoader(store)
    loader.load("raw", "bills", f"{folder}/part*", FILE_SCHEMA, loaded_columns(), stamp())
    bills, rejects = store.read("raw", "bills"), loader.rejected("raw", "bills")
    loaded = bills.select("bill_id", F.col("note").isNotNull().alias("whole"), F.lit("loaded").alias("outcome"))
    set_aside = rejects.select(F.split("line", ",")[0].alias("bill_id"), F.lit(False).alias("whole"), F.lit("rejected").alias("outcome"))
    return loaded.unionByName(set_aside)


def _load(spark, d, label: str, force: bool):
    """The same files offered to a raw table twice."""
    folder = bill_files(spark, d, label)
    store = TableStore(spark, work_dir(spark, f"{label}-store"))
    store.create("raw", "bills", RAW_SCHEMA)
    loader = FileLoader(store)
    for _ in range(2):
        loader.load("raw", "bills", f"{folder}/part*", FILE_SCHEMA, loaded_columns(), stamp(), force=force)
    return store.read("raw", "bills")


def csv_load_once(spark, d):
    return _load(spark, d, "once", False).select("bill_id", "bill_amount")


def csv_force_reload(spark, d):
    return _load(spark, d, "forced", True).groupBy("bill_id").agg(F.count(F.lit(1)).alias("copies"))


def csv_truncate_and_reload(spark, d):
    """Emptied and made anew: the history goes with the rows, so every file loads again, once."""
    folder = bill_files(spark, d, "reload")
    store = TableStore(spark, work_dir(spark, "reload-store"))
    store.create("raw", "bills", RAW_SCHEMA)
    loader = FileLoader(store)
    loader.load("raw", "bills", f"{folder}/part*", FILE_SCHEMA, loaded_columns(), stamp())
    before = store.read("raw", "bills").count()
    store.truncate("raw", "bills")
    for _ in range(2):
        loader.load("raw", "bills", f"{folder}/part*", FILE_SCHEMA, loaded_columns(), stamp())
    return store.read("raw", "bills").select("bill_id", F.lit(before).alias("rows_then"))


def _bills_by_status(spark, d, label: str) -> str:
    """A folder of files for each order status."""
    folder = work_dir(spark, label)
    out = _bills(spark, d).write.option("header", True).partitionBy("o_orderstatus")
    out.csv(folder)
    return folder


def staged_file_list(spark, d):
    """The files written for each status, found by listing."""
    listed = list_files(spark, f"{_bills_by_status(spark, d, 'listed')}/o_orderstatus=*")
    status = F.regexp_extract("path", r"/o_orderstatus=([^/]+)/", 1).alias("o_orderstatus")
    return listed.groupBy(status).agg((F.sum("length") > 0).alias("has_bytes"))


def csv_one_named_file(spark, d):
    """One file of several: only its rows are loaded."""
    folder = _bills_by_status(spark, d, "named")
    store = TableStore(spark, work_dir(spark, "named-store"))
    store.create("raw", "bills", RAW_SCHEMA)
    path = file_in(folder, "o_orderstatus=F")
    FileLoader(store).load("raw", "bills", path, FILE_SCHEMA, loaded_columns(), stamp())
    return store.read("raw", "bills").select("bill_id", "bill_amount")


def _customer_store(spark, d, label: str) -> TableStore:
    store = TableStore(spark, work_dir(spark, label))
    customers = table(spark, d, "customer")
    store.create("raw", "customer", customers.schema)
    store.append("raw", "customer", customers.where("c_acctbal >= 0"))
    store.append("raw", "customer", customers.where("c_acctbal < 0"))
    return store


def table_append(spark, d):
    return _customer_store(spark, d, "append").read("raw", "customer")


def table_drop_column(spark, d):
    store = _customer_store(spark, d, "drop")
    store.drop_column("raw", "customer", "c_mktsegment")
    return store.read("raw", "customer")


def table_truncate(spark, d):
    """Row counts before and after."""
    store = _customer_store(spark, d, "truncate")
    before = store.read("raw", "customer").count()
    store.truncate("raw", "customer")
    after = store.read("raw", "customer").agg(F.count(F.lit(1)).alias("rows_after"))
    return after.withColumn("rows_before", F.lit(before))


def table_merge(spark, d):
    """Customers in debt merged onto the others' table, which is split by key; only some folders are written."""
    store = TableStore(spark, work_dir(spark, "merge"))
    customers = table(spark, d, "customer")
    store.create("clean", "customer", customers.schema, parts=8, part_keys=["c_custkey"])
    store.merge("clean", "customer", customers.withColumn("c_name", F.lit("old")), ["c_custkey"])
    store.merge("clean", "customer", customers.where("c_acctbal < 0"), ["c_custkey"])
    return store.read("clean", "customer")


def csv_quoted_line_breaks(spark, d):
    """Notes of two lines inside quotes, in files that are read by several tasks each."""
    folder = work_dir(spark, "bills-quoted")
    two_lines = F.concat(F.col("o_orderpriority"), F.lit('\n"second", line'))
    lines = table(spark, d, "orders").select(
        F.concat(F.lit("B"), F.col("o_orderkey")).alias("bill_id"), F.col("o_custkey").cast("string").alias("patient_id"),
        F.lit("1").alias("bill_amount"), F.lit("d").alias("bill_date"), F.when(F.col("o_orderstatus") != "F", two_lines).alias("note"),
        *[F.lit(None).cast("string").alias(c) for c in ("_x1", "_x2")],
    )
    lines.write.option("header", True).option("escape", '"').csv(folder)
    good, _ = read_csv_layer(spark, folder, FILE_SCHEMA, loaded_columns(), stamp(), multi_line=True)
    return good.select("bill_id", "patient_id", "note")


def load_counts(spark, d):
    """Rows loaded and set aside by status of the order, as the load counted them while it wrote."""
    folder = work_dir(spark, "bills-counted")
    orders = table(spark, d, "orders")
    out = None
    for status in ("F", "O", "P"):
        fields = F.concat_ws(",", F.concat(F.lit("B"), F.col("o_orderkey")), F.col("o_custkey"), F.lit("1"), F.lit("d"))
        broken = F.col("o_orderpriority") == "2-HIGH"
        line = F.when(broken, F.concat(fields, F.lit(',"open'))).otherwise(F.concat(fields, F.lit(",n,,")))
        lines = orders.where(F.col("o_orderstatus") == status).select(line.alias(",".join([*COLUMNS, "", ""])))
        lines.write.option("header", True).option("quote", "").option("sep", "\t").csv(f"{folder}/{status}")
        store = TableStore(spark, work_dir(spark, "bills-counted-store"))
        store.create("raw", "bills", RAW_SCHEMA)
        FileLoader(store).load("raw", "bills", f"{folder}/{status}/part*", FILE_SCHEMA, loaded_columns(), stamp())
        counted = (status, store.rows("raw", "bills"), store.marks("raw", "bills")["set_aside"])
        row = spark.createDataFrame([counted], "o_orderstatus string, loaded long, set_aside long")
        out = row if out is None else out.unionByName(row)
    return out


def table_merge_bucketed(spark, d):
    """Orders of the later days and changed ones merged onto the earlier ones, both bucketed by key."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast(MONEY).alias("price"))
    old = orders.where(F.col("o_custkey") % 3 != 0)
    delta = orders.where(F.col("o_custkey") % 3 < 2).withColumn("o_orderstatus", F.lit("X"))
    names = [f"bucketed_{uuid.uuid4().hex[:12]}" for _ in range(2)]
    held = write_bucketed(old, names[0], work_dir(spark, names[0]), ["o_orderkey"], BUCKETS)
    return merge_bucketed(held, delta, ["o_orderkey"], names[1], work_dir(spark, names[1]), BUCKETS)


def resolve_keys_bucketed(spark, d):
    """Order lines and parts bucketed by the part's key: the lookup shuffles neither."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = table(spark, d, "part").where(F.col("p_size") > 10).select("p_partkey", "p_brand")
    made = []
    for rows, key in ((lines, "l_partkey"), (parts, "p_partkey")):
        name = f"bucketed_{uuid.uuid4().hex[:12]}"
        made.append(write_bucketed(rows, name, work_dir(spark, name), [key], BUCKETS))
    return lookup_bucketed(*made, "l_partkey", "p_partkey", "p_brand")


_BILLS_SQL = """(SELECT 'B' || CAST(o_orderkey AS VARCHAR) AS bill_id, CAST(o_custkey AS VARCHAR) AS patient_id,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(12,2)) END AS bill_amount,
    strftime(o_orderdate, '%d-%m-%Y') AS bill_date, CASE o_orderpriority WHEN '1-URGENT' THEN NULL
    WHEN '2-HIGH' THEN 'high, very' WHEN '3-MEDIUM' THEN NULL ELSE o_orderpriority END AS note, o_orderstatus FROM orders)"""

QUERIES = {
    "csv_ingest_roundtrip": csv_ingest_roundtrip,
    "csv_ingest_skip_bad_rows": csv_ingest_skip_bad_rows,
    "csv_ingest_rejected_lines": csv_ingest_rejected_lines,
    "csv_ingest_pad_short_rows": csv_ingest_pad_short_rows,
    "csv_load_once": csv_load_once,
    "csv_force_reload": csv_force_reload,
    "csv_ingest_every_line": csv_ingest_every_line,
    "csv_truncate_and_reload": csv_truncate_and_reload,
    "csv_one_named_file": csv_one_named_file,
    "staged_file_list": staged_file_list,
    "table_append": table_append,
    "table_drop_column": table_drop_column,
    "table_truncate": table_truncate,
    "table_merge": table_merge,
    "table_merge_bucketed": table_merge_bucketed,
    "resolve_keys_bucketed": resolve_keys_bucketed,
    "csv_quoted_line_breaks": csv_quoted_line_breaks,
    "csv_load_counts": load_counts,
}

ORACLE = {
    "csv_ingest_roundtrip": f"""SELECT * EXCLUDE (o_orderstatus), true AS from_csv,
        TIMESTAMP '2024-06-01 00:00:00' AS load_timestamp FROM {_BILLS_SQL}""",
    "csv_ingest_skip_bad_rows": f"SELECT * EXCLUDE (o_orderstatus) FROM {_BILLS_SQL} WHERE o_orderstatus <> 'O'",
    "csv_ingest_rejected_lines": f"SELECT bill_id || ',' || patient_id AS line FROM {_BILLS_SQL} WHERE o_orderstatus = 'O'",
    "csv_ingest_pad_short_rows": f"""SELECT bill_id, patient_id,
        CASE WHEN o_orderstatus <> 'O' THEN bill_amount END AS bill_amount,
        CASE WHEN o_orderstatus <> 'O' THEN bill_date END AS bill_date,
        CASE WHEN o_orderstatus <> 'O' THEN note END AS note FROM {_BILLS_SQL}""",
    "csv_load_once": f"SELECT bill_id, bill_amount FROM {_BILLS_SQL}",
    "csv_force_reload": f"SELECT bill_id, CAST(2 AS BIGINT) AS copies FROM {_BILLS_SQL}",
    "csv_ingest_every_line": """SELECT 'B' || o_orderkey AS bill_id, NOT broken AND o_orderstatus <> 'O' AS whole,
        CASE WHEN broken THEN 'rejected' ELSE 'loaded' END AS outcome
        FROM (SELECT *, o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' AS broken FROM orders)""",
    "csv_truncate_and_reload": "SELECT 'B' || o_orderkey AS bill_id, (SELECT count(*) FROM orders) AS rows_then FROM orders",
    "csv_one_named_file": f"SELECT bill_id, bill_amount FROM {_BILLS_SQL} WHERE o_orderstatus = 'F'",
    "staged_file_list": "SELECT DISTINCT o_orderstatus, true AS has_bytes FROM orders",
    "csv_quoted_line_breaks": """SELECT 'B' || o_orderkey AS bill_id, CAST(o_custkey AS VARCHAR) AS patient_id,
        CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority || chr(10) || '"second", line' END AS note FROM orders""",
    "csv_load_counts": """SELECT o_orderstatus, count(*) FILTER (o_orderpriority <> '2-HIGH') AS loaded,
        count(*) FILTER (o_orderpriority = '2-HIGH') AS set_aside FROM orders WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY 1""",
    "table_merge_bucketed": """SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 3 < 2 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
        CAST(o_totalprice AS DECIMAL(12,2)) AS price FROM orders""",
    "resolve_keys_bucketed": """SELECT l_orderkey, l_linenumber, l_partkey, p_brand
        FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON l_partkey = p_partkey""",
    "table_append": "SELECT * FROM customer",
    "table_drop_column": "SELECT * EXCLUDE (c_mktsegment) FROM customer",
    "table_merge": "SELECT * REPLACE (CASE WHEN c_acctbal < 0 THEN c_name ELSE 'old' END AS c_name) FROM customer",
    "table_truncate": "SELECT count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after FROM customer",
}
