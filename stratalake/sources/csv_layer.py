"""CSV files to raw rows: positional columns, null tokens, file lineage, bad-line split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from stratalake.functions.text import NULL_TOKENS, null_tokens
from stratalake.sources.quoted import quoted_records

CORRUPT, TEXT, FILE, REJECTED = "__corrupt", "__text_", "__file", "__rejected"


def physical_schema(columns: Sequence[str], padding: int = 0) -> T.StructType:
    """All-text schema in file order; ``padding`` unnamed columns follow the named ones."""
    names = [*columns, *[f"_x{i + 1}" for i in range(padding)]]
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


_FORMAT = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
}


def _options(reader, schema: T.StructType):
    # Which lines count as bad must not depend on the columns a query reads.
    reader = reader.options(**_FORMAT, header=True, enforceSchema=True, columnPruning=False)
    return reader.schema(_with_marker(schema))


def _with_marker(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def _typed(df: DataFrame, columns: Mapping[str, Column | None] | Sequence[str], tokens, load_ts: Column, texts: Sequence[str]) -> DataFrame:
    """Wanted columns, lineage, the corrupt-line marker, the cleaned texts, and the file they came from."""
    wanted = columns if isinstance(columns, Mapping) else dict.fromkeys(columns)
    file = F.col("_metadata")
    source = F.struct(file["file_path"].alias("path"), file["file_size"].alias("length"), file["file_modification_time"].alias("modified"))
    cleaned = df.select(*[null_tokens(c, tokens).alias(c) for c in texts], F.col(CORRUPT), file["file_name"].alias("file_name"), source.alias(FILE))
    outputs = [(F.col(c) if e is None else e).alias(c) for c, e in wanted.items()]
    return cleaned.select(*outputs, "file_name", load_ts.alias("load_timestamp"), CORRUPT, *[F.col(c).alias(TEXT + c) for c in texts], FILE)


def _with_rejects(rows: DataFrame, short_lines: str, limits: Mapping[str, int]) -> DataFrame:
    """The rows with ``REJECTED``, the line of each row that cannot be loaded and null for the others."""
    texts = [c for c in rows.columns if c.startswith(TEXT)]
    # put together for rejected lines only
    line = F.to_csv(F.struct(*[F.col(c).alias(c.removeprefix(TEXT)) for c in texts]))
    # Always true, but names a data column: Spark refuses to read the marker alone.
    anything = F.coalesce(F.length(line) >= 0, F.lit(True))
    bad = F.col(CORRUPT).isNotNull() & anything
    if short_lines == "pad":
        # Only an unbalanced quote is an error; lines with too few or too many fields are kept.
        bad = bad & (F.length(F.regexp_replace(CORRUPT, '[^"]', "")) % 2 == 1)
    elif short_lines != "reject":
        raise ValueError("short_lines is 'reject' or 'pad'")
    for col, most in limits.items():
        bad = bad | F.coalesce(F.length(TEXT + col) > most, F.lit(False))
    rejected = F.when(F.coalesce(bad, F.lit(False)), F.coalesce(CORRUPT, line))
    return rows.withColumn(REJECTED, rejected).drop(CORRUPT, *texts)


def _split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    bad = rows.where(F.col(REJECTED).isNotNull())
    return rows.where(F.col(REJECTED).isNull()).drop(REJECTED, FILE), bad.select(F.col(REJECTED).alias("line"), "file_name", "load_timestamp")


def read_csv_rows(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    columns: Mapping[str, Column | None] | Sequence[str],
    load_ts: Column | None = None,
    tokens: Sequence[str] = NULL_TOKENS,
    short_lines: str = "pad",
    multi_line: bool = False,
    limits: Mapping[str, int] | None = None,
    modified_after: datetime | None = None,
) -> DataFrame:
    """Every line of the CSV files under ``path``, parsed once: good and rejected rows told apart by ``REJECTED``.

    Takes the same options as :func:`read_csv_layer`. ``FILE`` holds path, length and change time of the row's file;
    files changed at ``modified_after`` or before are not opened.
    """
    stamp = F.current_timestamp() if load_ts is None else load_ts
    reader = spark.read
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after.strftime("%Y-%m-%dT%H:%M:%S")).option("timeZone", "UTC")
    paths = [path] if isinstance(path, str) else list(path)
    if multi_line:
        records = quoted_records(reader.option("lineSep", "\n").text(paths))
        parsed = F.from_csv("value", _with_marker(schema).toDDL(), _FORMAT).alias("__row")
        raw = records.select(parsed, "_metadata").select("__row.*", "_metadata")
    else:
        raw = _options(reader, schema).csv(paths)
    return _with_rejects(_typed(raw, columns, tokens, stamp, schema.names), short_lines, limits or {})


def read_csv_layer(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    columns: Mapping[str, Column | None] | Sequence[str],
    load_ts: Column | None = None,
    tokens: Sequence[str] = NULL_TOKENS,
    short_lines: str = "pad",
    multi_line: bool = False,
    limits: Mapping[str, int] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected lines) of the CSV files under ``path``.

    ``schema`` names every physical column by position; the header line is
    skipped, not read. ``columns`` picks the wanted ones, either by name or as
    ``{output: expression}`` for a cast while loading (``None`` keeps the text).
    Both frames carry ``file_name`` and ``load_timestamp``. A line with too few
    fields is padded with NULL, and fields too many are ignored;
    ``short_lines="reject"`` makes both bad lines. A bad line is set aside and the
    load goes on: one that does not parse, or exceeds a text length in ``limits``.
    ``multi_line`` allows line ends inside quotes; large files are split all the same.
    """
    return _split(read_csv_rows(spark, path, schema, columns, load_ts, tokens, short_lines, multi_line, limits))


def stream_csv_layer(
    reader: DataStreamReader,
    path: str,
    schema: T.StructType,
    columns: Mapping[str, Column | None] | Sequence[str],
    tokens: Sequence[str] = NULL_TOKENS,
    load_ts: Column | None = None,
    short_lines: str = "pad",
    multi_line: bool = False,
    limits: Mapping[str, int] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """:func:`read_csv_layer` as two streams, (good rows, rejected lines).

    The checkpoint of a query is its load history: each file is read once. With ``multi_line`` a file is one task.
    """
    stamp = F.current_timestamp() if load_ts is None else load_ts
    raw = _options(reader, schema).option("multiLine", multi_line).csv(path)
    return _split(_with_rejects(_typed(raw, columns, tokens, stamp, schema.names), short_lines, limits or {}))
