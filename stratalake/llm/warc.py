"""WARC archives: written by Spark's text writer, read back by verified record chains.

A file is a run of records: ``WARC/1.1``, named fields, an empty line, a block of
``Content-Length`` bytes, two line ends. Spark writes one record per row, with the two
line ends as its line separator; no page is sent through Python for it.

Reading does not trust the version line, since a payload may hold one. Spark's reader
cuts the files at every ``SEAM`` wherever its splits begin (the seam cannot overlap
itself, so the cuts do not depend on the splits), and each task emits a candidate
record for each cut: where it starts and where, by its ``Content-Length``, the next one
must start. Places are prefix sums of the pieces' lengths, within a split and over
the splits. Then pointers are jumped from the start of each file: with ``reached`` the first
2**k records and ``jump`` 2**k records long, one join gives the next 2**k records and one
doubles the jump. Candidates that are never reached lie inside payloads and go. Every
round is a written table, keyed by place alone, so neither a long file nor a
common page is a hot key. A chain that ends before its file does raises an error, unless
``broken="keep"`` asks for the records before the damage.

A payload that holds the seam is spread over several pieces, also of different splits;
such records alone are put together again, each a group of its own.

Nulls: a null payload is empty, a null url is left out of the record, a null id is written
as an empty name and read back as null. Of rows with equal payloads those with the smallest
id are responses (all of them, if a row is repeated) and the others, ids of null included, revisit it;
where all ids are null, all are responses. Line ends in a url are percent-encoded.
Payloads may have any length that a Spark row can hold; other columns are ignored; an
empty table gives an archive without records.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.settle import settled
from stratalake.operators.sizing import fits_broadcast
from stratalake.session import work_dir
from stratalake.sources.staging import stage, stage_scope

VERSION = "WARC/1.1\r"
# Begins at the line end before a version line; its ends differ, so two seams never overlap.
SEAM = "\n" + VERSION
RECORD_END = "\r\n\r\n"
HTTP = "application/http;msgtype=response"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
NAME = "urn:page:"
# The digits of base 32 as Spark's conv() writes them, and as digests are written.
CONV_DIGITS, BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a binary column in upper-case base 32: five hex digits are four of base 32."""
    hexes = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexes, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), CONV_DIGITS, BASE32_DIGITS)


# -- writing -------------------------------------------------------------


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit_bytes: int = 0,
    date: str = DATE,
) -> None:
    """A record for each row, as WARC files below ``path``.

    Of rows with equal payloads of at least ``min_revisit_bytes`` bytes the one with the smallest id holds
    the payload, the others refer to it. Payloads are not shuffled as long as the digests that repeat
    fit a broadcast (they are counted).
    """
    body = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), body.alias("body"))
    rows = rows.withColumns({"digest": base32_sha1(F.encode("body", "UTF-8")), "size": F.octet_length("body")})
    again = rows.where(F.col("size") >= min_revisit_bytes).groupBy("digest", "size")
    again = again.agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null").drop("n")
    again = stage(again, "repeated-payloads")
    rows = rows.join(F.broadcast(again) if fits_broadcast(again) else again, ["digest", "size"], "left")
    rows.select(_record(date).alias("value")).write.option("lineSep", RECORD_END).text(path)


def _record(date: str) -> Column:
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n")
    )
    block = F.when(revisit, head).otherwise(F.concat(head, F.col("body")))

    def field(name: str, *value) -> Column:
        return F.concat(F.lit(f"{name}: "), *value, F.lit("\r\n"))

    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    refers = F.concat(
        field("WARC-Profile", F.lit(PROFILE)), field("WARC-Refers-To", F.lit(f"<{NAME}"), F.col("first").cast("string"), F.lit(">"))
    )
    return F.concat(
        F.lit(f"{VERSION}\n"),
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", F.lit(f"<{NAME}"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">")),
        field("WARC-Date", F.lit(date)),
        F.coalesce(field("WARC-Target-URI", url), F.lit("")),
        field("WARC-Payload-Digest", F.lit("sha1:"), F.col("digest")),
        F.when(revisit, refers).otherwise(""),
        field("Content-Type", F.lit(HTTP)),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )


# -- reading -------------------------------------------------------------

FIELDS = {"warc-type": "type", "warc-record-id": "name", "warc-target-uri": "url", "warc-refers-to": "refers", "warc-payload-digest": "declared"}
PIECE = "file string, size long, block long, rel long, bytes long"
PARSED = ", ".join(f"{c} string" for c in FIELDS.values()) + ", header long, length long, digest string, payload_bytes long, payload binary"


def _parse(text: bytes) -> tuple[dict[str, str], int, int] | None:
    """Fields, where the block starts and how long it is, or None if no record starts here; ``text`` follows the version line."""
    end = text.find(b"\r\n\r\n")
    if end < 0 or text[:1] != b"\n":
        return None
    fields, length = {}, None
    for line in text[1:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        name, value = name.strip().lower().decode("latin-1"), value.strip()
        if not colon:
            return None
        if name == "content-length":
            if not (value.isascii() and value.isdigit() and len(value) < 19):
                return None
            length = int(value)
        elif name in FIELDS:
            fields[FIELDS[name]] = value.decode("utf-8", "replace")
        elif name == "content-type":
            fields["content"] = value.decode("latin-1").lower()
    return None if length is None else (fields, end + 4, length)


def _payload(block: bytes, content: str) -> bytes:
    """The block without the head of the HTTP message it holds."""
    if not content.startswith("application/http"):
        return block
    head = block.find(b"\r\n\r\n")
    return block if head < 0 else block[head + 4 :]


def _parsed(text: bytes, keep: bool) -> list:
    """The ``PARSED`` columns of one piece; nulls from ``digest`` on if its block goes on after the piece."""
    found = _parse(text)
    if found is None:
        return [None] * (len(FIELDS) + 5)
    fields, start, length = found
    row = [fields.get(c) for c in FIELDS.values()] + [start, length]
    if start + length > len(text):
        return [*row, None, None, None]
    body = _payload(text[start : start + length], fields.get("content", ""))
    return [*row, base64.b32encode(hashlib.sha1(body).digest()).decode(), len(body), body if keep else None]


def _cut(spark: SparkSession, path: str) -> DataFrame:
    m = F.col("_metadata")
    pieces = spark.read.option("lineSep", SEAM).text(path)
    return pieces.select(m["file_path"].alias("file"), m["file_size"].alias("size"), m["file_block_start"].alias("block"), F.col("value").cast("binary"))


def _pieces(spark: SparkSession, path: str, emit, columns: str) -> DataFrame:
    """``PIECE`` and ``columns`` for each piece of the files, in order within each split.

    ``rel`` is where the piece begins, counted from the first piece of its split; ``bytes`` is its length with the seam.
    ``emit`` gets what follows a version line up to the next line end that precedes one.
    """
    schema = f"{PIECE}, {columns}"
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*((c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")))

    def scan(batches: Iterator[pa.RecordBatch]):
        where, rel = None, 0
        for batch in batches:
            out = []
            for file, size, block, value in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (file, block) != where:
                    where, rel = (file, block), 0
                text = value
                if block == 0 and rel == 0:  # the file's first version line follows no line end
                    text = value[len(VERSION) :] if value.startswith(VERSION.encode()) else b""
                out.append([file, size, block, rel, len(value) + len(SEAM), *emit(text + b"\n")])
                rel += out[-1][4]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], list(names))

    return _cut(spark, path).mapInArrow(scan, schema)


def _placed(pieces: DataFrame) -> DataFrame:
    """The pieces with ``start``, ``place`` and ``stop``: of their file, of their version line, of the file's end.

    All places are counted through all files, with a gap of one, so that one long is a place. One row per
    split meets in one task for the running sums.
    """
    sums = pieces.groupBy("file", "block").agg(F.sum("bytes").alias("n"), F.max("size").alias("size"))
    files = sums.groupBy("file").agg(F.max("size").alias("size"), F.sum("n").alias("n"))
    wrong = files.where(f"n not in (size, size + {len(SEAM)})").select("file").take(3)
    if wrong:
        raise ValueError(f"the pieces do not add up to the files: {[r.file for r in wrong]}")
    before = "rows between unbounded preceding and 1 preceding"
    files = files.selectExpr("file", "size", f"coalesce(sum(size + 1) over (order by file {before}), 0) as start")
    sums = sums.selectExpr("file", "block", f"coalesce(sum(n) over (partition by file order by block {before}), 0) as base")
    placed = pieces.drop("size").join(sums.join(files, "file"), ["file", "block"])
    first = (F.col("base") == 0) & (F.col("rel") == 0)
    own = F.col("start") + F.col("base") + F.col("rel")
    return placed.withColumns({"place": F.when(first, own).otherwise(own - len(VERSION)), "stop": F.col("start") + F.col("size")})


def reach(nodes: DataFrame, starts: DataFrame) -> DataFrame:
    """The places met on the way from ``starts`` (``place``) along ``nodes`` (``place``, ``next``), by pointer jumping.

    Every place has one successor, none is met twice. Rounds grow with the logarithm of the longest chain.
    """
    known = nodes.select("place")
    # successors that are no candidates end their chain
    jump = stage(nodes.join(known.withColumnRenamed("place", "next"), "next", "left_semi").select("place", "next"), "jump")
    reached = stage(starts.select("place").join(known, "place", "left_semi"), "reached")
    while not jump.isEmpty():
        more = reached.join(jump, "place").select(F.col("next").alias("place"))
        reached = stage(reached.union(more), "reached")
        then = jump.select(F.col("place").alias("next"), F.col("next").alias("then"))
        jump = stage(jump.join(then, "next").select("place", F.col("then").alias("next")), "jump")
    return reached


RECORD = ["file", "offset", *FIELDS.values(), "digest", "payload_bytes", "payload"]


def read_archives(spark: SparkSession, path: str, payloads: bool = False, broken: str = "raise") -> DataFrame:
    """The records of the WARC files below ``path``, one row each, as a written table.

    ``digest`` and ``payload_bytes`` are of the payload as read, ``declared`` is what the record says; ``payload`` is
    null unless ``payloads`` asks for it. A file whose chain of records ends early raises, or with ``broken="keep"``
    gives the records before that point.
    """
    return settled(spark, "archives", lambda: _records(spark, path, payloads, broken))


def _records(spark: SparkSession, path: str, payloads: bool, broken: str) -> DataFrame:
    found = stage(_pieces(spark, path, lambda text: _parsed(text, payloads), PARSED), "candidates")
    places = stage(_placed(found.drop("payload")).drop("payload"), "places")
    block = F.col("place") + len(VERSION) + F.col("header")
    nodes = places.where("header is not null").withColumn("next", block + F.col("length") + len(RECORD_END))
    nodes = nodes.where(F.col("next") <= F.col("stop"))
    starts = places.select(F.col("start").alias("place")).distinct()
    true = nodes.join(reach(nodes.select("place", "next"), starts), "place", "left_semi")
    true = stage(true, "records")
    if broken == "raise":
        ended = true.where("next = stop").select("file")
        lost = places.select("file").distinct().join(ended, "file", "left_anti").take(3)
        if lost:
            raise ValueError(f"the chain of records ends early in {[r.file for r in lost]}")
    whole = true.where("digest is not null")
    spread = true.where("digest is null")
    if payloads:
        whole = whole.join(found.select("file", "block", "rel", "payload"), ["file", "block", "rel"])
    else:
        whole = whole.withColumn("payload", F.lit(None).cast("binary"))
    records = whole.withColumn("offset", F.col("place") - F.col("start")).select(*RECORD)
    if spread.isEmpty():
        return records
    return records.union(_put_together(spark, path, places, spread, payloads).select(*RECORD))


def _put_together(spark: SparkSession, path: str, places: DataFrame, spread: DataFrame, payloads: bool) -> DataFrame:
    """The records of which the payload holds seams: their pieces, read again, in order."""
    # the last record that starts before a piece owns it: within its split, else the last one of earlier splits
    marks = places.join(spread.select("place", F.col("next").alias("end")), "place", "left")
    own = "over (partition by file, block order by place rows between unbounded preceding and current row)"
    marks = marks.selectExpr(
        "file", "block", "rel", "place", f"max(if(end is null, null, place)) {own} as owner", f"max(end) {own} as end"
    )
    carried = marks.groupBy("file", "block").agg(F.max("owner").alias("o"), F.max("end").alias("e"))
    before = "over (partition by file order by block rows between unbounded preceding and 1 preceding)"
    carried = carried.selectExpr("file", "block", f"max(o) {before} as o", f"max(e) {before} as e")
    marks = marks.join(carried, ["file", "block"])
    marks = marks.withColumns({"owner": F.coalesce("owner", "o"), "end": F.coalesce("end", "e")}).where("place < end")
    texts = _pieces(spark, path, lambda text: [text], "text binary")
    parts = marks.select("file", "block", "rel", "place", "owner").join(texts, ["file", "block", "rel"])
    parts = parts.groupBy("owner").agg(F.sort_array(F.collect_list(F.struct("place", "text"))).alias("parts"))

    def join(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for owner, pieces in zip(batch.column("owner").to_pylist(), batch.column("parts").to_pylist()):
                row = _parsed(VERSION.encode().join(p["text"] for p in pieces), payloads)[-3:]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([owner]), *(pa.array([x], t) for x, t in zip(row, (pa.string(), pa.int64(), pa.binary())))],
                    ["place", "digest", "payload_bytes", "payload"],
                )

    joined = parts.mapInArrow(join, "place long, digest string, payload_bytes long, payload binary")
    spread = spread.drop("digest", "payload_bytes", "payload").withColumn("offset", F.col("place") - F.col("start"))
    return spread.join(joined, "place")


def page_records(records: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of records that ``write_archives`` wrote.

    A revisit takes size and digest from the payload of the response it names.
    """

    def number(name: str) -> Column:
        return F.expr(f"try_cast(regexp_extract({name}, '^<{NAME}(-?[0-9]+)>$', 1) as long)")

    own = records.select("type", number("name").alias("page_id"), number("refers").alias("refers_to"), "declared", "payload_bytes", "digest")
    columns = ["page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to"]
    responses = own.where("type = 'response'")
    # a page may be given twice; a response is named once
    named = responses.select(F.col("page_id").alias("refers_to"), "digest", "payload_bytes").distinct()
    declared = F.concat(F.lit("sha1:"), F.col("digest")) == F.col("declared")
    revisits = own.where("type = 'revisit'").drop("digest", "payload_bytes").join(named, "refers_to").where(declared)
    return responses.select(*columns).union(revisits.select(*columns))


def op13_warc(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")

    def build():
        path = work_dir(spark, "warc")
        write_archives(pages, path)
        done = page_records(read_archives(spark, path))
        return done

    return settled(spark, "op13", build)


_HEX = "('0x' || substr(h, 1 + 5 * i, 5))::BIGINT"
_DIGITS = " || ".join(f"substr('{BASE32_DIGITS}', 1 + ((v >> {shift}) & 31)::INTEGER, 1)" for shift in (15, 10, 5, 0))
ORACLE = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
  d AS (SELECT page_id, n, h, min(page_id) OVER (PARTITION BY h, n) AS first,
          list_aggregate(list_transform(list_transform(range(8), lambda i: {_HEX}), lambda v: {_DIGITS}), 'string_agg', '') AS digest FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""
