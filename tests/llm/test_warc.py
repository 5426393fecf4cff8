"""WARC archives: exact round trips, magic inside payloads, splits anywhere, damage."""

import base64
import hashlib
import random

import pytest

from stratalake.llm import warc
from stratalake.session import work_dir

SCHEMA = "page_id long, url string, html string, digest string, place long, size int"


def fake(n):
    """What a whole record looks like, as part of a payload."""
    return f"\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{n}>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def odd():
    rng = random.Random(3)
    texts = ["", None, "a", "WARC/1.1", "\nWARC/1.1\r", "WARC/1.1\r\n", "\n\r\n\r\n", "é漢\n" * 40, "x" * 300_000]
    texts += [fake(1), f"{fake(2) * 3}tail", f"WARC/1.1\r\nContent-Length: 0\r\n\r\n{fake(77)}", "\nWARC/1.1\r" * 50, "\r\n\r\n" * 9]
    texts += ["".join(rng.choice(["\n", "\r", "WARC/1.1", "WARC/1.1\r", "\nWARC/1.1\r\n", "a", fake(5)]) for _ in range(rng.randint(1, 30))) for _ in range(40)]
    return texts


def rows():
    texts = odd()
    data = [(i, f"http://h/{i}", t, "x", 1, 2) for i, t in enumerate(texts)]
    data += [(1000 + i, None, t, "x", 1, 2) for i, t in enumerate(texts[:20])]  # copies
    data += [(3, "http://h/3", texts[3], "x", 1, 2), (None, "u\r\n\r\nWARC/1.1\r\n", "no id", "x", 1, 2), (None, None, "a", "x", 1, 2)]
    data += [(500, "http://h/WARC/1.1", "in the url", "x", 1, 2), (-4, "http://h", "in the url", "x", 1, 2)]
    return data


def expected(data, least=0):
    body = lambda t: (t or "").encode()
    first = {}
    for page, _, text, *_ in data:
        if page is not None and len(body(text)) >= least:
            first[text or ""] = min(page, first.get(text or "", page))
    out = []
    for page, _, text, *_ in data:
        f = first.get(text or "")
        digest = base64.b32encode(hashlib.sha1(body(text)).digest()).decode()
        again = f is not None and page != f and len(body(text)) >= least
        out.append((page, len(body(text)), digest, "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


@pytest.fixture(params=[None, "100", "4096"])
def split(spark, request):
    if request.param:
        spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def written(spark, data, parts, **options):
    path = work_dir(spark, "test-warc")
    warc.write_archives(spark.createDataFrame(data, SCHEMA).repartition(parts), path, **options)
    return path


def test_round_trip_wherever_the_files_are_split(spark, split):
    # short and few texts, so that splits of 100 bytes are some hundreds
    data = [d for d in rows() if len(d[2] or "") < 2000][:: 3 if spark.conf.get("spark.sql.files.maxPartitionBytes") == "100" else 1]
    got = warc.page_records(warc.read_archives(spark, written(spark, data, 2))).collect()
    assert sorted(map(tuple, got), key=str) == expected(data)


def test_payloads_come_back_byte_for_byte(spark):
    data = rows()
    path = written(spark, data, 3)
    records = warc.read_archives(spark, path, payloads=True).collect()
    assert len(records) == len(data)
    responses = sorted((r.payload.decode() for r in records if r.type == "response"))
    assert set(responses) == {t or "" for _, _, t, *_ in data}
    assert all(r.declared == f"sha1:{r.digest}" for r in records if r.type == "response")
    assert sorted(map(tuple, warc.page_records(warc.read_archives(spark, path)).collect()), key=str) == expected(data)
    urls = {r.name: r.url for r in records}
    assert urls["<urn:page:500>"] == "http://h/WARC/1.1" and urls["<urn:page:>"] in (None, "u%0D%0A%0D%0AWARC/1.1%0D%0A")


def test_files_hold_plain_records_one_after_the_other(spark):
    data = rows()[:25]
    path = written(spark, data, 1)
    files = spark.read.format("binaryFile").load(path).collect()
    names = []
    for file in files:
        raw, at = bytes(file.content), 0
        while at < len(raw):
            end = raw.index(b"\r\n\r\n", at)
            lines = raw[at:end].split(b"\r\n")
            assert lines[0] == b"WARC/1.1"
            fields = dict(line.split(b": ", 1) for line in lines[1:])
            at = end + 4 + int(fields[b"Content-Length"])
            assert raw[at : at + 4] == b"\r\n\r\n"
            at += 4
            names.append(fields[b"WARC-Record-ID"].decode())
    assert sorted(names) == sorted(f"<urn:page:{d[0]}>" for d in data)


def test_least_size_of_a_revisit(spark):
    data = rows()
    got = warc.page_records(warc.read_archives(spark, written(spark, data, 2, min_revisit_bytes=9))).collect()
    assert sorted(map(tuple, got), key=str) == expected(data, 9)


def test_repeated_payloads_beyond_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(warc, "fits_broadcast", lambda df: False)
    data = rows()
    got = warc.page_records(warc.read_archives(spark, written(spark, data, 2))).collect()
    assert sorted(map(tuple, got), key=str) == expected(data)


def test_a_broken_file_is_told(spark):
    path = written(spark, [(i, "u", f"text {i}", "x", 1, 2) for i in range(6)], 1)
    text = "".join(bytes(f.content).decode() for f in spark.read.format("binaryFile").load(path).collect())
    cut = text.replace("Content-Length: 6\r\n\r\ntext 3", "Content-Length: 6\r\n\r\ntext 3 and more")
    assert cut != text
    damaged = work_dir(spark, "damaged")
    spark.createDataFrame([(cut.removesuffix("\r\n\r\n"),)], "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(damaged)
    with pytest.raises(ValueError, match="ends early"):
        warc.read_archives(spark, damaged)
    kept = warc.read_archives(spark, damaged, broken="keep")
    before = text[: text.index("text 3")].count("WARC-Record-ID")
    assert kept.count() == before


def test_chains_by_doubling(spark):
    rng = random.Random(5)
    follow, starts = {}, [0, 1000, 5000]
    for start, n in zip(starts, (1, 130, 17)):
        at = start
        for _ in range(n):
            follow[at] = at = at + rng.randint(1, 9)
    want, todo = set(), [s for s in starts if s in follow]
    while todo:
        at = todo.pop()
        want.add(at)
        todo += [follow[at]] if follow[at] in follow else []
    side = {at + 100_000: rng.choice(sorted(follow)) for at in range(50)}  # candidates that nothing leads to
    nodes = spark.createDataFrame(sorted((follow | side).items()), "place long, next long")
    got = [r.place for r in warc.reach(nodes, spark.createDataFrame([(s,) for s in starts], "place long")).collect()]
    assert sorted(got) == sorted(want)


def test_no_rows(spark):
    assert warc.page_records(warc.read_archives(spark, written(spark, [], 1))).count() == 0


def test_digest(spark):
    texts = ["", "a", "é" * 1000] + [str(i) for i in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(1)
    from pyspark.sql import functions as F

    for r in df.select("t", warc.base32_sha1(F.encode("t", "UTF-8")).alias("d")).collect():
        assert r.d == base64.b32encode(hashlib.sha1(r.t.encode()).digest()).decode()
