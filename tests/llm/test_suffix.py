"""Repeated byte strings against a plain version, and the index against its definition."""

import random
from collections import Counter

import numpy as np
import pytest
from cases import corpus, empty, frame, rows
from pyspark.sql import functions as F

from stratalake.llm import membership, suffix


def plain(documents, window):
    seen, out = set(), {}
    for i, t in sorted({(i, t) for i, t in documents if i is not None and t is not None}):
        b, gone = t.encode(), set()
        for p in range(len(b) - window + 1):
            if b[p : p + window] in seen:
                gone.update(range(p, p + window))
            seen.add(b[p : p + window])
        runs = sum(p - 1 not in gone for p in gone)
        out[i] = (len(b), len(gone), runs, bytes(x for p, x in enumerate(b) if p not in gone))
    rest = lambda t: (len((t or "").encode()), 0, 0, (t or "").encode())
    return Counter((i, *out.get(i, rest(t))) for i, t in documents)


@pytest.mark.parametrize(
    "seed, settings",
    [(0, {}), (1, {"hot": 1}), (2, {"window": 20, "k": 6}), (3, {"window": 30, "k": 29, "block_bytes": 1})],
)
def test_against_plain(spark, seed, settings):
    texts = corpus(seed)
    got = suffix.remove_repeats(frame(spark, texts), **settings).collect()
    assert Counter((*r[:4], bytes(r[4])) for r in got) == plain([r[:2] for r in rows(texts)], settings.get("window", 100))


@pytest.mark.parametrize("seed", range(8))
def test_index(seed):
    rng = random.Random(seed)
    segments = [bytes(rng.choice(b"ab\x00\xff"[: rng.randint(1, 4)]) for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(1, 8))]
    text, lengths = b"".join(segments), [len(s) for s in segments]
    room = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(text))
    order = suffix.suffix_order(np.frombuffer(text, np.uint8), room)
    tails = [text[i : i + room[i]] for i in range(len(text))]
    assert order.tolist() == sorted(range(len(text)), key=lambda i: (tails[i], i))
    shared = suffix.matching_statistics(np.frombuffer(text + bytes(8), np.uint8), room, order)
    for before, here in zip(order, order[1:]):
        a, b = tails[before], tails[here]
        assert shared[here] == next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    for window in (1, 3, 7):
        seen, again = set(), []
        for i, t in enumerate(tails):
            if len(t) >= window:
                again += [i] * (t[:window] in seen)
                seen.add(t[:window])
        assert suffix.repeats(segments, window).tolist() == again


def test_text_stays_valid(spark):
    texts = ["é" * 120 + "x", "z" + "é" * 110 + "y", "é" * 120 + "x", "q" * 99, "  "]
    got = suffix.without_repeats(frame(spark, texts))
    assert got.columns == frame(spark, texts).columns
    kept = {r.doc_id: r.text for r in got.where("doc_id is not null").collect()}
    assert kept[0].startswith("é") and 2 not in kept and kept[3] == "q" * 99 and kept[4] == "  " and kept[len(texts)] is None
    assert suffix.without_repeats(empty(spark)).count() == 0
    assert suffix.remove_repeats(empty(spark)).count() == 0


def test_bitmap_grows_with_its_members(spark):
    """It lets few other hashes pass, however many members it has, and stays small for few."""
    n = 6_000_000
    hashes = spark.range(n).select(F.xxhash64("id").alias("h"))
    own = hashes.where("h % 100 = 0").toArrow()["h"].to_numpy()
    other = spark.range(n, n + 200_000).select(F.xxhash64("id").alias("h")).toArrow()["h"].to_numpy()
    found = membership.bitmap(hashes, "h").value
    assert membership.contains(found, own).all()
    assert membership.contains(found, other).mean() < 0.02
    assert len(membership.bitmap(hashes.limit(1000), "h").value) * 64 == 1 << membership.LEAST_BITS


def test_classes_of_anchors(spark):
    """The same rows, however many classes the segments are taken up in."""
    texts = corpus(5)
    got = suffix.remove_repeats(frame(spark, texts), class_rows=300).collect()
    assert Counter((*r[:4], bytes(r[4])) for r in got) == plain([r[:2] for r in rows(texts)], 100)
