"""Repeated passages of words against a plain version."""

import hashlib
import re
from collections import Counter

import pytest
from cases import corpus, empty, frame, rows

from stratalake.llm import substring


def plain(documents, window):
    """Each document's kept words: those in no window that starts in a smaller id."""
    words = [(i, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for i, t in documents]
    first = {}
    for i, w in words:
        if i is not None:
            for p in range(len(w) - window + 1):
                key = tuple(w[p : p + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p : p + window])] < i:
                gone.update(range(p, p + window))
        out.append((i, len(w), len(gone), b" ".join(x for p, x in enumerate(w) if p not in gone).decode()))
    return Counter(out)


@pytest.mark.parametrize("seed, window, k", [(0, 50, 25), (2, 10, 4), (3, 12, 11)])
def test_against_plain(spark, seed, window, k):
    texts = corpus(seed)
    got = Counter(map(tuple, substring.remove_repeats(frame(spark, texts), window, k).collect()))
    assert got == plain([r[:2] for r in rows(texts)], window)


def test_coordinates_of_the_source(spark):
    texts = corpus(4)
    for r in substring.repeated_spans(frame(spark, texts)).collect():
        words, source = texts[r.doc_id].split(), " ".join(texts[r.source_id].split())
        assert r.source_id < r.doc_id and r.n >= 50 and " ".join(words[r.start : r.start + r.n]) in source


def test_paths_are_compacted(spark):
    """Copies of a text are a path each, not a row for each window."""
    texts = [" ".join(f"w{i}" for i in range(2000))] * 5
    docs = frame(spark, texts[:]).where("doc_id is not null and text is not null").select("doc_id", "text").dropDuplicates()
    spans = substring.compacted(docs, substring.edge_counts(docs))
    assert sorted((r.doc_id, r.start, r.n) for r in spans.collect()) == [(i, 0, 2000) for i in range(5)]


def test_digest_and_empty(spark):
    row = substring.digest(substring.remove_repeats(frame(spark, ["a  b"] * 4).where("doc_id = 0"))).first()
    assert tuple(row) == (0, 2, 0, hashlib.sha256(b"a b").hexdigest())
    assert substring.remove_repeats(empty(spark)).count() == 0
