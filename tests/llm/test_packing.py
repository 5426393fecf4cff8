"""Packing: the tokenizer's own ids, and every id in exactly one place."""

import random
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from cases import corpus, empty, frame, rows
from tokenizers import Tokenizer

from stratalake.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_ids_are_the_tokenizers():
    rng, own, whole = random.Random(1), packing.WordEncoder(PATH), Tokenizer.from_file(PATH)
    signs = "ab'sST 1\t\n é́İΣß!.<|endoftext|> \x1c字😀\u00adÀµªºÿĀſƒ²½\u00a0\u2028"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    for text in [*texts, "a <|endoftext|> b<|startoftext|>c", "", "don't  we'll", "WORD " * 3000, *corpus()]:
        want = whole.encode(text, add_special_tokens=False).ids
        assert own.encode(text.encode()).tolist() == [*want, packing.END]


def test_lookups_forget_the_old():
    made = []
    recent = packing._Recent(3, lambda key: made.append(key) or -key)
    assert [recent(k) for k in (1, 2, 3, 1, 4, 1, 5, 6, 7, 1)] == [-1, -2, -3, -1, -4, -1, -5, -6, -7, -1]
    assert len(recent.now) <= 3 and made.count(1) == 1


@pytest.mark.parametrize("seed", range(6))
def test_plan(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 2, 7, 63, 64, 65, 128, 500]) for _ in range(rng.randint(1, 300))]
    windows = packing.plan(lengths, 64)
    assert all(0 < sum(n for *_, n in w) <= 64 for w in windows)
    seen = defaultdict(list)
    for doc, start, n in (p for w in windows for p in w):
        seen[doc].append((start, n))
    for doc, n in enumerate(lengths):
        at = 0
        for start, size in sorted(seen[doc]):
            assert start == at and size > 0
            at += size
        assert at == n
    assert len(windows) == -(-sum(lengths) // 64) or len(windows) - sum(lengths) / 64 < 2


def test_differencing_is_nearly_even():
    rng = random.Random(2)
    sizes = [rng.randint(1, 1000) for _ in range(400)]
    sums = [sum(sizes[i] for i in part) for part in packing.differencing(sizes, 40)]
    assert max(sums) - min(sums) < 0.02 * max(sums) and sum(sums) == sum(sizes)
    assert packing.differencing([], 2) == [[], []]


def test_differencing_holds_filled_windows_only():
    tracemalloc.start()
    parts = packing.differencing([20] * 20_000, 98)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6 and sorted(i for part in parts for i in part) == list(range(20_000))


def test_long_run_of_null_texts(spark):
    docs = spark.range(150_000).selectExpr("id AS doc_id", "cast(NULL AS string) AS text").coalesce(1)
    got = packing.pack(docs, PATH).collect()
    assert sorted(r.doc_id for r in got) == list(range(150_000)) and all(r.length == r.doc_tokens == 1 for r in got)
    assert len({r.sequence_id for r in got}) == 37
    few = packing.pack(docs.limit(2500).coalesce(1), PATH, group_docs=1000).collect()
    assert len(few) == 2500 and len({r.sequence_id for r in few}) == 3


def test_pack(spark):
    texts = corpus(3) + ["word " * 9000]
    got = packing.pack(frame(spark, texts), PATH, 256, 5000).collect()
    whole, windows, docs = Tokenizer.from_file(PATH), defaultdict(list), defaultdict(list)
    for r in got:
        windows[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append(r)
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    texts = dict((i, t) for i, t, *_ in rows(texts))
    assert docs.keys() == texts.keys()
    for doc, pieces in docs.items():
        ids = np.array([*whole.encode(texts[doc] or "", add_special_tokens=False).ids, packing.END], "<u4")
        spans = sorted((p.start, p.length) for p in pieces)
        times = 2 if doc == 3 else 1
        assert sum(n for _, n in spans) == times * len(ids)
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes()) and p.doc_tokens == len(ids)
    total = sum(r.length for r in got)
    assert len(windows) < total / 256 + 3 + total / 5000 + 1
    assert packing.pack(empty(spark), PATH).count() == 0


def test_same_ids_on_a_second_run(spark):
    docs = frame(spark, corpus(1)).coalesce(2)
    run = lambda: sorted(map(tuple, packing.pack(docs, PATH).collect()), key=str)
    assert run() == run()
