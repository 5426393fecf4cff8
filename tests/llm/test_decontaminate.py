"""Benchmark items in documents against all windows."""

import random
from collections import Counter

import numpy as np
import pytest
from cases import empty, frame, prose

from stratalake.llm import decontaminate as d

ITEMS = "item_id long, text string, doc_id string"


def shingles(words):
    k = min(5, len(words))
    return Counter(tuple(words[p : p + k]) for p in range(len(words) - k + 1))


def plain(texts, items):
    """Pairs of document and item with a window of the item's size that is similar enough, and how similar."""
    own = {i: t.lower().split() for i, t in items.items()}
    uses = Counter(s for words in {tuple(w) for w in own.values()} for s in shingles(list(words)))
    found = {}
    for doc, text in enumerate(texts):
        words = text.lower().split()
        for item, mine in own.items():
            want = shingles(mine)
            for p in range(len(words) - len(mine) + 1) if mine else ():
                have = shingles(words[p : p + len(mine)])
                weight = lambda c: sum(n / uses[s] if s in want else n for s, n in c.items())
                like = weight(want & have) / weight(want | have)
                if like >= 0.75:
                    found[doc, item] = max(like, found.get((doc, item), 0))
    return found


def hits(spark, texts, items, parts=3):
    """Pairs found, of the documents that ``frame`` gives once."""
    table = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS).repartition(parts)
    docs = frame(spark, texts + [""] * (4 - len(texts)))
    got = d.contaminated(docs, table).where("doc_id is not null and doc_id <> 3").collect()
    return {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got}, len(got)


def test_against_all_windows(spark):
    rng = random.Random(1)
    items = {i: prose(rng, rng.randint(5, 60)) for i in range(30)}
    items |= {30: items[3], 31: items[4] + " " + prose(rng, 4), 32: "a b c d", 33: "a b c d e a b c d e", 34: "Q", 35: "q\tR\ns"}
    texts = []
    for _ in range(60):
        words = prose(rng, rng.randint(0, 200)).split()
        item = rng.choice(list(items.values())).split()
        if rng.random() < 0.4 and len(item) > 25:
            item[rng.randrange(len(item))] = "changed"
        at = rng.randint(0, len(words))
        texts.append(" ".join(words[:at] + item + words[at:] if rng.random() < 0.6 else words))
    texts += ["", "q", "p q r s", "a b c d", "x A b C d e a b c d E", items[5].upper() + "\n" + items[6], items[7] + " z " + items[7]]
    table = spark.createDataFrame([(i, t, "x") for i, t in items.items()] + [(40, None, "x"), (None, texts[0], "x")], ITEMS)
    docs = frame(spark, texts)
    got = [r for r in d.contaminated(docs, table).collect() if r.doc_id is not None and r.doc_id != 3]
    want = {k: v for k, v in plain(texts, items).items() if k[0] != 3}
    assert len({(r.doc_id, r.item_id) for r in got}) == len(got)
    assert {(r.doc_id, r.item_id) for r in got} <= want.keys()
    missed = want.keys() - {(r.doc_id, r.item_id) for r in got}
    assert not missed
    assert all(r.similarity >= 0.75 and r.n_words == len(items[r.item_id].split()) for r in got)
    clean = {r.doc_id for r in d.without_contaminated(docs, table).collect()}
    assert clean == {i for i, *_ in docs.select("doc_id").collect()} - {r.doc_id for r in d.contaminated(docs, table).collect()}
    assert d.without_contaminated(docs, table).columns == docs.columns


def test_recall_of_pairs_just_similar_enough(spark):
    rng = random.Random(4)
    texts, items = [], {}
    for i in range(600):
        # as many words replaced as leave the item just similar enough
        size, changed = [(39, [17]), (60, [20, 23]), (100, [40, 44, 48])][i % 3]
        items[i] = prose(rng, size)
        words = items[i].split()
        for k in changed:
            words[k] = "changed"
        texts.append(f"{prose(rng, 8)} {' '.join(words)} {prose(rng, 8)}")
    # items that share shingles, which then weigh next to nothing
    common, alike, mixed = prose(rng, 30).split(), {}, []
    for i in range(600, 612):
        own = prose(rng, 24).split()
        alike[i] = " ".join(common[: rng.randint(10, 30)] + own)
        mixed += [" ".join(common[8:] + own), " ".join(common[15:] + common[:10] + own)]
    want = {(len(texts) + doc, item) for doc, item in plain(mixed, alike)} | {(i, i) for i in range(600)}
    assert {(0, 0), (1, 1), (2, 2)} <= {(i, i) for i in range(3) if plain([texts[i]], {0: items[i]})}
    got, _ = hits(spark, texts + mixed, [*items.items(), *alike.items()])
    want = {k for k in want if k[0] != 3}
    assert got.keys() <= want and len(want - got.keys()) <= 0.01 * len(want)


def test_nothing_is_found_without_the_index(spark, monkeypatch):
    text = prose(random.Random(1), 30)
    assert hits(spark, [text], [(1, text)])[0] == {(0, 1): 1}
    monkeypatch.setattr(d, "RADIUS", -1)
    index = d.ItemIndex([1], [text], np.zeros(0, np.uint64), np.zeros(0, np.int64))
    assert len(index.within_radius(index.prints, 30)[0]) == 0


def shared_passage(n=40):
    """Items with a common passage, and documents that are an item with one word replaced."""
    rng = random.Random(6)
    passage, items, texts = prose(rng, 30), {}, []
    for i in range(n):
        items[i] = f"{passage} {prose(rng, 10)}"
        words = items[i].split()
        words[rng.randrange(6, 24)] = "changed"
        texts.append(" ".join(words))
    return items, texts


@pytest.mark.parametrize("size", [1, 7, 4096])
def test_what_is_found_does_not_depend_on_the_blocks(spark, monkeypatch, size):
    monkeypatch.setattr(d, "BLOCK_ITEMS", size)
    items, texts = shared_passage()
    items, texts = dict(list(items.items())[:12]), texts[:12]
    for i, words in list(items.items()):
        texts.append(words.replace(" ", "\n", 3))
    want = {k: round(v, 9) for k, v in plain(texts, items).items() if k[0] != 3}
    got, n = hits(spark, texts, list(items.items()))
    assert got.keys() == want.keys() and n == len(got) and len(want) >= 12
    assert all(got[k] <= want[k] for k in got)


def test_repeated_items_change_nothing(spark):
    rng = random.Random(7)
    items = [(i, prose(rng, 40)) for i in range(6)]
    texts = []
    for _, text in items:
        words = text.split()
        words[20] = "changed"
        texts.append(" ".join(words))
    once, n = hits(spark, texts, items)
    assert n == len(once) == 5
    assert hits(spark, texts, items * 4) == (once, n)
    # the same texts, differently spaced and written, under other ids
    more, m = hits(spark, texts, items + [(i + 100 * k, f" {t.upper()}  ") for i, t in items for k in (1, 2)])
    assert m == 3 * n and {k: v for k, v in more.items() if k[1] < 100} == once


def test_items_of_one_id_with_different_texts(spark):
    rng = random.Random(8)
    first, second = prose(rng, 20), prose(rng, 25)
    got, n = hits(spark, [first, second, f"{first} {second}"], [(1, first), (1, second)])
    assert got == {(0, 1): 1, (1, 1): 1, (2, 1): 1} and n == 4


def test_very_long_document(spark):
    rng = random.Random(9)
    items = [(i, prose(rng, 30)) for i in range(3)]
    text = f"{prose(rng, 60_000)} {items[1][1]} {prose(rng, 200_000)} {items[2][1]}"
    got, n = hits(spark, [text, "w " * 100_000 + items[0][1]], items)
    assert got == {(0, 1): 1, (0, 2): 1, (1, 0): 1} and n == 3


def test_more_items_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(d, "BLOCK_ITEMS", 3)
    rng = random.Random(2)
    items = [prose(rng, 20) for _ in range(10)]
    table = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], ITEMS)
    got = d.contaminated(frame(spark, items + ["clean"]), table).where("doc_id is not null and doc_id <> 3").collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(i, i) for i in range(10) if i != 3]


def test_all_fingerprints_within_the_radius():
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(list("abcdefgh"), 20)) for _ in range(40)]
    index = d.ItemIndex(list(range(40)), texts, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    prints = index.prints.copy()
    for i in range(len(prints)):
        for bit in rng.choice(64, rng.integers(0, 30), replace=False):
            prints[i] ^= np.uint64(1) << np.uint64(bit)
    query, item, distance = index.within_radius(prints, 20)
    every = np.bitwise_count(prints[:, None] ^ index.prints[None, :])
    assert {(q, i) for q, i in zip(query, item)} == set(zip(*np.nonzero(every <= d.RADIUS)))
    assert (every[query, item] == distance).all()


def test_empty(spark):
    none = spark.createDataFrame([], ITEMS)
    assert d.contaminated(frame(spark, ["a b c d e f"] * 4), none).count() == 0
    assert d.contaminated(empty(spark), none).count() == 0
