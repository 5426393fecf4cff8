"""Near copies against all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from cases import corpus, empty, frame, prose, rows

from stratalake.llm import minhash
from stratalake.llm.components import components


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[p : p + 5]) for p in range(max(len(words) - 4, min(len(words), 1)))}


def merged(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, y in links:
        x, y = sorted((root(x), root(y)))
        parent[y] = x
    return {i: root(i) for i in ids}


def plain(documents):
    sets = {i: shingles(t) for i, t in documents if i is not None}
    links = [
        (x, y) for x in sets for y in sets
        if x < y and sets[x] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y])
    ]
    part = merged(sets, links)
    return Counter((i, len(shingles(t)), part.get(i), i is None or part[i] == i) for i, t in documents)


@pytest.mark.parametrize("seed, popular", [(0, 32), (2, 1)])
def test_against_all_pairs(spark, seed, popular):
    texts = corpus(seed)
    got = Counter(map(tuple, minhash.near_copies(frame(spark, texts), popular=popular).collect()))
    assert got == plain([r[:2] for r in rows(texts)])


def test_chain_of_links(spark):
    """Each text is near the next one only, so the component needs every link."""
    rng = random.Random(7)
    words = prose(rng, 200).split()
    texts = []
    for i in range(12):
        texts.append(" ".join(words))
        words[i * 14 : i * 14 + 14] = prose(rng, 14).split()
    rng.shuffle(texts)
    got = {r.doc_id: r.component_id for r in minhash.near_copies(frame(spark, texts)).collect()}
    assert {got[i] for i in range(12)} == {0}


def test_a_passage_of_all_documents_makes_few_pairs(spark):
    rng = random.Random(4)
    passage = prose(rng, 60)
    texts = [f"{prose(rng, 30)} {passage} {prose(rng, 30)}" for _ in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    reps = docs.selectExpr("doc_id AS rep", "doc_id AS component_id")
    listed = minhash._prefixes(reps, docs, 5, 75, 32)
    assert minhash._sharing_rare(listed).count() + minhash._sharing_popular(listed, docs, 5, 75).count() < 20


def test_the_rest_holds_every_link(spark):
    """Pairs left after the hubs, from singletons and from groups, against all pairs."""
    rng = random.Random(11)
    base, texts = prose(rng, 120).split(), []
    for _ in range(50):
        words = list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(len(words))] = prose(rng, 1)
        texts.append(" ".join(words[: rng.randint(80, 120)]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for group, popular in ((1, 8), (5, 1)):
        listed = docs.selectExpr("1L AS key", "doc_id AS rep", f"doc_id - doc_id % {group} AS component_id")
        got = {tuple(r) for r in minhash._rest_pairs(listed, docs, 5, 75, popular).collect()}
        sets = [shingles(t) for t in texts]
        for x in range(50):
            for y in range(x + 1, 50):
                if x // group != y // group and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                    assert (x, y) in got


def test_keys_meet_within_the_radius():
    rng = np.random.default_rng(1)
    for _ in range(200):
        one = rng.integers(0, 2**16, (1, minhash.SYMBOLS), dtype=np.uint16)
        other = one.copy()
        at = rng.choice(minhash.SYMBOLS, minhash.RADIUS, replace=False)
        other[0, at] += 1
        assert set(minhash.chunk_keys(one)[0].tolist()) & set(minhash.chunk_keys(other)[0].tolist())


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 140)]
    got = {r.id: r.component_id for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    ids = {i for link in links if link[0] != link[1] for i in link}
    assert got == merged(ids, [x for x in links if x[0] != x[1]])
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_empty(spark):
    assert minhash.near_copies(empty(spark)).count() == 0
