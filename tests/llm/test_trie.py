"""The conversation trie against plain versions."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from stratalake.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, id1 string"


def conversations(seed=0, n=160, long=700):
    """Few words, so that sequences are shared; absent bases, copies, one long conversation."""
    rng = random.Random(seed)
    data = []
    for conv in [*range(0, n), *range(205, 230), *range(-120, -90), 1000, 1001, 1099]:
        if rng.random() < 0.1:
            continue
        turns = [] if not data or rng.random() < 0.5 else [d[1:4] for d in data if d[0] == data[-1][0]]
        for t in range(len(turns), len(turns) + rng.randint(0 if turns else 1, 5)):
            turns.append((t, rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None, "漢字 c"])))
        data += [(conv, *t, 1, "x") for t in turns]
    data += [(42_000, t, "user" if t % 2 else "assistant", rng.choice("ab"), 1, "x") for t in range(long)]
    data += [(42_001, t, "user" if t % 2 else "assistant", "a", 1, "x") for t in range(long // 2)]
    data += [(None, 0, "user", "lost", 1, "x"), (7, None, "user", "first", 1, "x")]
    data += [(c, t, "user", "long " * 50_000 + str(t * (c % 2)), 1, "x") for c in (900, 901, 902) for t in range(7)]
    return data


def rebuilt(data):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in data:
        if conv is not None:
            own[conv].append((-(10**9) if turn is None else turn, role or "", text or ""))
    own = {c: [t[1:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = (zlib.crc32(str(c).encode()) & 0xFFFFFFFF) % 6
        base = c - int(np.fmod(c, 100))  # the remainder has the sign of c, as in SQL
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def plain(data):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in rebuilt(data).items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = own + sum(saved[k] for k in kids[node])
    rows = []
    for node, convs in members.items():
        sha = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(convs), len(node), parent, len(convs), len(kids[node]), leaves[node], saved[node], sha))
    return sorted(rows, key=str)


@pytest.fixture
def many_parts(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_trie_against_plain_version(spark, many_parts):
    data = conversations()
    got = trie.conversation_trie(spark.createDataFrame(data, SCHEMA).repartition(5)).collect()
    assert sorted(map(tuple, got), key=str) == plain(data)


def test_rows_given_twice_are_turns_of_their_own(spark):
    data = [(1, 0, "user", "a", 1, "x")] * 9 + [(2, None, "user", "a", 1, "x")] * 9 + [(3, 0, "user", "a", 1, "x")] * 3
    got = trie.conversation_trie(spark.createDataFrame(data, SCHEMA).repartition(4)).collect()
    assert sorted(map(tuple, got), key=str) == plain(data)


def test_conversations_without_turns_end_at_the_root(spark):
    short = [c for c in range(300, 400) if c % 100 and zlib.crc32(str(c).encode()) % 6 >= 2][:5]
    data = [(c, 0, "user", "gone", 1, "x") for c in short]
    got = trie.conversation_trie(spark.createDataFrame(data, SCHEMA)).collect()
    assert [tuple(r) for r in got] == plain(data)
    assert got[0].n_convs == 5 and got[0].depth == 0 and got[0].n_leaves == 1


def test_no_rows(spark):
    assert trie.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_powers():
    exponents = np.array([0, 1, 2, 63, 1000, -1, -5])
    for base in trie.BASES:
        assert trie.power(base, exponents).tolist() == [pow(base, int(e), 2**64) for e in exponents]


def trees(seed):
    rng = random.Random(seed)
    shape = seed % 5
    n = 300
    if shape == 0:
        parent = {i: i - 1 for i in range(1, n)}  # one chain
    elif shape == 1:
        parent = {i: 0 for i in range(1, n)}  # a star
    elif shape == 2:
        parent = {i: rng.randrange(i) for i in range(1, n)}
    elif shape == 3:
        parent = {i: i - 2 if i % 2 == 0 else i - 1 for i in range(1, n)}  # a spine with a leaf at each node
    else:
        parent = {i: rng.randrange(max(0, i - 3), i) for i in range(1, n)}
    parent[0] = None
    if seed >= 3:  # a second tree, a root alone
        parent |= {i + 1000: None if p is None else p + 1000 for i, p in parent.items()} | {5000: None}
    return parent, {i: rng.randint(-5, 9) for i in parent}


@pytest.mark.parametrize("seed", range(5))
def test_contraction_against_plain_sums(spark, seed):
    parent, weight = trees(seed)
    mask = 2**63 - 1
    name = lambda i: (hash((i, seed)) & mask, i * 7)
    rows = [(*name(i), *(name(p) if p is not None else (None, None)), weight[i], 1) for i, p in parent.items()]
    tree = spark.createDataFrame(rows, "id1 long, id2 long, p1 long, p2 long, w long, one long")
    total, size = dict(weight), dict.fromkeys(parent, 1)
    for i in sorted(parent, reverse=True):  # parents have lesser numbers
        if parent[i] is not None:
            total[parent[i]] += total[i]
            size[parent[i]] += size[i]
    got = {(r.id1, r.id2): (r.w, r.one) for r in trie.subtree_sums(trie.with_children(tree), ["w", "one"]).collect()}
    assert got == {name(i): (total[i], size[i]) for i in parent}


def test_ends_of_many_conversations_at_one_node(spark, many_parts):
    ids = list(range(-300, 40_000, 3))
    ends = spark.createDataFrame([(1, 2, i) for i in ids] + [(5, -6, 9)], "id1 long, id2 long, conv_id long").repartition(4)
    got = {(r.id1, r.id2): r.sha for r in trie.end_digests(ends).collect()}
    sha = lambda x: hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()
    assert got == {(1, 2): sha(ids), (5, -6): sha([9])}
