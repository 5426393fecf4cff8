"""Conversation repair against a plain search for the cheapest edits."""

import functools
import hashlib
import random
import sys
import zlib
from collections import defaultdict

import numpy as np
import pytest

from stratalake.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, key string, gone int"
ROLES = ["user", "assistant", "system", "tool", "", None, "ufo", "Assistant"]
TEXTS = ["Hi.", "Hi", "So? ", "no", " \t\r\n", "", None, "a.b", "漢字。", "Well!\n", "\x0b\x0c", " "]


def conversations(seed=0, n=150):
    rng = random.Random(seed)
    data = []
    for c in [*range(n), -5, 10**12]:
        turn = rng.randint(-2, 3)
        for _ in range(rng.randint(1, 9)):
            plain = rng.random() < 0.5
            role = ("user", "assistant")[turn % 2] if plain else rng.choice(ROLES)
            data.append((c, None if rng.random() < 0.05 else turn, role, f"Text {rng.random():.4f}." if plain else rng.choice(TEXTS), "x", 1))
            turn += rng.choice([0, 1, 1, 1, 1, 2, 5]) if rng.random() < 0.3 else 1
    data += [(None, t, "user", f"lost {t % 3}.", "x", 1) for t in range(5)]
    data += [(888, t, ("user", "assistant")[t % 2], "word " * 60_000 + str(t) + "." * (t % 3), "x", 1) for t in range(7)]
    data += [data[0]] * 3
    # rows of one turn have one text, as the order among others is by a hash
    texts = {}
    return [(c, t, role, texts.setdefault((c, t), text), *rest) for c, t, role, text, *rest in data]


def after_damage(data):
    rows = defaultdict(list)
    for conv, turn, role, text, *_ in data:
        space = lambda x: " " if x is None else x
        role, text = space(role), space(text)
        own = rows[conv]
        hit = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else "".join(x for x in text if x not in ".!?") if hit == 2 else text
        own += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return {c: sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1])) for c, own in rows.items()}


def plain(rows):
    """Gaps, counts, cost, audit and hash of one conversation's rows after damage."""
    kinds, seen = [], set()
    for _, role, text in rows:
        ink = text.rstrip(" \t\n\x0b\x0c\r")
        kinds.append("blank" if not ink else "duplicate" if (role, text) in seen else "whole" if ink[-1] in ".!?" else "truncated")
        seen.add((role, text))
    need = {"": "user", "s": "user", "u": "assistant", "a": "user"}

    @functools.cache
    def best(i, state, inserts=3):
        """Cost, audit and lines from row ``i`` on, where ``state`` is the last initial; more than three inserts in a row never pay."""
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserts:
            cost, audit, lines = best(i, need[state][0], inserts - 1)
            found.append((cost + 2, "I" + audit, (f"{need[state]}:", *lines)))
        if i < len(rows):
            _, role, text = rows[i]
            cost, audit, lines = best(i + 1, state)
            found.append((cost + 3, "D" + audit, lines))
            if kinds[i] in ("whole", "truncated"):
                more = kinds[i] == "truncated"
                if role[:1] and (role[0] == need[state][0] or (role[0] == "s" and state == "")):
                    cost, audit, lines = best(i + 1, role[0])
                    found.append((cost + more, "K" + audit, (f"{role}:{text}", *lines)))
                cost, audit, lines = best(i + 1, need[state][0])
                found.append((cost + more + 2, "R" + audit, (f"{need[state]}:{text}", *lines)))
        return min(found) if found else (10**9, "", ())

    sys.setrecursionlimit(20_000)
    cost, audit, lines = best(0, "")
    turns = {t for t, _, _ in rows if t is not None}
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    counts = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha)


def expected(data):
    return sorted(((c, *plain(rows)) for c, rows in after_damage(data).items()), key=str)


def repaired(df):
    rows = repair.repair(repair.damaged(df)).collect()
    return sorted(((None if r[0] == " " else int(r[0]), *r[1:]) for r in rows), key=str)


@pytest.fixture(params=[None, 3])
def by_segments(request, spark, monkeypatch):
    """Once as it comes, once with every longer conversation in many open parts."""
    if request.param:
        monkeypatch.setattr(repair, "SOLVE_ROWS", request.param)
        monkeypatch.setattr(repair, "PIECE_CHARS", 40)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "30")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_against_plain_search(spark, by_segments):
    data = conversations()
    assert repaired(spark.createDataFrame(data, SCHEMA).repartition(4)) == expected(data)


def test_one_long_conversation_over_many_parts(spark, by_segments):
    rng = random.Random(8)
    data = [(1, t, rng.choice(ROLES[:4]), rng.choice(TEXTS + [f"Own {t}."] * 12), "x", 1) for t in range(240)]
    data += [(c, 0, "user", "Hi.", "x", 1) for c in range(2, 9)]
    assert repaired(spark.createDataFrame(data, SCHEMA).repartition(4)) == expected(data)


def test_conversations_of_which_no_row_is_left(spark, by_segments):
    gone = [c for c in range(2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:40]
    data = [(c, 0, "user", "Hi.", "x", 1) for c in gone]
    got = repaired(spark.createDataFrame(data, SCHEMA).repartition(3))
    assert got == sorted(((c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for c in gone), key=str)


def test_no_rows(spark):
    assert repaired(spark.createDataFrame([], SCHEMA)) == []


def test_matrices_and_layers_agree():
    rng = random.Random(2)
    for _ in range(200):
        codes = bytes(rng.randrange(16) for _ in range(rng.randint(0, 9)))
        cut = rng.randint(0, len(codes))
        layers = repair.layer_costs(codes, repair.last_costs())
        after = np.minimum((repair.transfer(codes[cut:]) + np.array(repair.last_costs())).min(1), repair.FAR)
        assert tuple(after) == layers[cut]
        assert tuple((repair.transfer(codes[:cut]) + after).min(1)) == layers[0]


def test_ranks_order_nodes_by_their_audits():
    rng = random.Random(4)
    codes = [bytes(rng.randrange(12) for _ in range(rng.randint(0, 40))) for _ in range(20)]
    paths = repair.Paths(codes, [repair.layer_costs(c, repair.last_costs()) for c in codes], [True] * len(codes))
    nodes = np.arange(len(paths.target))
    for node, audit in zip(nodes, paths.audits(nodes)):
        at, letters = node, b""
        while (paths.target[at] >= 0).any():
            letter = min(i for i in range(4) if paths.target[at, i] >= 0)
            letters, at = letters + repair.LETTERS[letter : letter + 1], paths.target[at, letter]
        assert audit == letters and paths.last[node] == at
