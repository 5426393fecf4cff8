"""The two classifiers: held-out accuracy, what they may read, odd rows."""

import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import empty, prose

from stratalake.llm import langid, toxicity

SF = "/root/testdata/sf0.1"
have = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
SCHEMA = "doc_id long, text string, lang string, source string, score double, lang_pred string"


@have
def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    right = langid.op9_language_id(spark, SF).join(docs, "doc_id").where("held_out").selectExpr("avg(int(lang = lang_pred))")
    assert right.first()[0] > 0.99


@have
def test_toxicity_of_held_out_documents(spark):
    scored = toxicity.op8_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out")
    by = {r.toxic: r.share for r in scored.groupBy("toxic").agg({"predicted": "avg"}).withColumnRenamed("avg(predicted)", "share").collect()}
    assert by[1] > 0.8 and by[0] < 0.02


def test_odd_texts(spark):
    rng = random.Random(1)
    data = [(i, prose(rng, 40) if i % 2 else "xyz zyx yyx " * 9, "aa" if i % 2 else "bb", "s", 1.0, "z") for i in range(60)]
    docs = spark.createDataFrame(data + [(900, None, "aa", "s", 1.0, "z"), (901, "", "aa", "s", 1.0, "z"), (902, "12 3!", "aa", "s", 1.0, "z"), (None, "xyz", None, "s", 1.0, "z"), (903, "zyx " * 60_000, "bb", "s", 1.0, "z")], SCHEMA)
    model = langid.train(docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, *model).collect()}
    assert got[900] == got[901] == got[902] == ("und", 0.0)
    assert got[None][0] == "bb" and got[903][0] == "bb" and 0.5 < got[903][1] <= 1
    assert langid.in_known_language(docs, *model).count() == docs.count() - 3
    kept = lambda *asked: {r.doc_id for r in langid.in_known_language(docs, *model, *asked).collect()}
    assert kept(["aa"]) == {i for i in range(60) if i % 2} and kept([]) == set()
    assert kept(["bb"]) == {i for i in range(60) if not i % 2} | {None, 903}
    assert kept(None, got[3][1]) == {i for i, (_, score) in got.items() if score >= got[3][1]}
    assert langid.train(empty(spark))[0] == []
    nothing = langid.train(empty(spark))
    assert {r.lang_pred for r in langid.identify(docs, *nothing).collect()} == {"und"}
    assert langid.identify(empty(spark), *model).count() == 0


def test_labels_of_held_out_rows_are_not_learnt(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'abc' AS text", "'l' AS lang")
    held = {r.doc_id for r in docs.where(langid.held_out(langid.F.col("doc_id"))).collect()}
    docs = docs.selectExpr("doc_id", "text", f"if(doc_id in ({','.join(map(str, held))}), 'held', 'l') AS lang")
    assert langid.train(docs)[0] == ["l"] and len(held) > 900


def test_features_stay_inside_documents():
    raw, bounds = np.frombuffer("abÉx".encode(), np.uint8), np.array([0, 2, 5, 5])
    grams, letters = langid.features(raw, bounds, 10)
    assert [np.diff(b).tolist() for _, b in grams] == [[2, 2, 0], [1, 1, 0], [0, 0, 0]] and letters.tolist() == [True, True, False]
    lower = langid.features(np.frombuffer("abéx".encode(), np.uint8), bounds, 10)[0]
    assert all((a == b).all() for (a, _), (b, _) in zip(grams, lower))


def score_of(text, weights):
    fixed = {w: k for words, k in ((toxicity.TARGETS, 2), (toxicity.NEGATIONS, 3), (toxicity.REPORTS, 4), (toxicity.THREATS, 1)) for w in words}
    return toxicity.evidence(text, weights, toxicity.grammar(), fixed)


def test_grammar():
    weights = {"fool": 5.0, "dumb*": 4.0}
    plain = score_of("what a fool", weights)
    assert plain == 5 and score_of("dumbest dumb", weights) == 8 and score_of("fools", weights) == 0
    assert score_of("you fool", weights) > plain > score_of("not a fool", weights) == score_of("x says: y. she", weights) + 2
    assert score_of("he said what a fool", weights) < score_of("he said. what a fool", weights) == plain
    assert score_of("i will kill you", {}) == score_of("you kill", {}) == toxicity.THREAT_WEIGHT
    assert score_of("kill. you", {}) == score_of("kill time", {}) == score_of("you and she", {}) == 0
    assert 0 < score_of("never kill you", {}) < toxicity.THREAT_WEIGHT
    assert toxicity.grammar().states == 4 * 2 * 2 * 3


def test_learning_and_scores(spark):
    rng = random.Random(5)
    docs, labels = [], []
    copied = prose(rng, 30) + " rareword " + prose(rng, 5)
    for i in range(400):
        toxic = i % 4 == 0
        words = prose(rng, 40).split()
        words.insert(rng.randint(1, 39), rng.choice(["blort", "Blorting"]) if toxic else "calm")
        docs.append((i, copied if toxic and i % 8 == 0 else " ".join(words), "l", "s", 0.1, "z"))
        labels.append((i, 1, int(toxic)))
    docs += [(1000, None, "l", "s", 0.1, "z"), (1001, "", "l", "s", 0.1, "z"), (None, "blort, you blorted", "l", "s", 0.1, "z")]
    docs = spark.createDataFrame(docs, SCHEMA)
    labels = spark.createDataFrame([*labels, (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    weights = toxicity.learn(docs, labels)
    assert "blor*" in weights and "rareword" not in weights and "calm" not in weights
    got = {r.doc_id: (r.score, r.predicted) for r in toxicity.score(docs, weights).collect()}
    assert got[1000] == got[1001] == (0.0, 0) and got[None][1] == 1 and got[4][1] == 1 and got[1][1] == 0
    assert toxicity.learn(docs, labels.where("toxic = 0")) == {} == toxicity.learn(empty(spark), labels.limit(0))
    assert toxicity.score(empty(spark), {}).count() == 0


def plain_evidence(text, weights, fixed):
    """Clauses scored by what stands in them, without states that are composed."""
    total = 0.0
    for clause in re.split(r"[.!?;:\n]", text):
        denied, said, aimed, threat = 0, False, False, 0
        for word in re.findall(r"[^\W\d_]+", clause):
            kind = fixed.get(word, toxicity.OTHER)
            weight = 0.0
            if kind == toxicity.OTHER:
                names = [word] + [word[:n] + "*" for n in (6, 5, 4)]
                weight = next((weights[n] for n in names if n in weights), 0.0)
                kind = toxicity.INSULT if weight else kind
            lowered = (toxicity.DENIED if denied else 1) * (toxicity.QUOTED if said else 1)
            if kind == toxicity.INSULT:
                total += weight * lowered * (toxicity.AIMED if aimed else 1)
            if kind == toxicity.TARGET and threat == 1 or kind == toxicity.THREAT and threat == 2:
                total += toxicity.THREAT_WEIGHT * lowered
            if kind == toxicity.THREAT:
                threat = 1 if threat == 0 else 0
            elif kind == toxicity.TARGET:
                threat, aimed = 2, True
            said = said or kind == toxicity.REPORT
            denied = toxicity.NEGATION_REACH if kind == toxicity.NEGATION else max(denied - 1, 0)
    return total


def test_clauses_against_a_plain_reading():
    rng = random.Random(11)
    fixed = {"you": toxicity.TARGET, "never": toxicity.NEGATION, "said": toxicity.REPORT, "kill": toxicity.THREAT}
    weights = {"fool": 3.0, "idio*": 2.0, "idiot*": 2.5, "dullard": 1.0}
    words = [*fixed, "fool", "fools", "idiom", "idiotic", "dullard", "a", "bee", ".", "!", "\n", "12", "x_y"]
    machine = toxicity.grammar()
    reader = toxicity.Reader(weights, machine, fixed)
    for _ in range(4000):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 25)))
        want = plain_evidence(text, weights, fixed)
        assert abs(toxicity.evidence(text, weights, machine, fixed) - want) < 1e-9
        assert abs(reader.evidence(toxicity._TOKENS(text)) - want) < 1e-9


def plain_bayes(texts, langs, text, bits):
    """Best language and its probability from counts of character n-grams, one at a time."""

    def grams(text):
        low = lambda c: c.lower() if len(c.lower()) == 1 else c
        line = "".join(low(c) if c.isalpha() else " " for c in text)
        keys = []
        line = re.sub(" +", " ", line)
        line = line if text and text[0].isalpha() else line.lstrip(" ")
        for i in range(len(line)):
            for n in (1, 2, 3):
                if i + n <= len(line):
                    keys.append(hashed(line[i : i + n], bits))
        return keys

    counts = {lang: Counter() for lang in sorted(set(langs))}
    for own, lang in zip(texts, langs):
        counts[lang].update(grams(own))
    logs = {}
    for lang, own in counts.items():
        every = sum(own.values()) + (1 << bits)
        logs[lang] = sum(math.log((own[k] + 1) / every) for k in grams(text))
    best = max(logs, key=lambda lang: (logs[lang], [-ord(c) for c in lang]))
    return best, 1 / sum(math.exp(v - logs[best]) for v in logs.values())


def hashed(gram, bits):
    key, mask = 0, 0xFFFFFFFF
    for order, c in enumerate(gram):
        key = (key ^ (0 if c == " " else ord(c))) * int(langid._FACTORS[order]) & mask
        key ^= key >> 15
    return (key * 0x2C1B3C6D + len(gram) - 1 & mask) >> 32 - bits


def test_language_against_plain_counts(spark):
    rng = random.Random(12)
    signs = {"aa": "abcde é", "bb": "abxyz ß", "cc": "dexyü Ç1."}
    data = [(i, "".join(rng.choice(signs[lang]) for _ in range(rng.randint(1, 30))), lang) for i in range(240) for lang in [rng.choice(sorted(signs))]]
    data += [(1000, "abé  xy--dd e" * 40, "aa"), (1001, "  12 zß", "bb")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(3)
    learnt = [(t, lang) for i, t, lang in data if zlib.crc32(str(i).encode()) % 4 != 2]
    model = langid.train(docs, bits=10)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, *model).collect()}
    for i, text, _ in data[::9] + data[-2:]:
        if not any(c.isalpha() for c in text):
            assert got[i] == ("und", 0.0)
            continue
        best, share = plain_bayes(*zip(*learnt), text, 10)
        assert got[i][0] == best and abs(got[i][1] - share) < 1e-3
