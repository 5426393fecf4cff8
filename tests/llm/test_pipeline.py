"""The pipeline: each stage against a plain version on a small table."""

import random

import public_tokenizers
import pytest
from cases import prose
from test_decontaminate import plain as leaks
from test_minhash import plain as near
from test_suffix import plain as repeats
from tokenizers import Tokenizer

import corpus_pipeline as pipe

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def sf_dir(spark, tmp_path):
    rng = random.Random(9)
    items = [prose(rng, 30) for _ in range(5)]
    shared, texts = prose(rng, 60), []
    for i in range(80):
        text = prose(rng, rng.randint(20, 120))
        if i % 7 == 3:
            text += " " + shared
        if i % 11 == 5:
            text = text + "\n" + items[i % 5] + " " + prose(rng, 12)
        if i % 5 == 4:
            text = texts[-1]
        if i % 9 == 8:
            text = texts[-3].replace("ka", "ko", 1)
        texts.append(text)
    texts += ["", "123 456", None, "é" * 60 + shared]
    data = [(i, t, "l1" if i % 2 else "l2", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(data + data[2:4], SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), dict(enumerate(texts)), dict(enumerate(items))


def test_stages(spark, sf_dir):
    path, texts, items = sf_dir
    assert [f for _, f in pipe.STAGES][-1] is pipe.pack and len(pipe.STAGES) == 5
    docs = spark.read.parquet(f"{path}/documents.parquet")
    now = {i: t for i, t in texts.items() if t and any(c.isalpha() for c in t)}
    for name, step in pipe.STAGES[:-1]:
        docs = pipe.stage(step(spark, docs, path), name)
        assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
        if name == "near_dedup":
            now = {i: now[i] for i, _, _, kept in near(now.items()) if kept}
        elif name == "substring_dedup":
            now = {i: k.decode("utf-8", "ignore") for i, _, gone, _, k in repeats(list(now.items()), 100) if not gone or k.strip()}
        elif name == "decontamination":
            ids = list(now)
            bad = {ids[i] for i, _ in leaks([now[i] for i in ids], items)}
            now = {i: t for i, t in now.items() if i not in bad}
        rows = docs.collect()
        assert {r.doc_id: r.text for r in rows} == now
        assert name == "language_id" or len(rows) == len(now)
        assert all(r.n_chars == len(r.text) for r in rows)
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = pipe.run(spark, path).collect()
    sizes = {i: len(whole.encode(t, add_special_tokens=False).ids) + 1 for i, t in now.items()}
    assert {r.doc_id: r.doc_tokens for r in got} == sizes and sum(r.length for r in got) == sum(sizes.values())


def test_empty_table_and_extra_columns(spark, tmp_path):
    schema = SCHEMA + ", kept string, spans string, score double"
    for rows, name in (([], "none"), ([(1, "a b c", "l", "s", 5, "k", "s", 0.5), (1, "a b c", "l", "s", 5, "k", "s", 0.5)], "some")):
        path = f"{tmp_path}/{name}"
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
        docs = spark.read.parquet(f"{path}/documents.parquet")
        for _, step in pipe.STAGES[:-1]:
            docs = step(spark, docs, path)
            assert docs.columns == [c.split()[0] for c in schema.split(", ")]
        assert [tuple(r)[5:] for r in docs.collect()] == [("k", "s", 0.5)] * (name == "some")
        assert pipe.run(spark, path).count() == (name == "some")


def test_languages_without_a_label(spark):
    texts = ["ka lo mi", "123 456", "", None, "é"]
    docs = spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in enumerate(texts)], SCHEMA)
    assert sorted(r.doc_id for r in pipe.language_id(spark, docs, "").collect()) == [0, 4]


def test_different_texts_under_one_id(spark):
    rng = random.Random(3)
    a, b, c, d, e = (prose(rng, 40) for _ in range(5))
    data = [(1, a), (1, b), (1, a), (2, b + " ka"), (3, c), (3, d), (3, None), (3, ""), (4, e), (5, e), (4, e), (None, a)]
    docs = spark.createDataFrame([(i, t, "l", "s", len(t or "")) for i, t in data], SCHEMA)
    run = lambda n: sorted(((r.doc_id, r.text) for r in pipe.near_dedup(spark, docs.repartition(n), "").collect()), key=str)
    got = run(3)
    rest = [r for r in got if r not in ((1, b), (2, b + " ka"))]
    assert len(got) == len(rest) + 1 and run(1) == got
    assert rest == sorted([(None, a), (1, a), (3, c), (3, d), (3, None), (3, ""), (4, e)], key=str)


def test_language_stage_says_what_it_told(spark):
    rng = random.Random(5)
    words = {"aa": ["ka", "lo", "mi"], "bb": ["zu", "xe", "qy"]}
    text = lambda lang: " ".join(rng.choice(words[lang]) for _ in range(40))
    data = [(i, text(lang), lang) for i, lang in enumerate(["aa", "bb"] * 40)]
    odd = [(100, text("aa"), "bb"), (101, text("bb"), None), (102, "123", "aa")]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t)) for i, t, lang in data + odd], SCHEMA)
    got = {r.doc_id: (r.text, r.lang) for r in pipe.language_id(spark, docs, "").collect()}
    assert got == {**{i: (t, lang) for i, t, lang in data}, 100: (odd[0][1], "aa"), 101: (odd[1][1], "bb")}
