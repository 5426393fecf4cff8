"""Small texts with copies, near copies, shared passages and odd rows, and plain versions of the operators."""

import random

SYLLABLES = ["ka", "lo", "mi", "ter", "un", "vas", "pre", "go", "shi", "ne"]
LETTERS = "doc_id long, text string, lang string, source string, n_chars long, kept string, score double"


def prose(rng, n, sep=" "):
    return sep.join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus(seed=0, n=60):
    """Texts by id: fresh ones, exact and near copies of some, passages that many share, and odd ones."""
    rng = random.Random(seed)
    passage, texts = prose(rng, 70), []
    for i in range(n):
        kind = rng.random()
        if kind < 0.3 or not texts:
            text = prose(rng, rng.randint(1, 160), rng.choice([" ", "  ", "\n", "\t"]))
        elif kind < 0.45:
            text = rng.choice(texts)
        elif kind < 0.7:
            words = rng.choice(texts).split(" ")
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = prose(rng, rng.randint(0, 2))
            text = " ".join(words)
        else:
            text = f"{prose(rng, rng.randint(0, 30))} {passage} {prose(rng, rng.randint(0, 30))}"
        texts.append(text)
    texts += ["", " \n ", "a b c", "a b c", "A B C", "é" * 400, "é" * 401, "ab" * 300, passage.upper(), "İ ß 漢字 " * 40]
    return texts


def rows(texts):
    """As documents with clashing columns, a null text, a null id and a row given twice."""
    every = [(i, t) for i, t in enumerate(texts)] + [(len(texts), None), (None, texts[0]), (3, texts[3])]
    return [(i, t, "en", "s", 1, "x", 0.5) for i, t in every]


def frame(spark, texts, parts=3):
    return spark.createDataFrame(rows(texts), LETTERS).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], LETTERS)
