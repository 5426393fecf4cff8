"""Toxicity by a weighted finite-state grammar over clauses.

A text is read as a sequence of word classes: insult, threat, target (a person spoken to
or of), negation, reported speech, clause break, other. Four small transducers read it:

- negation: on for the words after a negation, lowers what it covers;
- reported speech: on from a verb of saying to the end of the clause, lowers as well;
- target: on from a person to the end of the clause, raises insults;
- threat: a threat counts once a target follows (or stands before) in its clause.

They are composed to one transducer (the product of their states, the product of
their factors), which is run once over the classes. So it is clauses that are
scored: an insult weighs less where it is denied or quoted, more where it is aimed.
The evidence e of a text, summed over its clauses, gives the score 1 - exp(-RATE * e).

Insults are learnt: the words, and word beginnings of four to six letters, that
a share of toxic documents holds that is at least ``LEAST_RATIO`` times that of others. Of
each document one neighbourhood of a word counts, and documents with the same one count
once, so that copies of a text are no evidence; ``LEAST_CONTEXTS`` must be left.
Each weighs its log ratio. Learning takes a sample (by a hash of the id) of at most
about ``SAMPLE`` labelled documents of either kind that are not held out, with whole
texts; the counts are made in Spark. The function words of the grammar are fixed.

Null and empty texts score 0. Texts of any length are read whole, in memory of their own size; without documents there are no rows. If nothing can be learnt, only threats score. Rows with
a null ``doc_id`` are scored but neither learnt from nor held out; repeated rows are
scored each. A document with several labels is toxic if one says so. Other columns are
ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import product

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.langid import held_out
from stratalake.llm.settle import small_batches
from stratalake.operators.sizing import fits_broadcast
from stratalake.sources.staging import stage

SAMPLE = 4000
LEAST_CONTEXTS = 6
LEAST_RATIO = 20.0
MOST_WEIGHT = 5.0
RATE = 0.08
THRESHOLD = 0.3
STEMS = (4, 5, 6)
# Words whose class a worker remembers.
WORDS_KNOWN = 200_000
# The function words and threats of the grammar, in the languages of the corpus.
TARGETS = "you your yourself he she they him her them du dich dir ihr euch sie tu te toi vous ils elle lui tú ti usted ustedes él ella".split()
NEGATIONS = "not never no nobody isn aren wasn don doesn didn nicht kein keine nie pas jamais ni nunca jamás".split()
REPORTS = "said says say saying claimed called calls wrote quoted reported sagte sagt schrieb dit disait écrit dijo dice escribió".split()
THREATS = "kill hurt destroy beat murder strangle töten umbringen tuer frapper matar golpear".split()
INSULT, THREAT, TARGET, NEGATION, REPORT, BREAK, OTHER = range(7)
DENIED, QUOTED, AIMED = 0.4, 0.4, 1.3
THREAT_WEIGHT = 4.0
NEGATION_REACH = 3
_WORDS = regex.compile(r"[^\W\d_]+").findall
_TOKENS = regex.compile(r"[^\W\d_]+|[.!?;:\n]").findall


class Transducer:
    """States from 0, and for each state and class the next state and a factor (a function of both)."""

    def __init__(self, states: int, step, factor):
        self.states = states
        self.next = [[step(s, c) for c in range(7)] for s in range(states)]
        self.factor = [[factor(s, c) for c in range(7)] for s in range(states)]

    def compose(self, other: Transducer) -> Transducer:
        """Both at once: pairs of states, products of factors."""
        pairs = list(product(range(self.states), range(other.states)))
        return Transducer(
            len(pairs),
            lambda s, c: self.next[pairs[s][0]][c] * other.states + other.next[pairs[s][1]][c],
            lambda s, c: self.factor[pairs[s][0]][c] * other.factor[pairs[s][1]][c],
        )


def _switch(on: int, covered: tuple[int, ...], factor: float) -> Transducer:
    """On from a class to the end of the clause; a factor for the classes it covers."""
    return Transducer(2, lambda s, c: 0 if c == BREAK else int(s or c == on), lambda s, c: factor if s and c in covered else 1.0)


def grammar() -> Transducer:
    """The composed transducer. Its factor at an insult scales its weight; at a target or threat it tells a completed threat."""
    negation = Transducer(
        NEGATION_REACH + 1,
        lambda s, c: 0 if c == BREAK else NEGATION_REACH if c == NEGATION else max(s - 1, 0),
        lambda s, c: DENIED if s and c in (INSULT, THREAT, TARGET) else 1.0,
    )
    reported = _switch(REPORT, (INSULT, THREAT, TARGET), QUOTED)
    target = _switch(TARGET, (INSULT,), AIMED)
    # 1: a threat without a target yet, 2: a target; a pair of both counts once
    threat = Transducer(
        3,
        lambda s, c: 0 if c == BREAK else 1 if c == THREAT and s == 0 else 2 if c == TARGET else 0 if c == THREAT else s,
        lambda s, c: 0.0 if c == THREAT and s != 2 or c == TARGET and s != 1 else 1.0,
    )
    return negation.compose(reported).compose(target).compose(threat)


def _features(word: str) -> list[str]:
    """The word itself, and its beginnings (marked by a star)."""
    return [word] * (len(word) >= 3) + [word[:n] + "*" for n in STEMS if len(word) >= n]


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict[str, float]:
    """Weights of insulting words and beginnings."""
    toxic = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    toxic = toxic.where(~held_out(F.col("doc_id")))
    counts = {r[0]: r[1] for r in toxic.groupBy("toxic").count().collect()}
    shares = [F.when(F.col("toxic") == kind, min(1.0, sample / n)) for kind, n in counts.items() if kind in (0, 1)]
    if len(shares) < 2:
        return {}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    wanted = stage(toxic.where(draw < F.coalesce(*shares)), "sample")
    if fits_broadcast(wanted):  # a few thousand ids: the texts stay where they are
        wanted = F.broadcast(wanted)
    drawn = docs.select("doc_id", "text").join(wanted, "doc_id").select("text", "toxic")

    def emit(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            rows = []
            for text, kind in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                words = _WORDS((text or "").lower())
                found: dict[str, int] = {}
                for a, w, b in zip(["", *words[:-1]], words, [*words[1:], ""]):
                    near = zlib.crc32(f"{a} {b}".encode()) if kind else 0
                    for f in _features(w):
                        found[f] = min(near, found.get(f, near))
                rows += [(f, near, int(kind)) for f, near in found.items()]
            if rows:
                columns = [pa.array(x, k) for x, k in zip(zip(*rows), (pa.string(), pa.int64(), pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, ["feature", "near", "toxic"])

    seen = drawn.mapInArrow(emit, "feature string, near long, toxic int")
    seen = seen.groupBy("feature", "near", "toxic").agg(F.count(F.lit(1)).alias("n"))
    seen = seen.groupBy("feature").agg(
        F.count(F.when(F.col("toxic") == 1, 1)).alias("contexts"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("other")
    )
    size = {kind: min(sample, n) for kind, n in counts.items()}
    ratio = (F.col("contexts") / size[1]) / ((F.col("other") + 0.5) / size[0])
    found = seen.where((F.col("contexts") >= LEAST_CONTEXTS) & (ratio >= LEAST_RATIO))
    return {r[0]: min(math.log(r[1]), MOST_WEIGHT) for r in found.select("feature", ratio).collect()}


class Reader:
    """Reads tokens through the composed transducer; remembers the class and weight of words."""

    def __init__(self, weights: dict[str, float], machine: Transducer, fixed: dict[str, int]):
        self.weights, self.machine, self.fixed = weights, machine, fixed
        self.known: dict[str, tuple[int, float]] = {}
        # how a run of words without a class of their own moves each state: no more than the reach of a negation counts
        self.after = [list(range(machine.states))]
        for _ in range(NEGATION_REACH):
            self.after.append([machine.next[s][OTHER] for s in self.after[-1]])

    def classify(self, token: str) -> tuple[int, float]:
        """The class of a token and what it weighs."""
        if not token.isalpha():
            return BREAK, 0.0
        kind = self.fixed.get(token, OTHER)
        if kind != OTHER:
            return kind, THREAT_WEIGHT if kind in (THREAT, TARGET) else 0.0
        weight = next((self.weights[f] for f in (token, *(token[:n] + "*" for n in reversed(STEMS))) if f in self.weights), 0.0)
        return (INSULT if weight else OTHER), weight

    def evidence(self, tokens: list[str]) -> float:
        """Summed weight of the insults and threats of a text, as its clauses make them."""
        known = self.known
        if len(known) > WORDS_KNOWN:
            known.clear()
        for token in set(tokens).difference(known):
            known[token] = self.classify(token)
        state, total, last = 0, 0.0, -1
        factor, following, after = self.machine.factor, self.machine.next, self.after
        for i, token in enumerate(tokens):
            kind, weight = known[token]
            if kind != OTHER:
                state = after[min(i - last - 1, NEGATION_REACH)][state]
                if weight:
                    total += weight * factor[state][kind]
                state, last = following[state][kind], i
        return total


def evidence(text: str, weights: dict[str, float], machine: Transducer, fixed: dict[str, int]) -> float:
    """:meth:`Reader.evidence` of one text in lower case."""
    return Reader(weights, machine, fixed).evidence(_TOKENS(text))


def score(docs: DataFrame, weights: dict[str, float], threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``, in place of columns so named."""
    fixed = {w: k for words, k in ((TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT), (THREATS, THREAT)) for w in words}
    model = docs.sparkSession.sparkContext.broadcast((weights, grammar(), fixed))
    docs = docs.drop("score", "predicted")
    schema = docs.select("*", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema

    def emit(batches: Iterator[pa.RecordBatch]):
        weights, machine, fixed = model.value
        reader = Reader(weights, machine, fixed)
        words = {f for f in weights if f[-1] != "*"} | set(THREATS)
        stems = {f[: STEMS[0]] for f in weights if f[-1] == "*"}
        for batch in batches:
            scores = []
            for text in batch.column("text"):
                tokens = _TOKENS((text.as_py() or "").lower())
                own = set(tokens)
                if not own.isdisjoint(words) or not stems.isdisjoint([w[: STEMS[0]] for w in own]):
                    scores.append(1 - math.exp(-RATE * reader.evidence(tokens)))
                else:
                    scores.append(0.0)
            more = [pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())]
            yield pa.RecordBatch.from_arrays(batch.columns + more, schema.names)

    return small_batches(docs).mapInArrow(emit, schema)


def op8_toxicity(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.select("doc_id", "text")
    scored = score(docs, learn(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
