"""Language identification: multinomial naive Bayes over hashed character n-grams.

Characters are Unicode code points, lower-cased, all but letters read as one
blank. Every run of one, two and three of them is hashed to one of ``2**BITS``
features. Training counts features per language in Spark; only the sums, of a
size fixed by features and languages, reach the driver, and the matrix of
log-probabilities goes out to the tasks. A batch of documents is scored at once:
the rows of the matrix at its features are summed per document.

Training takes about ``SAMPLE`` labelled documents of each language (by a hash of
the id, so the same ones every time), or all if there are fewer; texts count
whole. ``lang`` is only read in training; ``source`` never.

A text that is null, empty or without a letter is ``und`` with score 0, as is
every text if there is nothing to learn from. Ties go to the language that sorts
first. Rows with a null ``doc_id`` are scored but neither learnt from nor held out.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm import arrays
from stratalake.llm.settle import small_batches
from stratalake.operators.sizing import fits_broadcast
from stratalake.sources.staging import stage

BITS = 15
SAMPLE = 2000
UNKNOWN = "und"
_FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
_letters: list[np.ndarray] = []


def held_out(doc_id: Column) -> Column:
    """Whether a document may not be learnt from: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _letter_table() -> np.ndarray:
    """The lower-case code of each letter, 0 for other characters."""
    if not _letters:
        table = np.zeros(0x110000, np.uint32)
        for code in range(0x110000):
            c = chr(code)
            if c.isalpha():
                low = c.lower()
                table[code] = ord(low) if len(low) == 1 else code
        _letters.append(table)
    return _letters[0]


def features(raw: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each n-gram length the features and where each document's begin, and whether a document has letters."""
    n_docs = len(offsets) - 1
    codes = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    bounds = heads[offsets]
    letters = _letter_table()[codes]
    solid = letters != 0
    doc = np.repeat(np.arange(n_docs), np.diff(bounds))
    # runs of blanks become one, leading ones go; what another document ends with does not matter
    use = solid.copy()
    use[1:] |= solid[:-1] & (doc[1:] == doc[:-1])
    letters, doc, solid = letters[use], doc[use], solid[use]
    has_letter = np.bincount(doc[solid], minlength=n_docs) > 0
    out, key = [], np.zeros(len(letters), np.uint32)
    for order, factor in enumerate(_FACTORS):
        if order:
            key = key[:-1]
        if len(key) == 0:
            out.append((np.zeros(0, np.int64), np.zeros(n_docs + 1, np.int64)))
            continue
        key = (key ^ letters[order:]) * factor
        key ^= key >> np.uint32(15)
        inside = doc[order:] == doc[: len(doc) - order]
        found = ((key * np.uint32(0x2C1B3C6D) + np.uint32(order)) >> np.uint32(32 - bits))[inside]
        counts = np.bincount(doc[order:][inside], minlength=n_docs)
        out.append((found.astype(np.int64), np.concatenate([[0], np.cumsum(counts)])))
    return out, has_letter


def training_sample(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``(text, lang)`` of about ``sample`` labelled documents of each language that are not held out."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = counts.select("lang", F.least(F.lit(1.0), F.lit(float(sample)) / F.col("n")).alias("share"))
    share = stage(share, "languages")
    if fits_broadcast(share):  # a row per language: the texts stay where they are
        share = F.broadcast(share)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    return labelled.join(share, "lang").where(draw < F.col("share")).select("text", "lang")


def train(docs: DataFrame, bits: int = BITS, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """The languages in order, and for each feature its log-probability in each, less the mean over them."""

    def emit(batches: Iterator[pa.RecordBatch]):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            raw, offsets = arrays.utf8(batch.column("text"))
            langs = batch.column("lang").to_pylist()
            for lo, hi in arrays.slices(offsets):
                grams, _ = features(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], bits)
                for found, bounds in grams:
                    for i in range(hi - lo):
                        one = sums.setdefault(langs[lo + i], np.zeros(1 << bits, np.int64))
                        one += np.bincount(found[bounds[i] : bounds[i + 1]], minlength=1 << bits)
        for lang, one in sums.items():
            at = np.flatnonzero(one)
            columns = [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(one[at])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "feature", "n"])

    counted = training_sample(small_batches(docs), sample).mapInArrow(emit, "lang string, feature int, n long")
    table = counted.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(table["lang"].to_pylist()))
    counts = np.ones((1 << bits, len(langs)))
    place = {lang: i for i, lang in enumerate(langs)}
    np.add.at(counts, (table["feature"].to_numpy(), [place[x] for x in table["lang"].to_pylist()]), table["n"].to_numpy())
    if not langs:
        return langs, counts
    logs = np.log(counts / counts.sum(axis=0))
    return langs, (logs - logs.mean(axis=1, keepdims=True)).astype(np.float32)


def _predict(weights: np.ndarray, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Index of the best language of each text (the number of languages if none) and its probability."""
    bits, langs = int(weights.shape[0]).bit_length() - 1, weights.shape[1]
    best, score = np.full(batch.num_rows, langs), np.zeros(batch.num_rows)
    raw, offsets = arrays.utf8(batch.column("text"))
    for lo, hi in arrays.slices(offsets) if langs else ():
        grams, has_letter = features(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], bits)
        total = np.zeros((hi - lo, langs))
        for found, bounds in grams:
            full = np.flatnonzero(np.diff(bounds))
            if len(full):
                for j in range(langs):
                    total[full, j] += np.add.reduceat(weights[:, j][found], bounds[full])
        top = total.argmax(axis=1)
        share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        best[lo:hi] = np.where(has_letter, top, langs)
        score[lo:hi] = np.where(has_letter, share, 0)
    return best, score


def _have_letter(batch: pa.RecordBatch) -> np.ndarray:
    """Whether each text has a letter."""
    raw, offsets = arrays.utf8(batch.column("text"))
    own = lambda lo, hi: features(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], BITS)[1]
    return np.concatenate([np.zeros(0, bool), *[own(lo, hi) for lo, hi in arrays.slices(offsets)]])


def identify(docs: DataFrame, langs: list[str], matrix: np.ndarray) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the probability of that language), in place of columns so named."""
    model = docs.sparkSession.sparkContext.broadcast(matrix)
    docs = docs.drop("lang_pred", "score")
    schema = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def emit(batches: Iterator[pa.RecordBatch]):
        names = np.array([*langs, UNKNOWN], dtype=object)
        for batch in batches:
            best, score = _predict(model.value, batch)
            columns = [*batch.columns, pa.array(names[best], pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.mapInArrow(emit, schema)


def in_known_language(
    docs: DataFrame, langs: list[str], matrix: np.ndarray, wanted: Collection[str] | None = None, least_score: float = 0.0
) -> DataFrame:
    """The documents, with all their columns, whose language can be told, is a ``wanted`` one and scores ``least_score``.

    By default every language learnt is wanted. ``lang`` of what stays is the language told from the text, the one that was asked for.
    With nothing learnt and nothing asked for, those with a letter, their ``lang`` as given.
    """
    model = docs.sparkSession.sparkContext.broadcast(matrix)
    asked = np.array([wanted is None or lang in wanted for lang in langs] + [False])
    at = docs.columns.index("lang")

    def emit(batches: Iterator[pa.RecordBatch]):
        names = np.array([*langs, UNKNOWN], dtype=object)
        for batch in batches:
            if langs or wanted is not None or least_score > 0:
                best, score = _predict(model.value, batch)
                stays = asked[best] & (score >= least_score)
                batch = batch.set_column(at, batch.schema.field(at), pa.array(names[best], batch.schema.field(at).type))
            else:
                stays = _have_letter(batch)
            yield batch.filter(pa.array(stays))

    return small_batches(docs).mapInArrow(emit, docs.schema)


def op9_language_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.select("doc_id", "text", "lang"))
    found = identify(docs.select("doc_id", "text"), *model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
