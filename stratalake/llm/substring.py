"""Repeated passages of words, found on a de Bruijn graph with compacted paths.

The graph's edges are token k-mers: of every run of ``window - k + 1`` k-mers the
least one is taken (so every window of ``window`` words holds an edge, the same in
each of its copies), and an edge leads to the next one of its document.

1. Each edge is counted over all documents, with the words that lead to it and
   on from it. An edge of one document only is left out; one that is always
   reached and left by the same words does not branch.
2. Runs of edges that do not branch are compacted to one path per document; each
   of its copies elsewhere spans the same words from end to end. A window that
   no path covers, because an edge in it branches, stands for itself.
3. Paths and windows, each by a 128-bit hash of its words, are joined with their
   first document. All but the first's copies are removed, by the coordinates
   that came along.

A passage in a third of all documents is a few rows per document, counted
before the shuffle; Spark splits the skewed side of the join. Two bitmaps of
fixed size (``membership``) spare most of the rows; they never lose one.

Documents with null text have no words. A null ``doc_id`` is never a source and
loses nothing. ``doc_id`` is the key of a document: a row repeated as a whole
counts as one document, and each of its rows gets the same result. Equal
passages of one document are no repetition. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm import arrays, membership
from stratalake.llm.settle import settled, small_batches
from stratalake.sources.staging import stage

WINDOW = 50
K = 25


class _Edges:
    """The edges of a slice of documents, and the edge of each window."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, window: int, k: int):
        self.words = words = arrays.Words(raw, offsets)
        codes = words.codes()
        self.rolling = arrays.Rolling(codes)
        self.rolling_b = arrays.Rolling(codes, arrays.BASE_B)
        n = len(codes)
        grams = self.rolling.grams(k)
        least = arrays.window_argmin(grams, window - k + 1)
        at = np.arange(len(least))
        self.windows = at[words.doc[at] == words.doc[at + window - 1]] if n >= window else at[:0]
        chosen = least[self.windows]
        new = np.ones(len(chosen), bool)
        new[1:] = chosen[1:] != chosen[:-1]
        self.at, self.of_window = chosen[new], np.cumsum(new) - 1
        self.edge = grams[self.at]
        self.doc = words.doc[self.at]
        self.opens = np.ones(len(self.at), bool)
        self.opens[1:] = self.doc[1:] != self.doc[:-1]
        self.closes = np.ones(len(self.at), bool)
        self.closes[:-1] = self.opens[1:]
        self.lead = np.where(self.opens, words.first[self.doc], np.roll(self.at, 1))
        self.tail = np.where(self.closes, words.first[self.doc + 1], np.roll(self.at, -1) + k)
        self.k = k

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words that lead to each edge and on from it; ends of documents differ from all else."""
        before = self.rolling.of(self.lead, self.at + self.k) ^ self.opens.astype(np.uint64)
        after = self.rolling.of(self.at, self.tail) ^ (self.closes.astype(np.uint64) << np.uint64(1))
        return before, after


def _slices(batch: pa.RecordBatch):
    raw, offsets = arrays.utf8(batch.column("text"))
    ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
    for lo, hi in arrays.slices(offsets):
        yield raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], ids[lo:hi]


def edge_counts(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """``(edge, branches)`` of each edge that more than one document holds."""

    def emit(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for raw, offsets, ids in _slices(batch):
                e = _Edges(raw, offsets, window, k)
                before, after = e.links()
                columns = [arrays.signed(e.edge), ids[e.doc], arrays.signed(before), arrays.signed(after)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["edge", "doc_id", "before", "after"])

    rows = docs.mapInArrow(emit, "edge long, doc_id long, before long, after long")
    found = rows.groupBy("edge").agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
        *[f(c).alias(f"{f.__name__}_{c}") for c in ("before", "after") for f in (F.min, F.max)],
    )
    branches = (F.col("min_before") != F.col("max_before")) | (F.col("min_after") != F.col("max_after"))
    return found.where("lo < hi").select("edge", branches.alias("branches"))


def compacted(docs: DataFrame, counts: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """Paths and single windows that may repeat: ``(a, b, doc_id, start, n)``, hashed words and where they are."""
    repeated = membership.bitmap(counts, "edge")
    branching = membership.bitmap(counts.where("branches"), "edge")

    def emit(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for raw, offsets, ids in _slices(batch):
                e = _Edges(raw, offsets, window, k)
                held = membership.contains(repeated.value, e.edge)
                if not held.any():
                    continue
                inner = held & ~membership.contains(branching.value, e.edge)
                begins = inner & (e.opens | ~np.concatenate([[False], inner[:-1]]))
                ends = inner & (e.closes | ~np.concatenate([inner[1:], [False]]))
                path = np.cumsum(begins) - 1
                lo, hi = e.lead[begins], e.tail[ends]
                at, of = e.windows, e.of_window
                own = path[of].clip(0)
                covered = inner[of]
                if len(lo):
                    covered &= (lo[own] <= at) & (at + window <= hi[own])
                single = at[held[of] & ~covered]
                long = hi - lo >= window
                start = np.concatenate([lo[long], single])
                end = np.concatenate([hi[long], single + window])
                doc = e.words.doc[start]
                columns = [
                    pa.array(arrays.signed(e.rolling.of(start, end))),
                    pa.array(arrays.signed(e.rolling_b.of(start, end))),
                    pa.array(ids[doc]),
                    pa.array((start - e.words.first[doc]).astype(np.int32)),
                    pa.array((end - start).astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b", "doc_id", "start", "n"])

    return docs.mapInArrow(emit, "a long, b long, doc_id long, start int, n int")


def repeated_spans(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """Spans of words that a document with a smaller ``doc_id`` holds too.

    ``(doc_id, start, n, source_id)``; spans may overlap, and together they cover
    each word of each window that starts in an earlier document.
    """
    docs = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    counts = stage(edge_counts(docs, window, k), "edges")
    spans = stage(compacted(docs, counts, window, k), "paths")
    first = spans.groupBy("a", "b").agg(F.min("doc_id").alias("source_id"), F.max("doc_id").alias("last_id"))
    # written, so that Spark can split the other side of the join at a passage that very many documents hold
    first = stage(first.where("source_id < last_id").drop("last_id"), "sources")
    return spans.join(first, ["a", "b"]).where("source_id < doc_id").select("doc_id", "start", "n", "source_id")


def remove_repeats(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """Each document without the words that repeat: ``(doc_id, n_words, n_removed, kept)``.

    The kept words are joined by one space.
    """
    spans = settled(small_batches(docs).sparkSession, "spans", lambda: repeated_spans(docs, window, k))
    per_doc = spans.groupBy("doc_id").agg(F.collect_set(F.struct("start", "n")).alias("spans"))
    rows = docs.select("doc_id", "text").join(per_doc, "doc_id", "left")

    def emit(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                words = (row["text"] or "").encode().split()
                spans = row["spans"] or ()
                if spans:
                    change = np.zeros(len(words) + 1, np.int32)
                    np.add.at(change, [s["start"] for s in spans], 1)
                    np.add.at(change, [s["start"] + s["n"] for s in spans], -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
                else:
                    kept = words
                out.append((row["doc_id"], len(words), len(words) - len(kept), b" ".join(kept).decode()))
            columns = [pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            if out:
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept"])

    return rows.mapInArrow(emit, "doc_id long, n_words long, n_removed long, kept string")


def digest(kept: DataFrame) -> DataFrame:
    """The kept text as a digest."""
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op4_substring_dedup(spark, sf_dir):
    return digest(remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")))


_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"
ORACLE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (
  SELECT doc_id, p, md5(array_to_string(w[p + 1:p + {WINDOW}], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - {WINDOW - 1}, 0))) AS p FROM d)),
again AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY h) AS first_id FROM win) WHERE first_id < doc_id),
gone AS (SELECT DISTINCT doc_id, p + i AS p FROM again, range(0, {WINDOW}) r(i)),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS p FROM d),
kept AS (
  SELECT word.doc_id, string_agg(word, ' ' ORDER BY word.p) AS text, count(*) AS n
  FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p GROUP BY word.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
