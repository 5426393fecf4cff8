"""Benchmark items found inside documents, by SimHash windows of each item's size.

1. Words are runs of non-blank characters with A-Z lower-cased, shingles five of
   them; an item of fewer words is one shingle. A shingle an item holds weighs one over the number of different
   texts in the whole benchmark that hold it (Spark counts them once, whatever the blocks); one that the item
   lacks weighs one.
2. A window similar to an item holds three of its shingles for each other one, so windows
   with fewer benchmark shingles are left out at once; none that could count is lost.
3. Of each such window of an item's size, a 64-bit SimHash of its shingles is
   taken, and looked up in a multi-index: fingerprints are split into four blocks
   of 16 bits, and by the pigeonhole principle two within ``RADIUS`` = 23 bits agree in a
   block but for five bits at most. Each item stands under all values of each of its
   blocks that differ by up to three bits, a window looks under all that differ from its own by two, so all fingerprints
   within the radius are found, and only those are candidates. A similarity of 0.75 is 11 bits on average (15 in the worst case of weights) with a spread of 3, so
   a few pairs in a thousand that are barely similar lie beyond; tests hold the recall against all windows.
4. A candidate counts if the weighted Jaccard similarity of the two shingle
   multisets is at least 0.75. Of several places of an item in a document the one of the nearest fingerprint is reported, then the first.

Documents are read once and not shuffled for each block of at most about
``BLOCK_ITEMS`` items or ``BLOCK_BYTES`` of their texts; only one block is
broadcast at a time, so a larger benchmark takes more passes, not more memory. What is found does not depend on the blocks.

Items that are null or have no word or a null id are no evidence and
match nothing. Texts of one id are items of their own under that id. Items given twice, or under several ids, change no weight. A document that is null, empty or shorter than all items matches nothing. Repeated
documents each give their rows. Long documents are worked on in slices of windows, in memory of their own size. Other
columns are ignored; without documents or items there are no rows.
"""

from __future__ import annotations

import functools
import itertools
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm import arrays
from stratalake.llm.settle import small_batches
from stratalake.sources.staging import stage

SHINGLE = 5
SIMILARITY = 0.75
# Errors of a block of bits: those the items are listed under, and those the windows look under.
BLOCKS, LISTED, PROBED = 4, 3, 2
RADIUS = BLOCKS * (LISTED + PROBED + 1) - 1
WINDOWS = 512
BLOCK_ITEMS = 4096
BLOCK_BYTES = 1 << 23
_WIDTH = 64 // BLOCKS
SCHEMA = "doc_id long, item_id long, start long, n_words long, similarity double"


@functools.cache
def _near_values(errors: int) -> np.ndarray:
    """All changes of at most ``errors`` bits of a block."""
    masks = [sum(1 << b for b in bits) for e in range(errors + 1) for bits in itertools.combinations(range(_WIDTH), e)]
    return np.array(masks, np.uint16)


def _values(prints: np.ndarray, block: int, errors: int) -> np.ndarray:
    """One row per fingerprint: the block's values that differ from its own by at most ``errors`` bits."""
    own = ((prints >> np.uint64(block * _WIDTH)) & np.uint64((1 << _WIDTH) - 1)).astype(np.uint16)
    return own[:, None] ^ _near_values(errors)


class _Text:
    """The words of texts and the shingles of their windows."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.words = arrays.Words(arrays.lower_ascii(raw), offsets)
        self._rolling = arrays.Rolling(self.words.codes())
        self._grams: dict[int, np.ndarray] = {}

    def shingles(self, length: int) -> tuple[np.ndarray, int]:
        """The shingles at all words for windows of ``length`` words, and how many a window has."""
        size = min(length, SHINGLE)
        if size not in self._grams:
            self._grams[size] = self._rolling.grams(size)
        return self._grams[size], length - size + 1

    def of(self, doc: int) -> np.ndarray:
        """All shingles of one text."""
        length, first = int(self.words.counts[doc]), self.words.first[doc]
        grams, n = self.shingles(length) if length else (np.zeros(0, np.uint64), 0)
        return grams[first : first + n]


def simhash(shingles: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The fingerprint of each range of shingles: for each bit, whether most of them have it."""
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32)
    sums = np.zeros((len(shingles) + 1, 64), np.int32)
    np.cumsum(2 * bits - 1, axis=0, out=sums[1:])
    return np.packbits(sums[end] > sums[start], axis=1).view(np.uint64).ravel()


class ItemIndex:
    """The items of a block: shingles with weights, fingerprints, and for each size of items the multi-index over them.

    ``shared`` and ``uses`` are the shingles that several texts of the benchmark hold, in order, and how many hold each.
    """

    def __init__(self, ids: list[int], texts: list[str], shared: np.ndarray, uses: np.ndarray):
        text = _Text(*arrays.utf8(pa.array(texts, pa.string())))
        judged = [i for i in range(len(ids)) if text.words.counts[i]]
        self.ids = np.array([ids[i] for i in judged], np.int64)
        self.words = np.array([text.words.counts[i] for i in judged], np.int64)
        own = [text.of(i) for i in judged]
        self.items = [np.unique(x, return_counts=True) for x in own]
        self.weights = []
        for x, _ in self.items:
            at = np.searchsorted(shared, x).clip(max=max(len(shared) - 1, 0))
            weight = np.ones(len(x))
            if len(shared):
                weight = np.where(shared[at] == x, 1 / uses[at], weight)
            self.weights.append(weight)
        self.shingles = np.unique(np.concatenate(own)) if own else np.zeros(0, np.uint64)
        self.low = np.zeros(1 << 20, bool)
        self.low[self.shingles & np.uint64((1 << 20) - 1)] = True
        prints = [simhash(x, np.array([0]), np.array([len(x)])) for x in own]
        self.prints = np.concatenate(prints) if prints else np.zeros(0, np.uint64)
        self.tables: dict[int, list] = {}
        for length in np.unique(self.words):
            of = np.flatnonzero(self.words == length).astype(np.int32)
            tables = []
            for block in range(BLOCKS):
                listed = _values(self.prints[of], block, LISTED)
                order = np.argsort(listed, axis=None, kind="stable")
                held = np.zeros(1 << _WIDTH, bool)
                held[listed] = True
                tables.append((held, listed.ravel()[order], np.repeat(of, listed.shape[1])[order]))
            self.tables[int(length)] = tables

    def known(self, shingles: np.ndarray) -> np.ndarray:
        """Which shingles an item holds."""
        held = self.low[shingles & np.uint64((1 << 20) - 1)]
        at = np.flatnonzero(held)
        place = np.searchsorted(self.shingles, shingles[at]).clip(max=max(len(self.shingles) - 1, 0))
        held[at] = self.shingles[place] == shingles[at]
        return held

    def within_radius(self, prints: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(query, item, distance)`` of all fingerprints of items of ``length`` words within the radius."""
        pairs = []
        for block, (held, listed, owner) in enumerate(self.tables[length]):
            value = _values(prints, block, PROBED)
            query, probe = np.nonzero(held[value])
            value = value[query, probe]
            lo = np.searchsorted(listed, value)
            n = np.searchsorted(listed, value, side="right") - lo
            item = owner[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
            pairs.append(np.repeat(query, n) * len(self.prints) + item)
        query, item = np.divmod(np.unique(np.concatenate(pairs)), max(len(self.prints), 1))
        distance = np.bitwise_count(prints[query] ^ self.prints[item]).astype(np.int64)
        near = distance <= RADIUS
        return query[near], item[near], distance[near]

    def similarity(self, window: np.ndarray, item: int) -> float:
        """Weighted Jaccard similarity of the window's shingles and the item's, as multisets."""
        own, own_n = self.items[item]
        other, other_n = np.unique(window, return_counts=True)
        at = np.searchsorted(own, other).clip(max=len(own) - 1)
        held = own[at] == other
        both = np.zeros(len(own), np.int64)
        both[at[held]] = other_n[held]
        weight = self.weights[item]
        every = (weight * np.maximum(own_n, both)).sum() + other_n[~held].sum()
        return float((weight * np.minimum(own_n, both)).sum() / every)


def _found(index: ItemIndex, raw: np.ndarray, offsets: np.ndarray):
    """``(document, item, start, words, similarity)`` of each item found in a slice of documents, at its best place."""
    text = _Text(raw, offsets)
    doc = text.words.doc
    best: dict[tuple[int, int], tuple] = {}
    sums: dict[int, np.ndarray] = {}
    for length in index.tables:
        grams, n = text.shingles(length)
        size = length - n + 1
        if len(grams) < n:
            continue
        if size not in sums:
            sums[size] = np.concatenate([[0], np.cumsum(index.known(grams))])
        known = sums[size]
        if not known[-1]:
            continue
        start = np.flatnonzero((known[n:] - known[:-n]) >= SIMILARITY * n)
        start = start[doc[start] == doc[start + length - 1]]
        for lo in range(0, len(start), WINDOWS):
            _judge(index, grams, n, text.words, start[lo : lo + WINDOWS], length, best)
    for (document, item), (_, start, length, like) in best.items():
        yield document, item, int(start - text.words.first[document]), length, like


def _judge(index: ItemIndex, grams: np.ndarray, n: int, words: arrays.Words, start: np.ndarray, length: int, best: dict) -> None:
    """Adds the items found in windows of one size to ``best``: the nearest fingerprint, then the first place."""
    change = np.zeros(start[-1] - start[0] + n + 1, np.int32)
    change[start - start[0]] += 1
    change[start - start[0] + n] -= 1
    covered = np.flatnonzero(np.cumsum(change)) + start[0]
    at = np.searchsorted(covered, start)
    query, item, distance = index.within_radius(simhash(grams[covered], at, at + n), length)
    order = np.lexsort((start[query], distance))
    for q, i, bits in zip(query[order], item[order], distance[order]):
        key = (int(words.doc[start[q]]), int(i))
        if key not in best or bits < best[key][0]:
            like = index.similarity(grams[start[q] : start[q] + n], i)
            if like >= SIMILARITY:
                best[key] = (int(bits), int(start[q]), length, like)


def _each_shingle(texts: DataFrame) -> DataFrame:
    """``shingle``: the different ones of each text."""

    def emit(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            text = _Text(*arrays.utf8(batch.column("text")))
            own = [np.unique(text.of(i)) for i in range(batch.num_rows)]
            if own:
                yield pa.RecordBatch.from_arrays([pa.array(arrays.signed(np.concatenate(own)))], ["shingle"])

    return texts.select("text").mapInArrow(emit, "shingle long")


def _blocks(benchmark: DataFrame) -> Iterator[Broadcast]:
    """The index of each block of items, as it is needed."""
    spark = small_batches(benchmark).sparkSession
    # texts are told apart by their words
    words = F.trim(F.regexp_replace(F.translate("text", string.ascii_uppercase, string.ascii_lowercase), "[ \t-\r]+", " "))
    items = benchmark.where("text is not null and item_id is not null").select("item_id", words.alias("text"))
    items = stage(items.where("text <> ''").distinct(), "items")
    uses = _each_shingle(items.select("text").distinct()).groupBy("shingle").agg(F.count(F.lit(1)).alias("uses"))
    uses = stage(uses.where("uses > 1"), "item-shingles")
    rows, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()
    blocks = max(1, -(-rows // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        # of the counts, those of the block's own shingles
        shared = uses.join(_each_shingle(part).distinct(), "shingle", "left_semi").toArrow()
        shingles, counts = shared["shingle"].to_numpy().view(np.uint64), shared["uses"].to_numpy()
        order = np.argsort(shingles)
        part = part.orderBy("item_id", "text").collect()
        yield spark.sparkContext.broadcast(ItemIndex([r[0] for r in part], [r[1] for r in part], shingles[order], counts[order]))


def _hits(index: ItemIndex, batch: pa.RecordBatch) -> list[tuple]:
    """:func:`_found` over a whole batch."""
    raw, offsets = arrays.utf8(batch.column("text"))
    hits = []
    for lo, hi in arrays.slices(offsets):
        found = _found(index, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        hits += [(lo + doc, *rest) for doc, *rest in found]
    return hits


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, start, n_words, similarity)``: each item that a document holds, and where."""
    docs, found = docs.select("doc_id", "text"), None
    for index in _blocks(benchmark):

        def emit(batches: Iterator[pa.RecordBatch], index=index):
            for batch in batches:
                if hits := _hits(index.value, batch):
                    doc, item, start, n, like = zip(*hits)
                    columns = [batch.column("doc_id").take(pa.array(doc)), pa.array(index.value.ids[list(item)])]
                    columns += [pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(like, pa.float64())]
                    yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCHEMA.split(", ")])

        part = docs.mapInArrow(emit, SCHEMA)
        found = part if found is None else found.union(part)
    return found


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, with all their columns, that hold no item."""
    for index in _blocks(benchmark):

        def emit(batches: Iterator[pa.RecordBatch], index=index):
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[hit[0] for hit in _hits(index.value, batch)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(emit, docs.schema)
    return docs


def op2_decontaminate(spark, sf_dir):
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contaminated(docs, benchmark)
