"""Byte strings that occur again, marked on a run-length index.

The rule: each byte covered by a string of ``window`` bytes that also starts
earlier (in a smaller ``doc_id``, or before in the same document) is removed.

1. Of the k-byte strings of every window the least one (by hash) is its anchor,
   the same in each copy of the window. The windows of one anchor occurrence form
   a segment, which is known by its anchor and a hash of its bytes. Anchors that
   occur once need no more.
2. Segments are counted by content, before the shuffle. All copies of a segment
   but the first are removed as a whole.
3. First copies of different segments under one anchor may share windows still.
   They meet, anchor by anchor, in blocks of bounded size. Over each block a
   run-length index is built: the suffix order, its Burrows-Wheeler transform in
   runs, and samples at the run ends. The matching statistics (how many bytes from
   here on also stand at the neighbour in suffix order) are read at the samples
   only and streamed over the text from there: inside a run the match of the
   next position is shorter by one. Neighbours that match over a whole window are
   one class, of which all but the earliest are marked.
4. Anchors with more than ``HOT`` different segments, such as the edge of a
   passage that very many documents hold, are not brought together: each of
   their windows is joined with its first place by a 128-bit hash. This gives
   the same rows, spread over all tasks.

The segments are sorted out by classes of anchors, ``MOST_CLASSES`` for a large table, so that
a share of them is shuffled at a time.

Texts are UTF-8 bytes, null reads as empty. Matches never cross documents. Rows
with a null ``doc_id`` are no source and lose nothing. ``doc_id`` is the key of a
document: a row repeated as a whole counts as one document. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm import arrays, membership
from stratalake.llm.settle import settled, small_batches
from stratalake.sources.staging import stage, stage_observed

WINDOW = 100
K = 32
HOT = 1024
BLOCK_BYTES = 1 << 19
CLASS_ROWS = 1 << 22
MOST_CLASSES = 8
_SPOT = np.uint64(0x9E3779B97F4A7C15)


class _Segments:
    """The segments of a slice of documents: anchor hash, bounds in the slice, document, place there."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, window: int, k: int):
        self.rolling = arrays.Rolling(arrays.BYTE_CODES[raw])
        grams = self.rolling.grams(k)
        least = arrays.window_argmin(grams, window - k + 1)
        lengths = np.diff(offsets)
        room = np.maximum(lengths - window + 1, 0)
        change = np.zeros(len(raw) + 2, np.int32)
        np.add.at(change, offsets[:-1][room > 0], 1)
        np.add.at(change, (offsets[:-1] + room)[room > 0], -1)
        valid = np.flatnonzero(np.cumsum(change[: len(least)]))
        chosen = least[valid]
        new = np.ones(len(chosen), bool)
        new[1:] = chosen[1:] != chosen[:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(chosen))[: len(first)] - 1
        self.anchor = grams[chosen[first]]
        self.start = valid[first]
        self.end = valid[last] + window
        self.doc = np.searchsorted(offsets[1:], self.start, side="right")
        self.place = self.start - offsets[self.doc]

    def keep(self, held: np.ndarray) -> _Segments:
        for name in ("anchor", "start", "end", "doc", "place"):
            setattr(self, name, getattr(self, name)[held])
        return self


def _slices(batch: pa.RecordBatch):
    raw, offsets = arrays.utf8(batch.column("text"))
    ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
    for lo, hi in arrays.slices(offsets):
        yield raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], ids[lo:hi]


def _spot(doc_id: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A hash of a place, for the bitmaps."""
    return arrays.mix(arrays.mix(doc_id.astype(np.int64).view(np.uint64)) + place.astype(np.uint64) * _SPOT)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns.values()], list(columns))


def _anchors(docs: DataFrame, window: int, k: int) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for raw, offsets, _ in _slices(batch):
                yield _batch(anchor=arrays.signed(_Segments(raw, offsets, window, k).anchor))

    return docs.mapInArrow(emit, "anchor long")


def _segments(docs: DataFrame, repeated, window: int, k: int) -> DataFrame:
    """``(anchor, content, doc_id, place, n)`` of each segment whose anchor may occur again."""

    def emit(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for raw, offsets, ids in _slices(batch):
                s = _Segments(raw, offsets, window, k)
                s.keep(membership.contains(repeated.value, s.anchor))
                yield _batch(
                    anchor=arrays.signed(s.anchor),
                    content=arrays.signed(s.rolling.of(s.start, s.end)),
                    doc_id=ids[s.doc],
                    place=s.place.astype(np.int32),
                    n=(s.end - s.start).astype(np.int32),
                )

    return docs.mapInArrow(emit, "anchor long, content long, doc_id long, place int, n int")


def _with_spot(firsts: DataFrame) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            spot = _spot(*(batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "place")))
            yield pa.RecordBatch.from_arrays([pa.array(arrays.signed(spot))], ["spot"])

    return firsts.select("doc_id", "place").mapInArrow(emit, "spot long")


def _bytes_of(docs: DataFrame, wanted, hot, window: int, k: int) -> DataFrame:
    """The bytes of the segments at the wanted places; of a hot anchor, a hash of each window instead.

    ``(a, b, doc_id, place, segment)``: ``a`` is the anchor and ``segment`` the bytes, or ``a, b`` a window's hash.
    """

    def emit(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for raw, offsets, ids in _slices(batch):
                s = _Segments(raw, offsets, window, k)
                s.keep(membership.contains(wanted.value, _spot(ids[s.doc], s.place)))
                if not len(s.anchor):
                    continue
                is_hot = membership.contains(hot.value, s.anchor)
                cold = ~is_hot
                text = raw.tobytes()
                yield _batch(
                    a=arrays.signed(s.anchor[cold]),
                    b=np.zeros(int(cold.sum()), np.int64),
                    doc_id=ids[s.doc[cold]],
                    place=s.place[cold].astype(np.int32),
                    segment=pa.array([text[x:y] for x, y in zip(s.start[cold], s.end[cold])], pa.binary()),
                )
                if is_hot.any():
                    counts = (s.end - s.start - window + 1)[is_hot]
                    at = np.repeat(s.start[is_hot] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
                    doc = np.repeat(s.doc[is_hot], counts)
                    other = arrays.Rolling(arrays.BYTE_CODES[raw], arrays.BASE_B)
                    yield _batch(
                        a=arrays.signed(s.rolling.of(at, at + window)),
                        b=arrays.signed(other.of(at, at + window)),
                        doc_id=ids[doc],
                        place=(at - offsets[doc]).astype(np.int32),
                        segment=pa.nulls(len(at), pa.binary()),
                    )

    return docs.mapInArrow(emit, "a long, b long, doc_id long, place int, segment binary")


def suffix_order(text: np.ndarray, room: np.ndarray) -> np.ndarray:
    """The suffixes in order; ``room`` is how far each goes on (its string ends there). Equal ones in text order."""
    n = len(text)
    at = np.arange(n)
    key = np.zeros(n, np.uint64)
    step = 7
    symbols = text.astype(np.uint64) + np.uint64(1)
    for j in range(step):
        part = np.zeros(n, np.uint64)
        part[: n - j] = symbols[j:]
        part[room <= j] = 0
        key = (key << np.uint64(9)) | part
    longest = int(room.max(initial=0))
    while True:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.zeros(n, np.int64)
        new[1:] = ordered[1:] != ordered[:-1]
        ranks = np.cumsum(new)
        if step >= longest or (n and ranks[-1] == n - 1):
            return order
        rank = np.empty(n, np.int64)
        rank[order] = ranks + 1
        follow = np.where(room > step, rank[np.minimum(at + step, n - 1)], 0)
        key = (rank * (n + 1) + follow).view(np.uint64)
        step *= 2


def matching_statistics(text: np.ndarray, room: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each position, how many bytes it shares with its predecessor in suffix order.

    Read at the starts of the runs of the Burrows-Wheeler transform, and streamed
    in text order from there. ``text`` has 8 bytes to spare at the end.
    """
    n = len(order)
    before = np.full(n, -1, np.int64)
    inside = np.zeros(n, bool)
    inside[1:] = room[1:n] == room[: n - 1] - 1
    before[inside] = text[: n - 1][inside[1:]]
    bwt = before[order]
    runs = np.ones(n, bool)
    runs[1:] = (bwt[1:] != bwt[:-1]) | (bwt[1:] < 0)
    sampled, neighbour = order[runs], order[np.flatnonzero(runs) - 1]
    shared = np.zeros(len(sampled), np.int64)
    most = np.minimum(room[sampled], room[neighbour])
    most[0] = 0  # the first suffix has no predecessor
    eight = np.lib.stride_tricks.as_strided(text, (n, 8), (1, 1))
    eight = np.ascontiguousarray(eight).view(np.uint64).ravel()
    open_ = np.flatnonzero(most > 0)
    while len(open_):
        x = eight[sampled[open_] + shared[open_]] ^ eight[neighbour[open_] + shared[open_]]
        low = x & (~x + np.uint64(1))
        same = np.where(x == 0, 8, np.frexp(low.astype(np.float64))[1].astype(np.int64) - 1 >> 3)
        shared[open_] += same
        open_ = open_[(same == 8) & (shared[open_] < most[open_])]
    shared = np.minimum(shared, most)
    value = np.zeros(n, np.int64)
    value[sampled] = shared + sampled
    at = np.arange(n)
    last = np.zeros(n, np.int64)
    last[sampled] = sampled
    return value[np.maximum.accumulate(last)] - at


def repeats(segments: list[bytes], window: int) -> np.ndarray:
    """Positions in the joined segments at which a window starts that started earlier."""
    lengths = np.array([len(x) for x in segments])
    total = int(lengths.sum())
    text = np.frombuffer(b"".join(segments) + bytes(8), np.uint8)
    room = np.repeat(np.cumsum(lengths), lengths) - np.arange(total)
    order = suffix_order(text[:total], room)
    matched = matching_statistics(text, room, order)[order]
    begins = np.flatnonzero(matched < window)
    first = np.minimum.reduceat(order, begins)
    classes = np.cumsum(matched < window) - 1
    again = order[order != first[classes]]
    return np.sort(again)


def _marked(rows: DataFrame, window: int, block_bytes: int) -> DataFrame:
    """Spans of the windows that repeat among the segments of an anchor, block by block."""

    def spans(block):
        segments = [x[3] for x in block]
        again = repeats(segments, window) if len(segments) > 1 else ()
        if not len(again):
            return None
        bounds = np.cumsum([0] + [len(x) for x in segments])
        owner = np.searchsorted(bounds[1:], again, side="right")
        new = np.ones(len(again), bool)
        new[1:] = (again[1:] != again[:-1] + 1) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(again)) - 1
        own = owner[first]
        return _batch(
            doc_id=np.array([x[1] for x in block])[own],
            place=(np.array([x[2] for x in block])[own] + again[first] - bounds[own]).astype(np.int32),
            n=(again[last] - again[first] + window).astype(np.int32),
        )

    def emit(batches: Iterator[pa.RecordBatch]):
        block, size, group, group_at = [], 0, None, 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("a", "doc_id", "place", "segment"))):
                if row[0] != group:
                    if size >= block_bytes:
                        if len(block) - group_at == 1:
                            block.pop()  # an anchor with one segment has nothing to share
                        if (found := spans(block)) is not None:
                            yield found
                        block, size = [], 0
                    elif block and len(block) - group_at == 1:
                        size -= len(block.pop()[3])
                    group, group_at = row[0], len(block)
                elif block and row[:3] == block[-1][:3]:
                    continue  # a document given twice
                block.append(row)
                size += len(row[3])
        if block and (found := spans(block)) is not None:
            yield found

    return rows.mapInArrow(emit, "doc_id long, place int, n int")


def _copies(segments: DataFrame, hot: int) -> DataFrame:
    """``(doc_id, place, n)`` of each later copy; with ``n`` 0 and the anchor, the first copies that others under one anchor may share windows with."""
    first = segments.groupBy("anchor", "content").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.count(F.lit(1)).alias("times"))
    first = stage(first, "firsts")
    several = first.where("times > 1").select("anchor", "content", "first")
    copies = segments.join(several, ["anchor", "content"]).where("struct(doc_id, place) > first")
    contents = stage(first.groupBy("anchor").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1"), "contents")
    shared = first.join(contents, "anchor")
    none = F.lit(None).cast("long")
    return copies.select("doc_id", "place", "n", none.alias("anchor"), F.lit(False).alias("hot")).union(
        shared.select("first.doc_id", "first.place", F.lit(0), "anchor", F.col("contents") > hot)
    )


def _all_copies(docs: DataFrame, window: int, k: int, hot: int, class_rows: int) -> DataFrame:
    """:func:`_copies` of all segments, class by class of the anchors."""
    repeated = _anchors(docs, window, k).groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = membership.bitmap(repeated, "anchor")
    segments, found = stage_observed(_segments(docs, repeated, window, k), "segments", rows=F.count(F.lit(1)))
    classes = min(1 + found["rows"] // class_rows, MOST_CLASSES)
    own = [segments.where(f"(anchor & 65535) % {classes} = {i}") if classes > 1 else segments for i in range(classes)]
    return reduce(DataFrame.union, [settled(docs.sparkSession, "copies", partial(_copies, s, hot)) for s in own])


def repeated_spans(
    docs: DataFrame, window: int = WINDOW, k: int = K, hot: int = HOT, block_bytes: int = BLOCK_BYTES, class_rows: int = CLASS_ROWS
) -> DataFrame:
    """``(doc_id, place, n)``: spans of bytes (they may overlap) that also stand earlier."""
    docs = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    found = settled(docs.sparkSession, "copies", lambda: _all_copies(docs, window, k, hot, class_rows))
    copies, shared = found.where("n > 0").select("doc_id", "place", "n"), found.where("n = 0")
    wanted = membership.bitmap(_with_spot(shared), "spot")
    too_many = membership.bitmap(shared.where("hot").select("anchor").distinct(), "anchor")
    held = stage(_bytes_of(docs, wanted, too_many, window, k), "bytes")

    blocks = held.where("segment is not null").repartition("a").sortWithinPartitions("a", "doc_id", "place")
    windows = held.where("segment is null").select("a", "b", "doc_id", "place")
    earliest = windows.groupBy("a", "b").agg(
        F.min(F.struct("doc_id", "place")).alias("first"), F.max(F.struct("doc_id", "place")).alias("last")
    )
    # written, so that Spark can split the other side of the join at a window that very many documents hold
    earliest = stage(earliest.where("first < last").select("a", "b", "first"), "earliest")
    again = windows.join(earliest, ["a", "b"]).where("struct(doc_id, place) > first")
    again = again.select("doc_id", "place", F.lit(window).alias("n"))
    return copies.union(_marked(blocks, window, block_bytes)).union(again)


def _with_spans(docs: DataFrame, settings: dict) -> DataFrame:
    """``docs`` and, as last column, the spans of each document."""
    name = "spans"
    while name in docs.columns:
        name += "_"
    spans = settled(small_batches(docs).sparkSession, "spans", lambda: repeated_spans(docs, **settings))
    spans = spans.groupBy("doc_id").agg(F.collect_set(F.struct("place", "n")).alias(name))
    return docs.join(spans, "doc_id", "left").select(*docs.columns, name)


def _cut(batch: pa.RecordBatch) -> Iterator[tuple[bytes | None, int, int]]:
    """Of each text the bytes left, how many were removed, in how many runs."""
    for text, spans in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.columns[-1].to_pylist()):
        if text is None or not spans:
            yield text, 0, 0
        else:
            yield arrays.cut_out(text, *(np.array([s[c] for s in spans]) for c in ("place", "n")))


def remove_repeats(docs: DataFrame, **settings) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)``: what was removed of each document, and the bytes that are left."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]

    def emit(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            kept, removed, runs = zip(*_cut(batch)) if batch.num_rows else ((), (), ())
            size = [len(k or b"") + n for k, n in zip(kept, removed)]
            columns = [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (size, removed, runs))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([k or b"" for k in kept], pa.binary())], names)

    rows = _with_spans(docs.select("doc_id", "text"), settings)
    return rows.mapInArrow(emit, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def without_repeats(docs: DataFrame, **settings) -> DataFrame:
    """The documents, with all their columns, without the repeats in ``text``; a character cut in two goes as a whole.

    Documents that were not blank and are now are left out.
    """
    names = docs.columns

    def emit(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            texts, stays = [], []
            for kept, removed, _ in _cut(batch):
                texts.append(None if kept is None else kept.decode("utf-8", "ignore"))
                stays.append(not removed or not kept.isspace() and len(kept) > 0)
            at = batch.schema.get_field_index("text")
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns[:-1])]
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(stays, pa.bool_()))

    return _with_spans(docs, settings).mapInArrow(emit, docs.schema)


def op7_suffix_array_dedup(spark, sf_dir):
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
