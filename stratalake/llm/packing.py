"""Packing documents into token windows by multiway differencing.

Each task reads its documents as they come, turns them into token ids and packs
them group by group; a group holds some ``GROUP_TOKENS`` tokens and at most
``GROUP_DOCS`` documents, however short, so memory is bounded and nothing is
shuffled. In a group

1. documents of more than a window are cut: whole windows leave at once, the rest
   stays as one item;
2. the items are divided among m = ceil(tokens / capacity) windows by the
   Karmarkar-Karp method: every item starts as a partition of its own (one window
   filled, the others empty and not held), and the two partitions of the largest imbalance
   merge, the fullest window of one with the emptiest of the other, until one is
   left. Its windows are nearly equal;
3. what a window holds above the capacity is cut off and goes to windows with
   room; if there is none, the window count rises.

Windows are padded to the capacity, but for those whose length is a power of two;
a group leaves less than one window of padding. Window ids number the windows
of a task, below the task's own number in the upper bits; a task that runs again
after a lost executor reads the same rows and gives the same ids.

A document is its ids (no special ones added) and the end id, so an empty or null
text is the end id alone. Rows are packed as they are: repeated rows and null
ids are documents like others. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame

from stratalake.llm.settle import small_batches

CAPACITY = 4096
END = 2
GROUP_TOKENS = 1 << 20
GROUP_DOCS = 1 << 17
# Words, and parts of words, whose ids a worker remembers in each of two generations.
CACHED_WORDS, CACHED_PARTS = 200_000, 400_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_END_BYTES = np.array([END], np.uint32).tobytes()
# Visible signs and Latin letters, which lower-casing and normal form leave apart.
_LATIN = regex.compile("[!-~\u00a1-\u024f]+").fullmatch
_LAST_LATIN = "\u024f"
# Signs that often end a word; a run of them is one part, and none begins another kind of part.
_FINAL = b".,;:!?)\"-"
# Byte-level vocabularies write a byte that is no visible Latin-1 sign as the next free code from 256 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_SIGNS = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}
_encoders: dict[str, WordEncoder] = {}


class _Recent:
    """A lookup that forgets what was not asked for lately: two generations of bounded size."""

    def __init__(self, size: int, make):
        self._size, self._make = size, make
        self.now, self._before = {}, {}

    def __call__(self, key):
        value = self.now.get(key)
        if value is not None:
            return value
        value = self._before.get(key)
        if value is None:
            value = self._make(key)
        if len(self.now) >= self._size:
            self._before, self.now = self.now, {}
        self.now[key] = value
        return value


class WordEncoder:
    """Token ids of whole texts, word by word, as the tokenizer's file defines them.

    Its rules never join characters across white space, so the ids of a text are
    those of its words in turn. Words and their parts are looked up among recent
    ones; a new part goes to the tokenizer's model, and a word with characters
    beyond the Latin ones, or with a special token's sign, to the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._words, self._parts = _Recent(CACHED_WORDS, self._word), _Recent(CACHED_PARTS, self._part)
        rule = json.loads(self._tokenizer.to_str())["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._split = regex.compile(rule).findall

    def _part(self, part: str) -> bytes:
        """Ids of a run of letters, a digit or a run of signs, in lower case."""
        signs = part if part.isascii() else part.encode().decode("latin-1").translate(_BYTE_SIGNS)
        return array("I", [t.id for t in self._model.tokenize(signs)]).tobytes()

    def _word(self, word: bytes) -> bytes:
        core = word.rstrip(_FINAL)
        letters = core.decode().lower()
        if letters.isalpha() and (letters.isascii() or max(letters) <= _LAST_LATIN):
            # letters, then signs or nothing: what most words are, and no rule could split them further
            ids = self._parts(letters)
            return ids if len(core) == len(word) else ids + self._parts(word[len(core) :].decode())
        text = word.decode()
        if "<|" in text or not _LATIN(text):
            return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self._parts, self._split(text.lower())))

    def encode(self, text: bytes) -> np.ndarray:
        """The ids of a text, with the end id."""
        words = text.split()
        ids = list(map(self._words.now.get, words))
        if None in ids:
            ids = [self._words(w) if x is None else x for w, x in zip(words, ids)]
        return np.frombuffer(b"".join(ids) + _END_BYTES, np.uint32)


def encoder(path: str) -> WordEncoder:
    """One encoder per worker and vocabulary."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """The items of each window, by Karmarkar-Karp differencing over ``windows`` windows.

    A partition holds its filled windows only, the fullest first.
    """
    heap = [(-size, item, np.array([size], np.int64), [[item]]) for item, size in enumerate(sizes)]
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        _, _, sums, sets = heapq.heappop(heap)
        _, _, other, more = heapq.heappop(heap)
        both = max(len(sums) + len(other) - windows, 0)
        alone, rest = len(sums) - both, len(other) - both
        # the emptiest windows of one, and the other's in reverse, meet
        sums = np.concatenate([sums, other[:rest][::-1]])
        sums[alone : alone + both] += other[rest:][::-1]
        sets = sets[:alone] + [a + b for a, b in zip(sets[alone:], reversed(more[rest:]))] + more[:rest][::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        least = int(sums[-1]) if len(sums) == windows else 0
        heapq.heappush(heap, (least - int(sums[0]), count, sums, [sets[i] for i in order]))
        count += 1
    sets = heap[0][3] if heap else []
    return sets + [[] for _ in range(windows - len(sets))]


def plan(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Windows of pieces ``(document, start, length)`` that hold every token of the group once."""
    full, items = [], []
    for doc, n in enumerate(lengths):
        cut = n - n % capacity
        full += [[(doc, start, capacity)] for start in range(0, cut, capacity)]
        if cut < n:
            items.append((doc, cut, n - cut))
    if not items:
        return full
    total = sum(n for _, _, n in items)
    count = -(-total // capacity)
    packed = []
    spare: list[tuple[int, int, int]] = []
    for members in differencing([n for _, _, n in items], count):
        window, room = [], capacity
        for doc, start, n in (items[i] for i in members):
            fits = min(n, room)
            if fits:
                window.append((doc, start, fits))
                room -= fits
            if fits < n:
                spare.append((doc, start + fits, n - fits))
        packed.append([room, window])
    for doc, start, n in spare:
        while n:
            target = next((w for w in packed if w[0]), None)
            if target is None:
                packed.append(target := [capacity, []])
            fits = min(n, target[0])
            target[1].append((doc, start, fits))
            target[0] -= fits
            start, n = start + fits, n - fits
    return full + [window for _, window in packed if window]


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, group_tokens: int = GROUP_TOKENS, group_docs: int = GROUP_DOCS
) -> DataFrame:
    """One row per piece of a document, with its place in its document and in its window."""

    def emit(batches: Iterator[pa.RecordBatch]):
        words, task = encoder(tokenizer), TaskContext.get().partitionId() << 40
        made, ids, tokens, size = 0, [], [], 0

        def packed():
            nonlocal made, ids, tokens, size
            rows = []
            for window in plan([len(t) for t in tokens], capacity):
                offset = 0
                for doc, start, n in window:
                    crc = zlib.crc32(tokens[doc][start : start + n].astype("<u4").tobytes())
                    rows.append((ids[doc], start, n, crc, len(tokens[doc]), task + made, offset))
                    offset += n
                made += 1
            ids, tokens, size = [], [], 0
            columns = [pa.array(x, pa.int64()) for x in zip(*rows)]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCHEMA.split(", ")])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
                ids.append(doc_id)
                tokens.append(words.encode(text.as_py() or b""))
                size += len(tokens[-1])
                if size >= group_tokens or len(tokens) >= group_docs:
                    yield packed()
        if tokens:
            yield packed()

    return small_batches(docs.select("doc_id", "text")).mapInArrow(emit, SCHEMA)


def op10_packing(spark, sf_dir):
    import public_tokenizers

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
