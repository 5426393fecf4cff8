"""Chat formatting on token level, with loss masks.

A turn reads ``### role: text</turn>`` and a line end. As tokens it is

    [TURN] ids of the role [TEXT] ids of the text [END]

where the three marks are reserved ids that no text can produce: each segment is
encoded for itself, then spliced in. Inside roles and texts a backslash goes
before every backslash, ``#`` and ``</turn>``, so no ``###`` and no bare ``</turn>`` is
left in the written form, and taking the backslashes away gives the text back.

The loss mask covers the text ids of ``LOSS_ROLE`` turns. It is kept as the bounds
of each turn and derived by prefix sums over +1 and -1 marks. The place of a turn in
its conversation is a prefix sum as well: the turns are dealt out by range of
conversation and turn, summed within each part, and the few sums of conversations
that span parts are added up. So one conversation of a third of all turns is
spread over the tasks. (``digests`` hashes each conversation from its first
character to the last, which only one task can do; it streams, in constant memory.)
Long texts have the ids of the whole text, whatever their length.

Null texts and roles read as empty. Turns of one conversation are ordered by
``turn`` (null first), then by role and a hash of the text; rows repeated as a whole
are turns of their own. Turns with a null ``conv_id`` form one conversation.
Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.settle import small_batches
from stratalake.sources.staging import stage

LOSS_ROLE = "assistant"
# The vocabulary has ids 0 to 50255; these follow.
TURN, TEXT, END = 50256, 50257, 50258
MARKS = {TURN: "### ", TEXT: ": ", END: "</turn>\n"}
# Longer texts are encoded in parts, so that no text needs memory beyond its length.
PART_CHARS = 1 << 16
_CONTROL = re.compile(r"\\|#|</turn>")
_ESCAPED = re.compile(r"\\(\\|#|<)")
_codecs: dict[str, object] = {}


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def codec(path: str, pattern: str):
    """The byte-level tokenizer of a vocabulary file, once per worker."""
    if path not in _codecs:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        _codecs[path] = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _codecs[path]


def _parts(text: str, pattern: str) -> Iterator[str]:
    """A long text in parts of some ``PART_CHARS`` characters, cut only where the tokenizer itself begins a new piece.

    Never after blanks, as how these are split depends on what follows.
    """
    start = end = 0
    for piece in regex.finditer(pattern, text):
        if end - start >= PART_CHARS and not text[end - 1].isspace():
            yield text[start:end]
            start = end
        end = piece.end()
    yield text[start:]


def encode(found, text: str) -> list[int]:
    """The ids of a text; of a long one by parts, which gives the same ids."""
    if len(text) <= PART_CHARS:
        return found.encode_ordinary(text)
    return [i for part in _parts(text, found._pat_str) for i in found.encode_ordinary(part)]


def format_turns(turns: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(conv_id, place, offset, ids, loss_start, loss_end)``, one row per turn.

    ``place`` counts the turns of the conversation, ``offset`` the ids before this
    turn; the loss bounds are within ``ids`` and equal where there is no loss. The turns are sorted as text, and encoded and
    numbered where they then lie: what is written is the result alone.
    """

    def number(batches: Iterator[pa.RecordBatch]):
        found, part = codec(path, pattern), TaskContext.get().partitionId()
        conv, place, offset = object(), 0, 0
        for batch in batches:
            rows = []
            for own, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if own != conv:
                    conv, place, offset = own, 0, 0
                head, body = encode(found, escape(role or "")), encode(found, escape(text or ""))
                lo = len(head) + 2
                ids = [TURN, *head, TEXT, *body, END]
                rows.append((own, part, place, offset, ids, lo, lo + (len(body) if role == LOSS_ROLE else 0)))
                place, offset = place + 1, offset + len(ids)
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.int32())
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["conv_id", "part", "place", "offset", "ids", "loss_start", "loss_end"])

    order = ["conv_id", "turn", "role", "tie"]
    rows = small_batches(turns).select("conv_id", "turn", "role", "text", F.xxhash64("text").alias("tie"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "role", "text")
    bounds = "ids array<int>, loss_start int, loss_end int"
    rows = stage(rows.mapInArrow(number, f"conv_id long, part int, place long, offset long, {bounds}"), "numbered")

    # At most two conversations of a part go on in another one, so these rows are bounded by the parts.
    sums = rows.groupBy("conv_id", "part").agg(
        F.count(F.lit(1)).alias("turns"), F.max(F.col("offset") + F.size("ids")).alias("tokens")
    )
    sums = sums.withColumn("parts", F.expr("count(1) over (partition by conv_id)")).where("parts > 1")
    before = "over (partition by conv_id order by part rows between unbounded preceding and 1 preceding)"
    sums = sums.selectExpr(
        "conv_id AS conv", "part AS part_", f"coalesce(sum(turns) {before}, 0) AS turns", f"coalesce(sum(tokens) {before}, 0) AS tokens"
    )
    on = F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("part") == F.col("part_"))
    placed = rows.join(F.broadcast(sums), on, "left")
    return placed.select(
        "conv_id",
        (F.col("place") + F.coalesce("turns", F.lit(0))).alias("place"),
        (F.col("offset") + F.coalesce("tokens", F.lit(0))).alias("offset"),
        "ids", "loss_start", "loss_end",
    )


def loss_mask(n: int, start: int, end: int) -> np.ndarray:
    """Which of a turn's ids count for the loss."""
    marks = np.zeros(n + 1, np.int8)
    marks[start] += 1
    marks[end] -= 1
    return np.cumsum(marks[:n]).astype(bool)


def read_back(ids: np.ndarray, mask: np.ndarray, found) -> tuple[str, str, str, int]:
    """Role, text, text under the mask, and length of the written form of one turn."""
    text_at = int(np.flatnonzero(ids == TEXT)[0])
    role, text = (found.decode_bytes(x.tolist()).decode() for x in (ids[1:text_at], ids[text_at + 1 : -1]))
    covered = found.decode_bytes(ids[mask].tolist()).decode()
    return unescape(role), unescape(text), unescape(covered), len(role) + len(text) + sum(map(len, MARKS.values()))


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(formatted: DataFrame, path: str, pattern: str) -> DataFrame:
    """What each formatted conversation holds, read back from its ids and masks."""

    def emit(batches: Iterator[pa.RecordBatch]):
        found, conv, state = codec(path, pattern), None, None

        def row():
            turns, every, chars, loss, length = state
            return [conv, turns, every.hexdigest(), chars, loss.hexdigest(), length]

        def batch_of(rows):
            names = [c.split()[0] for c in DIGEST.split(", ")]
            kinds = [pa.string() if c.endswith("string") else pa.int64() for c in DIGEST.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "ids", "loss_start", "loss_end"))
            for own, ids, lo, hi in zip(*columns):
                if state is None or own != conv:
                    if state is not None:
                        done.append(row())
                    conv, state = own, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = np.array(ids)
                role, text, covered, length = read_back(ids, loss_mask(len(ids), lo, hi), found)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(covered)
                state[3].update(covered.encode())
                state[4] += length
            if done:
                yield batch_of(done)
        if state is not None:
            yield batch_of([row()])

    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return rows.select("conv_id", "ids", "loss_start", "loss_end").mapInArrow(emit, DIGEST)


EXTRA_CONV, EXTRA_TEXT = -7, "\\### Assistant: </turn> ok"


def op1_chat_formatting(spark, sf_dir):
    import public_tokenizers

    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(
        [(EXTRA_CONV, 0, "user", EXTRA_TEXT), (EXTRA_CONV, 1, "assistant", EXTRA_TEXT)], "conv_id long, turn long, role string, text string"
    )
    settings = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return digests(format_turns(turns.union(extra), *settings), *settings)


def _escaped_sql(column: str) -> str:
    return f"replace(replace(replace({column}, '\\', '\\\\'), '#', '\\#'), '</turn>', '\\</turn>')"


ORACLE = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {EXTRA_CONV}, 0, 'user', '{EXTRA_TEXT}' UNION ALL SELECT {EXTRA_CONV}, 1, 'assistant', '{EXTRA_TEXT}')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = '{LOSS_ROLE}'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role) FILTER (WHERE role = '{LOSS_ROLE}'), '')) AS loss_sha256,
       sum(length({_escaped_sql('role')}) + length({_escaped_sql('text')}) + {sum(map(len, MARKS.values()))})::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""
