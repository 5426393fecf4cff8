"""Repair of conversations by the cheapest edits, the least audit among equals.

A conversation's rows may be kept, given another role, deleted, or have turns put between them,
so that the role initials read ``(s?(ua)+)?``. Four states say what may come next; a layer of four nodes
stands before each row and after the last one. The costs to the end are a dynamic program from the
last layer back. The arcs that cost no more than the best form the graph that is
ranked: first by the letter of the best arc, then, by pairs of ranks, by audits of 2, 4, 8 … letters,
each round with pointers twice as long. The ranks choose the arc of each node, the doubled pointers give the
node at any place of the path.

Turns are sorted by range, so a conversation lies in one task or in a few that follow each other. Those that lie
within one are solved there, all of a batch at once. Those that may go on in another task, or have over
``SOLVE_ROWS`` rows in one, are solved by segments (conversation, part): each becomes a 4 x 4 matrix of costs, the matrices (a few
numbers per part) are multiplied from the back, the segments solved for each state they may be entered in,
the states followed from the front. Which rows repeat earlier ones is then a join on the text's hash. So one conversation of
any length is spread over the tasks; only its SHA-256 streams through one, from pieces that are joined before.

Null roles and texts are one space, as are null ids and turns in the damage's key; rows with a null ``conv_id`` are one
conversation. Rows are ordered by ``turn`` (null first), then by role and a hash of the text; equal rows are duplicates. An initial
is the role's first character as it is. Texts may have any length; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.trie import CRC_SQL
from stratalake.sources.staging import stage

# The blanks, the ends of a whole sentence, and what an edit costs.
BLANKS, ENDS = " \t\n\x0b\x0c\r", ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
LEGAL = {"su", "ua", "au"}
INITIALS = "sua"
# States: nothing yet, after a system turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
NEEDED = ("user", "user", "assistant", "user")
AFTER_NEEDED = (USER, USER, ASSISTANT, USER)
LETTERS = b"DIKR"
# How a row's text is: whole, truncated, repeated, blank. With the initial it makes a row's code.
WHOLE, CUT, REPEATED, BLANK = range(4)
OTHER = 3  # an initial that is none of INITIALS
SOLVE_ROWS = 4096
PIECE_CHARS = 1 << 20
FAR = 1 << 50


def last_costs() -> tuple[int, ...]:
    """Costs to the end of the four states after the last row."""
    return _inserted((0, FAR, FAR, 0))


def _inserted(b) -> tuple[int, ...]:
    """Costs of a layer, given those without inserting in it."""
    user, assistant = min(b[USER], INSERT + b[ASSISTANT]), min(b[ASSISTANT], INSERT + b[USER])
    return min(b[START], INSERT + user), min(b[SYSTEM], INSERT + user), user, assistant


def _before(code: int, c) -> tuple[int, ...]:
    """Costs of the layer before a row, given those of the layer after it."""
    kind, initial = divmod(code, 4)
    if kind >= REPEATED:
        return _inserted([DELETE + x for x in c])
    more = TRUNCATED if kind == CUT else 0
    to_user = more + c[USER] + (0 if initial == 1 else REROLE)
    to_assistant = more + c[ASSISTANT] + (0 if initial == 2 else REROLE)
    first = min(DELETE + c[START], to_user, more + c[SYSTEM] if initial == 0 else FAR)
    return _inserted((first, min(DELETE + c[SYSTEM], to_user), min(DELETE + c[USER], to_assistant), min(DELETE + c[ASSISTANT], to_user)))


def layer_costs(codes: bytes, after) -> list[tuple[int, ...]]:
    """Costs of every layer, the given one after the last row included."""
    layers = [tuple(after)]
    for code in reversed(codes):
        layers.append(_before(code, layers[-1]))
    return layers[::-1]


def transfer(codes: bytes) -> np.ndarray:
    """The 4 x 4 matrix of least costs from a state before the rows to a state in the layer after them."""
    return np.array([layer_costs(codes, [0 if s == t else FAR for s in range(4)])[0] for t in range(4)]).T


class Paths:
    """The least audits from any node of one or more conversations, laid out one after the other.

    ``ends`` says for each whether its last layer is the conversation's last one, where turns may still be inserted.
    """

    def __init__(self, codes: list[bytes], costs: list[list[tuple[int, ...]]], ends: list[bool]):
        self.first = np.cumsum([0, *(len(c) for c in costs)])
        cost = np.array([x for c in costs for x in c], np.int64)
        code = np.zeros(len(cost), np.int64)
        is_row = np.ones(len(cost), bool)
        is_row[self.first[1:] - 1] = False
        code[is_row] = np.frombuffer(b"".join(codes), np.uint8)
        may_insert = is_row.copy()
        may_insert[self.first[1:] - 1] = ends
        self._arcs(cost, code, is_row, may_insert)
        self._rank()

    def _arcs(self, cost, code, is_row, may_insert) -> None:
        """Per node and letter the target of the arc, or -1 if there is none among the cheapest."""
        n = len(cost)
        after = np.vstack([cost[1:], cost[-1:]])
        kind, initial = code >> 2, code & 3
        edits = is_row & (kind < REPEATED)
        more = np.where(kind == CUT, TRUNCATED, 0)
        self.target = np.full((n, 4, 4), -1, np.int64)
        here = 4 * np.arange(n)
        for s in range(4):
            to = AFTER_NEEDED[s]
            keeps_to = np.full(n, -1)
            if s in (START, SYSTEM, ASSISTANT):
                keeps_to[initial == 1] = USER
            if s == START:
                keeps_to[initial == 0] = SYSTEM
            if s == USER:
                keeps_to[initial == 2] = ASSISTANT
            keep_cost = more + np.take_along_axis(after, np.maximum(keeps_to, 0)[:, None], 1)[:, 0]
            arcs = (
                (is_row, DELETE + after[:, s], here + 4 + s),
                (may_insert, INSERT + cost[:, to], here + to),
                (edits & (keeps_to >= 0), keep_cost, here + 4 + keeps_to),
                (edits, more + REROLE + after[:, to], here + 4 + to),
            )
            for letter, (there, price, target) in enumerate(arcs):
                self.target[:, s, letter] = np.where(there & (cost[:, s] == price), target, -1)
        self.target = self.target.reshape(-1, 4)

    def _rank(self) -> None:
        """Ranks by audits of 1, 2, 4 … letters, pointers as long; then the arc of each node by letter and rank of what follows."""
        nodes = np.arange(len(self.target))
        there = self.target >= 0
        ends = ~there.any(1)
        best = there.argmax(1)  # letters are in ASCII order
        pointer = np.where(ends, nodes, self.target[nodes, best])
        rank, steps = np.where(ends, 0, best + 1), (~ends).astype(np.int64)
        self.jumps = [pointer]
        while True:
            _, rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)
            steps = steps + steps[pointer]
            longer = pointer[pointer]
            if (longer == pointer).all():
                break
            pointer = longer
            self.jumps.append(pointer)
        follow = np.where(there, rank[np.maximum(self.target, 0)], 0)
        by = np.where(there, np.arange(4) * (rank.max() + 1) + follow, np.iinfo(np.int64).max)
        self.letter, self.steps, self.last = by.argmin(1), steps, pointer

    def walk(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nodes on the paths from ``starts``, one path after the other, and where each path begins."""
        length = self.steps[starts]
        begin = np.cumsum(np.r_[0, length])
        at = np.arange(begin[-1]) - np.repeat(begin[:-1], length)
        node = np.repeat(starts, length)
        for k, jump in enumerate(self.jumps):
            node = np.where((at >> k) & 1 == 1, jump[node], node)
        return node, begin

    def audits(self, starts: np.ndarray) -> list[bytes]:
        node, begin = self.walk(starts)
        letters = np.frombuffer(LETTERS, np.uint8)[self.letter[node]].tobytes()
        return [letters[lo:hi] for lo, hi in zip(begin, begin[1:])]


class Editor:
    """Applies an audit to the rows it was made for, as they come."""

    def __init__(self, audit: bytes, state: int):
        self.audit, self.state, self.at = audit, state, 0

    def inserts(self) -> Iterator[str]:
        """Turns to put in before the next row, or after the last one."""
        while self.audit[self.at : self.at + 1] == b"I":
            yield f"{NEEDED[self.state]}:"
            self.state, self.at = AFTER_NEEDED[self.state], self.at + 1

    def lines(self, role: str, text: str) -> Iterator[str]:
        yield from self.inserts()
        letter, self.at = self.audit[self.at : self.at + 1], self.at + 1
        if letter == b"R":
            yield f"{NEEDED[self.state]}:{text}"
            self.state = AFTER_NEEDED[self.state]
        elif letter == b"K":
            yield f"{role}:{text}"
            self.state = (SYSTEM, USER, ASSISTANT)[INITIALS.index(role[0])]


def damaged(conversations: DataFrame) -> DataFrame:
    """``(key, turn, role, text, gone)``: the rows after damage, and those it drops marked ``gone``.

    ``key`` is the id as text, one space for null.
    """
    blank = F.lit(" ")
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), blank).alias("key"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
    )
    name = F.concat("key", F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = rows.withColumn("hit", F.crc32(F.encode(name, "UTF-8")) % 20)
    hit = F.col("hit")
    text = F.when(hit.isin(0, 1), "").when(hit == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return rows.select("key", "turn", F.when(hit == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (hit == 0).alias("gone"), copies).drop("copy")


def _marked(rows: DataFrame) -> DataFrame:
    """With ``initial`` and ``kind`` (whole, truncated or blank) of each row, and two hashes of its text."""
    ink = F.rtrim("text", F.lit(BLANKS))
    start = F.substring("role", 1, 1)
    initial = F.when(start == "s", 0).when(start == "u", 1).when(start == "a", 2).otherwise(OTHER)
    kind = F.when(ink == "", BLANK).when(F.right(ink, F.lit(1)).isin(*ENDS), WHOLE).otherwise(CUT)
    return rows.select(
        "*", initial.alias("initial"), kind.alias("kind"),
        F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"),
    )


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
OPEN = "part int, pos long, turn long, role string, text string, gone boolean, initial int, kind int, h1 long, h2 long"
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]
_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}


def _fields(schema: str) -> list[tuple[str, pa.DataType]]:
    return [(c.split()[0], _ARROW[c.split()[1]]) for c in schema.split(", ")]


def _batch(rows: list, fields) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)], [n for n, _ in fields])


def _solved(convs: list[tuple[str, list]]) -> list:
    """``[key, *RESULT]`` of conversations given with all their rows ``(turn, role, text, initial, kind)``."""
    codes, costs, counts, texts = [], [], [], []
    for _, rows in convs:
        seen, kinds = set(), []
        for _, role, text, _, kind in rows:
            if kind != BLANK and (role, text) in seen:
                kind = REPEATED
            seen.add((role, text))
            kinds.append(kind)
        turns = {r[0] for r in rows if r[0] is not None}
        pairs = zip(rows, rows[1:])
        illegal = sum(a[1][:1] + b[1][:1] not in LEGAL for a, b in pairs)
        counts.append([max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(kinds.count(k) for k in (BLANK, REPEATED, CUT)), illegal])
        codes.append(bytes(4 * kind + r[3] for kind, r in zip(kinds, rows)))
        costs.append(layer_costs(codes[-1], last_costs()))
        texts.append(rows)
    if not convs:
        return []
    paths = Paths(codes, costs, [True] * len(convs))
    out = []
    for (key, rows), count, cost, audit in zip(convs, counts, costs, paths.audits(4 * paths.first[:-1] + START)):
        editor = Editor(audit, START)
        lines = [line for _, role, text, _, _ in rows for line in editor.lines(role, text)] + list(editor.inserts())
        out.append([key, *count, cost[0][START], audit.decode(), hashlib.sha256("\n".join(lines).encode()).hexdigest()])
    return out


def repair(rows: DataFrame) -> DataFrame:
    """``key`` and the columns of ``RESULT`` for each conversation of rows such as :func:`damaged` gives."""
    order = ["key", "turn", "role", "h1", "row"]
    result, opened = _fields(RESULT), _fields(OPEN)
    width, both = len(result), [("key", pa.string()), *_fields(RESULT), *_fields(OPEN)]

    def solve(batches: Iterator[pa.RecordBatch]):
        part, pos, state = TaskContext.get().partitionId(), 0, {"first": True, "key": None, "rows": []}

        def open_row(row):
            return [state["key"], *[None] * width, part, *row]

        def emit(convs, loose):
            # rows that are gone count for nothing, but their conversation is reported
            done = _solved([(key, [(r[1], r[2], r[3], r[5], r[6]) for r in own if not r[4]]) for key, own in convs])
            rows = [[*r, *[None] * len(opened)] for r in done] + loose
            if rows:
                yield _batch(rows, both)

        for batch in batches:
            convs, loose = [], []
            for key, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if key != state["key"]:
                    if state["key"] is not None and not state["first"]:
                        convs.append((state["key"], state["rows"]))
                    # the part's first conversation may have begun before, so it is left open
                    state = {"first": state["key"] is None, "key": key, "rows": []}
                row = [pos, *row]
                pos += 1
                if state["first"]:
                    loose.append(open_row(row))
                    continue
                state["rows"].append(row)
                if len(state["rows"]) > SOLVE_ROWS:
                    loose += map(open_row, state["rows"])
                    state = {"first": True, "key": key, "rows": []}
            yield from emit(convs, loose)
        yield from emit([], [open_row(row) for row in state["rows"]])  # the last one may go on

    rows = _marked(rows).withColumn("row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select("key", "turn", "role", "text", "gone", "initial", "kind", "h1", "h2")
    found = stage(rows.mapInArrow(solve, f"key string, {RESULT}, {OPEN}"), "repaired")
    names = [n for n, _ in result]
    closed = found.where("part is null").select("key", *names)
    loose = found.where("part is not null").select("key", *[n for n, _ in opened])
    return closed.union(_by_segments(loose).select("key", *names))


SEGMENT = "key string, part int, rows long, codes binary, costs binary, low long, high long, turns long, begin string, end string, blank long, duplicate long, truncated long, illegal long"


def _by_segments(loose: DataFrame) -> DataFrame:
    """:func:`repair` of conversations given as rows of ``OPEN`` in several parts."""
    place = F.struct("part", "pos")
    own = loose.where("not gone")
    first = own.where(F.col("kind") != BLANK).groupBy("key", "role", "h1", "h2").agg(F.min(place).alias("at"))
    # written, so that Spark can split the join at a text that very many rows hold
    first = stage(first, "first-rows")
    slim = loose.select("key", "part", "pos", "turn", "role", "gone", "initial", "kind", "h1", "h2")
    marked = slim.join(first, ["key", "role", "h1", "h2"], "left")
    again = (F.col("kind") != BLANK) & ~F.col("gone") & (F.col("at") < place)
    marked = marked.withColumn("kind", F.when(F.coalesce(again, F.lit(False)), REPEATED).otherwise(F.col("kind")))
    marked = marked.withColumn("start", F.substring("role", 1, 1))
    segments = marked.repartition("key", "part").sortWithinPartitions("key", "part", "pos")
    segments = segments.select("key", "part", "turn", "start", "gone", "initial", "kind").mapInArrow(_segments, SEGMENT)
    segments = stage(segments, "segments")

    # At most two conversations of a part go on in another one, or have many rows in it: these rows are bounded by the parts.
    frame = segments.drop("codes")
    ahead = frame.groupBy("key").applyInPandas(_from_the_back, "key string, part int, after binary, last boolean")
    counts = frame.groupBy("key").applyInPandas(_counted, "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long")
    solved = segments.select("key", "part", "codes").join(ahead, ["key", "part"])
    solved = stage(solved.mapInArrow(_entered, "key string, part int, exits binary, audits binary"), "entered")
    entry = solved.select("key", "part", "exits").groupBy("key").applyInPandas(_from_the_front, "key string, part int, entry int")
    audits = solved.drop("exits").join(entry, ["key", "part"])
    texts = own.select("key", "part", "pos", "role", "text")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("audits", "binary"), ("entry", "int"))]
    both = texts.select("*", *none).unionByName(
        audits.select("key", "part", F.lit(-1).cast("long").alias("pos"), *[F.lit(None).cast("string").alias(c) for c in ("role", "text")], "audits", "entry")
    )
    both = both.repartition("key", "part").sortWithinPartitions("key", "part", "pos")
    pieces = both.select("key", "part", "role", "text", "audits", "entry").mapInArrow(_edited, "key string, part int, seq int, lines string, audit string")
    pieces = pieces.repartition("key").sortWithinPartitions("key", "part", "seq")
    return counts.join(pieces.select("key", "lines", "audit").mapInArrow(_hashed, "key string, audit string, repaired_sha256 string"), "key")


def _runs(batches: Iterator[pa.RecordBatch], width: int):
    """Rows of the batches, with True before the first row of each value of the first ``width`` columns."""
    held = object()
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            yield row[:width] != held, row
            held = row[:width]


def _segments(batches: Iterator[pa.RecordBatch]):
    fields = _fields(SEGMENT)
    state = None

    def finished():
        codes = bytes(state["codes"])
        turns = state["turns"]
        own = [len(codes), codes, transfer(codes).astype(np.int64).tobytes(), min(turns, default=0), max(turns, default=0), len(turns)]
        return _batch([[*state["name"], *own, state["begin"], state["start"], *(state["kinds"][k] for k in (BLANK, REPEATED, CUT)), state["illegal"]]], fields)

    for new, (key, part, turn, start, gone, initial, kind) in _runs(batches, 2):
        if new:
            if state:
                yield finished()
            state = {"name": (key, part), "codes": bytearray(), "turns": set(), "begin": None, "start": None, "kinds": [0] * 4, "illegal": 0}
        if gone:
            continue
        state["codes"].append(4 * kind + initial)
        state["kinds"][kind] += 1
        if turn is not None:
            state["turns"].add(turn)
        if state["start"] is None:
            state["begin"] = start
        else:
            state["illegal"] += state["start"] + start not in LEGAL
        state["start"] = start
    if state:
        yield finished()


def _matrix(value: bytes) -> np.ndarray:
    return np.frombuffer(value, np.int64).reshape(4, 4)


def _from_the_back(pdf: pd.DataFrame) -> pd.DataFrame:
    """The costs of the layer after each segment."""
    after, out = np.array(last_costs()), []
    pdf = pdf.sort_values("part", ascending=False)
    for key, part, costs in zip(pdf["key"], pdf["part"], pdf["costs"]):
        out.append((key, part, after.astype(np.int64).tobytes(), not out))
        after = np.minimum((_matrix(costs) + after).min(1), FAR)
    return pd.DataFrame(out, columns=["key", "part", "after", "last"])


def _counted(pdf: pd.DataFrame) -> pd.DataFrame:
    """The counts of a conversation, and its cost, from those of its segments."""
    pdf = pdf.sort_values("part")
    held, high, low, turns, illegal, after = None, None, None, 0, int(pdf["illegal"].sum()), np.array([0, FAR, FAR, FAR])
    for row in pdf.itertuples():
        if row.rows:
            illegal += held is not None and held + row.begin not in LEGAL
            held = row.end
        if row.turns:
            # turns are in order, so only the last one before can come again
            turns += row.turns - (high is not None and int(row.low) == high)
            low, high = int(row.low) if low is None else low, int(row.high)
        after = np.minimum((after[:, None] + _matrix(row.costs)).min(0), FAR)
    gaps = high - low + 1 - turns if turns else 0
    kinds = [int(pdf[c].sum()) for c in ("blank", "duplicate", "truncated")]
    cost = int((after + np.array(last_costs())).min())
    return pd.DataFrame([(pdf["key"].iloc[0], gaps, *kinds, illegal, cost)], columns=["key", *COUNTS, "cost"])


def _entered(batches: Iterator[pa.RecordBatch]):
    """For each state a segment may be entered in, the state it is left in and the audit, four to a row."""
    fields = _fields("key string, part int, exits binary, audits binary")
    for batch in batches:
        rows = []
        for key, part, codes, after, last in zip(*(batch.column(c).to_pylist() for c in ("key", "part", "codes", "after", "last"))):
            costs = layer_costs(codes, np.frombuffer(after, np.int64).tolist())
            paths = Paths([codes], [costs], [last])
            rows.append([key, part, (paths.last[:4] % 4).astype(np.uint8).tobytes(), b",".join(paths.audits(np.arange(4)))])
        if rows:
            yield _batch(rows, fields)


def _from_the_front(pdf: pd.DataFrame) -> pd.DataFrame:
    """The state in which each segment is entered."""
    state, out = START, []
    pdf = pdf.sort_values("part")
    for key, part, exits in zip(pdf["key"], pdf["part"], pdf["exits"]):
        out.append((key, part, state))
        state = exits[state]
    return pd.DataFrame(out, columns=["key", "part", "entry"])


def _edited(batches: Iterator[pa.RecordBatch]):
    """Repaired lines of each segment, joined to pieces; the first piece carries the audit."""
    fields = _fields("key string, part int, seq int, lines string, audit string")
    name, editor, seq, lines, audit, size = None, None, 0, [], "", 0

    def piece():
        return _batch([[*name, seq, "\n".join(lines) if lines else None, audit]], fields)

    for new, (key, part, role, text, audits, entry) in _runs(batches, 2):
        if new:
            if name:
                lines += editor.inserts()
                yield piece()
            own = audits.split(b",")[entry]
            name, editor, seq, lines, audit, size = (key, part), Editor(own, entry), 0, [], own.decode(), 0
            continue
        fresh = list(editor.lines(role, text))
        lines += fresh
        size += sum(map(len, fresh))
        if size > PIECE_CHARS:
            yield piece()
            seq, lines, audit, size = seq + 1, [], "", 0
    if name:
        lines += editor.inserts()
        yield piece()


def _hashed(batches: Iterator[pa.RecordBatch]):
    fields = _fields("key string, audit string, repaired_sha256 string")
    name, digest, audit, begun = None, None, [], False
    for new, (key, lines, letters) in _runs(batches, 1):
        if new:
            if name is not None:
                yield _batch([[name, "".join(audit), digest.hexdigest()]], fields)
            name, digest, audit, begun = key, hashlib.sha256(), [], False
        audit.append(letters)
        if lines is not None:
            digest.update((b"\n" if begun else b"") + lines.encode())
            begun = True
    if name is not None:
        yield _batch([[name, "".join(audit), digest.hexdigest()]], fields)


def op11_conversation_repair(spark, sf_dir):
    rows = damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    repaired = repair(rows)
    conv_id = F.when(F.col("key") != " ", F.col("key")).cast("long").alias("conv_id")
    return repaired.select(conv_id, *[n for n, _ in _fields(RESULT)])


def _edit_sql(letter: str, cost: str, line: str, after: str) -> str:
    return f"struct_pack(c := {after}.c + {cost}, a := '{letter}' || {after}.a, l := {line} || {after}.l)"


def _least_sql(*choices: str) -> str:
    return f"list_min([{', '.join(choices)}])"


def _layer_sql() -> tuple[str, str, str]:
    """The choices of a row in each state, then inserting: first after user and assistant, then before both."""
    far, own = "struct_pack(c := 1000000000::BIGINT, a := '', l := '')", "role || ':' || text || chr(10)"
    row = []
    for state, keeps in enumerate((("s", SYSTEM), ("", 0), ("", 0), ("", 0))):
        to, need = AFTER_NEEDED[state], NEEDED[state]
        choices = [_edit_sql("D", str(DELETE), "''", f"s{state}")]
        arcs = [_edit_sql("K", "more", own, f"s{to}"), _edit_sql("R", f"more + {REROLE}", f"'{need}:' || text || chr(10)", f"s{to}")]
        choices += [f"CASE WHEN may AND ini = '{need[0]}' THEN {arcs[0]} ELSE {far} END", f"CASE WHEN may THEN {arcs[1]} ELSE {far} END"]
        if keeps[0]:
            choices.append(f"CASE WHEN may AND ini = 's' THEN {_edit_sql('K', 'more', own, f's{SYSTEM}')} ELSE {far} END")
        row.append(f"{_least_sql(*choices)} AS b{state}")
    insert = [_edit_sql("I", str(INSERT), f"'{need}:' || chr(10)", x) for need, x in (("user", "u2"), ("assistant", "b3"), ("user", "b2"))]
    inner = f"b0, b1, {_least_sql('b2', insert[1])} AS u2, {_least_sql('b3', insert[2])} AS u3"
    outer = f"{_least_sql('b0', insert[0])} AS s0, {_least_sql('b1', insert[0])} AS s1, u2 AS s2, u3 AS s3"
    return ", ".join(row), inner, outer


_ROW, _INNER, _OUTER = _layer_sql()
_BLANKS_SQL = " || ".join(f"chr({ord(c)})" for c in BLANKS)
ORACLE = f"""
WITH RECURSIVE raw AS (
  SELECT coalesce(conv_id::VARCHAR, ' ') AS key, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM conversations),
hit AS (SELECT *, {CRC_SQL.format(text="(key || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS m FROM raw),
damaged AS (
  SELECT key, turn, CASE m WHEN 4 THEN 'user' ELSE role END AS role,
         CASE m WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE m WHEN 0 THEN []::INTEGER[] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM hit),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         rtrim(text, {_BLANKS_SQL}) AS ink, left(role, 1) AS ini FROM damaged),
rows AS (
  SELECT *, CASE WHEN ink = '' THEN 'b' WHEN row_number() OVER (PARTITION BY key, role, text ORDER BY i) > 1 THEN 'd'
                 WHEN right(ink, 1) IN ('.', '!', '?') THEN 'w' ELSE 't' END AS kind,
         ini || lead(ini) OVER (PARTITION BY key ORDER BY i) AS pair FROM placed),
counts AS (
  SELECT key, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE kind = 'b') AS blank,
         count(*) FILTER (WHERE kind = 'd') AS duplicate, count(*) FILTER (WHERE kind = 't') AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY key),
layers AS (
  SELECT key, n AS i, struct_pack(c := 0::BIGINT, a := '', l := '') AS s0, struct_pack(c := 4::BIGINT, a := 'II', l := 'user:' || chr(10) || 'assistant:' || chr(10)) AS s1,
         struct_pack(c := 2::BIGINT, a := 'I', l := 'assistant:' || chr(10)) AS s2, struct_pack(c := 0::BIGINT, a := '', l := '') AS s3 FROM counts
  UNION ALL
  SELECT key, i, {_OUTER} FROM (SELECT key, i, {_INNER} FROM (SELECT key, i, {_ROW} FROM (
    SELECT l.key, l.i - 1 AS i, s0, s1, s2, s3, role, text, ini, kind IN ('w', 't') AS may, (kind = 't')::INTEGER AS more
    FROM layers l JOIN rows r ON r.key = l.key AND r.i = l.i)))),
keys AS (SELECT DISTINCT key FROM raw)
SELECT nullif(key, ' ')::BIGINT AS conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(s0.c, 0) AS cost, coalesce(s0.a, '') AS audit,
       sha256(CASE WHEN coalesce(s0.l, '') = '' THEN '' ELSE left(s0.l, length(s0.l) - 1) END) AS repaired_sha256
FROM keys LEFT JOIN counts USING (key) LEFT JOIN (SELECT key, s0 FROM layers WHERE i = 0) USING (key)
"""
