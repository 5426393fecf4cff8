"""The prefix trie of conversations, and what each of its subtrees holds.

**Nodes.** A sequence of turns is known by two 64-bit polynomial sums over the hashes of
its turns, so a turn's node and its parent's come from prefix sums: taken within each
range of the sorted turns, carried over the few conversations that go on in another range, and
moved to the place that a shared head gives them. No conversation has to fit one
task, however long. Rows are added up per node before the shuffle, so a first turn that all
conversations share is one row per task.

**Subtree sums** come from parallel tree contraction. Each round rakes the leaves
(their totals are added to their parents) and compresses chains of nodes with one
child left (each takes over its child's child and weight, so its pointer doubles). A chain node is
expanded again once the node it points to has a total. Rounds grow with the
logarithm of the tree's size, also for one long chain; each is a written table. Which child a
node has left is the exclusive or of its children's ids less those done, so no list of children is kept.

**Ends.** The ids of the conversations that end at a node are hashed in order: joined to
pieces of ``PIECE_IDS`` where they lie, and the pieces streamed through SHA-256.

Null roles and texts are empty. Turns are ordered by ``turn`` (null first), then role and a hash of the text; a row
given twice is two turns. Rows with a null ``conv_id`` belong to no conversation and are left out. Other columns
are ignored. Without conversations there is no root, and no rows. Texts may have any length: they are hashed and counted where
they are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.arrays import BASE_A, BASE_B
from stratalake.llm.settle import settled
from stratalake.sources.staging import stage

U64 = np.uint64
BASES = (BASE_A, BASE_B)
GROUP, SHARED = 100, 6
MOST_SHARED = SHARED - 1
PIECE_IDS = 1 << 14
EMPTY_SHA = hashlib.sha256().hexdigest()


def power(base: int, exponents: np.ndarray) -> np.ndarray:
    """``base ** exponents`` modulo 2**64; negative ones by the inverse (the base is odd)."""
    out = np.ones(len(exponents), U64)
    for sign, root in ((1, base), (-1, pow(base, -1, 2**64))):
        left, step = np.maximum(exponents * sign, 0), U64(root % 2**64)
        while left.any():
            out = np.where(left & 1 == 1, out * step, out)
            left, step = left >> 1, U64(int(step) * int(step) % 2**64)
    return out


def _u64(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(U64)


def _longs(names: Sequence[str], columns: Sequence) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(c).astype(U64, copy=False).view(np.int64)) for c in columns], list(names))


NUMBERED = ["conv_id", "part", "i", "k1", "k2", "s1", "s2", "chars"]


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, pos, k1, k2, g1, g2, chars)``: each turn's place, hash, prefix sum with itself, and code points.

    ``g`` is the sum of ``k * base ** pos`` over the conversation's turns so far, modulo 2**64.
    """
    rows = turns.where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = rows.select(
        "conv_id", "turn", "role", F.xxhash64("role", "text").alias("k1"), F.xxhash64(F.lit(1), "role", "text").alias("k2"),
        F.length("text").cast("long").alias("chars"), F.monotonically_increasing_id().alias("row"),
    )
    # rows that are the same in all that orders them are dealt apart by ``row``; which comes first does not matter
    order = ["conv_id", "turn", "role", "k1", "row"]

    def number(batches: Iterator[pa.RecordBatch]):
        part, conv, i, sums = TaskContext.get().partitionId(), None, 0, [U64(0), U64(0)]
        for batch in batches:
            own = batch.column("conv_id").to_numpy()
            n = len(own)
            if not n:
                continue
            head = np.flatnonzero(np.r_[conv is None or own[0] != conv, own[1:] != own[:-1]])
            if not len(head) or head[0] != 0:
                head = np.r_[0, head]
                first, before = i, sums
            else:
                first, before = 0, [U64(0), U64(0)]
            run = np.repeat(np.arange(len(head)), np.diff(np.r_[head, n]))
            at = np.arange(n) - head[run]
            at[run == 0] += first
            out = []
            for lane, base in enumerate(BASES):
                total = np.cumsum(_u64(batch.column(f"k{lane + 1}")) * power(base, at), dtype=U64)
                less = np.r_[U64(0), total][head]
                less[0] -= before[lane]
                out.append(total - less[run])
            conv, i, sums = own[-1], int(at[-1]) + 1, [out[0][-1], out[1][-1]]
            yield _longs(NUMBERED, [own, np.full(n, part), at, *(_u64(batch.column(k)) for k in ("k1", "k2")), *out, batch.column("chars").to_numpy()])

    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "k1", "k2", "chars")
    rows = stage(rows.mapInArrow(number, ", ".join(f"{c} long" for c in NUMBERED)), "numbered-turns")

    # At most two conversations of a part go on in another one, so these rows are bounded by the parts.
    sums = rows.groupBy("conv_id", "part").agg(F.max(F.struct("i", "s1", "s2")).alias("last"))
    sums = sums.withColumn("parts", F.expr("count(1) over (partition by conv_id)")).where("parts > 1")

    def carry(pdf):
        pdf = pdf.sort_values("part")
        at, g = 0, [0, 0]
        out = []
        for part, last in zip(pdf["part"], pdf["last"]):
            out.append((pdf["conv_id"].iloc[0], part, at, *(x - 2**64 if x >= 2**63 else x for x in g)))
            for lane, base in enumerate(BASES):
                g[lane] = (g[lane] + pow(base, at, 2**64) * int(last[f"s{lane + 1}"])) % 2**64
            at += last["i"] + 1
        import pandas as pd

        return pd.DataFrame(out, columns=["conv", "part_", "o", "b1", "b2"])

    carried = sums.select("conv_id", "part", "last").groupBy("conv_id").applyInPandas(carry, "conv long, part_ long, o long, b1 long, b2 long")
    placed = rows.join(F.broadcast(carried), (F.col("conv_id") == F.col("conv")) & (F.col("part") == F.col("part_")), "left")
    placed = placed.na.fill(0, ["o", "b1", "b2"])
    names = ["conv_id", "pos", "k1", "k2", "g1", "g2", "chars"]

    def move(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            col = {c: _u64(batch.column(c)) for c in batch.schema.names}
            o = col["o"].view(np.int64)
            sums = [col[f"b{lane + 1}"] + power(base, o) * col[f"s{lane + 1}"] for lane, base in enumerate(BASES)]
            yield _longs(names, [col["conv_id"], col["i"] + col["o"], col["k1"], col["k2"], *sums, col["chars"]])

    return placed.drop("conv", "part", "part_").mapInArrow(move, ", ".join(f"{c} long" for c in names))


NODE_ROW = ["id1", "id2", "p1", "p2", "depth", "conv_id", "chars", "ends"]
HEAD = ["conv_id", "h", "b", "n", "e1", "e2", "f1", "f2"]


def shared_heads(numbered: DataFrame, group: int = GROUP, shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """Each conversation rebuilt on the head of another: ``(heads, rows)``.

    The first ``h`` turns come from conversation ``conv_id - conv_id % group``, the rest are its own after
    its first ``h``; ``h`` is CRC-32 of the id modulo ``shared``. ``rows`` are the nodes of root and heads, a row for each conversation.
    ``heads`` has for each conversation what its later turns need: the sum ``e`` of its head, its length ``b``, and the sum ``f`` of the own turns left out.
    """
    most = shared - 1
    convs = numbered.groupBy("conv_id").agg(
        (F.max("pos") + 1).alias("n"),
        F.sort_array(F.collect_list(F.when(F.col("pos") < most, F.struct("pos", "k1", "k2", "g1", "g2", "chars")))).alias("first"),
    )
    convs = stage(convs, "conversations")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared
    bases = convs.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.col("first").alias("given"))
    convs = convs.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % group}).join(bases, "base", "left")

    def build(batches: Iterator[pa.RecordBatch]):
        powers = [[pow(base, j, 2**64) for j in range(most)] for base in BASES]
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "n", "h", "first", "given"))
            for conv, n, own_from, own, given in zip(*columns):
                given = (given or [])[:own_from]
                length = len(given) + max(n - own_from, 0)
                sums = [0, 0]
                out.append((0, 0, 0, 0, 0, conv, 0, int(length == 0), 0, 0, 0, 0))
                for j, turn in enumerate(given):
                    parent = list(sums)
                    for lane in (0, 1):
                        sums[lane] = (sums[lane] + turn[f"k{lane + 1}"] * powers[lane][j]) % 2**64
                    out.append((*sums, *parent, j + 1, conv, turn["chars"], int(length == j + 1), 0, 0, 0, 0))
                skipped = own[own_from - 1] if 0 < own_from <= len(own) else None
                before = [skipped["g1"], skipped["g2"]] if skipped else [0, 0]
                # a row of the other kind: the head itself
                out.append((*sums, *(x % 2**64 for x in before), -1 % 2**64, conv, 0, 0, own_from, len(given), n, 1))
            yield _longs([*NODE_ROW, "h", "b", "n", "head"], [np.array(c, dtype=object).astype(U64) for c in zip(*((x % 2**64 for x in r) for r in out))])

    both = convs.select("conv_id", "n", "h", "first", "given").mapInArrow(build, ", ".join(f"{c} long" for c in [*NODE_ROW, "h", "b", "n", "head"]))
    both = stage(both, "heads")
    heads = both.where("head = 1").select("conv_id", "h", "b", "n", *(F.col(c).alias(a) for c, a in zip(("id1", "id2", "p1", "p2"), ("e1", "e2", "f1", "f2"))))
    return heads, both.where("head = 0").select(*NODE_ROW)


def _own_rows(numbered: DataFrame, heads: DataFrame) -> DataFrame:
    """The node rows of the turns after the heads."""
    rows = numbered.join(heads, "conv_id").where("pos >= h")

    def place(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            col = {c: _u64(batch.column(c)) for c in batch.schema.names}
            b, h, pos, n = (col[c].view(np.int64) for c in ("b", "h", "pos", "n"))
            ids, parents = [], []
            for lane, base in ((1, BASES[0]), (2, BASES[1])):
                moved = power(base, b - h)
                term = col[f"k{lane}"] * power(base, pos)
                ids.append(col[f"e{lane}"] + moved * (col[f"g{lane}"] - col[f"f{lane}"]))
                parents.append(ids[-1] - moved * term)
            yield _longs(NODE_ROW, [*ids, *parents, b + pos - h + 1, col["conv_id"], col["chars"], (pos == n - 1).astype(np.int64)])

    return rows.mapInArrow(place, ", ".join(f"{c} long" for c in NODE_ROW))


# -- subtree sums --------------------------------------------------------


def with_children(tree: DataFrame) -> DataFrame:
    """``tree`` with ``kids``, the number of a node's children, and ``n1, n2``, the exclusive or of their ids; as a written table."""
    kids = tree.where("p1 is not null").groupBy("p1", "p2").agg(
        F.count(F.lit(1)).alias("kids"), F.expr("bit_xor(id1)").alias("n1"), F.expr("bit_xor(id2)").alias("n2")
    )
    kids = kids.withColumnsRenamed({"p1": "id1", "p2": "id2"})
    return stage(tree.join(kids, ["id1", "id2"], "left").na.fill(0, ["kids"]), "tree")


def subtree_sums(tree: DataFrame, values: Sequence[str]) -> DataFrame:
    """``(id1, id2, *values)`` with each value summed over the subtree of the node, itself included.

    ``tree`` has ``id1, id2``, the parent's ``p1, p2`` (null for a root), and what :func:`with_children` adds; it is read a few
    times. Any number of roots.
    """
    values = list(values)
    nodes = tree.select("id1", "id2", "p1", "p2", "kids", "n1", "n2", *values)
    keep = ["id1", "id2", "p1", "p2", *values]
    raked = nodes.where("kids = 0").select(*keep)
    chains = nodes.where("kids = 1").drop("kids")
    rest = nodes.where("kids > 1")
    done = [raked]
    while not raked.isEmpty():
        totals = raked.selectExpr("id1 as n1", "id2 as n2", "true as hit", *[f"{v} as t_{v}" for v in values])
        # expand: a chain node that points to a node with a total
        joined = chains.join(totals, ["n1", "n2"], "left")
        added = [(F.col(v) + F.coalesce(f"t_{v}", F.lit(0))).alias(v) for v in values]
        joined = stage(joined.select("id1", "id2", "p1", "p2", "n1", "n2", F.col("hit").isNotNull().alias("hit"), *added), "expanded")
        expanded, chains = joined.where("hit").select(*keep), joined.where("not hit").drop("hit")
        # rake: totals go to parents that have other children left
        credit = raked.where("p1 is not null").groupBy("p1", "p2").agg(
            F.count(F.lit(1)).alias("c"), F.expr("bit_xor(id1)").alias("x1"), F.expr("bit_xor(id2)").alias("x2"),
            *[F.sum(v).alias(f"t_{v}") for v in values],
        )
        credit = credit.withColumnsRenamed({"p1": "id1", "p2": "id2"})
        rest = rest.join(credit, ["id1", "id2"], "left").selectExpr(
            "id1", "id2", "p1", "p2", "kids - coalesce(c, 0) as kids", "n1 ^ coalesce(x1, 0) as n1", "n2 ^ coalesce(x2, 0) as n2",
            *[f"{v} + coalesce(t_{v}, 0) as {v}" for v in values],
        )
        rest = stage(rest, "branching")
        chains = chains.select(*rest.drop("kids").columns).union(rest.where("kids = 1").drop("kids"))
        leaves, rest = rest.where("kids = 0").select(*keep), rest.where("kids > 1")
        # compress: a chain node takes over the pointer and the weight of the chain node it points to
        then = chains.selectExpr("id1 as n1", "id2 as n2", "n1 as m1", "n2 as m2", *[f"{v} as t_{v}" for v in values])
        chains = chains.join(then, ["n1", "n2"], "left").selectExpr(
            "id1", "id2", "p1", "p2", "if(m1 is null, n1, m1) as n1", "if(m1 is null, n2, m2) as n2",
            *[f"{v} + coalesce(t_{v}, 0) as {v}" for v in values],
        )
        chains = stage(chains, "chains")
        raked = expanded.union(leaves)
        done.append(raked)
    out = done[0]
    for frame in done[1:]:
        out = out.union(frame)
    return out.select("id1", "id2", *values)


# -- ends ----------------------------------------------------------------


def end_digests(ends: DataFrame) -> DataFrame:
    """``(id1, id2, sha)``: SHA-256 of each node's ``conv_id`` in numeric order, comma-joined."""
    order = ["id1", "id2", "conv_id"]
    kinds = [("id1", pa.int64()), ("id2", pa.int64()), ("first", pa.int64()), ("ids", pa.string())]

    def pieces(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            a, b, conv = (batch.column(c).to_numpy() for c in order)
            cut = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, np.int64)
            texts = [",".join(map(str, conv[lo:hi])) for lo, hi in zip(cut, np.r_[cut[1:], len(a)])]
            columns = [a[cut], b[cut], conv[cut], texts]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds)], [n for n, _ in kinds])

    def stream(batches: Iterator[pa.RecordBatch]):
        node, state = None, None
        for batch in batches:
            done = []
            for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("id1", "id2", "ids"))):
                if (a, b) != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = (a, b), hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            yield from _digest_rows(done)
        if node is not None:
            yield from _digest_rows([(*node, state.hexdigest())])

    def _digest_rows(rows):
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string()))], ["id1", "id2", "sha"]
            )

    parts = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    parts = parts.mapInArrow(pieces, "id1 long, id2 long, first long, ids string")
    parts = parts.repartition("id1", "id2").sortWithinPartitions("id1", "id2", "first")
    return parts.select("id1", "id2", "ids").mapInArrow(stream, "id1 long, id2 long, sha string")


def conversation_trie(conversations: DataFrame, group: int = GROUP, shared: int = SHARED) -> DataFrame:
    """One row per node of the rebuilt conversations (see :func:`shared_heads`), as a written table.

    ``conv_id`` (least member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    """
    return settled(conversations.sparkSession, "trie", lambda: _trie(conversations, group, shared))


def _trie(conversations: DataFrame, group: int, shared: int) -> DataFrame:
    numbered = stage(numbered_turns(conversations), "turns")
    heads, rows = shared_heads(numbered, group, shared)
    rows = stage(rows.union(_own_rows(numbered, heads)), "node-rows")
    nodes = rows.groupBy("id1", "id2").agg(
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"),
    )
    for p in ("p1", "p2"):
        nodes = nodes.withColumn(p, F.when(F.col("depth") > 0, F.col(p)))
    nodes = with_children(stage(nodes, "nodes"))
    weights = nodes.selectExpr("*", "if(kids = 0, 1L, 0L) as n_leaves", "(n_convs - 1) * chars as saved_tokens")
    sums = subtree_sums(weights, ["n_leaves", "saved_tokens"])
    parents = nodes.where("kids > 0").selectExpr("id1 as p1", "id2 as p2", "conv_id as parent_conv_id")
    out = nodes.join(sums, ["id1", "id2"]).join(end_digests(rows.where("ends = 1")), ["id1", "id2"], "left")
    # written, so that Spark can split the join at a parent with very many children
    out = stage(out, "summed").join(parents, ["p1", "p2"], "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("kids").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("sha", F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )


def op12_conversation_trie(spark, sf_dir):
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


CRC_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"""
ORACLE = f"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, '')) - 1 AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % {GROUP} AS base, any_value({CRC_SQL.format(text="conv_id::VARCHAR")}) % {SHARED} AS h FROM t GROUP BY conv_id),
i AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS b FROM c LEFT JOIN c b ON b.conv_id = c.base),
r AS (
  SELECT i.conv_id, t.pos + 1 AS depth, role, text FROM i JOIN t ON t.conv_id = i.base AND t.pos < i.h
  UNION ALL SELECT i.conv_id, t.pos - i.h + i.b + 1, role, text FROM i JOIN t ON t.conv_id = i.conv_id AND t.pos >= i.h),
k AS (
  SELECT conv_id, depth, length(text) AS chars,
         md5(string_agg(role || chr(31) || text || chr(30), '') OVER (PARTITION BY conv_id ORDER BY depth)) AS key FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM i),
m AS (SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
        depth = max(depth) OVER (PARTITION BY conv_id) AS is_end FROM k),
n AS (SELECT key, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(parent) AS parent, count(*) AS n_convs, max(chars) AS chars,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends_sha256 FROM m GROUP BY key),
d AS (SELECT parent, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
w AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN d ON d.parent = n.key),
s AS (SELECT m.key, count(*) FILTER (WHERE w.n_children = 0) AS n_leaves, sum((w.n_convs - 1) * w.chars)::BIGINT AS saved_tokens
      FROM w JOIN m ON m.conv_id = w.conv_id AND m.depth <= w.depth GROUP BY m.key)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved_tokens, w.ends_sha256
FROM w JOIN s ON s.key = w.key LEFT JOIN n p ON p.key = w.parent
"""
