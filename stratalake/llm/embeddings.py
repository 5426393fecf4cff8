"""Near copies among embeddings by an inverted multi-index.

Vectors are scaled to unit length and cut in halves. Each half has a codebook of its
own (k-means); a pair of codes is a cell of the product grid, and each vector lies in
the cell of its nearest codes. A vector visits the cells nearest to it, in the order
of the multi-sequence traversal (the sums of the two half distances), and is compared
with all vectors there in double precision.

- The codebooks are fitted on a sample of at most about ``SAMPLE`` vectors. How many
  cells a visit takes is measured on it as well: as many as find ``RECALL`` of
  partners made at exactly the threshold, the hardest ones. All vectors are indexed,
  all visit.
- Equal vectors form one class that is compared once and counted with its copies.
- Cells are dealt out in blocks of a bounded number of vectors; a cell that
  holds a large part of all vectors is dealt to parts, each a key of its own. Two blocks meet as two
  matrices. A pair that is found from both sides counts once.
- A block pair returns sums of links per vector and the links that hold its
  vectors together (fewer than its vectors), never all pairs.

Vectors that are null, empty, zero or hold null or non-finite components link with
nothing; so do those with a null ``vec_id``. Vectors of different lengths are compared
within their length only. A row repeated as a whole counts as one vector; an id given with different
vectors has the links of each, and gets the greatest number of links and the least component among them. ``label``
and other columns are ignored. Without vectors there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm import arrays
from stratalake.llm.components import components
from stratalake.llm.settle import small_batches
from stratalake.operators.sizing import fits_broadcast
from stratalake.sources.staging import stage

COSINE = 0.95
RECALL = 0.995
SAMPLE = 8192
# Vectors a cell holds on average. The codes of a half follow the number of vectors, up to half the sample: cells keep
# this size up to a billion vectors; beyond, take a larger sample.
CELL = 64
BLOCK = 512
_SEED = 20


def _classes(vectors: DataFrame) -> DataFrame:
    """``(vec_id, dim, a, b, vector)``: usable vectors with a 128-bit hash of their components.

    Vectors are packed in the precision they have in the table: all sums are in double precision.
    """
    kind = np.float32 if vectors.schema["embedding"].dataType.elementType == T.FloatType() else np.float64

    def emit(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            lists = batch.column("embedding").cast(pa.large_list(pa.float64()))
            size = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64)
            flat = lists.flatten()
            numbers, start = flat.to_numpy(zero_copy_only=False), np.cumsum(size) - size
            known = batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
            for dim in np.unique(size[size > 0]):
                at = np.flatnonzero((size == dim) & known)
                own = numbers[start[at][:, None] + np.arange(dim)] + 0.0  # null components are NaN here; -0.0 is 0.0
                usable = np.isfinite(own).all(axis=1) & own.any(axis=1)
                at, own = at[usable], own[usable]
                if not len(at):
                    continue
                code = arrays.mix(own.view(np.uint64))
                steps = (np.array([pow(base, j, 2**64) for j in range(dim)], np.uint64) for base in (arrays.BASE_A, arrays.BASE_B))
                a, b = (arrays.mix((code * step).sum(axis=1, dtype=np.uint64) + np.uint64(dim)) for step in steps)
                packed = pa.array([v.tobytes() for v in own.astype(kind)], pa.binary())
                columns = [batch.column("vec_id").take(pa.array(at)), pa.array(np.full(len(at), dim, np.int32)), pa.array(arrays.signed(a)), pa.array(arrays.signed(b)), packed]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "dim", "a", "b", "vector"])

    rows = small_batches(vectors).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return rows.mapInArrow(emit, "vec_id long, dim int, a long, b long, vector binary")


def _unit(packed: bytes, dim: int, rows: int) -> np.ndarray:
    """Packed vectors as unit rows in double precision; scaled first so that no square overflows."""
    kind = np.float64 if len(packed) == 8 * dim * rows else np.float32
    rows = np.frombuffer(packed, kind).reshape(rows, dim).astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _k_means(points: np.ndarray, codes: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centers = points[rng.choice(len(points), codes, replace=False)]
    for _ in range(rounds):
        nearest = _distances(points, centers).argmin(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, points)
        held = np.bincount(nearest, minlength=codes)
        centers = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], centers)
    return centers


def _distances(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return (points**2).sum(axis=1)[:, None] - 2 * points @ centers.T + (centers**2).sum(axis=1)


class Grid:
    """Two codebooks, and how many cells a visit takes."""

    def __init__(self, sample: np.ndarray, rows: int, cosine: float, recall: float):
        rng = np.random.Generator(np.random.PCG64(_SEED))
        codes = int(np.clip(np.sqrt(rows / CELL), 1, max(1, len(sample) // 2)))
        self.half = sample.shape[1] // 2
        self.books = [_k_means(part, codes, rng) for part in (sample[:, : self.half], sample[:, self.half :])]
        self.codes, self.visits = codes, codes * codes
        self.visits = self._depth(sample[:2048], cosine, recall, rng)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        one, two = (_distances(p, b).argmin(axis=1) for p, b in zip((vectors[:, : self.half], vectors[:, self.half :]), self.books))
        return one * self.codes + two

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        """The first ``visits`` cells of each vector's multi-sequence traversal.

        With both codebooks in order of distance, the cell at ranks (i, j) comes after
        all of (i' <= i, j' <= j), so only those with (i + 1) * (j + 1) <= visits can be among them.
        """
        one, two = (_distances(p, b) for p, b in zip((vectors[:, : self.half], vectors[:, self.half :]), self.books))
        first, second = one.argsort(axis=1, kind="stable"), two.argsort(axis=1, kind="stable")
        rank = np.arange(1, self.codes + 1)
        i, j = np.nonzero(rank[:, None] * rank <= self.visits)
        one, two = np.take_along_axis(one, first, 1), np.take_along_axis(two, second, 1)
        order = (one[:, i] + two[:, j]).argsort(axis=1, kind="stable")[:, : self.visits]
        return np.take_along_axis(first, i[order], 1) * self.codes + np.take_along_axis(second, j[order], 1)

    def _depth(self, sample: np.ndarray, cosine: float, recall: float, rng: np.random.Generator) -> int:
        """Cells to visit so that the given share of partners at exactly this cosine is found from one of both sides."""
        aside = rng.standard_normal(sample.shape)
        aside -= (aside * sample).sum(axis=1, keepdims=True) * sample
        size = np.linalg.norm(aside, axis=1, keepdims=True)
        partners = cosine * sample + np.sqrt(1 - cosine**2) * aside / np.where(size > 0, size, 1)
        ranks = []
        for lo in range(0, len(sample), 64):
            x, y = sample[lo : lo + 64], partners[lo : lo + 64]
            there = (self.nearest(x) == self.cells(y)[:, None]).argmax(axis=1)
            back = (self.nearest(y) == self.cells(x)[:, None]).argmax(axis=1)
            ranks.append(np.minimum(there, back))
        return int(np.quantile(np.concatenate(ranks), recall, method="higher")) + 1


def _parts(residents: DataFrame, size: int) -> DataFrame:
    """``(cell, parts)`` of the cells that hold more than ``size`` vectors."""
    counts = residents.groupBy("cell").agg(F.count(F.lit(1)).alias("rows_")).where(F.col("rows_") > size)
    return stage(counts.select("cell", F.ceil(F.col("rows_") / size).cast("int").alias("parts")), "dense-cells")


def _blocks(rows: DataFrame, names: list[str], size: int) -> DataFrame:
    """Rows of a cell and part packed into blocks of at most ``size``: ``cell``, ``part`` and the other columns as bytes."""
    dealt = rows.repartition("cell", "part").sortWithinPartitions("cell", "part", "rep").select("cell", "part", *names)

    def emit(batches: Iterator[pa.RecordBatch]):
        block, at = [], None

        def packed():
            columns = [np.array(c, np.int64).tobytes() if isinstance(c[0], int) else b"".join(c) for c in zip(*block)]
            fields = [pa.array([at[0]], pa.int64()), pa.array([at[1]], pa.int64()), *(pa.array([c], pa.binary()) for c in columns)]
            return pa.RecordBatch.from_arrays(fields, ["cell", "part", *names])

        for batch in batches:
            for cell, part, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (cell, part) != at or len(block) >= size:
                    if block:
                        yield packed()
                    block, at = [], (cell, part)
                block.append(row)
        if block:
            yield packed()

    return dealt.mapInArrow(emit, ", ".join(["cell long", "part long", *(f"{c} binary" for c in names)]))


def _holding(linked: np.ndarray) -> list[tuple[int, int]]:
    """Of a bipartite graph, links (row, column) that join the same rows and columns; fewer than there are of both."""
    rows, columns = linked.shape
    label = np.arange(rows)
    far = rows + columns
    while True:
        below = np.where(linked, label[:, None], far).min(axis=0)
        again = np.minimum(label, np.where(linked, below[None, :], far).min(axis=1))
        if (again == label).all():
            break
        label = again
    links = []
    for column in np.flatnonzero(below < far):
        links.append((int(below[column]), int(column)))
    for row in np.flatnonzero(linked.any(axis=1)):
        if label[row] != row:
            links.append((int(row), int(np.flatnonzero(linked[row])[0])))
    return links


def links(classes: DataFrame, dim: int, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """``(x, y, n)`` of classes ``(rep, copies, vector)``: with y null, n more links of x; else a link of x and y."""
    spark, rows = classes.sparkSession, classes.count()
    # a draw by hash, fine enough for any number of rows: about SAMPLE of them
    share = min(1.0, SAMPLE / max(rows, 1))
    drawn = classes if share == 1 else classes.where(F.shiftrightunsigned(F.xxhash64("rep"), 1) < int(share * 2**63))
    drawn = drawn.orderBy("rep").select("vector").toArrow().column("vector").to_pylist()
    grid = spark.sparkContext.broadcast(Grid(_unit(b"".join(drawn), dim, len(drawn)), rows, cosine, recall))

    def place(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                own = _unit(b"".join(part.column("vector").to_pylist()), dim, part.num_rows)
                visited = grid.value.nearest(own).astype(np.int32)
                columns = [part.column(c) for c in ("rep", "copies", "vector")] + [pa.array(grid.value.cells(own).astype(np.int64))]
                columns += [pa.array([v.tobytes() for v in visited], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["rep", "copies", "vector", "cell", "visited"])

    def visits(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            cells = [np.frombuffer(v, np.int32) for v in batch.column("visited").to_pylist()]
            of = pa.array(np.repeat(np.arange(len(cells)), [len(c) for c in cells]))
            columns = [pa.array(np.concatenate(cells).astype(np.int64) if cells else np.zeros(0, np.int64))]
            columns += [batch.column(c).take(of) for c in ("rep", "copies", "cell", "vector")]
            yield pa.RecordBatch.from_arrays(columns, ["cell", "rep", "copies", "home", "vector"])

    placed = stage(classes.mapInArrow(place, "rep long, copies long, vector binary, cell long, visited binary"), "placed")
    parts = _parts(placed, BLOCK)
    parts = F.broadcast(parts) if fits_broadcast(parts) else parts
    # a dense cell's vectors are dealt to parts; each visitor goes to all of them, so a part is a key of its own
    residents = placed.join(parts, "cell", "left").withColumn("part", F.expr("pmod(xxhash64(rep), coalesce(parts, 1))"))
    visitors = placed.mapInArrow(visits, "cell long, rep long, copies long, home long, vector binary")
    visitors = visitors.join(parts, "cell", "left").withColumn("part", F.explode(F.expr("sequence(0L, coalesce(parts, 1) - 1L)")))
    residents = _blocks(residents, ["rep", "copies", "visited", "vector"], BLOCK)
    visitors = _blocks(visitors, ["rep", "copies", "home", "vector"], BLOCK)
    residents = residents.withColumnsRenamed({c: f"at_{c}" for c in ("rep", "copies", "visited", "vector")})

    def meet(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in range(batch.num_rows):
                x, y = {}, {}
                for side, prefix in ((x, ""), (y, "at_")):
                    for c in ("rep", "copies"):
                        side[c] = np.frombuffer(batch.column(prefix + c)[row].as_py(), np.int64)
                    side["unit"] = _unit(batch.column(f"{prefix}vector")[row].as_py(), dim, len(side["rep"]))
                x["home"] = np.frombuffer(batch.column("home")[row].as_py(), np.int64)
                y["visited"] = np.frombuffer(batch.column("at_visited")[row].as_py(), np.int32).reshape(len(y["rep"]), -1)
                linked = x["unit"] @ y["unit"].T >= cosine
                i, j = np.nonzero(linked)
                both = (y["visited"][j] == x["home"][i][:, None]).any(axis=1)
                counts = np.where(both, x["rep"][i] < y["rep"][j], x["rep"][i] != y["rep"][j])
                linked[i[~counts], j[~counts]] = False
                i, j = i[counts], j[counts]
                if not len(i):
                    continue
                of_x = np.bincount(i, y["copies"][j], len(x["rep"])).astype(np.int64)
                of_y = np.bincount(j, x["copies"][i], len(y["rep"])).astype(np.int64)
                held = np.array(_holding(linked))
                ends = [x["rep"][of_x > 0], y["rep"][of_y > 0], x["rep"][held[:, 0]]]
                other = pa.concat_arrays([pa.nulls(len(ends[0]) + len(ends[1]), pa.int64()), pa.array(y["rep"][held[:, 1]])])
                n = np.concatenate([of_x[of_x > 0], of_y[of_y > 0], np.zeros(len(held), np.int64)])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ends)), other, pa.array(n)], ["x", "y", "n"])

    met = visitors.join(residents, ["cell", "part"]).drop("cell", "part")
    return met.mapInArrow(meet, "x long, y long, n long")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``: one vector of each component is kept, its least id."""
    usable = stage(_classes(vectors), "vectors")
    single = usable.dropDuplicates(["vec_id", "a", "b"])
    classes = single.groupBy("dim", "a", "b").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")
    )
    classes = stage(classes, "classes")
    found = None
    for (dim,) in sorted(classes.select("dim").distinct().collect()):
        part = links(classes.where(F.col("dim") == dim).select("rep", "copies", "vector"), dim, cosine, recall)
        found = part if found is None else found.union(part)
    rows = usable.select("vec_id", "dim", "a", "b")
    if found is None:
        of_class = classes.select("dim", "a", "b", F.lit(0).cast("long").alias("n_links"), F.col("rep").alias("component_id"))
    else:
        found = stage(found, "links")
        counts = found.groupBy("x").agg(F.sum("n").alias("n")).withColumnRenamed("x", "rep")
        label = components(found.where("y is not null"), "x", "y").withColumnRenamed("id", "rep")
        of_class = classes.join(counts, "rep", "left").join(label, "rep", "left").select(
            "dim", "a", "b",
            (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "rep").alias("component_id"),
        )
    of_class = stage(of_class, "of_class")
    linked = rows.join(of_class, ["dim", "a", "b"])
    linked = linked.groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    rows = vectors.select("vec_id").join(linked, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return rows.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def op6_embedding_near_dedup(spark, sf_dir):
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT x.vec_id AS x, y.vec_id AS y FROM v x JOIN v y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= {COSINE}),
reach AS (SELECT vec_id AS id, vec_id AS other FROM embeddings UNION SELECT reach.id, link.y FROM reach JOIN link ON link.x = reach.other),
c AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id),
n AS (SELECT x, count(*) AS n FROM link GROUP BY x)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.id = e.vec_id LEFT JOIN n ON n.x = e.vec_id
"""
