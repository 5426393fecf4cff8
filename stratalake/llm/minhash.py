"""Near copies by a multi-index Hamming join over minhash signatures, confirmed on whole shingle sets.

A document's set holds its distinct runs of five words (A-Z lower-cased). Its
signature has 64 symbols of 16 bits, one per hash function: two documents
differ in a symbol about as often as their sets differ. The signature is split
into 16 chunks of four symbols. Two signatures within ``RADIUS`` = 31 symbols
have, by the pigeonhole principle, a chunk that differs in one symbol at most, so
they agree on the chunk's index with one symbol left out: each signature is
listed under 16 * 4 such keys, and every pair within the radius meets. At a
similarity of 0.75, 16 symbols differ on average; 32 or more are over four
standard deviations off.

1. Equal sets form one class, represented by its least ``doc_id``; copies are
   counted before the shuffle and never paired.
2. Classes that share a key are candidates. A key's bucket is never expanded into
   all pairs: each member is compared with the bucket's hub only, and links found
   are joined to components. What is left in different components of a bucket (a
   passage that very many documents hold, an edited copy) is compared if it
   shares one of its rarest shingles, which all links do (the prefix filter),
   and if the distances to the components' hubs leave room for a link (the
   triangle inequality). Neither filter loses a link.
3. A candidate counts as a link if, on the full sets, 100 * shared >= 75 * all.

A document without words (or null text) has an empty set and no links. A null
``doc_id`` links with nothing. Rows that repeat a ``doc_id`` with the same text
get the same result each. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm import arrays, membership
from stratalake.llm.components import components
from stratalake.llm.settle import settled, small_batches
from stratalake.sources.staging import stage

SHINGLE = 5
PERCENT = 75
SYMBOLS, CHUNK = 64, 4
RADIUS = 2 * SYMBOLS // CHUNK - 1
# Shingles that more classes than this hold are listed only where they make up most of a set.
POPULAR = 32
_rng = np.random.Generator(np.random.PCG64(5))
_MULTIPLIER = _rng.integers(0, 2**63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDEND = _rng.integers(0, 2**64, SYMBOLS, dtype=np.uint64)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE):
    """``(hashes, count per document)``: the distinct shingles of each document, in ascending order."""
    words = arrays.Words(arrays.lower_ascii(raw), offsets)
    rolling = arrays.Rolling(words.codes())
    n = len(words.start)
    at = np.arange(max(n - shingle + 1, 0))
    at = at[words.doc[at] == words.doc[at + shingle - 1]] if len(at) else at
    short = np.flatnonzero((words.counts > 0) & (words.counts < shingle))
    start = np.concatenate([at, words.first[short]])
    end = np.concatenate([at + shingle, words.first[short + 1]])
    hashes, doc = rolling.of(start, end), words.doc[start]
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    hashes, doc = hashes[new], doc[new]
    return hashes, np.bincount(doc, minlength=len(offsets) - 1).astype(np.int64)


def sketches(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, n, a, b, signature)``: set size, a 128-bit hash of the set, and its signature (null without words)."""

    def emit(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            raw, offsets = arrays.utf8(batch.column("text"))
            for lo, hi in arrays.slices(offsets):
                hashes, counts = shingle_sets(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], shingle)
                full = np.flatnonzero(counts)
                a, b = np.zeros(hi - lo, np.uint64), np.zeros(hi - lo, np.uint64)
                signature = np.zeros((len(full), SYMBOLS), np.uint16)
                if len(full):
                    starts = (np.cumsum(counts) - counts)[full]
                    a[full] = np.add.reduceat(arrays.mix(hashes), starts)
                    b[full] = np.add.reduceat(arrays.mix(hashes ^ np.uint64(0x9E3779B97F4A7C15)), starts)
                    for j in range(SYMBOLS):
                        least = np.minimum.reduceat(hashes * _MULTIPLIER[j] + _ADDEND[j], starts)
                        signature[:, j] = arrays.mix(least) >> np.uint64(48)
                packed = [None] * (hi - lo)
                for i, row in zip(full, signature):
                    packed[i] = row.tobytes()
                ids = batch.column("doc_id").slice(lo, hi - lo)
                columns = [ids, pa.array(counts), pa.array(arrays.signed(a)), pa.array(arrays.signed(b)), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "a", "b", "signature"])

    return docs.select("doc_id", "text").mapInArrow(emit, "doc_id long, n long, a long, b long, signature binary")


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """The keys of each signature: every chunk with each one of its symbols left out."""
    rows = len(signatures)
    chunks = signatures.reshape(rows, -1, CHUNK).astype(np.uint64)
    out = np.empty((rows, chunks.shape[1], CHUNK), np.uint64)
    for left_out in range(CHUNK):
        key = np.arange(chunks.shape[1], dtype=np.uint64) * np.uint64(CHUNK) + np.uint64(left_out + 1)
        key = np.broadcast_to(arrays.mix(key), chunks.shape[:2])
        for j in range(CHUNK):
            if j != left_out:
                key = arrays.mix(key * np.uint64(0x9E3779B97F4A7C15) + chunks[:, :, j])
        out[:, :, left_out] = key
    return out.reshape(rows, -1)


def listings(classes: DataFrame, shared=None) -> DataFrame:
    """``(key, rep, spot)``: each class under its keys, or under those in the bitmap ``shared``."""

    def emit(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                rep = part.column("rep").to_numpy(zero_copy_only=False)
                signatures = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint16).reshape(-1, SYMBOLS)
                keys = chunk_keys(signatures)
                reps = np.repeat(rep, keys.shape[1])
                keys = keys.ravel()
                if shared is not None:
                    held = membership.contains(shared.value, keys)
                    keys, reps = keys[held], reps[held]
                spots = arrays.signed(arrays.mix(reps.view(np.uint64)))
                columns = [pa.array(arrays.signed(keys)), pa.array(reps), pa.array(spots)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "rep", "spot"])

    return classes.select("rep", "signature").mapInArrow(emit, "key long, rep long, spot long")


def _texts(docs: DataFrame, wanted) -> DataFrame:
    """The documents whose id may be in the bitmap."""

    def emit(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            held = membership.contains(wanted.value, arrays.mix(ids.view(np.uint64)))
            yield batch.filter(pa.array(held))

    return docs.mapInArrow(emit, docs.schema)


def overlaps(pairs: DataFrame, texts: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(x, y, shared, every)``: sizes of the intersection and union of the full shingle sets of each pair of ids."""
    of_x = texts.select(F.col("doc_id").alias("x"), F.col("text").alias("text_x"))
    of_y = texts.select(F.col("doc_id").alias("y"), F.col("text").alias("text_y"))

    def emit(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            (raw_x, at_x), (raw_y, at_y) = (arrays.utf8(batch.column(c)) for c in ("text_x", "text_y"))
            # so many pairs at a time as have few bytes together: a hub's text stands in each of its pairs
            for lo, hi in arrays.slices(at_x + at_y):
                hx, nx = shingle_sets(raw_x[at_x[lo] : at_x[hi]], at_x[lo : hi + 1] - at_x[lo], shingle)
                hy, ny = shingle_sets(raw_y[at_y[lo] : at_y[hi]], at_y[lo : hi + 1] - at_y[lo], shingle)
                ex, ey, shared = np.cumsum(nx), np.cumsum(ny), np.zeros(hi - lo, np.int64)
                for i in range(hi - lo):
                    both = np.intersect1d(hx[ex[i] - nx[i] : ex[i]], hy[ey[i] - ny[i] : ey[i]], assume_unique=True)
                    shared[i] = len(both)
                columns = [batch.column(c).slice(lo, hi - lo) for c in "xy"] + [pa.array(shared), pa.array(nx + ny - shared)]
                yield pa.RecordBatch.from_arrays(columns, ["x", "y", "shared", "every"])

    rows = pairs.join(of_x, "x").join(of_y, "y").select("x", "y", "text_x", "text_y")
    return rows.mapInArrow(emit, "x long, y long, shared long, every long")


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The pairs ``(x, y)`` of ids whose full shingle sets share enough."""
    return overlaps(pairs, texts, shingle).where(f"100 * shared >= {percent} * every").select("x", "y")


def _hub_pairs(listed: DataFrame) -> DataFrame:
    """Each listed class with the hub of its bucket, if that is of another component."""
    hubs = listed.groupBy("key").agg(F.min(F.struct("component_id", "rep")).alias("hub"), F.max("component_id").alias("last"))
    hubs = hubs.where("hub.component_id < last").select("key", F.col("hub.component_id").alias("lo"), F.col("hub.rep").alias("x"))
    hubs = stage(hubs, "hubs")
    return listed.join(hubs, "key").where("component_id > lo").select("x", F.col("rep").alias("y")).distinct()


def _prefixes(reps: DataFrame, texts: DataFrame, shingle: int, percent: int, popular: int) -> DataFrame:
    """``(key, rep, component_id, n, common, popular)``: the classes ``(rep, component_id)`` by their rarest shingles.

    Two sets that share enough also share one of the rarest n - ceil(percent / 100 * n) + 1 of
    either, whatever order all follow; here it is how many of the classes hold
    a shingle. A shingle that more than ``popular`` of them hold is listed for those
    sets only of which such shingles make up ``percent`` at least: the other
    sets' partners share a rarer one with them, so a passage that very many documents
    hold brings few together. ``n`` is the size of the set, ``common`` how many popular
    shingles it has.
    """

    def emit(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            raw, offsets = arrays.utf8(batch.column("text"))
            for lo, hi in arrays.slices(offsets):
                hashes, counts = shingle_sets(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], shingle)
                of = pa.array(np.repeat(np.arange(lo, hi), counts))
                columns = [pa.array(arrays.signed(hashes)), batch.column("component_id").take(of), batch.column("doc_id").take(of)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "component_id", "rep"])

    wanted = texts.join(reps.withColumnRenamed("rep", "doc_id"), "doc_id").select("doc_id", "component_id", "text").distinct()
    held = stage(wanted.mapInArrow(emit, "key long, component_id long, rep long"), "shingles")
    often = held.groupBy("key").agg(F.count(F.lit(1)).alias("often"), F.min("component_id").alias("lo"), F.max("component_id").alias("hi"))
    often = stage(often.where("often > 1"), "often")
    own = Window.partitionBy("rep")
    ranked = held.join(often, "key", "left").select(
        "key",
        "rep",
        "component_id",
        F.coalesce(F.col("often") > popular, F.lit(False)).alias("popular"),
        (F.col("lo") < F.col("hi")).alias("elsewhere"),
        F.row_number().over(own.orderBy(F.coalesce("often", F.lit(1)), "key")).alias("place"),
        F.count(F.lit(1)).over(own).alias("n"),
        F.count_if(F.col("often") > popular).over(own).alias("common"),
    )
    listed = ranked.where(F.col("elsewhere") & (F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1))
    listed = listed.where(~F.col("popular") | (100 * F.col("common") >= percent * F.col("n")))
    return listed.select("key", "rep", "component_id", "n", "common", "popular")


def _sharing_rare(listed: DataFrame) -> DataFrame:
    """``(x, y)`` of different components that share a shingle few classes hold."""
    x, y = (listed.where("not popular").select("key", *[F.col(c).alias(c + s) for c in ("rep", "component_id")]) for s in "xy")
    pairs = x.join(y, "key").where("repx < repy and component_idx <> component_idy")
    return pairs.select(F.col("repx").alias("x"), F.col("repy").alias("y")).distinct()


def _enough(percent: int, n: str, m: str, most: str, other: str):
    """Whether the popular parts alone can make two sets a link: shared >= t * (n + m - shared)."""
    return (100 + percent) * F.least(most, other) >= percent * (F.col(n) + F.col(m))


def _sharing_popular(listed: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``(x, y)`` of different components that popular shingles alone could make a link.

    Components that share one are paired, and their hubs (their least ids) are compared. One
    minus the similarity is a distance, so members of two components are no nearer
    than their hubs less their own distances to these.
    """
    listed = listed.where("popular")
    grouped = listed.groupBy("key", "component_id").agg(F.min("n").alias("n"), F.max("common").alias("common"))
    grouped = stage(grouped, "popular")
    x, y = (grouped.select("key", *[F.col(c).alias(c + s) for c in ("component_id", "n", "common")]) for s in "xy")
    pairs = x.join(y, "key").where((F.col("component_idx") < F.col("component_idy")) & _enough(percent, "nx", "ny", "commonx", "commony"))
    pairs = stage(pairs.select(F.col("component_idx").alias("cx"), F.col("component_idy").alias("cy")).distinct(), "components")

    apart = 1 - F.col("shared") / F.col("every")
    hubs = overlaps(pairs.select(F.col("cx").alias("x"), F.col("cy").alias("y")), texts, shingle)
    hubs = stage(hubs.select(F.col("x").alias("cx"), F.col("y").alias("cy"), apart.alias("apart")), "hubs-apart")
    involved = hubs.select(F.explode(F.array("cx", "cy")).alias("component_id")).distinct()
    own = listed.select("rep", "component_id", "n", "common").distinct().join(involved, "component_id")
    own = stage(own, "members")
    to_hub = overlaps(own.where("rep <> component_id").select(F.col("component_id").alias("x"), F.col("rep").alias("y")), texts, shingle)
    own = own.join(to_hub.select(F.col("y").alias("rep"), apart.alias("off")).distinct(), "rep", "left")
    own = stage(own.withColumn("off", F.coalesce("off", F.lit(0.0))), "to-hub")
    most = 1 - percent / 100 + 1e-9
    radius = own.groupBy("component_id").agg(F.max("off").alias("radius"))
    of = lambda s: radius.select(F.col("component_id").alias(f"c{s}"), F.col("radius").alias(f"radius{s}"))
    near = hubs.join(of("x"), "cx").join(of("y"), "cy").where(F.col("apart") <= most + F.col("radiusx") + F.col("radiusy"))
    near = stage(near, "near")
    x, y = (
        own.select(F.col("component_id").alias(f"c{s}"), F.col("rep").alias(s), *[F.col(c).alias(c + s) for c in ("off", "n", "common")])
        for s in "xy"
    )
    some = near.join(x, "cx").where(F.col("apart") <= most + F.col("offx") + F.col("radiusy"))
    room = (F.col("apart") <= most + F.col("offx") + F.col("offy")) & _enough(percent, "nx", "ny", "commonx", "commony")
    both = some.join(y, on=[some["cy"] == y["cy"], room])
    return both.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def _rest_pairs(listed: DataFrame, texts: DataFrame, shingle: int, percent: int, popular: int) -> DataFrame:
    """What the hubs leave to compare: pairs of different components that can be links."""
    sides = listed.select("key", "component_id").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("sides"))
    sides = stage(sides.where("sides > 1").select("key"), "sides")
    reps = stage(listed.join(sides, "key").select("rep", "component_id").distinct(), "unsettled")
    listed = stage(_prefixes(reps, texts, shingle, percent, popular), "prefixes")
    return _sharing_rare(listed).union(_sharing_popular(listed, texts, shingle, percent)).distinct()


def near_copies(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, popular: int = POPULAR) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``: one document of each component is kept, its least id."""
    return settled(docs.sparkSession, "near-copies", lambda: _near_copies(docs, shingle, percent, popular))


def _near_copies(docs: DataFrame, shingle: int, percent: int, popular: int) -> DataFrame:
    docs = small_batches(docs.select("doc_id", "text"))
    sketch = stage(sketches(docs, shingle), "sketches")
    known = sketch.where("n > 0 and doc_id is not null")
    classes = known.groupBy("a", "b", "n").agg(F.min(F.struct("doc_id", "signature")).alias("first"))
    classes = stage(classes.select("a", "b", "n", F.col("first.doc_id").alias("rep"), F.col("first.signature").alias("signature")), "classes")

    repeated = listings(classes).groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi")
    listed = stage(listings(classes, membership.bitmap(repeated, "key")), "listings")
    wanted = membership.bitmap(listed.select("spot").distinct(), "spot")
    texts = stage(_texts(docs.where("doc_id is not null"), wanted), "texts")

    links = compared = labels = None
    for step in range(2):
        if labels is None:
            labelled = listed.withColumn("component_id", F.col("rep"))
        else:
            labelled = listed.join(labels.withColumnRenamed("id", "rep"), "rep", "left")
            labelled = labelled.withColumn("component_id", F.coalesce("component_id", "rep"))
        pairs = _hub_pairs(labelled) if step == 0 else _rest_pairs(labelled, texts, shingle, percent, popular)
        if compared is not None:
            pairs = pairs.join(compared, ["x", "y"], "left_anti")
        pairs = stage(pairs, "pairs")
        found = confirmed(pairs, texts, shingle, percent)
        compared = pairs if compared is None else compared.union(pairs)
        links = stage(found if links is None else links.union(found), "found")
        labels = stage(components(links, "x", "y"), "labels")

    of_class = classes.select("a", "b", "n", "rep").join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    of_class = stage(of_class.select("a", "b", "n", F.coalesce("component_id", "rep").alias("component_id")), "of_class")
    known = known.select("doc_id", "n", "a", "b").join(of_class, ["a", "b", "n"])
    lone = sketch.where("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    rows = known.select("doc_id", "n", "component_id").union(lone)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept)


def op5_minhash_near_dedup(spark, sf_dir):
    return near_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[p + 1:p + {SHINGLE}], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - {SHINGLE - 1}, least(len(w), 1)))) AS p FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (SELECT x.doc_id AS x, y.doc_id AS y, count(*) AS shared FROM s x JOIN s y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (
  SELECT x, y FROM pair JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * shared >= {PERCENT} * (a.n + b.n - shared)),
both_ways AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id AS id, doc_id AS other FROM d UNION SELECT reach.id, both_ways.y FROM reach JOIN both_ways ON both_ways.x = reach.other),
c AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d JOIN c ON c.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
