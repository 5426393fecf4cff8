"""From raw documents to token windows: five stages, each a Spark job over all that its predecessor kept.

1. language_id: documents in which no language can be told (no letter, no text) go, and those whose
   language is not in ``LANGUAGES`` or scores below ``LEAST_SCORE``. The others go on with the language that was told
   from their text in ``lang``, so the later stages' tables do not hold a wrong or missing label.
2. near_dedup: of each group of near copies the document with the least id stays, once.
   Of different texts under one id each is a document; the one of the least MD5 counts
   under that id, the others after all ids, in a fixed order. Of rows that repeat id and text
   but not the other columns, the least of these stays.
3. substring_dedup: byte strings of 100 or more that also stand earlier are cut out; a
   document of which nothing but blanks is left goes. ``n_chars`` follows the text.
4. decontamination: documents that hold a benchmark item go.
5. packing: the rest as pieces of token windows.

A stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet in the shared
work folder and read again, so a lost executor costs no more than the stage's own tasks.
All stages but the last return the columns of ``documents``. Other columns that ``docs`` may have
are carried along. An empty table goes through all stages and gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import decontaminate, langid, minhash, packing, suffix
from stratalake.operators.sizing import fits_broadcast
from stratalake.operators.upsert import assign_keys
from stratalake.sources.staging import stage


# The languages to keep (None: all that were learnt), and the least probability of the best one.
LANGUAGES: tuple[str, ...] | None = None
LEAST_SCORE = 0.0


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.in_known_language(docs, *langid.train(docs), LANGUAGES, LEAST_SCORE)


def _small(ids: DataFrame) -> DataFrame:
    """Ids that go out to the tasks if they are few, so that the texts stay where they are; they are counted."""
    return F.broadcast(ids) if fits_broadcast(ids) else ids


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents with an id, once for each id and text, and a ``__key`` of each."""
    known = docs.where("doc_id is not null")
    shared = known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    shared = stage(shared, "shared-ids")
    if shared.isEmpty():
        return known.withColumn("__key", F.col("doc_id"))
    shared = _small(shared)
    texts = known.join(shared, "doc_id", "left_semi").withColumn("__text", F.coalesce(F.md5("text"), F.lit("")))
    # a fixed row of those that repeat id and text, whichever task is done again
    rest = F.to_json(F.struct(F.lit(0), *[F.col(c) for c in docs.columns if c not in ("doc_id", "text")]))
    texts = texts.groupBy("doc_id", "__text").agg(F.min_by(F.struct(*docs.columns), rest).alias("__row"))
    texts = stage(texts.select("__text", "__row.*"), "shared-texts")
    texts = texts.join(texts.groupBy("doc_id").agg(F.min("__text").alias("__first")), "doc_id")
    more = stage(texts.where("__text <> __first"), "more-texts")
    more = assign_keys(more, ["doc_id", "__text"], "__key", known.agg(F.max("doc_id")).first()[0])
    rest = known.join(shared, "doc_id", "left_anti").unionByName(texts.where("__text = __first").select(*docs.columns))
    rest = rest.withColumn("__key", F.col("doc_id"))
    return stage(rest.unionByName(more.select(*docs.columns, "__key")), "keyed")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = _keyed(docs)
    copies = minhash.near_copies(keyed.select(F.col("__key").alias("doc_id"), "text"))
    extra = copies.where(~F.col("kept")).select(F.col("doc_id").alias("__key"))
    known = keyed.join(_small(extra), "__key", "left_anti")
    return known.select(*docs.columns).union(docs.where("doc_id is null"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffix.without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents that the stages keep."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs


# Tokens and similarities of whole documents are beyond SQL: tests/llm holds each stage against brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
