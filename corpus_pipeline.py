"""Five corpus operators in a row: each stage's result is written and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm import language_id, line_dedup, mixing, packing, simhash
from sluicegate.llm.common import table, written
from sluicegate.shipping import ship

#: A document that shares this part of its words, in whole lines, with one earlier document, and of that one's, is a copy; the near-duplicate
#: stage judges it. A lower part would leave in passages of documents that the stage doesn't link, as their other words differ.
COPY = 0.95
#: How often a small source may come; the largest comes once.
MAX_REPEATS = 1.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough confidence; the model is fitted on a bounded sample of them.

    Documents whose text is null or has no letter have no language and go. Without any labelled document nothing can
    be told, so all documents stay.
    """
    ship(spark)
    model = language_id.fit_on(docs, F.lit(True))
    if not model.langs:
        return docs
    return language_id.identify(docs, model).where("not rejected").select(*docs.columns)


def without_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that recur; n_chars follows the text."""
    found = line_dedup.drop_recurring(docs, copies_from=COPY)
    return found.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies; documents without words are one group."""
    ship(spark)
    return simhash.keep_one(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once; those of small sources again, up to MAX_REPEATS on average."""
    return mixing.mixture(docs, max_repeats=MAX_REPEATS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document, with its place in a sequence; a document that comes several times has its pieces several times."""
    ship(spark)
    pieces = packing.token_pieces(docs.select("doc_id", "text"))
    digests = written(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return packing.pack(digests, ["doc_id", "piece", "start", "ids_crc32"])


STAGES = [
    ("language_id", known_language),
    ("line_dedup", without_recurring_lines),
    ("simhash", one_of_each_group),
    ("mixing", mixed_sources),
    ("packing", packed),
]
#: Language identification, fingerprints and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
