"""A corpus pipeline: five stages, each by one operator of promolake.llm over all that its predecessor kept.

Every stage keeps all columns under their names, whatever these are, and needs doc_id and text; labels and benchmark are
read beside the documents.  A null or blank text is no reason to go, and an empty table gives an empty one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolake.llm import decontamination, jaccard_join, line_dedup, sentencepieces, toxicity
from promolake.llm.common import Rows, Shelf, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Near copies have this share of their distinct runs of SHINGLE words in common.
SHINGLE, PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below 0.5 stay; rows that repeat go or stay together."""
    rows = Rows(docs)
    own = rows.only("doc_id", "text")
    model = toxicity.fit(own, table(spark, sf_dir, "labels"))
    return rows.back(toxicity.score(spark, own, model, into="score").filter("score < 0.5"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from the texts, and n_chars, if there is one, is counted anew; a document of which nothing is left
    goes.  Of like lines the one in the least doc_id stays (null before all others); rows that repeat both keep it."""
    rows = Rows(docs)
    found = line_dedup.deduplicated(spark, rows.only("doc_id", "text"))
    left = found.filter((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        at = rows.at("n_chars")
        left = left.withColumn(at, F.when(F.col("n_removed") == 0, F.col(at)).otherwise(F.char_length("text").cast("bigint")))
    return rows.back(left)


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays, the one with the least doc_id (null after all others; of equal ids the
    least hash of the text, of equal rows any); documents without a word all stay."""
    return jaccard_join.keep_one(spark, docs, SHINGLE, PERCENT)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go; rows that repeat go or stay together."""
    return decontamination.clean(spark, docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """ids, n_tokens, n_byte_pieces, and as text what the ids decode to, by one worker; a null text comes back empty.
    Columns that have the name of a result give way to it."""
    return sentencepieces.encode(spark, docs, back=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("jaccard_join", keep_one),
    ("decontamination", drop_benchmark),
    ("sentencepiece", tokenize),
]

#: The stages train a network and follow links, which SQL does not express; tests hold them against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    shelf = Shelf(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shelf.put(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
