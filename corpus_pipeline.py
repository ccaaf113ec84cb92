"""From raw documents to packed sequences: quality, exact and near dedup, decontamination, packing.

A document is a doc_id with a text: texts that share a doc_id, or have none, are told apart by row keys (see ``bookpipe.llm.rowkeys``), which follow
the order of the doc_ids, null last. So a decision never falls on another text of the same doc_id. Columns beyond those of ``documents`` pass through
all stages but the last. A null text is an empty one. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookpipe.llm import decontaminate, neardup, packing, quality
from bookpipe.llm.queries import KEEP_SCORE, SEQUENCE, new_index, tokenizer
from bookpipe.llm.rowkeys import ROW, row_keys
from bookpipe.llm.text import held_out, store
from bookpipe.session import ship_package


def without(spark: SparkSession, docs: DataFrame, found: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows but those whose keys ``found`` gives as doc_id, when it is given (doc_id, text) with keys as doc_ids."""
    rows, _ = row_keys(spark, docs, nulls=True)
    dropped = found(rows.select(F.col(ROW).alias("doc_id"), "text")).select(F.col("doc_id").alias(ROW)).distinct()
    return rows.join(dropped, ROW, "left_anti").select(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores at 0.3 or more.

    The score depends on the text alone, so repeated rows are treated alike, whatever their doc_ids. Labels are learned of ids that are not held out; an
    id with several texts is labelled by one of them. Empty texts are scored like any other.
    """
    ship_package(spark)
    model = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"), held_out(5, 0))
    return quality.score(docs, model, docs.columns).filter(F.col("score") >= KEEP_SCORE).select(*docs.columns)


def exact_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, compared after lower-casing A-Z: that of the largest key, so one without a doc_id if there is any.

    Rows that repeat both doc_id and text tie, and any one of them stays. Empty texts are equal texts.
    """
    rows, _ = row_keys(spark, docs, nulls=True)
    decisions = store(spark, new_index(spark).add(rows.select(F.col(ROW).alias("doc_id"), "text")))
    dropped = decisions.filter("NOT kept").select(F.col("doc_id").alias(ROW)).distinct()
    left = rows.join(dropped, ROW, "left_anti").select(*rows.columns)
    tied = decisions.filter("kept AND group_size > 1").groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias(ROW))
    if not tied.isEmpty():
        again = left.join(tied, ROW, "left_semi").select(*rows.columns)
        left = left.join(tied, ROW, "left_anti").select(*rows.columns).unionByName(again.dropDuplicates([ROW]))
    return left.select(*docs.columns)


def near_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the least key, of each group linked by 0.8 of their 5-word shingles. Texts without words stay."""
    ship_package(spark)
    return without(spark, docs, lambda rows: neardup.near_duplicates(spark, rows, words=5, percent=80).filter("NOT kept"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, with or without a doc_id."""
    ship_package(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return without(spark, docs, lambda rows: decontaminate.find_leaks(spark, rows, benchmark))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 ids, with the ids. Every row is packed, each on its own; an empty text is the final id alone."""
    ship_package(spark)
    return packing.pack(spark, docs, tokenizer(), SEQUENCE, with_ids=True)


STAGES = [
    ("quality_classifier", good_quality),
    ("exact_dedup", exact_once),
    ("minhash_dedup", near_once),
    ("benchmark_decontamination", decontaminated),
    ("packing", packed),
]

# SQL has neither the fitted classifier nor the tokenizer; tests/llm/test_pipeline.py holds brute-force counterparts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = store(spark, stage(spark, docs, sf_dir))
    return docs
