"""Names for the documents of a table where a doc_id may stand for several texts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookpipe.llm.mixing import numbered
from bookpipe.llm.text import store

ROW, MARK = "__row", "__mark"


def row_keys(spark: SparkSession, docs: DataFrame, nulls: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """The rows with ``__row``, a whole number that names a document by its doc_id and text, in the order of the doc_ids.

    Where no doc_id has two texts it is the doc_id. Otherwise the distinct pairs of doc_id and text digest are numbered in their order, and the second result
    has (doc_id, __row). Equal rows have one name. With ``nulls`` rows without a doc_id get names too, behind all others; otherwise theirs is null.
    """
    rows = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marks = rows.groupBy("doc_id").agg(F.min(F.xxhash64(text)).alias("low"), F.max(F.xxhash64(text)).alias("high"))
    shared = marks.filter("doc_id IS NULL" if nulls else "false").limit(1).unionByName(marks.filter("doc_id IS NOT NULL AND low <> high").limit(1))
    if shared.isEmpty():
        return rows.withColumn(ROW, F.col("doc_id")), None
    marked = rows.withColumn(MARK, F.md5(text.cast("binary")))
    pairs = marked.select("doc_id", MARK).filter("true" if nulls else "doc_id IS NOT NULL").distinct()
    names = store(spark, numbered(spark, pairs, F.col("doc_id").asc_nulls_last(), F.col(MARK).asc()).withColumnRenamed("place", ROW))
    named = names.select(F.col("doc_id").alias("__id"), F.col(MARK).alias("__of"), ROW)
    joined = marked.join(named, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col(MARK) == F.col("__of")), "left")
    return store(spark, joined.drop("__id", "__of", MARK)), names.select("doc_id", ROW)


def separately(spark: SparkSession, docs: DataFrame, operate: Callable[[DataFrame], DataFrame], ids: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Apply an operator that tells documents apart by doc_id, with texts that share a doc_id as documents of their own.

    ``operate`` gets (doc_id, text) and may return doc_ids in the columns ``ids``.
    """
    rows, names = row_keys(spark, docs.select("doc_id", "text"))
    if names is None:
        return operate(rows.select("doc_id", "text"))
    found = operate(rows.select(F.col(ROW).alias("doc_id"), "text"))
    columns = found.columns
    for name in ids:
        own = names.select(F.col(ROW).alias(name), F.col("doc_id").alias("__id"))
        found = found.join(own, name, "left").drop(name).withColumnRenamed("__id", name)
    return found.select(*columns)
