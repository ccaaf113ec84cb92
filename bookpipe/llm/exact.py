"""Exact dedup with a persistent digest index."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from bookpipe.llm.text import store

INDEX = StructType([StructField("digest", StringType()), StructField("keep_id", LongType()), StructField("group_size", LongType())])
# A digest with a thousandth of all rows is hot, if it has two at least; so there are at most a thousand.
HOT_SHARE = 1_000


def digest(text):
    """SHA-256, in lowercase hex, of a text whose A-Z are lower-cased; null counts as empty."""
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.sha2(lowered.cast("binary"), 256)


class DigestIndex:
    """Digests seen so far, bucketed and sorted by digest in a folder that outlives the session.

    A new session finds an index again by its folder and bucket count. ``add`` finds new digests by a
    sort-merge anti-join, for which the stored side needs no shuffle, and appends them. Rows of an
    earlier batch stay; within a batch the largest doc_id stays.
    """

    def __init__(self, spark: SparkSession, folder: str, name: str, buckets: int):
        self.spark, self.name = spark, name
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in INDEX)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (digest) "
                  f"SORTED BY (digest) INTO {int(buckets)} BUCKETS LOCATION '{folder}'")
        self.buckets = int(buckets)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, docs: DataFrame) -> DataFrame:
        """Decide on each row of ``docs`` (doc_id, text), and append what is new.

        Returns one row per input row: doc_id, keep_id, group_size, kept, text_sha256. ``group_size``
        counts the rows of the batch that brought a digest in. A null text is an empty one. Rows that
        repeat both text and kept doc_id are all marked kept; a null doc_id stays only in a group of
        nulls. Other columns are ignored. An empty table gives no row.
        """
        rows = store(self.spark, docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("digest")))
        # Stored, as the anti-join would otherwise be pushed below the grouping and meet every copy of a hot text.
        groups = store(self.spark, rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
        new = store(self.spark, groups.hint("merge").join(self.table().select("digest").hint("merge"), "digest", "left_anti"))
        # Hash partitions are the buckets, so a task writes one sorted file.
        new.repartition(self.buckets, "digest").select(*INDEX.names).write.insertInto(self.name)
        return self._decide(rows)

    def _decide(self, rows: DataFrame) -> DataFrame:
        """Look the digests up. Hot ones, of which a thousand exist at most, go by broadcast."""
        least = max(2, -(-rows.count() // HOT_SHARE))
        hot = F.broadcast(rows.groupBy("digest").count().filter(F.col("count") >= least).select("digest"))
        index = self.table()
        found = rows.join(F.broadcast(index.join(hot, "digest", "left_semi")), "digest").unionByName(
            rows.join(hot, "digest", "left_anti").hint("merge").join(index.hint("merge"), "digest"))
        return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                            F.col("digest").alias("text_sha256"))
