"""The supplied star-schema tables seen as the four entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookpipe.operators.align import align
from bookpipe.schemas import TS, WAREHOUSE_AUTHORS, BOOKS, USERS

POSTED = "EEE MMM dd HH:mm:ss '-0800' yyyy"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def posted_text(moment: Column) -> Column:
    """A date as the sources write it."""
    return F.date_format(moment, POSTED)


def review_id():
    """One number per order line."""
    return (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("review_id")


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """One review per order line, without the reviewer: no join is needed."""
    return table(spark, folder, "lineitem").select(
        review_id(), F.col("l_partkey").alias("book_id"),
        F.col("l_suppkey").alias("author_id"), F.col("l_quantity").alias("review_rating"),
        F.col("l_shipdate").alias(TS))


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with their orders as reviews; dates as raw text.

    Both tables grow with the data, so the join shuffles, which also spreads lines that are stored
    as one row group over the tasks.
    """
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders").hint("merge")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        review_id(), F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("book_id"), F.col("l_suppkey").alias("author_id"),
        F.col("l_quantity").alias("review_rating"),
        posted_text(F.col("o_orderdate")).alias("review_added_date"),
        posted_text(F.col("l_shipdate")).alias("review_updated_date"),
        F.col("l_shipdate").alias(TS))


def authors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("author_id"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("average_rating"))


def books(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("book_id"), F.col("p_name").alias("title"),
        F.col("p_brand").alias("publisher"), F.col("p_type").alias("format"),
        F.col("p_size").alias("num_pages"), F.col("p_retailprice").alias("average_rating"))


def users(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("user_name"),
        F.col("c_mktsegment").alias("location"))


def activity(spark: SparkSession, folder: str) -> DataFrame:
    """Events as reviews: real sub-second timestamps over thirty days."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("review_id"), F.col("user_id").alias("author_id"),
        F.col("ts").alias(TS))


def author_dimension(spark: SparkSession, folder: str) -> DataFrame:
    return align(authors(spark, folder), WAREHOUSE_AUTHORS)


def book_dimension(spark: SparkSession, folder: str) -> DataFrame:
    return align(books(spark, folder), BOOKS)


def user_dimension(spark: SparkSession, folder: str) -> DataFrame:
    return align(users(spark, folder), USERS)


def active_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """Customers in the author layout: the dimension of ``activity``."""
    people = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("author_id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("average_rating"))
    return align(people, WAREHOUSE_AUTHORS)


def write_raw(df: DataFrame, path: str) -> None:
    """Raw CSV as a source delivers it: comma, header, doubled quotes, values unchanged."""
    (
        df.write.options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
                         ignoreTrailingWhiteSpace=False, timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS")
        .csv(path)
    )
