"""The processed zone: cleaned entities between the cleaning job and the staging load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from bookpipe.functions.dates import cut_to_millis
from bookpipe.schemas import CODEC

# The exchange format of the processed zone.
MILLIS = "yyyy-MM-dd HH:mm:ss.SSS"
CSV_OPTIONS = {"sep": "|", "quote": '"', "escape": '"', "header": True}


def write_processed_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """Gzip CSV with ``|``; the folder is replaced and timestamps are cut to milliseconds.

    One file per task, or a fixed number of ``files``, into which all rows are then gathered.
    Like any such file, it holds no difference between null and the empty string, and values lose
    blanks at their ends.
    """
    rows = df if files is None else df.repartition(files)
    (
        rows.write.mode("overwrite").options(**CSV_OPTIONS)
        .option("compression", "gzip")
        .option("timestampFormat", MILLIS).option("timestampNTZFormat", MILLIS)
        .csv(path)
    )


def read_processed_csv(spark: SparkSession, path: str, layout: StructType) -> DataFrame:
    """Rows of a processed CSV folder. Columns are positional; a line break in a value survives."""
    return (
        spark.read.schema(layout).options(**CSV_OPTIONS).option("multiLine", True)
        .option("timestampFormat", MILLIS).option("timestampNTZFormat", MILLIS)
        .csv(path)
    )


def write_processed(df: DataFrame, path: str) -> None:
    """Parquet with the same timestamp precision; the folder is replaced."""
    df.select([
        cut_to_millis(F.col(field.name)).alias(field.name)
        if isinstance(field.dataType, TimestampNTZType) else F.col(field.name)
        for field in df.schema
    ]).write.mode("overwrite").option("compression", CODEC).parquet(path)

