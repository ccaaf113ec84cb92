"""Fit rows to a table layout by column name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bookpipe.schemas import RECORD_DATE, TS


def align(df: DataFrame, layout: StructType, renames: Mapping[str, str] | None = None) -> DataFrame:
    """The layout's columns in its order and types.

    Renamed columns are found under their old name, missing ones become typed nulls, extra ones are
    left out. A value that does not fit the target type fails the job and is not damaged silently.
    """
    df = df.withColumnsRenamed({old: new for old, new in (renames or {}).items() if old in df.columns})
    present = set(df.columns)
    return df.select([
        (F.col(field.name) if field.name in present else F.lit(None)).cast(field.dataType).alias(field.name)
        for field in layout
    ])


def with_load_time(df: DataFrame, ts: str = TS) -> DataFrame:
    """Add the load time as record timestamp if the input has no such column.

    A null that was supplied stays null.
    """
    return df if ts in df.columns else df.withColumn(ts, F.localtimestamp())


def with_record_date(df: DataFrame, ts: str = TS) -> DataFrame:
    """Add the day of the timestamp, as warehouse reviews store it."""
    return df.withColumn(RECORD_DATE, F.col(ts).cast("date"))


def clustered(df: DataFrame, column: str) -> DataFrame:
    """Shuffle the rows into narrow ranges of a column, so that filters on it skip most files.

    The row number is the second range column: a value that holds many of the rows is split. The
    input must be read from files, whose row order survives a lost executor.
    """
    row = "__row"
    return (
        df.withColumn(row, F.monotonically_increasing_id())
        .repartitionByRange(column, row).drop(row)
        .sortWithinPartitions(column)
    )
