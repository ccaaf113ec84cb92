"""Strict time windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookpipe.schemas import RECORD_DATE, TS


def day_bounds(ds: str) -> tuple[str, str]:
    """First and last microsecond of the day ``YYYY-MM-DD``."""
    day = date.fromisoformat(ds).isoformat()
    return f"{day} 00:00:00.000000", f"{day} 23:59:59.999999"


def within(df: DataFrame, low: str, high: str, ts: str = TS) -> DataFrame:
    """Rows with ``low < ts < high``.

    Both bounds are strict, so a row exactly on a bound is outside; that is the stated meaning of
    the daily rankings. The bounds are folded to literals of the column's own type and pushed to
    the scan. Where the table has a record date, row groups of other days are skipped by it.
    """
    kind = df.schema[ts].dataType
    inside = (F.col(ts) > F.lit(low).cast(kind)) & (F.col(ts) < F.lit(high).cast(kind))
    if RECORD_DATE in df.columns:
        inside &= F.col(RECORD_DATE).between(F.lit(low[:10]).cast("date"), F.lit(high[:10]).cast("date"))
    return df.where(inside)


def day_window(df: DataFrame, ds: str, ts: str = TS) -> DataFrame:
    """Rows strictly inside the day."""
    return within(df, *day_bounds(ds), ts=ts)
