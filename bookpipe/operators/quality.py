"""Non-empty checks."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class EmptyTableError(ValueError):
    """A gated table has no rows."""


def non_empty_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count, passed), one row per table."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", (F.col("row_count") >= 1).alias("passed"))
        for name, df in tables.items()
    ])


def gate(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Row counts of the tables; raises with the first empty one in the given order."""
    counts = {row.table_name: row.row_count for row in non_empty_report(tables).collect()}
    for name in tables:
        if counts[name] < 1:
            raise EmptyTableError(f"table {name} has no rows")
    return counts
