"""Top groups, their attributes, and the overlap of two rankings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A ranking is broadcast up to this many rows; each is a key and a number.
BROADCAST_ROWS = 100_000


def top_groups(facts: DataFrame, key: str, measure: Column, name: str, n: int = 10) -> DataFrame:
    """The ``n`` groups with the highest measure; equal ones by ascending key, null measures last.

    Aggregates before the shuffle and keeps ``n`` rows per task, so neither a hot group nor the
    number of groups gathers in one place.
    """
    return (
        facts.groupBy(key).agg(measure.alias(name))
        .orderBy(F.desc_nulls_last(name), F.asc(key))
        .limit(n)
    )


def settle(top: DataFrame, n: int = 10) -> tuple[DataFrame, list]:
    """Compute a ranking of at most ``n`` rows now; gives it back with its keys.

    The driver gets these ``n`` rows, which the caller chose.
    """
    rows = top.collect()
    return top.sparkSession.createDataFrame(rows, top.schema), [row[0] for row in rows]


def enrich(top: DataFrame, dimension: DataFrame, key: str, name: str,
           columns: Mapping[str, str], n: int = 10) -> DataFrame:
    """Attributes for a ranking of at most ``n`` rows. Groups without a dimension row vanish.

    ``columns`` maps dimension columns to result columns. The ranking is bounded by ``n``, so it is
    the side that is broadcast and the dimension is read in place.
    """
    side = F.broadcast(top) if n <= BROADCAST_ROWS else top
    return dimension.select(key, *columns).join(side, key).select(
        key, name, *[F.col(source).alias(result) for source, result in columns.items()])


def overlap(by_average: DataFrame, by_count: DataFrame, key: str, count_name: str) -> DataFrame:
    """Keys in both rankings, with the count and the first ranking's columns."""
    return by_average.join(by_count.select(key, count_name), key)
