"""Upsert by key: drop target rows whose key is staged, then add every staged row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPREAD = "__key_hash"


def _match(target: DataFrame, staging: DataFrame, key: str, how: str, few: bool = False) -> DataFrame:
    if few:
        return target.join(F.broadcast(staging.select(key)), key, how).select(target.columns)
    # The distinct step stops copies of one staged key from gathering. The hash as a second join
    # column makes Spark shuffle the distinct keys once more, directly below the join: only then
    # can adaptive execution split a hot key of the target.
    keys = staging.select(key).distinct().withColumn(_SPREAD, F.xxhash64(key))
    return (
        target.withColumn(_SPREAD, F.xxhash64(key)).join(keys, [key, _SPREAD], how)
        .select(target.columns)
    )


def replaced(target: DataFrame, staging: DataFrame, key: str) -> DataFrame:
    """Target rows that the upsert will delete."""
    return _match(target, staging, key, "left_semi")


def replaced_keys(target: DataFrame, staging: DataFrame, key: str) -> DataFrame:
    """Keys that the upsert will delete, once each. Reads and shuffles nothing but keys."""
    return replaced(target.select(key), staging, key).distinct()


def survivors(target: DataFrame, staging: DataFrame, key: str, few: bool = False) -> DataFrame:
    """Target rows that the upsert will keep. Rows with a null key match nothing and survive.

    ``few`` says that the staged keys were counted and can be broadcast: the target is then
    filtered in place, without a shuffle.
    """
    return _match(target, staging, key, "left_anti", few)


def upsert(target: DataFrame, staging: DataFrame, key: str) -> DataFrame:
    """Survivors plus all staged rows; both sides in the target's columns.

    Applying the same staging twice changes nothing.
    """
    return survivors(target, staging, key).unionByName(staging)


def unchanged_keys(target: DataFrame, staging: DataFrame, key: str) -> DataFrame:
    """Keys whose target rows and staged rows are the same, repeated rows included.

    Rows are compared by sums of hashes per key, combined before the shuffle. The hash passes over
    nulls, so which columns are null is hashed too.
    """
    names = target.columns
    row = F.xxhash64(*names, *[F.isnull(name) for name in names])
    marks = {"n": F.count(F.lit(1)), "high": F.sum(F.shiftright(row, 32)), "low": F.sum(row.bitwiseAND(0xFFFFFFFF))}

    def marked(rows: DataFrame) -> DataFrame:
        return rows.select(names).groupBy(key).agg(*[mark.alias(f"__{name}") for name, mark in marks.items()])

    return marked(target).join(marked(staging), [key, *[f"__{name}" for name in marks]]).select(key)
