"""Latest record per key. Ties on the timestamp are all kept; a null key or timestamp is dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookpipe.schemas import TS

# Largest number of keys that a join may broadcast: a long and a timestamp each, about 100 MB as a
# hashed relation.
BROADCAST_KEYS = 2_000_000
# 64 hashes to a row; so many rows are broadcast at most when there are more keys.
SLOTS = BROADCAST_KEYS
_SPREAD, _SLOT, _MET = "__key_sign", "__slot", "__met"


def latest_lookup(df: DataFrame, key: str, ts: str = TS) -> DataFrame:
    """(key, latest timestamp). Combined before the shuffle, so a hot key costs one row per task."""
    return df.groupBy(key).agg(F.max(ts).alias(ts))


def latest(df: DataFrame, key: str, ts: str = TS) -> DataFrame:
    """Rows that carry their key's latest timestamp, in the input's columns.

    A semi join on (key, timestamp), and not a window over the key: a window would bring all rows
    of a hot key to one task. Hashing on both columns spreads such a key over its timestamps, and
    if most of them tie, adaptive execution splits the row side of the join.
    """
    return df.join(latest_lookup(df, key, ts), [key, ts], "left_semi").select(df.columns)


def superseded(df: DataFrame, key: str, ts: str = TS) -> DataFrame:
    """(key, latest timestamp) for those keys that were seen with more than one timestamp."""
    return (
        df.groupBy(key)
        .agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
        .where(F.col(key).isNotNull() & (F.col("first_ts") < F.col("last_ts")))
        .select(key, "last_ts")
    )


def latest_stored(df: DataFrame, key: str, ts: str = TS,
                  broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """Same rows as ``latest``, for an input that is already in columnar files.

    The superseded keys are found first from two columns and checkpointed. If they are few, they
    are broadcast and the wide rows are filtered where they lie, without a shuffle, however skewed
    they are. Otherwise their hashes are, as bits, and only rows whose key has such a hash are moved.
    """
    changed = superseded(df, key, ts).checkpoint()
    dated = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    if changed.count() <= broadcast_keys:
        return _not_older(dated, F.broadcast(changed), key, ts)
    place = F.pmod(F.xxhash64(key), F.lit(64 * SLOTS))
    slot, bit = F.shiftright(place, 6), F.pmod(place, F.lit(64)).cast("int")
    met = changed.groupBy(slot.alias(_SLOT)).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias(_MET))
    rows = dated.withColumn(_SLOT, slot).join(F.broadcast(met), _SLOT, "left")
    moved = F.coalesce(F.getbit(_MET, bit) == 1, F.lit(False))
    # A second join column makes Spark shuffle the keys once more, directly below the join: only then can adaptive execution
    # split a hot key of the rows. A bit of the hash is enough and hardly adds to what moves.
    sign = (F.xxhash64(key) > 0).alias(_SPREAD)
    kept = _not_older(rows.where(moved).select(*df.columns, sign), changed.select("*", sign), key, ts, F.col(f"rows.{_SPREAD}") == F.col(f"old.{_SPREAD}"))
    return rows.where(~moved).select(df.columns).unionByName(kept.select(df.columns))


def _not_older(df: DataFrame, changed: DataFrame, key: str, ts: str, *also: Column) -> DataFrame:
    """Rows but those that are older than their key's latest timestamp."""
    on = [F.col(f"rows.{key}") == F.col(f"old.{key}"), *also, F.col(f"rows.{ts}") < F.col("old.last_ts")]
    return df.alias("rows").join(changed.alias("old"), on, "left_anti")
