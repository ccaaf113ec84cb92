"""What the operators share: Arrow rows, word hashes, written intermediates."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookpipe.session import shared_folder

BASE = 0x9E3779B97F4A7C15
MIX = np.uint64(0xD6E8FEB86659FD93)
BLOCK = 1 << 18


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store(spark: SparkSession, frame: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors.

    The shuffle files that led to the rows are not needed any more and go when they are written.
    """
    path = f"{shared_folder(spark)}/part"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        frame.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(path)


def held_out(modulus: int, remainder: int):
    """crc32 of the doc_id as text, modulo ``modulus``, is ``remainder``; a null doc_id counts as the text ''."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus == remainder


def texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """UTF-8 bytes of a text column, one at a time; null is empty."""
    for value in batch.column(name).cast(pa.binary()):
        yield value.as_py() or b""


def emit(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


@cache
def _table(ascii_space: bool) -> np.ndarray:
    """Which bytes belong to words: all but blanks, or ASCII letters, digits and bytes from 0x80."""
    table = np.ones(256, bool) if ascii_space else np.zeros(256, bool)
    if ascii_space:
        table[[0x20, *range(0x09, 0x0E)]] = False
    else:
        for low, high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
            table[low : high + 1] = True
    return table


_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    h = (h ^ (h >> np.uint64(29))) * MIX
    return h ^ (h >> np.uint64(32))


def spans(data: np.ndarray, ascii_space: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word of a byte array."""
    edge = np.diff(np.concatenate(([False], _table(ascii_space)[data], [False])).view(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(text: bytes, ascii_space: bool = True, fold: bool = True) -> np.ndarray:
    """A 64-bit hash of each word, A-Z lower-cased unless ``fold`` is false."""
    data = np.frombuffer(text.lower() if fold else text, np.uint8)
    return hash_spans(data, *spans(data, ascii_space))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes between each start and end, in order.

    A word's polynomial is a difference of prefix sums; they are taken block by block, so memory
    beyond the result does not grow with a text of ordinary words.
    """
    out = np.empty(len(starts), np.uint64)
    cuts = np.searchsorted(starts, np.arange(0, len(data) + BLOCK, BLOCK))
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        if i == j:
            continue
        low, high = starts[i], ends[j - 1]
        up, down = _power(max(BLOCK, int(high - low)))
        part = (data[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part, dtype=np.uint64)))
        out[i:j] = (sums[ends[i:j] - low] - sums[starts[i:j] - low]) * down[starts[i:j] - low]
    return mixed(out)


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` words; of fewer words, one hash of them all; of none, nothing."""
    if not len(words):
        return words
    size = min(n, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = mixed(out * MIX + words[k : len(words) - size + 1 + k])
    return out


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of rows with equal keys from a partition sorted by these keys."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
        change = np.zeros(table.num_rows - 1, bool)
        for key in keys:
            column = table.column(key).to_numpy()
            change |= column[1:] != column[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1)]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            yield table.slice(i, j - i)
        rest = table.slice(cuts[-1])
    if rest is not None:
        yield rest
