"""Periodic runs of words by a dictionary of basic factors."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookpipe.llm.text import emit, spans, texts, word_hashes

# Words whose factors are named together: short documents share arrays, a longer one has its own.
CHUNK_WORDS = 1 << 18
GATHERED_WORDS = 1 << 16

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])
FOUND_TYPE = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _stretches(at: np.ndarray, gap: np.ndarray, size: int) -> np.ndarray:
    """Runs (start, length, period) from the places whose factor of ``size`` words recurs ``gap`` words on.

    A place and its successors, each ``gap`` on, are an arithmetic progression that proposes ``gap`` as a
    period. Progressions that start at neighbouring places with the same difference tell of the same
    run; joined, they reach as far to both sides as the period holds.
    """
    order = np.argsort(at, kind="stable")
    at, gap = at[order], gap[order]
    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(gap) != 0)) + 1
    first = np.concatenate(([0], cut)).astype(np.int64)
    last = np.concatenate((cut, [len(at)])).astype(np.int64) - 1
    return np.stack((at[first], at[last] - at[first] + gap[first] + size, gap[first]), axis=1)


def factor_runs(words: np.ndarray, owner: np.ndarray, least: int, times: int) -> np.ndarray:
    """Runs (start, length, period) in a sequence of word hashes, by start, then period.

    ``owner`` rises along the sequence and names the document of each word; no run crosses documents.

    Level k names the factors of 2 ** k words: two places have one name if their factors are equal. The name
    of a factor twice as long is the pair of its halves' names. A factor whose name occurs once has no
    repeated extension and leaves. Sorted by name and place, each place stands next to its successor.
    A factor and a successor that both lie within twice its length (``gap <= size``) make a stretch of period
    ``gap``. That is the smallest period there, as a smaller one would have brought a nearer successor. A
    run of period q and at least three times q words is met at the one level where size / 2 < q <= size.
    """
    longest = int(np.bincount(owner).max()) if len(owner) else 0
    at, size, found = np.arange(len(words)), 1, [np.empty((0, 3), np.int64)]
    distinct, name = np.unique(words, return_inverse=True)
    key = owner.astype(np.int64) * max(1, len(distinct)) + name
    while len(at) and size // 2 < max(1, longest // times):
        order = np.argsort(key, kind="stable")
        ranked, place = key[order], at[order]
        same, gap = ranked[1:] == ranked[:-1], np.diff(place)
        near = same & (gap <= size) & (gap > size // 2)
        if near.any():
            found.append(_stretches(place[:-1][near], gap[near], size))
        again = np.zeros(len(at) + 1, bool)
        again[1:-1] = same
        name = np.empty(len(at), np.int64)
        name[order] = np.cumsum(np.concatenate(([False], ~same)))
        recurs = np.empty(len(at), bool)
        recurs[order] = again[1:] | again[:-1]
        at, name = at[recurs], name[recurs]
        if not len(at):
            break
        half = np.minimum(np.searchsorted(at, at + size), len(at) - 1)
        whole = (at[half] == at + size) & (owner[at[half]] == owner[at])
        key = name[whole] * (int(name.max()) + 1) + name[half][whole]
        at, size = at[whole], size * 2
    runs = np.concatenate(found)
    runs = runs[runs[:, 1] >= np.maximum(least, times * runs[:, 2])]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The words between the given bounds, with one space between two."""
    parts = []
    for i in range(0, len(starts), GATHERED_WORDS):
        low, high = starts[i : i + GATHERED_WORDS], ends[i : i + GATHERED_WORDS]
        sizes = high - low + 1
        to = np.cumsum(sizes)
        picked = data[np.minimum(np.arange(to[-1]) + np.repeat(low - (to - sizes), sizes), len(data) - 1)]
        picked[to - 1] = 0x20
        parts.append(picked.tobytes())
    return b"".join(parts)[:-1]


def _chunk(rows: list[tuple], least: int, times: int) -> Iterator[tuple]:
    """Result rows of some documents, given as (doc_id, bytes, starts, ends, word hashes)."""
    counts = np.array([len(row[2]) for row in rows])
    offsets = np.concatenate(([0], np.cumsum(counts)))
    owner = np.repeat(np.arange(len(rows)), counts)
    runs = factor_runs(np.concatenate([row[4] for row in rows]), owner, least, times)
    bounds = np.searchsorted(runs[:, 0], offsets)
    for n, (doc_id, data, starts, ends, _) in enumerate(rows):
        own = runs[bounds[n] : bounds[n + 1]] - (offsets[n], 0, 0)
        if len(own):
            change = np.zeros(len(starts) + 1, np.int64)
            np.add.at(change, own[:, 0] + own[:, 2], 1)
            np.add.at(change, own[:, 0] + own[:, 1], -1)
            kept = np.cumsum(change[:-1]) == 0
            starts, ends = starts[kept], ends[kept]
        listed = [{"start": s, "length": w, "period": q} for s, w, q in own.tolist()]
        yield doc_id, int(counts[n]), listed, _joined(data, starts, ends).decode() if len(starts) else ""


def periodic_runs(docs: DataFrame, least: int = 6, times: int = 4) -> DataFrame:
    """Maximal runs of consecutive words that repeat with a smallest period, of each document.

    Words are what ASCII white space divides; letter case counts. A run of period q has at least ``times`` * q
    and at least ``least`` words, and no neighbouring word prolongs it. ``times`` is 3 or more. Returns a
    row per input row: doc_id, n_words, runs (start as a word number, length, period; by start, then
    period) and collapsed: the words that remain when every run is cut to its first q words, joined by one space.

    Documents are handled where they lie, without a shuffle. Memory is about 100 bytes a word of the longest
    document. Words are compared by 64-bit hashes. A null or empty text has no words, no runs and an empty collapsed text. Rows
    with equal or null doc_id are handled each on its own. An empty table gives no row. Other columns are ignored.
    """
    if times < 3:
        raise ValueError("a run must hold its period three times at least")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                data = np.frombuffer(text, np.uint8)
                rows.append((doc_id, data, *spans(data), word_hashes(text, fold=False)))
                size += len(rows[-1][2])
                if size >= CHUNK_WORDS:
                    yield emit(FOUND, zip(*_chunk(rows, least, times), strict=True))
                    rows, size = [], 0
            if rows:
                yield emit(FOUND, zip(*_chunk(rows, least, times), strict=True))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, FOUND_TYPE)
