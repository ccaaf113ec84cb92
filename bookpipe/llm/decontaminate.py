"""Benchmark decontamination by SimHash windows of the items' sizes."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookpipe.llm.text import emit, mixed, shingles, texts, word_hashes

WORDS, SIMILARITY = 5, 0.8
# Fingerprints within RADIUS of 64 bits agree, in one of BLOCKS blocks of 8 bits, up to RADIUS // BLOCKS bits.
RADIUS, BLOCKS = 15, 8
# Items that one scan of the documents holds; more items take further scans.
ITEMS_PER_SCAN = 20_000
# Words and window-item cells that are compared at a time, so that a very long text needs no more memory.
WORD_BLOCK, CELLS = 1 << 16, 1 << 22

LEAKS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("n_words", pa.int64()),
                   ("similarity", pa.float64()), ("hamming", pa.int64())])
_NEAR_BYTES = np.array([[bin(a ^ b).count("1") <= RADIUS // BLOCKS for b in range(256)] for a in range(256)])


def words_of(text: bytes) -> np.ndarray:
    """Hashes of runs of ASCII letters, digits and bytes from 0x80; A-Z are lower-cased."""
    return word_hashes(text, ascii_space=False)


def fingerprints(words: np.ndarray, size: int, starts: np.ndarray) -> np.ndarray:
    """SimHash of windows of ``size`` words: bit by bit, whether more of the words' hashes have it than not."""
    low = int(starts.min())
    part = words[low : int(starts.max()) + size]
    bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32)
    sums = np.concatenate((np.zeros((1, 64), np.int32), bits.cumsum(axis=0, dtype=np.int32)))
    ones = sums[starts - low + size] - sums[starts - low]
    return np.packbits(2 * ones > size, axis=1).view(np.uint64).ravel()


@dataclass
class Items:
    """Items of one word count, with a multi-index over the blocks of their fingerprints."""

    ids: list[int]
    words: list[np.ndarray]

    def __post_init__(self):
        self.size = len(self.words[0])
        self.prints = np.concatenate([fingerprints(w, self.size, np.zeros(1, np.int64)) for w in self.words])
        self.blocks = self.prints.view(np.uint8).reshape(-1, BLOCKS)
        self.grams = [np.unique(shingles(w, WORDS), return_counts=True) for w in self.words]
        # For each block: which items does a value of it lead to?
        self.index = [_NEAR_BYTES[:, self.blocks[:, b]] for b in range(BLOCKS)]

    def within_radius(self, prints: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(window, item, distance) for all fingerprints within the radius, found by the blocks."""
        step = max(1, CELLS // len(self.ids))
        for low in range(0, len(prints), step):
            part = prints[low : low + step]
            values = part.view(np.uint8).reshape(-1, BLOCKS)
            found = self.index[0][values[:, 0]]
            for b in range(1, BLOCKS):
                found |= self.index[b][values[:, b]]
            window, item = np.nonzero(found)
            distance = np.bitwise_count(part[window] ^ self.prints[item])
            near = distance <= RADIUS
            yield from zip((window[near] + low).tolist(), item[near].tolist(), distance[near].tolist(), strict=True)


def overlap(item: tuple[np.ndarray, np.ndarray], window: np.ndarray) -> float:
    """Weight of the shingles that item and window share, by the item's weight; a shingle weighs its count."""
    names, counts = np.unique(window, return_counts=True)
    _, i, j = np.intersect1d(item[0], names, assume_unique=True, return_indices=True)
    return float(np.minimum(item[1][i], counts[j]).sum() / item[1].sum())


class Benchmark:
    def __init__(self, items: list[tuple[int, bytes]]):
        by_size: dict[int, list[tuple[int, np.ndarray]]] = defaultdict(list)
        for item_id, text in items:
            words = words_of(text)
            if len(words):
                by_size[len(words)].append((item_id, words))
        self.sizes = {n: Items([i for i, _ in x], [w for _, w in x]) for n, x in by_size.items()}
        # Long items by shingle; items of under WORDS words by their only, shorter shingle.
        pairs = defaultdict(set)
        for n, x in self.sizes.items():
            for names, _ in x.grams:
                for g in names.tolist():
                    pairs[(min(n, WORDS), g)].add(n)
        self.known = {}
        for k in {k for k, _ in pairs}:
            own = sorted((g, s) for (j, g), s in pairs.items() if j == k)
            self.known[k] = (np.array([g for g, _ in own], np.uint64), [sorted(s) for _, s in own])

    def leaks(self, text: bytes) -> list[tuple[int, int, int, float, int]]:
        """Best window of each item: (item_id, first word, words, similarity, Hamming distance).

        A window without any shingle of the items has similarity 0, so only the others get fingerprints.
        """
        words = words_of(text)
        places: dict[int, list[int]] = defaultdict(list)
        for k, (known, sizes) in self.known.items():
            if len(words) < k:
                continue
            grams = shingles(words, k)
            at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            for p in np.flatnonzero(known[at] == grams).tolist():
                for n in sizes[at[p]]:
                    places[n].append(p)
        best: dict[int, tuple[float, int, int, int]] = {}
        for n, found in places.items():
            items = self.sizes[n]
            for at in _windows(np.array(found), n, len(words)):
                for w, i, distance in items.within_radius(fingerprints(words, n, at)):
                    start = int(at[w])
                    similar = overlap(items.grams[i], shingles(words[start : start + n], WORDS))
                    if similar >= SIMILARITY and (similar, -start) > best.get(items.ids[i], (0.0, 0))[:2]:
                        best[items.ids[i]] = (similar, -start, n, distance)
        return [(i, -s, n, x, d) for i, (x, s, n, d) in sorted(best.items())]


def _windows(places: np.ndarray, size: int, n_words: int) -> Iterator[np.ndarray]:
    """Starts of the windows of ``size`` words around shingles at ``places``, in blocks of the text.

    A text that ends within an item has the item's start or end only, so there may be none.
    """
    first = np.maximum(0, places - size + min(size, WORDS))
    last = np.minimum(places, n_words - size)
    fits = last >= first
    edges = np.zeros(n_words + 1, np.int32)
    np.add.at(edges, first[fits], 1)
    np.add.at(edges, last[fits] + 1, -1)
    starts = np.flatnonzero(edges.cumsum() > 0)
    if len(starts):
        yield from np.split(starts, np.flatnonzero(np.diff(starts // WORD_BLOCK)) + 1)


def _find(benchmark: Benchmark):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(d.as_py(), *x) for d, t in zip(batch.column("doc_id"), texts(batch), strict=True) for x in benchmark.leaks(t)]
            if rows:
                yield emit(LEAKS, zip(*rows, strict=True))
    return run


def find_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, items_per_scan: int = ITEMS_PER_SCAN) -> DataFrame:
    """Passages of documents that hold a benchmark item, whole or slightly changed.

    Windows have an item's number of words. Their SimHash is looked up in a multi-index that finds every
    item within ``RADIUS`` bits, and the weighted overlap of 5-word shingles, 0.8 or more, decides.

    One row per document and item, with the best window (the first of equals): doc_id, item_id, start,
    n_words, similarity, hamming. Null and empty texts and items hold nothing. Repeated rows each give
    their rows. Rows with a null doc_id report it as null. Other columns are ignored; empty tables give no row. The items
    go to the tasks in slices of bounded number, with one scan of the documents for each slice.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text IS NOT NULL").distinct()
    slices = -(-items.count() // items_per_scan)
    out = None
    for k in range(max(1, slices)):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, slices))) == k).collect()
        held = Benchmark(sorted((r.item_id if r.item_id is not None else -1, r.text.encode()) for r in part))
        found = source.mapInArrow(_find(held), "doc_id long, item_id long, start long, n_words long, similarity double, hamming long")
        out = found if out is None else out.unionByName(found)
    return out
