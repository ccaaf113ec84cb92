"""Substring dedup by sliding spans of sentences."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookpipe.llm.rowkeys import separately
from bookpipe.llm.text import _power, emit, mixed, spans, store, texts, word_hashes

# A span has at least so many consecutive sentences, and goes on until it has so many words.
SENTENCES, WORDS = 2, 20
_END = re.compile(rb"[.!?]+[ \t\r\x0b\x0c]+|\s*\n\s*")

RUNS = pa.schema([("span", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64()), ("again", pa.bool_())])
CLEANED = pa.schema([("doc_id", pa.int64()), ("n_sentences", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("text", pa.string())])


@dataclass
class Sentences:
    """Sentences of one text that hold words: byte cuts, word ranges, and the spans that begin at them."""

    starts: np.ndarray
    ends: np.ndarray
    names: np.ndarray  # hash of the span that begins at a sentence
    last: np.ndarray  # sentence after its last one; 0 where the text ends before a span is complete


def sentences(text: bytes, least: int = SENTENCES, words: int = WORDS) -> Sentences:
    """Split at line ends and after marks, and hash each span by its words, so that blanks and marks do not count."""
    cuts = np.array([0, *(m.end() for m in _END.finditer(text)), len(text)], np.int64)
    hashes = word_hashes(text, ascii_space=False)
    at, _ = spans(np.frombuffer(text, np.uint8), ascii_space=False)
    first = np.searchsorted(at, cuts)
    full = np.flatnonzero(first[1:] > first[:-1])
    starts, ends = cuts[:-1][full], cuts[1:][full]
    # Pieces without words belong to the sentence before them.
    if len(full):
        ends = np.append(starts[1:], len(text))
        starts = starts.copy()
        starts[0] = 0
    low = np.append(first[:-1][full], len(hashes))
    n = len(full)
    i = np.arange(n)
    last = np.maximum(i + least, np.searchsorted(low, low[:-1] + words))
    up, down = _power(max(1 << 18, len(hashes)))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * up[: len(hashes)], dtype=np.uint64)))
    ok = last <= n
    stop = low[np.minimum(last, n)]
    names = mixed((sums[stop] - sums[low[:-1]]) * down[low[:-1]] + (stop - low[:-1]).astype(np.uint64)).view(np.int64) if n else np.zeros(0, np.int64)
    return Sentences(starts, ends, names, np.where(ok, last, 0))


def _runs(least: int, words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                found = sentences(text, least, words)
                place = np.flatnonzero(found.last)
                names = found.names[place]
                again = np.ones(len(names), bool)
                again[np.unique(names, return_index=True)[1]] = False
                out.append((names, np.full(len(names), doc_id, np.int64), place, again))
            if out:
                yield emit(RUNS, map(np.concatenate, zip(*out, strict=True)))
    return run


def _cleaned(least: int, words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text, places in zip(batch.column("doc_id").to_pylist(), texts(batch), batch.column("places").to_pylist(), strict=True):
                found = sentences(text, least, words)
                gone = np.zeros(len(found.starts) + 1, np.int64)
                for place in places or ():
                    if place < len(found.last) and found.last[place]:
                        gone[place] += 1
                        gone[found.last[place]] -= 1
                gone = gone.cumsum()[:-1] > 0
                kept = text if not gone.any() else b"".join(
                    text[i:j] for i, j, g in zip(found.starts.tolist(), found.ends.tolist(), gone.tolist(), strict=True) if not g)
                out.append((doc_id, len(gone), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()))
                if len(out) >= 500:
                    yield emit(CLEANED, zip(*out, strict=True))
                    out = []
            if out:
                yield emit(CLEANED, zip(*out, strict=True))
    return run


def remove_repeated_spans(spark: SparkSession, docs: DataFrame, least: int = SENTENCES, words: int = WORDS) -> DataFrame:
    """Remove the sentences covered by a span of consecutive sentences that occurred before.

    A span begins at every sentence and has the fewest sentences, ``least`` or more, that hold ``words``
    words. Before means in a smaller doc_id, or earlier in the document. Counts and least doc_ids per span are
    combined before the shuffle; the join back has a frequent span under one key, which adaptive execution splits.

    One row per input row: doc_id, n_sentences, n_removed, kept_sha256 and the rest of the text. Null is an
    empty text; a text without a complete span stays whole. Equal rows are one document and are not removed
    against each other; texts that share a doc_id are documents of their own, in the order of their
    digests. A null doc_id takes no part. Other columns are ignored; an empty table gives no row.
    """
    return separately(spark, docs, lambda own: _removed(spark, own, least, words))


def _removed(spark: SparkSession, docs: DataFrame, least: int, words: int) -> DataFrame:
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = source.filter("doc_id IS NOT NULL").mapInArrow(_runs(least, words), "span long, doc_id long, place long, again boolean")
    repeated = store(spark, rows.groupBy("span").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).filter("n > 1").select("span", "first"))
    later = rows.join(repeated, "span").filter("doc_id <> first OR again")
    places = store(spark, later.groupBy("doc_id").agg(F.collect_set("place").alias("places")))
    return source.join(places, "doc_id", "left").select("doc_id", "text", "places").mapInArrow(
        _cleaned(least, words), "doc_id long, n_sentences long, n_removed long, kept_sha256 string, text string")
