"""Packing by concatenate and cut: prefix sums over partition totals give global offsets."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import cache
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bookpipe.llm.text import emit, store, texts

END = 1
CACHED_WORDS = 400_000
# Rows of an Arrow batch.
ROWS = 500
PUNCTUATION = ".,!?|$%&*#;:"

TOKENS = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("before", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])
PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])


def _bytes(ids: list[int]) -> bytes:
    return pack_ids(f"<{len(ids)}I", *ids)


class WordEncoder:
    """Ids of a text as little-endian unsigned 32-bit integers, word by word.

    The vocabulary's pieces never span white space, so a text's ids are those of its words. Words are
    kept in a cache of bounded size. Plain Latin words go to the model directly, which spares the
    general normaliser; all others take the whole way.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words: dict[bytes, bytes] = {}
        self.stems: dict[str, bytes] = {}
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in printed]
        # The byte-level alphabet: printable Latin-1 stands for itself, the rest follows from 256 on.
        self.alphabet = {b: chr(b) for b in printed} | {b: chr(256 + i) for i, b in enumerate(other)}

    def _whole(self, word: str) -> bytes:
        return _bytes(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def _stem(self, stem: str) -> bytes:
        found = self.stems.get(stem)
        if found is None:
            if len(self.stems) >= CACHED_WORDS:
                self.stems.clear()
            piece = stem if stem.isascii() else stem.encode().decode("latin-1").translate(self.alphabet)
            found = self.stems[stem] = _bytes([t.id for t in self.model.tokenize(piece)])
        return found

    def word(self, raw: bytes) -> bytes:
        word = raw.decode()
        lowered = word.lower()
        stem = lowered.rstrip(PUNCTUATION)
        if stem.isalpha() and (stem.isascii() or max(stem) < "ɐ"):
            tail = lowered[len(stem) :]
            found = self._stem(stem)
            if tail:
                if (ids := self.words.get(tail.encode())) is None:
                    ids = self.words[tail.encode()] = self._whole(tail)
                found += ids
        else:
            found = self._whole(word)
        if len(self.words) >= CACHED_WORDS:
            self.words.clear()
        self.words[raw] = found
        return found

    def encode(self, text: bytes) -> bytes:
        known = self.words.get
        return b"".join([known(w) or self.word(w) for w in text.split()])


@cache
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _tokens(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, before = encoder(path).encode, TaskContext.get().partitionId(), 0
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                ids = encode(text) + END.to_bytes(4, "little")
                n = len(ids) // 4
                # Ids below 2 ** 16 are stored in two bytes.
                out.append((part, doc_id, before, n, np.frombuffer(ids, "<u4").astype("<u2").tobytes()))
                before += n
                if len(out) >= ROWS:
                    yield emit(TOKENS, zip(*out, strict=True))
                    out = []
            if out:
                yield emit(TOKENS, zip(*out, strict=True))
    return run


def _cut(length: int, with_ids: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, at, stored in zip(batch.column("doc_id").to_pylist(), batch.column("at").to_pylist(), batch.column("ids"), strict=True):
                ids = np.frombuffer(stored.as_py(), "<u2").astype("<u4").tobytes()
                n, start = len(ids) // 4, 0
                while start < n:
                    end = min(n, start + length - (at + start) % length)
                    piece = ids[4 * start : 4 * end]
                    out.append((doc_id, start, end - start, zlib.crc32(piece), n, (at + start) // length, (at + start) % length, piece if with_ids else None))
                    start = end
                if len(out) >= ROWS:
                    yield emit(PIECES, zip(*out, strict=True))
                    out = []
            if out:
                yield emit(PIECES, zip(*out, strict=True))
    return run


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str, length: int = 2048, with_ids: bool = False) -> DataFrame:
    """Lay the ids of all documents, each with a final id 1, end to end and cut them every ``length`` ids.

    First pass: a task writes its documents' ids with the number of ids that precede them in the task.
    The totals of the tasks, one row each, become the tasks' offsets by a running sum. Second pass: the
    written rows, now with global offsets, are cut. Only the last sequence is not full. As both passes
    see the same files, a repeated task gives the same rows.

    One row per piece; ``ids`` is filled on request. A null or empty text is the final id alone. Rows
    with equal or null doc_id are packed each on its own. An empty table gives no row. Other columns are
    ignored. The vocabulary must have at most 2 ** 16 ids.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    written = store(spark, rows.mapInArrow(_tokens(tokenizer), "part int, doc_id long, before long, doc_tokens long, ids binary"))
    totals = written.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    # One row per task of the first pass; a million tasks are 16 MB.
    base = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    placed = written.join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("before")).alias("at"), "ids")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    return placed.mapInArrow(_cut(length, with_ids), schema)
