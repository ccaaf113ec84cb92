"""Substring dedup by maximal repeats of an enhanced suffix array."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookpipe.llm.rowkeys import separately
from bookpipe.llm.text import _power, emit, mixed, runs, store, texts

LENGTH = 100
# Anchors are runs of GRAM bytes; every window of LENGTH bytes holds LENGTH - GRAM + 1 of them.
GRAM = 32
BLOCK_WINDOWS, PLACE = 1 << 19, np.uint64((1 << 20) - 1)
# Distinct contexts of one anchor from which on its windows are dealt out by their own bytes.
HOT_CONTEXTS = 5_000
# Suffixes that one array sorts at a time.
SUFFIXES = 200_000

ANCHORS = pa.schema([("fp", pa.int64()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("twice", pa.bool_())])
OCCURRENCES = pa.schema([("fp", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("doc_id", pa.int64()), ("low", pa.int64()), ("context", pa.binary())])
OCCURRENCE_TYPE = "fp long, k1 long, k2 long, doc_id long, low long, context binary"
GROUPS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()), ("group", pa.int64()),
                    ("first_doc", pa.int64()), ("first_start", pa.int64())])
GROUP_TYPE = "k1 long, k2 long, offset long, length long, group long, first_doc long, first_start long"
CUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])
CUT_TYPE = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` bytes, from differences of a polynomial's prefix sums."""
    up, down = _power(max(1 << 18, len(data)))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64)))
    return mixed((sums[size:] - sums[:-size]) * down[: len(data) - size + 1])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while 2 * step <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def anchors(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprint, first window, last window): each window of ``length`` bytes belongs to its least run of GRAM bytes.

    Of equal runs the leftmost counts. The choice depends on the window's bytes alone, so equal windows
    belong to equal anchors; an anchor's windows follow each other.
    """
    data = np.frombuffer(text, np.uint8)
    windows, width = len(data) - length + 1, length - GRAM + 1
    out = [np.zeros((3, 0), np.int64)]
    for low in range(0, windows, BLOCK_WINDOWS):
        n = min(BLOCK_WINDOWS, windows - low)
        grams = gram_hashes(data[low : low + n + length - 1], GRAM)
        at = sliding_least((grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64), width) & PLACE
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        last = np.append(first[1:], n) - 1
        out.append(np.stack((grams[at[first].astype(np.int64)].view(np.int64), first + low, last + low)))
    return tuple(np.concatenate(out, axis=1))


def _anchor_rows(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, docs, keys, twice = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                found, counts = np.unique(anchors(text, length)[0], return_counts=True)
                names.append(found)
                twice.append(counts > 1)
                docs.append(np.full(len(found), doc_id, np.int64))
                keys.append(np.full(len(found), xxhash.xxh3_64_intdigest(text), np.uint64).view(np.int64))
            if names:
                yield emit(ANCHORS, map(np.concatenate, (names, docs, keys, twice)))
    return run


def _keys(context: bytes) -> tuple[int, int]:
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(context), np.int64).tolist())


def _occurrences(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text, repeated in zip(batch.column("doc_id").to_pylist(), texts(batch), batch.column("fps"), strict=True):
                names, low, high = anchors(text, length)
                hit = np.flatnonzero(np.isin(names, repeated.values.to_numpy()))
                for fp, i, j in zip(names[hit].tolist(), low[hit].tolist(), high[hit].tolist(), strict=True):
                    context = text[i : j + length]
                    out.append((fp, *_keys(context), doc_id, i, context))
                if len(out) >= 20_000:
                    yield emit(OCCURRENCES, zip(*out, strict=True))
                    out = []
            if out:
                yield emit(OCCURRENCES, zip(*out, strict=True))
    return run


def _by_window(length: int):
    """Deal a context out to its windows; each goes by its own bytes."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, low, context in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "low", "context")), strict=True):
                for j in range(len(context) - length + 1):
                    window = context[j : j + length]
                    keys = _keys(window)
                    out.append((keys[0], *keys, doc_id, low + j, window))
                if len(out) >= 20_000:
                    yield emit(OCCURRENCES, zip(*out, strict=True))
                    out = []
            if out:
                yield emit(OCCURRENCES, zip(*out, strict=True))
    return run


def suffix_array(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of suffixes text[start:end] within their buckets, and common prefixes with their predecessors (0 in a new bucket)."""
    width = int((ends - starts).max())
    padded = np.concatenate((text, np.zeros(width, np.uint8)))
    rows = np.lib.stride_tricks.sliding_window_view(padded, width)[starts].copy()
    rows[np.arange(width) >= (ends - starts)[:, None]] = 0
    head = bucket.astype(">u4").view(np.uint8).reshape(-1, 4)
    order = np.argsort(np.concatenate((head, rows), axis=1).view(f"S{width + 4}").ravel(), kind="stable")
    rows, size = rows[order], (ends - starts)[order]
    unequal = rows[1:] != rows[:-1]
    common = np.where(unequal.any(axis=1), unequal.argmax(axis=1), width)
    common = np.minimum(common, np.minimum(size[1:], size[:-1]))
    common[bucket[order][1:] != bucket[order][:-1]] = 0
    return order, np.concatenate(([0], common))


def intervals(common: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Common-prefix intervals (length, first, last) of at least ``least`` bytes, found with a stack."""
    found, stack = [], []
    lengths = [*common.tolist(), 0]
    for i in range(1, len(lengths)):
        here, start = lengths[i] if lengths[i] >= least else 0, i - 1
        while stack and stack[-1][0] > here:
            size, start = stack.pop()
            found.append((size, start, i - 1))
        if here and (not stack or stack[-1][0] < here):
            stack.append((here, start))
    return found


def repeat_groups(contexts: list[bytes], bucket: np.ndarray, length: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(length, [(context, offset)]) of the repeats between the distinct contexts of each bucket.

    An interval whose members are all preceded by the same byte is part of one that starts a byte
    earlier, and is left out. A member that opens its context counts as preceded by a byte of its own.
    """
    sizes = np.array([len(c) for c in contexts], np.int64)
    ends = sizes.cumsum()
    text = np.frombuffer(b"".join(contexts), np.uint8)
    count = sizes - length + 1
    owner = np.repeat(np.arange(len(contexts)), count)
    offset = np.arange(count.sum()) - np.repeat(count.cumsum() - count, count)
    starts = (ends - sizes)[owner] + offset
    # Suffixes whose first bytes no other has, or whose equals all have one left neighbour, are not sorted.
    head = mixed(gram_hashes(text, length)[starts] ^ mixed(bucket[owner].astype(np.uint64)))
    _, code, times = np.unique(head, return_inverse=True, return_counts=True)
    left = np.where(offset > 0, text[starts - 1].astype(np.int64), 256 + owner)
    low, high = np.full(len(times), 1 << 40), np.full(len(times), -1)
    np.minimum.at(low, code, left)
    np.maximum.at(high, code, left)
    rest = np.flatnonzero((times[code] > 1) & (low[code] != high[code]))
    if not len(rest):
        return
    order, common = suffix_array(text, starts[rest], ends[owner[rest]], bucket[owner[rest]])
    order = rest[order]
    owner, offset, left = owner[order].tolist(), offset[order].tolist(), left[order].tolist()
    for size, i, j in intervals(common, length):
        if len(set(left[i : j + 1])) > 1:
            yield size, list(zip(owner[i : j + 1], offset[i : j + 1], strict=True))


def _groups(length: int):
    def found(held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        table = pa.concat_tables(held).combine_chunks()
        k1, k2, doc, low, n, context = (table.column(c).to_pylist() for c in ("k1", "k2", "doc_id", "low", "n", "context"))
        out: list[tuple] = []
        for i, c in enumerate(context):
            if n[i] > 1:
                out.append((k1[i], k2[i], 0, len(c), k1[i], doc[i], low[i]))
        many = np.array([t.num_rows > 1 for t in held])
        bucket = np.repeat(np.arange(len(held)), [t.num_rows for t in held])
        chosen = np.flatnonzero(many[bucket])
        if len(chosen):
            for size, members in repeat_groups([context[i] for i in chosen], bucket[chosen], length):
                members = [(int(chosen[i]), j) for i, j in members]
                first = min((doc[i], low[i] + j) for i, j in members)
                i, j = members[0]
                name = int(np.uint64(xxhash.xxh3_64_intdigest(context[i][j : j + size])).view(np.int64))
                out.extend((k1[i], k2[i], j, size, name, *first) for i, j in members)
        if out:
            yield emit(GROUPS, zip(*out, strict=True))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for group in runs(batches, ["fp"]):
            held.append(group)
            size += group.num_rows * (length - GRAM + 1)
            if size >= SUFFIXES:
                yield from found(held)
                held, size = [], 0
        if held:
            yield from found(held)
    return run


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _whole(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Size and digest of every text."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    return store(spark, _source(docs).select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha256")))


def _groups_and_occurrences(spark: SparkSession, docs: DataFrame, whole: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Repeat groups by context, and where the contexts occur, over one document of each text."""
    source = _source(docs).filter("doc_id IS NOT NULL")
    rows = source.filter(F.octet_length("text") >= length).mapInArrow(_anchor_rows(length), "fp long, doc_id long, text_key long, twice boolean")
    repeated = store(spark, rows.groupBy("fp").agg(F.min("text_key").alias("a"), F.max("text_key").alias("b"), F.max("twice").alias("t")).filter("a <> b OR t").select("fp"))
    first = whole.filter(F.col("n_bytes") >= length).groupBy("sha256").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    hits = rows.select("fp", "doc_id").join(repeated, "fp")
    by_doc = store(spark, hits.groupBy("doc_id").agg(F.collect_set("fp").alias("fps")).join(first, "doc_id"))
    occurrences = store(spark, source.join(by_doc, "doc_id").select("doc_id", "text", "fps").mapInArrow(_occurrences(length), OCCURRENCE_TYPE))
    hot = occurrences.select("fp", "k1", "k2").distinct().groupBy("fp").count().filter(F.col("count") > HOT_CONTEXTS).select("fp")
    hot = store(spark, hot)
    if not hot.isEmpty():
        dealt = occurrences.join(hot, "fp", "left_semi").select(*OCCURRENCES.names).mapInArrow(_by_window(length), OCCURRENCE_TYPE)
        occurrences = occurrences.join(hot, "fp", "left_anti").select(*OCCURRENCES.names).unionByName(dealt)
    # Equal contexts are one, combined before the shuffle, so a passage that many share stays small.
    contexts = occurrences.groupBy("fp", "k1", "k2").agg(F.min(F.struct("doc_id", "low", "context")).alias("x"), F.count("*").alias("n"))
    contexts = contexts.select("fp", "k1", "k2", "n", "x.*").repartition("fp").sortWithinPartitions("fp", "doc_id", "low")
    groups = store(spark, contexts.mapInArrow(_groups(length), GROUP_TYPE))
    return groups, occurrences.drop("context", "fp")


def maximal_repeats(spark: SparkSession, docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Repeats of at least ``length`` bytes with all their occurrences: group, length, doc_id, start, first.

    Equal texts are looked at once, by the least doc_id. Windows are dealt out by content-chosen anchors,
    and anchors that occur once are dropped. A bucket holds the contexts of one anchor: the bytes of the
    windows that belong to it. A suffix array of the contexts with common-prefix lengths is scanned
    with a stack; the intervals that cannot be extended to the left are the groups. A repeat longer than
    a context is reported as the groups of its anchors, which overlap. Texts that share a doc_id are
    documents of their own.
    """
    return separately(spark, docs, lambda own: _repeats(spark, own, length))


def _repeats(spark: SparkSession, docs: DataFrame, length: int) -> DataFrame:
    whole = _whole(spark, docs)
    groups, occurrences = _groups_and_occurrences(spark, docs, whole, length)
    found = groups.join(occurrences, ["k1", "k2"]).withColumn("start", F.col("low") + F.col("offset"))
    return found.select("group", "length", "doc_id", "start", ((F.col("doc_id") == F.col("first_doc")) & (F.col("start") == F.col("first_start"))).alias("first")).distinct()


def _cut(with_text: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text, spans in zip(batch.column("doc_id").to_pylist(), texts(batch), batch.column("spans"), strict=True):
                kept, removed, count, at = [], 0, 0, 0
                starts, ends = (spans.values.field(c).to_numpy() for c in ("start", "end"))
                order = np.argsort(starts, kind="stable")
                reach = np.maximum.accumulate(ends[order])
                new = np.flatnonzero(np.concatenate(([True], starts[order][1:] > reach[:-1])))
                for i, j in zip(starts[order][new].tolist(), reach[np.append(new[1:], len(reach)) - 1].tolist(), strict=True):
                    kept.append(text[at:i])
                    removed, count, at = removed + j - i, count + 1, j
                kept.append(text[at:])
                rest = b"".join(kept)
                out.append((doc_id, len(text), removed, count, hashlib.sha256(rest).hexdigest(), rest if with_text else None))
            if out:
                yield emit(CUT, zip(*out, strict=True))
    return run


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """Remove each byte covered by ``length`` bytes that start earlier too: in a smaller doc_id, or before in the document.

    One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, on request, the bytes
    ``kept``, which may end within a character. Null is an empty text; texts shorter than ``length`` stay.
    Of equal texts all but the least doc_id's go as a whole. Equal rows are one document and not removed
    against each other; texts that share a doc_id are documents of their own, in the order of their
    digests. A null doc_id takes no part. Other columns are ignored; an empty table gives no row.
    """
    return separately(spark, docs, lambda own: _removed(spark, own, length, with_text))


def _removed(spark: SparkSession, docs: DataFrame, length: int, with_text: bool) -> DataFrame:
    whole = _whole(spark, docs)
    groups, occurrences = _groups_and_occurrences(spark, docs, whole, length)
    later = groups.join(occurrences, ["k1", "k2"]).withColumn("start", F.col("low") + F.col("offset")).filter(
        "NOT (doc_id = first_doc AND start = first_start)")
    spans = store(spark, later.select("doc_id", "start", (F.col("start") + F.col("length")).alias("end")).groupBy("doc_id").agg(
        F.collect_set(F.struct("start", "end")).alias("spans")))
    cut = _source(docs).join(spans, "doc_id").select("doc_id", "text", "spans").mapInArrow(_cut(with_text), CUT_TYPE)
    if with_text:
        text = F.coalesce("text", F.lit("")).cast("binary")
        whole = _source(docs).select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha256"), text.alias("kept"))
    else:
        cut = cut.drop("kept")
    first = whole.groupBy("sha256").agg(F.min("doc_id").alias("first_id"))
    rest = whole.join(spans.select("doc_id"), "doc_id", "left_anti").join(first, "sha256")
    gone = F.coalesce((F.col("n_bytes") >= length) & (F.col("doc_id") > F.col("first_id")), F.lit(False))
    left = {"doc_id": F.col("doc_id"), "n_bytes": F.col("n_bytes"), "n_removed": F.when(gone, F.col("n_bytes")).otherwise(F.lit(0)),
            "n_spans": gone.cast("long"), "kept_sha256": F.when(gone, F.sha2(F.lit(b""), 256)).otherwise(F.col("sha256"))}
    if with_text:
        left["kept"] = F.when(gone, F.lit(b"")).otherwise(F.col("kept"))
    return cut.unionByName(rest.select(*(c.alias(k) for k, c in left.items())))
