"""Phrase collocations by sampling, a counted negative border, and expansion until it is closed."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bookpipe.llm.text import MIX, emit, hash_spans, mixed, spans, store, texts

# Bytes that end a piece, and the mark that stands for them between words.
SEPARATORS, MARK = b".,;:!?\n\x0b\x0c\r", b"."
# Texts are counted together up to about this size; a longer text is counted in blocks of it.
BLOCK_BYTES = 2 << 20
# One document in so many proposes phrases, and a phrase must be seen there so often to be proposed.
SAMPLE_ONE_IN, SAMPLE_LEAST = 16, 2
# A filter has a bit per 16th of a proposed phrase, from 2 ** 16 bits to 2 ** 28 (32 MB).
LEAST_BITS, MOST_BITS, BITS_PER_PHRASE = 16, 28, 16
# Parts into which a language's phrases are dealt to find its first ones.
TOP_PARTS = 64

COUNTS = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])
COUNTS_TYPE = "lang string, words int, phrase string, f long"
HASHED = pa.schema([("hash", pa.int64()), ("f", pa.int64())])
SLOTS = pa.schema([("slot", pa.int64()), ("bits", pa.int64())])


def _bits(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of each hash in a filter."""
    places = np.uint64((1 << bits) - 1)
    return hashes & places, (hashes >> np.uint64(32)) * MIX >> np.uint64(64 - bits)


class Filter:
    """A Bloom filter of phrases, of bounded size. It may take in a phrase that was not put in, and never misses one that was."""

    def __init__(self, bits: int, slots: np.ndarray):
        self.bits, self.slots = bits, slots

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for at in _bits(hashes, self.bits):
            found &= (self.slots[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found

    def joined(self, other: Filter) -> Filter:
        return Filter(self.bits, self.slots | other.slots)


def _combined(hashes: np.ndarray, following: np.ndarray) -> np.ndarray:
    return mixed(hashes * MIX + following)


_TABLE = bytes.maketrans(SEPARATORS + b"\t" + bytes(range(0x41, 0x5B)), MARK * len(SEPARATORS) + b" " + bytes(range(0x61, 0x7B)))


def _blocks(text: bytes) -> Iterator[bytes]:
    """A text cut behind blanks into blocks of ``BLOCK_BYTES`` or as much more as a word is long."""
    start = 0
    while len(text) - start > BLOCK_BYTES:
        cut = max(text.rfind(b, start, start + BLOCK_BYTES) for b in (b" ", b"\t", b"\n", MARK))
        if cut < start:
            cut = min((at for b in (b" ", b"\t", b"\n", MARK) if (at := text.find(b, start + BLOCK_BYTES)) >= 0), default=len(text) - 1)
        yield text[start : cut + 1]
        start = cut + 1
    yield text[start:]


def gathered(rows: Iterable[tuple[str, bytes]], longest: int) -> Iterator[tuple[str, bytes, int]]:
    """(language, text, how many of its words are known already): texts put together by language, or blocks of long ones.

    A-Z are lower-cased, a mark stands where a piece ends, and all else between words is blanks. A block of a long text begins with the last
    words of the one before, so that no phrase across the cut is lost.
    """
    waiting: dict[str, tuple[list[bytes], int]] = {}
    for lang, text in rows:
        if len(text) > BLOCK_BYTES:
            carried, known = b"", 0
            for block in _blocks(text):
                marked = carried + block.translate(_TABLE)
                yield lang, marked, known
                starts, _ = spans(np.frombuffer(marked.replace(MARK, b" "), np.uint8))
                known = min(longest - 1, len(starts))
                carried = marked[starts[-known] :] if known else b""
            continue
        parts, size = waiting.get(lang, ([], 0))
        parts.append(text)
        waiting[lang] = parts, size + len(text)
        if size + len(text) >= BLOCK_BYTES:
            yield lang, MARK.join(waiting.pop(lang)[0]).translate(_TABLE), 0
    for lang, (parts, _) in waiting.items():
        yield lang, MARK.join(parts).translate(_TABLE), 0


class Block:
    """Words of one language, by their hashes, and the phrases among them."""

    def __init__(self, lang: str, marked: bytes, known: int):
        self.lang, self.known = lang, known
        self.text = marked.replace(MARK, b" ")
        data = np.frombuffer(self.text, np.uint8)
        starts, ends = spans(data)
        self.hashes = mixed(hash_spans(data, starts, ends) ^ np.uint64(xxhash.xxh64_intdigest(lang.encode())))
        self.piece = np.searchsorted(np.flatnonzero(np.frombuffer(marked, np.uint8) == MARK[0]), starts)

    @cached_property
    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """The words as numbers of distinct ones."""
        coded = pa.array(self.text.split(), pa.binary()).dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary

    def phrases(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each length: (length, starts, hashes) of the phrases that lie in a piece and end behind the known words.

        Then the hashes of their two parts, without the last word and without the first one; of single words these say nothing.
        """
        starts, hashes, rest = np.arange(len(self.hashes)), self.hashes, self.hashes
        shorter = hashes
        for n in range(1, longest + 1):
            if n > 1:
                rest = np.zeros(len(self.hashes) + 1, np.uint64)
                rest[starts] = hashes
                inside = starts[: np.searchsorted(starts, len(self.hashes) - n + 1)]
                whole = self.piece[inside] == self.piece[inside + n - 1]
                starts, shorter = inside[whole], hashes[: len(inside)][whole]
                hashes = _combined(shorter, self.hashes[starts + n - 1])
                rest = rest[starts + 1]
            new = starts + n > self.known
            if new.all():
                yield n, starts, hashes, shorter, rest
            else:
                yield n, starts[new], hashes[new], shorter[new], rest[new]

    def counted(self, starts: np.ndarray, n: int) -> tuple[pa.Array, np.ndarray]:
        """The distinct phrases of ``n`` words at these places, and how often each is there."""
        ids, words = self.coded
        size = max(1, len(words))
        if n == 1:
            counts = np.bincount(ids[starts], minlength=size)
            codes = np.flatnonzero(counts)
            return words.take(pa.array(codes)), counts[codes]
        codes = ids[starts]
        for k in range(1, n):
            if size**n >= 1 << 62:
                # Numbers of the distinct beginnings stay small.
                _, codes = np.unique(codes, return_inverse=True)
            codes = codes * size + ids[starts + k]
        if size**n < 1 << 62:
            codes, counts = np.unique(codes, return_counts=True)
            columns = [codes // size ** (n - 1 - k) % size for k in range(n)]
        else:
            _, first, counts = np.unique(codes, return_index=True, return_counts=True)
            columns = [ids[starts[first] + k] for k in range(n)]
        return pc.binary_join_element_wise(*[words.take(pa.array(c)) for c in columns], b" "), counts


def _blocks_of(batches: Iterable[pa.RecordBatch], longest: int) -> Iterator[Block]:
    for batch in batches:
        pairs = zip(batch.column("lang").to_pylist(), texts(batch), strict=True)
        for part in gathered(pairs, longest):
            yield Block(*part)
        pa.default_memory_pool().release_unused()


def _hash_counts(rows: DataFrame, shortest: int, longest: int, new: Filter | None = None, old: Filter | None = None) -> DataFrame:
    """(hash, f): how often phrases of ``shortest`` to ``longest`` words occur, by 64-bit hashes.

    With filters, those of three words or more only if both parts are held by ``new``, and not both by ``old``.
    """
    shared = rows.sparkSession.sparkContext.broadcast((new, old))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, before = shared.value
        for block in _blocks_of(batches, longest):
            for n, _, hashes, *parts in block.phrases(longest):
                if n < shortest:
                    continue
                if now is not None and n > 2:
                    held = now.holds(parts[0]) & now.holds(parts[1])
                    if before is not None:
                        held &= ~(before.holds(parts[0]) & before.holds(parts[1]))
                    hashes = hashes[held]
                if len(hashes):
                    yield emit(HASHED, (found.view(np.int64) if i == 0 else found for i, found in enumerate(np.unique(hashes, return_counts=True))))

    return rows.mapInArrow(run, "hash long, f long").groupBy("hash").agg(F.sum("f").alias("f"))


def _exact_counts(rows: DataFrame, longest: int, possible: Filter) -> DataFrame:
    """(lang, words, phrase, f): how often each word occurs, and each longer phrase that the filter holds."""
    shared = rows.sparkSession.sparkContext.broadcast(possible)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks_of(batches, longest):
            for n, starts, hashes, *_ in block.phrases(longest):
                if n > 1:
                    starts = starts[shared.value.holds(hashes)]
                if len(starts):
                    phrases, counts = block.counted(starts, n)
                    lang, words = (pa.repeat(pa.scalar(v, f.type), len(phrases)) for v, f in zip((block.lang, n), COUNTS, strict=False))
                    yield pa.RecordBatch.from_arrays([lang, words, phrases.cast(pa.string()), pa.array(counts, pa.int64())], schema=COUNTS)

    return rows.mapInArrow(run, COUNTS_TYPE).groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))


def filter_bits(phrases: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, (phrases * BITS_PER_PHRASE).bit_length()))


def _filter(hashes: DataFrame, bits: int) -> Filter:
    """The filter of some hashes. Tasks give set bits by slot; slots are put together before the driver gets them, at most 2 ** ``bits`` bits."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = np.unique(np.concatenate(_bits(batch.column("hash").to_numpy().view(np.uint64), bits)))
                slot, first = np.unique(at >> np.uint64(6), return_index=True)
                yield emit(SLOTS, (slot.astype(np.int64), np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first).view(np.int64)))

    found = hashes.select("hash").mapInArrow(run, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    slots = np.zeros(1 << (bits - 6), np.uint64)
    slots[found.column("slot").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return Filter(bits, slots)


def _outside(hashes: DataFrame, known: Filter) -> DataFrame:
    """Those hashes that the filter does not hold."""
    shared = hashes.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~shared.value.holds(batch.column("hash").to_numpy().view(np.uint64))))

    return hashes.select("hash").mapInArrow(run, "hash long")


def frequent_phrases(spark: SparkSession, docs: DataFrame, least: int = 10, longest: int = 3) -> DataFrame:
    """(lang, words, phrase, f): every phrase of 1 to ``longest`` words that occurs ``least`` times in a language, counted exactly.

    ``docs`` has lang and text, neither null. A sample of one document in 16 proposes phrases that it holds twice. A full pass counts
    the proposed phrases and their negative border: all pairs of words, and the longer phrases whose two parts were both proposed. What
    is frequent there without having been proposed is a failure of the sample: it is proposed too, and another pass counts the phrases
    that have joined the border by it. When nothing fails any more, no phrase outside of the border can be frequent. A failure can only fail phrases that are
    longer, so there are less than ``longest`` such passes.

    In these passes phrases are counted by 64-bit hashes. Equal hashes of different phrases can only make a count greater, so they lose nothing. A last pass
    counts the words, and of the phrases those that were frequent by their hashes, by the phrases themselves.

    Tasks know phrases by a Bloom filter of 32 MB at most. One that it wrongly holds is counted in vain; none is missed. With too many phrases for the filter,
    more are counted than needed, by as many tasks.
    """
    rows = docs.select("lang", "text")
    sample = rows.filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLE_ONE_IN)) == 0)
    proposed = store(spark, _hash_counts(sample, 2, max(2, longest - 1)).filter(F.col("f") >= SAMPLE_LEAST).select("hash"))
    bits = filter_bits(proposed.count())
    known, before, possible = _filter(proposed, bits), None, None
    # The k-th pass closes the phrases of k + 1 words, so the next one need not count them again.
    for shortest in range(2, longest + 1):
        counted = store(spark, _hash_counts(rows, shortest, longest, known, before).filter(F.col("f") >= least).select("hash"))
        possible = counted if possible is None else possible.unionByName(counted)
        failed = store(spark, _outside(counted, known))
        if failed.isEmpty():
            break
        before, known = known, known.joined(_filter(failed, bits))
    exact = _exact_counts(rows, longest, _filter(possible, filter_bits(possible.count())))
    return store(spark, exact.filter(F.col("f") >= least))


def _long(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def scored(spark: SparkSession, frequent: DataFrame, longest: int) -> DataFrame:
    """(lang, words, phrase, a, l, r, score) of the frequent phrases of two words or more, at their lowest-scoring cut.

    The score is floor(1000000 * a * a / (l * r)) in whole numbers of up to 38 digits, that is for counts up to 10 ** 16. Both parts of a frequent phrase are
    frequent, so they are found among the others by joins, which spread over languages and phrases.
    """
    parts = F.split("phrase", " ")
    long = frequent.filter("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cut = long.withColumn("first", F.array_join(F.slice(parts, F.lit(1), F.col("k")), " ")).withColumn(
        "rest", F.array_join(F.slice(parts, F.col("k") + 1, F.col("words") - F.col("k")), " "))
    left = frequent.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    both = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    score = F.expr("cast(1000000 as decimal(7,0)) * (cast(a as decimal(16,0)) * cast(a as decimal(16,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = both.withColumn("score", score.cast("long")).groupBy("lang", "words", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("c"))
    return best.select("lang", "words", "phrase", "c.a", "c.l", "c.r", "c.score")


def collocations(spark: SparkSession, docs: DataFrame, least: int = 10, longest: int = 3, top: int = 2_000, percent: int = 50) -> DataFrame:
    """The first ``top`` phrases of 2 to ``longest`` words of each language, with counts and score.

    Texts are split into pieces at ``. , ; : ! ?`` and line ends, and these at blanks and tabs into words, with A-Z lower-cased. A phrase is a run of words of a piece; all its
    occurrences count, also overlapping ones. It must occur ``least`` times. Its score is that of its weakest cut (see ``scored``); of equal cuts the first. A phrase that lies
    in a longer frequent one is left out if that has at least ``percent`` percent of its occurrences. The order is score, then count, both
    descending, then the phrase in byte order.

    Returns lang, rank (from 1), phrase, a, l, r, n (the language's words), score. A null text is empty; a null language is ``und``. Rows count as often as they are
    there, whatever their doc_id. An empty table, or one without frequent phrases, gives no row. Other columns are ignored.
    """
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = rows.groupBy("lang").agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09.,;:!?\x0A-\x0D]+")).cast("long")).alias("n"))
    frequent = frequent_phrases(spark, rows, least, longest)
    found = store(spark, scored(spark, frequent, longest))
    parts, words_in = F.split("phrase", " "), F.col("words")
    starts = F.flatten(F.transform(F.sequence(F.lit(2), words_in - 1), lambda m: F.transform(
        F.sequence(F.lit(1), words_in - m + 1), lambda i: F.array_join(F.slice(parts, i, m), " "))))
    around = found.filter("words > 2").select("lang", F.col("a").alias("longer"), F.explode(F.array_distinct(starts)).alias("phrase"))
    around = around.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = found.join(around, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * _long("longer") < percent * _long("a")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language may hold most phrases: its first ones are among the first ones of its parts.
    dealt = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS)))
    first = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
