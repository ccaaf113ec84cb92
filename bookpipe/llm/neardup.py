"""Near-duplicates by b-bit MinHash."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookpipe.llm.components import components
from bookpipe.llm.rowkeys import separately
from bookpipe.llm.text import emit, mixed, runs, shingles, store, texts, word_hashes

MINIMA, BITS = 128, 4
PER_WORD = 64 // BITS
# Members of a bucket, or of a family and shingles of it, that one task compares with each other.
BUCKET_ROWS, FAMILY_ROWS, FAMILY_SHINGLES = 4_096, 400, 1_000_000
# Standard deviations by which an estimate may fall short; chance 1e-6 for each link and band.
MARGIN = 4.7

SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()),
                    ("signature", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64()))])
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
LINK_TYPE = "a long, b long"


def band_rows(similarity: float) -> int:
    """Most rows per band for which a pair at ``similarity`` misses all bands with chance 1e-6 at most."""
    return max((r for r in range(1, 17) if (1 - similarity**r) ** (MINIMA // r) <= 1e-6), default=1)


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 2 * MINIMA + 1, dtype=np.uint64))
    odd = (seeds >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    return odd[:MINIMA, None], odd[MINIMA:, None]


def minima(found: np.ndarray, chunk: int = 2_048) -> np.ndarray:
    """The least value of each of the 128 hash functions over a shingle set."""
    a, b = _multipliers()
    low = (found ^ (found >> np.uint64(32))).astype(np.uint32)[None, :]
    best = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for i in range(0, low.shape[1], chunk):
        h = low[:, i : i + chunk] * a
        h ^= h >> np.uint32(15)
        h *= b
        h ^= h >> np.uint32(16)
        np.minimum(best, h.min(axis=1), out=best)
    return best


def packed(best: np.ndarray) -> np.ndarray:
    """The low bits of the minima, 16 to a 64-bit word."""
    low = (best & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(-1, PER_WORD)
    return np.bitwise_or.reduce(low << (np.arange(PER_WORD, dtype=np.uint64) * np.uint64(BITS)), axis=1)


def estimate(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Similarity from equal low bits, counted bitwise and freed of the chance collisions, 2 ** -BITS."""
    x = one ^ others
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    unequal = np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=-1)
    chance = 2.0**-BITS
    return (1 - unequal / MINIMA - chance) / (1 - chance)


def least_estimate(similarity: float) -> float:
    chance = 2.0**-BITS
    equal = chance + (1 - chance) * similarity
    return similarity - MARGIN * (equal * (1 - equal) / MINIMA) ** 0.5 / (1 - chance)


def shingle_set(text: bytes, words: int) -> np.ndarray:
    return np.unique(shingles(word_hashes(text), words))


def _signed(words: int, rows: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = MINIMA // rows
        salt = mixed(np.arange(bands, dtype=np.uint64))
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id"), texts(batch), strict=True):
                found = shingle_set(text, words)
                if not len(found):
                    out.append((doc_id.as_py(), 0, None, None, None))
                    continue
                best = minima(found)
                key = salt
                for column in best[: bands * rows].reshape(bands, rows).T.astype(np.uint64):
                    key = mixed(key * np.uint64(31) + column)
                out.append((doc_id.as_py(), len(found), xxhash.xxh3_128_digest(found.tobytes()), packed(best).view(np.int64), key.view(np.int64)))
            if out:
                yield emit(SIGNED, zip(*out, strict=True))
    return run


def connected(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
    """Label n rows by the first row that links reach; ``near(i, rows)`` tells which rows link with i.

    A row that is already reached is not compared again, so a group that hangs together costs a
    comparison per row and no pair is listed.
    """
    label = np.arange(n)
    rest = np.arange(n)
    while len(rest):
        root, rest = rest[0], rest[1:]
        frontier = [root]
        while frontier and len(rest):
            hit = near(frontier.pop(), rest)
            label[rest[hit]] = root
            frontier.extend(rest[hit])
            rest = rest[~hit]
    return label


def _bucket_links(least: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["key", "s", "t"]):
            if group.num_rows < 2:
                continue
            docs = group.column("rep").to_numpy()
            signs = group.column("signature").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(docs), -1)
            label = connected(len(docs), lambda i, rows, m=signs: estimate(m[i], m[rows]) >= least)
            linked = label != np.arange(len(docs))
            if linked.any():
                yield emit(LINKS, [docs[linked], docs[label[linked]]])
    return run


def _family_links(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["component", "s", "t"]):
            if group.num_rows < 2:
                continue
            docs = group.column("rep").to_numpy()
            sets = [np.frombuffer(x.as_py(), np.uint64) for x in group.column("shingles")]
            label = linked_sets(sets, percent)
            linked = label != np.arange(len(docs))
            if linked.any():
                yield emit(LINKS, [docs[linked], docs[label[linked]]])
    return run


def linked_sets(sets: list[np.ndarray], percent: int, columns: int = 2_048) -> np.ndarray:
    """Components of sets with 100 * intersection >= percent * union, counted on the full sets.

    Shingles of one set only cannot meet; the others are counted by products of 0/1 matrices.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    if len(sets) <= 4:
        def near(i, rows):
            both = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for j in rows], np.int64)
            return 100 * both >= percent * (sizes[i] + sizes[rows] - both)
        return connected(len(sets), near)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(count > 1) - 1
    keep = count[code] > 1
    owner, code = owner[keep], shared[code[keep]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    cuts = np.searchsorted(code, np.arange(0, (code[-1] + 1 if len(code) else 0) + columns, columns))
    for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if i < j:
            part = np.zeros((len(sets), columns), np.float32)
            part[owner[i:j], code[i:j] - k * columns] = 1
            both += part @ part.T
    both = both.astype(np.int64)
    return connected(len(sets), lambda i, rows: 100 * both[i, rows] >= percent * (sizes[i] + sizes[rows] - both[i, rows]))


def _sets(words: int):
    schema = pa.schema([("rep", pa.int64()), ("component", pa.int64()), ("blocks", pa.int32()), ("shingles", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = [shingle_set(t, words).tobytes() for t in texts(batch)]
                yield emit(schema, [batch.column("rep"), batch.column("component"), batch.column("blocks"), found])
    return run


def _in_blocks(rows: DataFrame, group: str) -> DataFrame:
    """Deal a group's rows to its pairs of blocks (s, t): any two rows meet in one, none holds them all."""
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("s", F.least("own", "other")).withColumn("t", F.greatest("own", "other")).drop("own", "other", "blocks")
    keys = [group, "s", "t"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "rep")


def near_duplicates(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Link documents whose sets of ``words``-word shingles have 100 * intersection >= percent * union.

    Words are runs of anything but ASCII blanks, with A-Z lower-cased. Documents with equal sets are one
    class, stood for by its least doc_id. Classes that share a band of full minima are candidates; of
    their minima only the low bits are kept, and pairs whose corrected estimate is far below the
    threshold go. What hangs together by estimates is a family, and inside a family all links are
    confirmed on the full sets. Buckets and families too large for a task are dealt out as pairs of blocks. No
    pair is listed: tasks return a spanning link per row.

    One row per input row: doc_id, n_shingles, component_id (least doc_id reachable), kept. Null or
    blank texts have no shingle and link with nothing. Equal rows are one document and are reported alike;
    texts that share a doc_id are documents of their own. A null doc_id takes no part:
    component_id is null and kept is true. Other columns are ignored; an empty table gives no row.
    """
    found = separately(spark, docs, lambda own: _components_of(spark, own, words, percent), ["doc_id", "component_id"])
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _components_of(spark: SparkSession, docs: DataFrame, words: int, percent: int) -> DataFrame:
    rows = band_rows(percent / 100)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = store(spark, source.mapInArrow(_signed(words, rows), "doc_id long, n_shingles long, set_key binary, signature array<long>, bands array<long>"))
    linked = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = store(spark, linked.groupBy("set_key").agg(F.min(F.struct("doc_id", "n_shingles", "signature", "bands")).alias("x")).select(
        "set_key", F.col("x.doc_id").alias("rep"), "x.n_shingles", "x.signature", "x.bands"))
    # One of the buckets with the same members is enough; members are compared by count, ends and a hash.
    band = classes.select("rep", F.explode("bands").alias("key"))
    buckets = band.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.min("rep").alias("lo"),
                                      F.max("rep").alias("hi")).filter("n > 1")
    buckets = buckets.groupBy("n", "x", "lo", "hi").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("n") / BUCKET_ROWS).cast("int").alias("blocks"))
    members = band.join(buckets, "key").join(classes.select("rep", "signature"), "rep")
    families = components(spark, _in_blocks(members, "key").mapInArrow(_bucket_links(least_estimate(percent / 100)), LINK_TYPE))
    families = families.withColumnRenamed("node", "rep").join(classes.select("rep", "n_shingles"), "rep")
    sizes = families.groupBy("component").agg(F.ceil(F.greatest(
        F.count("*") / FAMILY_ROWS, F.sum("n_shingles") / FAMILY_SHINGLES)).cast("int").alias("blocks"))
    members = store(spark, families.select("rep", "component").join(sizes, "component"))
    sets = source.join(members, source["doc_id"] == members["rep"]).select("rep", "component", "blocks", "text").mapInArrow(
        _sets(words), "rep long, component long, blocks int, shingles binary")
    links = _in_blocks(sets, "component").mapInArrow(_family_links(percent), LINK_TYPE)
    found = components(spark, links).withColumnRenamed("node", "rep")
    named = classes.select("set_key", "rep").join(found, "rep", "left").select("set_key", F.coalesce("component", "rep").alias("component_id"))
    shown = ["doc_id", "n_shingles", "component_id"]
    alone = signed.filter("NOT (n_shingles > 0 AND doc_id IS NOT NULL)").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.select("doc_id", "n_shingles", "set_key").join(named, "set_key").select(*shown).unionByName(alone)
