"""Each stage of the pipeline, and all of them, against straight Python."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from bookpipe.llm import packing
from bookpipe.llm.exact import DigestIndex
from bookpipe.llm.neardup import near_duplicates
from bookpipe.llm.queries import tokenizer
from bookpipe.llm.repeats import remove_repeats
from bookpipe.llm.rowkeys import ROW, row_keys
from bookpipe.llm.sentences import remove_repeated_spans

TYPE = "doc_id long, text string, lang string, source string, n_chars long, key string, count int, __part int"


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def shingles(text, n=5):
    words = lowered(text).split()
    size = min(n, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def order(row):
    return row[0] is None, row[0] or 0


def frame(spark, rows):
    """Documents with columns whose names clash with inner ones."""
    return spark.createDataFrame([(d, t, "en", "s", None if t is None else len(t), f"k{i}", i, -i) for i, (d, t) in enumerate(rows)], TYPE).repartition(3)


def pairs(found):
    return Counter((r.doc_id, r.text) for r in found.collect())


def words(seed, n):
    r = random.Random(seed)
    return [f"w{r.randrange(10**5)}" for _ in range(n)]


def nasty():
    base = words(1, 60)
    near = [" ".join([*base[:i], "changed", *base[i + 1 :]]) for i in (3, 30, 55)]
    rows = [(1, " ".join(base)), (2, near[0]), (2, " ".join(words(2, 40))), (3, "A text"), (3, "another text"), (4, "a TEXT"), (4, "a TEXT"), (5, None), (6, ""), (7, "  "),
            (None, near[1]), (None, "a text"), (None, " ".join(words(3, 30))), (8, "ÄRGER"), (9, "ärger"), (10, " ".join(words(4, 9000))), (11, near[2]), (11, near[2])]
    return rows + [(20 + i, "copy of a text " * 4) for i in range(30)]


def brute_exact(rows):
    """The row of the largest id of each text, null above all; ties leave one row."""
    best = {}
    for row in sorted(rows, key=lambda row: (order(row), row[1] or "")):
        best[lowered(row[1])] = row
    return Counter(best.values())


def test_exact_once(spark, tmp_path):
    rows = nasty()
    found = pairs(pipeline.exact_once(spark, frame(spark, rows), ""))
    assert {(d, lowered(t)): n for (d, t), n in found.items()} == {(d, lowered(t)): n for (d, t), n in brute_exact(rows).items()}
    # The verdict's case: a text that shares its doc_id with a dropped one stays.
    assert pairs(pipeline.exact_once(spark, frame(spark, [(1, "a"), (1, "unique b"), (2, "a")]), "")) == Counter([(1, "unique b"), (2, "a")])


def brute_near(rows):
    documents = sorted(set(rows), key=lambda row: (order(row), zlib.crc32((row[1] or "").encode())))
    sets, group = [shingles(t) for _, t in documents], list(range(len(documents)))
    for a in range(len(documents)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]) and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    return [[documents[i] for i in range(len(documents)) if group[i] == g] for g in sorted(set(group))]


def test_near_once(spark):
    rows = nasty()
    found = pairs(pipeline.near_once(spark, frame(spark, rows), ""))
    for group in brute_near(rows):
        kept = [row for row in group if row in found]
        # One document of the least doc_id stays, with all its equal rows.
        least = min(order(row) for row in group)
        assert len(kept) == 1 and order(kept[0]) == least, group
        assert found[kept[0]] == rows.count(kept[0])


def test_decontaminated(spark, tmp_path):
    item = " ".join(words(50, 30))
    pq.write_table(pa.table({"item_id": [1, 2], "text": [item, " ".join(words(51, 12))]}), tmp_path / "benchmark.parquet")
    leaks = [(1, f"before {item} after"), (None, item.upper()), (2, " ".join(words(60, 50)) + " " + " ".join(words(51, 12)))]
    clean = [*nasty(), (2, "clean"), (1, " ".join(words(70, 200)))]
    found = pairs(pipeline.decontaminated(spark, frame(spark, leaks + clean), str(tmp_path)))
    assert found == Counter(clean)


def test_packed(spark):
    rows = nasty()
    found = pipeline.packed(spark, frame(spark, rows), "").collect()
    encode = packing.encoder(tokenizer()).encode
    expected = Counter((d, np.append(np.frombuffer(encode((t or "").encode()), "<u4"), 1).astype("<u4").tobytes()) for d, t in rows)
    places = sorted((r.sequence_id * 2048 + r.offset, r.length) for r in found)
    at = 0
    for start, length in places:
        assert start == at
        at += length
    assert at == sum(len(ids) // 4 for _, ids in expected.elements())
    joined, now = Counter(), []
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        now.append(bytes(r.ids))
        assert zlib.crc32(now[-1]) == r.ids_crc32
        if r.start + r.length == r.doc_tokens:
            joined[r.doc_id, b"".join(now)] += 1
            now = []
    assert joined == expected


def test_good_quality(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    more = docs.limit(3).withColumns({"doc_id": F.lit(None).cast("long")}).unionByName(docs.limit(1).withColumn("text", F.lit(None).cast("string")))
    found = pipeline.good_quality(spark, docs.unionByName(more), sf_dir)
    assert found.columns == docs.columns
    kept = pairs(found)
    everything = pairs(docs.unionByName(more))
    assert not kept - everything and all(n == everything[row] for row, n in kept.items())
    # The same text has the same fate under every doc_id.
    fate = {}
    for (doc_id, text), n in everything.items():
        fate.setdefault(text, set()).add((doc_id, text) in kept)
    assert all(len(f) == 1 for f in fate.values())
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    labelled = [(label[d], (d, t) in kept) for d, t in everything if d in label]
    assert np.mean([q == k for q, k in labelled]) > 0.9


@pytest.mark.parametrize("stage", [name for name, _ in pipeline.STAGES])
def test_empty_tables(spark, sf_dir, stage):
    empty = frame(spark, [(1, "x")]).filter("false")
    found = dict(pipeline.STAGES)[stage](spark, empty, sf_dir)
    assert found.count() == 0
    assert stage == "packing" or found.columns == empty.columns


def test_run_applies_the_stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in pipeline.STAGES:
        rows = stage(spark, docs, sf_dir)
        docs = spark.createDataFrame(rows.collect(), rows.schema)
    def digest(found):
        return Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in found.collect() if r.start == 0 and r.length == r.doc_tokens)
    found = pipeline.run(spark, sf_dir)
    assert found.columns == docs.columns
    assert found.agg(F.sum("length")).first()[0] == docs.agg(F.sum("length")).first()[0]
    assert set(r.doc_id for r in found.select("doc_id").distinct().collect()) == set(r.doc_id for r in docs.select("doc_id").distinct().collect())


# Texts that share a doc_id

def test_row_keys(spark):
    rows = [(5, "a"), (5, "b"), (2, "x"), (None, "n"), (None, None), (5, "a"), (2, "x")]
    keyed, names = row_keys(spark, spark.createDataFrame(rows, "doc_id long, text string"), nulls=True)
    key = {}
    for r in keyed.collect():
        key.setdefault((r.doc_id, r.text), set()).add(r[ROW])
    assert all(len(k) == 1 for k in key.values()) and sorted(k for (k,) in key.values()) == [0, 1, 2, 3, 4]
    assert key[2, "x"] == {0} and max(key[5, "a"] | key[5, "b"]) < min(key[None, "n"] | key[None, None])
    plain, names = row_keys(spark, spark.createDataFrame([(5, "a"), (2, "x"), (5, "a")], "doc_id long, text string"))
    assert names is None and sorted(r[ROW] for r in plain.collect()) == [2, 5, 5]


def test_operators_tell_texts_of_one_doc_id_apart(spark):
    r = random.Random(9)
    passage = "".join(r.choice("abcdefgh ") for _ in range(150))
    other = "".join(r.choice("ijklmnop ") for _ in range(300))
    rows = [(1, passage + "!"), (2, "x" + passage), (2, other), (2, "short"), (None, passage)]
    found = sorted((x.doc_id or 0, x.n_bytes, x.n_removed) for x in remove_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert found == [(0, 150, 0), (1, 151, 0), (2, 5, 0), (2, 151, 150), (2, 300, 0)]

    run = "Some sentence with quite a few words in it to count. And another sentence that also has a good number of words. "
    rows = [(1, run + "One end."), (2, "A start. " + run), (2, "Gamma here now. Delta over there. Epsilon is last.")]
    texts = {(x.doc_id, x.text) for x in remove_repeated_spans(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (2, rows[2][1]) in texts and (1, rows[0][1]) in texts and rows[1] not in texts

    base = words(5, 80)
    near = " ".join([*base[:40], "changed", *base[41:]])
    rows = [(5, " ".join(base)), (5, "something else that is here now"), (2, near), (None, near)]
    found = {(x.doc_id, x.n_shingles): (x.component_id, x.kept) for x in near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {(5, 76): (2, False), (5, 2): (5, True), (2, 76): (2, True), (None, 76): (None, True)}


def test_copies_are_combined_before_the_index_is_joined(spark, tmp_path, monkeypatch):
    """The anti-join with the index reads written groups, not the rows."""
    import bookpipe.llm.exact as exact

    plans, store = [], exact.store

    def watched(session, rows):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return store(session, rows)

    monkeypatch.setattr(exact, "store", watched)
    found = DigestIndex(spark, str(tmp_path / "index"), "digests_combined", 3).add(spark.createDataFrame([(i, "same") for i in range(50)], "doc_id long, text string"))
    assert {r.group_size for r in found.collect()} == {50}
    (anti,) = [plan for plan in plans if "LeftAnti" in plan]
    assert "Aggregate" not in anti
