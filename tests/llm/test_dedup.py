import hashlib
import random
import uuid

import numpy as np
import pytest

from bookpipe.llm import neardup
from bookpipe.llm.components import components
from bookpipe.llm.exact import DigestIndex
from bookpipe.llm.neardup import band_rows, linked_sets, near_duplicates
from bookpipe.llm.text import shingles, word_hashes


def test_word_hashes_do_not_depend_on_place_or_blocks():
    words = [b"alpha", b"Beta", b"x" * 300_000, "é".encode(), b"alpha"]
    one = word_hashes(b" ".join(words))
    two = word_hashes(b"\n\t" + b"\x0b ".join(words[::-1]) + b" ")
    assert one.tolist() == two[::-1].tolist() and one[0] == one[4] and len(set(one.tolist())) == 4
    many = b" ".join(b"w%d" % (i % 50_000) for i in range(150_000))
    assert len(np.unique(word_hashes(many))) == 50_000
    assert len(word_hashes(b" \n")) == 0 and len(shingles(word_hashes(b"a b"), 3)) == 1


def test_components(spark):
    random.seed(3)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    linked = {x for a, b in edges if a != b for x in (a, b)}
    found = {r.node: r.component for r in components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: find(x) for x in linked}
    assert components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def index(spark, tmp_path, name=None):
    return DigestIndex(spark, str(tmp_path / "index"), name or f"d{uuid.uuid4().hex}", 3)


def test_exact_groups(spark, tmp_path):
    rows = [(1, "Ab"), (5, "aB"), (3, "ÄB"), (4, "äb"), (7, None), (6, ""), (8, "x" * 100_000), (2, "ab"), (9, "q"), (9, "q"), (None, "ab"), (None, "z")]
    found = index(spark, tmp_path).add(spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, digest int")).collect()
    by = {(r.doc_id, r.text_sha256): r for r in found}
    low = lambda t: hashlib.sha256("".join(c.lower() if c.isascii() else c for c in t or "").encode()).hexdigest()
    assert len(found) == len(rows) and {(d, low(t)) for d, t in rows} == set(by)
    assert all(by[d, low("ab")].keep_id == 5 and by[d, low("ab")].group_size == 4 for d in (1, 5, 2, None))
    assert by[7, low("")].kept and not by[6, low("")].kept and by[3, low("ÄB")].kept and by[4, low("äb")].kept
    assert [r.kept for r in found if r.doc_id == 9] == [True, True] and by[None, low("z")].kept and not by[None, low("ab")].kept
    assert index(spark, tmp_path / "none").add(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_index_outlives_its_session(spark, tmp_path):
    first = index(spark, tmp_path)
    first.add(spark.createDataFrame([(10, "old"), (11, "same")], "doc_id long, text string"))
    spark.sql(f"DROP TABLE {first.name}")  # external: the files stay
    later = index(spark, tmp_path).add(spark.createDataFrame([(20, "SAME"), (21, "new")], "doc_id long, text string")).collect()
    assert {r.doc_id: (r.keep_id, r.kept) for r in later} == {20: (11, False), 21: (21, True)}
    assert later and index(spark, tmp_path).table().count() == 3


def brute_near(rows, words, percent):
    sets = {}
    for doc_id, text in rows:
        w = [x for x in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\n", " ").split(" ") if x]
        n = min(words, len(w))
        sets[doc_id] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
    label = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * len(sets[a] | sets[b]) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return {d: (len(sets[d]), label[d]) for d in sets}


def family(random, size, edits, words=60):
    base = [f"w{random.randrange(10**6)}" for _ in range(words)]
    for _ in range(size):
        copy = list(base)
        for _ in range(random.randrange(edits)):
            copy[random.randrange(words)] = f"e{random.randrange(10**6)}"
        yield " ".join(copy)


@pytest.mark.parametrize(("words", "percent", "small"), [(3, 85, False), (5, 80, False), (3, 85, True)])
def test_near_duplicates_against_brute_force(spark, monkeypatch, words, percent, small):
    if small:
        monkeypatch.setattr(neardup, "BUCKET_ROWS", 8)
        monkeypatch.setattr(neardup, "FAMILY_ROWS", 7)
    r = random.Random(5)
    texts = [*family(r, 60, 9), *family(r, 20, 3), *family(r, 20, 14), "", None, "one", "one two", "One TWO", "a b c", "same thing here"] + ["same thing here"] * 5
    texts += [" ".join(f"u{i}x{j}" for j in range(30)) for i in range(20)]
    r.shuffle(texts)
    rows = list(enumerate(texts))
    frame = spark.createDataFrame([(*x, "s") for x in rows], "doc_id long, text string, component string")
    found = {x.doc_id: (x.n_shingles, x.component_id) for x in near_duplicates(spark, frame, words, percent).collect()}
    assert found == brute_near(rows, words, percent)


def test_near_duplicates_edge_rows(spark):
    rows = near_duplicates(spark, spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, " ")], "doc_id long, text string")).collect()
    assert sorted((x.doc_id or 0, x.n_shingles, x.component_id or 0, x.kept) for x in rows) == [(0, 1, 0, True), (1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]
    assert near_duplicates(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_set_links_by_product_and_by_pair():
    r = np.random.default_rng(1)
    base = np.arange(4_000, dtype=np.uint64)
    sets = [np.unique(np.concatenate((base[: int(n)], r.integers(10**6, 10**9, 50).astype(np.uint64)))) for n in r.integers(2_000, 4_000, 12)]
    whole = linked_sets(sets, 85)
    for i in range(12):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                assert whole[i] == whole[j]
                assert linked_sets([sets[i], sets[j]], 85).tolist() == [0, 0]


def test_bands_miss_one_in_a_million_at_most():
    for similarity in (0.7, 0.8, 0.85, 0.9):
        rows = band_rows(similarity)
        assert (1 - similarity**rows) ** (neardup.MINIMA // rows) <= 1e-6 and rows > 1
