import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from bookpipe.llm import mixing
from bookpipe.llm.mixing import mix, numbered, repetitions
from bookpipe.llm.queries import by_turns


def brute_targets(sizes, weights, total, most):
    """Clamp, reshare, repeat, in fractions."""
    clamped = {}
    while True:
        open_ = [s for s in sizes if s not in clamped]
        rest, all_ = total - sum(clamped.values()), sum(weights[s] for s in open_)
        above = [s for s in open_ if Fraction(rest * weights[s], all_) > most * sizes[s]]
        if not above:
            return {s: Fraction(clamped[s]) if s in clamped else Fraction(rest * weights[s], all_) for s in sizes}
        clamped |= {s: most * sizes[s] for s in above}


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, key string, size int")


def checked(spark, rows, share=100, most=3, **other):
    """Mix and compare targets and sums with the brute-force ones."""
    found = mix(spark, table(spark, rows), by_turns(spark), share, most, **other).collect()
    assert Counter((r.doc_id, r.text, r.source) for r in found) == Counter(rows)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    targets = brute_targets(sizes, weights, sum(sizes.values()) * share // 100, most)
    taken = defaultdict(int)
    for r in found:
        assert r.size == len((r.text or "").split()) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(float(targets[r.source]))
        assert r.copies * r.size <= r.taken <= (r.copies + 1) * r.size and r.taken <= most * r.size
        taken[r.source] += r.taken
    return found, targets, taken


def test_targets_and_sums(spark):
    random.seed(12)
    rows = [(i, " ".join("w" * random.randint(1, 9) for _ in range(random.choice((0, 1, 5, 40)))), random.choice("abcdefgz") if i % 3 else "hot") for i in range(900)]
    rows += [(1000 + i, "q w e", None) for i in range(30)] + [(2000, "one\ttwo\x0bthree", "tiny"), (2001, None, "void"), (None, "null id", "a")]
    for most in (1, 2, 3):
        _, targets, taken = checked(spark, rows, most=most)
        assert all(abs(taken[s] - targets[s]) <= Fraction(1, 2) for s in targets)
    _, targets, taken = checked(spark, rows, share=40)
    assert all(abs(taken[s] - targets[s]) <= Fraction(1, 2) for s in targets)


def test_narrowing_gives_the_same_rows(spark, monkeypatch):
    rows = [(i, "a b c d e"[: 1 + i % 9], "hot" if i % 2 else f"s{i % 14}") for i in range(800)]
    one = Counter((r.doc_id, r.taken) for r in checked(spark, rows)[0])
    monkeypatch.setattr(mixing, "TASK_ROWS", 1)
    random.shuffle(rows)
    assert Counter((r.doc_id, r.taken) for r in checked(spark, rows)[0]) == one
    assert Counter((r.doc_id, r.taken) for r in checked(spark, rows, seed="other")[0]) != one


def test_repeated_rows_share_the_cut(spark):
    rows = [(5, "a b c d", "s")] * 40 + [(6, "a b", "s")] * 3 + [(5, "other text", "s")] + [(i, "x " * 50, "t") for i in range(10, 20)]
    found, targets, taken = checked(spark, rows)
    assert all(0 <= targets[s] - taken[s] < 41 or abs(targets[s] - taken[s]) <= Fraction(1, 2) for s in targets)
    assert len({r.taken for r in found if (r.doc_id, r.text) == (5, "a b c d")}) == 1


def test_empty_tables_and_sources_without_words(spark):
    assert mix(spark, table(spark, []), by_turns(spark)).count() == 0
    found = mix(spark, table(spark, [(1, "", "a"), (2, None, None)]), by_turns(spark)).collect()
    assert [(r.size, r.target, r.taken) for r in found] == [(0, 0.0, 0)] * 2
    # More is asked for than the caps allow.
    found = mix(spark, table(spark, [(1, "a b", "a"), (2, "c", "b")]), by_turns(spark), share=900).collect()
    assert {(r.doc_id, r.target, r.taken) for r in found} == {(1, 6.0, 6), (2, 3.0, 3)}


def test_a_very_long_text(spark):
    found, targets, taken = checked(spark, [(1, "word " * 300_000, "a"), (2, "b " * 10, "b")])
    assert all(abs(taken[s] - targets[s]) <= Fraction(1, 2) for s in targets) and {r.doc_id: r.taken for r in found}[2] == 30


def test_repetitions_hold_the_taken_words(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(i % 7)), "ab"[i % 2] if i % 5 else None) for i in range(200)]
    mixed = mix(spark, table(spark, rows), by_turns(spark)).persist()
    texts = defaultdict(list)
    for r in repetitions(mixed).orderBy("repetition").collect():
        texts[r.doc_id].append(r.text)
    for r in mixed.collect():
        assert sum(len(t.split()) for t in texts[r.doc_id]) == r.taken
        assert all(r.text.startswith(t) for t in texts[r.doc_id])
    mixed.unpersist()


def test_numbers_over_partitions(spark):
    rows = spark.range(1000).select(F.when(F.col("id") != 500, F.format_string("%05d", F.col("id") * 7919 % 1000)).alias("source"))
    found = numbered(spark, rows.repartition(7), F.col("source").asc_nulls_last()).collect()
    expected = sorted(r.source for r in found if r.source) + [None]
    assert [r.source for r in sorted(found, key=lambda r: r.place)] == expected
    assert sorted(r.place for r in found) == list(range(1000))
