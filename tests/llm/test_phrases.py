import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from bookpipe.llm import phrases
from bookpipe.llm.phrases import Block, Filter, collocations, frequent_phrases, gathered
from bookpipe.llm.text import word_hashes


def brute_counts(rows, longest):
    """Counts of every phrase, by language, straight from the rules."""
    counts = defaultdict(Counter)
    for lang, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, longest + 1):
                counts[lang or "und"].update(" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
    return counts


def brute(rows, least, longest, top, percent):
    out = []
    for lang, f in brute_counts(rows, longest).items():
        n = sum(c for p, c in f.items() if " " not in p)
        found = {}
        for p, a in f.items():
            words = p.split(" ")
            if len(words) > 1 and a >= least:
                cuts = [(10**6 * a * a // (f[" ".join(words[:k])] * f[" ".join(words[k:])]), k) for k in range(1, len(words))]
                score, k = min(cuts)
                found[p] = (a, f[" ".join(words[:k])], f[" ".join(words[k:])], score)
        kept = [p for p, v in found.items() if not any(
            len(q) > len(p) and f" {p} " in f" {q} " and 100 * w[0] >= percent * v[0] for q, w in found.items())]
        kept.sort(key=lambda p: (-found[p][3], -found[p][0], p.encode()))
        out += [(lang, i, p, *found[p][:3], n, found[p][3]) for i, p in enumerate(kept[:top], 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "q") for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, f int, phrase string")


def corpus(seed, docs=300):
    random.seed(seed)
    words = ["the", "The", "of", "x.y", "new", "york", "city", "ß", "É", "na me", "a\x00b"] + [f"w{i}" for i in range(60)]
    out = []
    for i in range(docs):
        text = "".join(random.choice(words) + random.choice((" ", " ", "  ", "\t", ", ", ".\n", "! ", "\x0b")) for _ in range(random.randint(0, 60)))
        if i % 4 == 0:
            text += " New York City" * random.randint(1, 3) + "; ice cream. " * (i % 3)
        out.append((random.choice(("en", "en", "de", None, "und")), text))
    return out + [("en", None), ("en", ""), ("fr", "..."), (None, " \t")] + [("en", "same row again and again")] * 40


@pytest.mark.parametrize("least,longest,top,percent", [(10, 3, 2000, 50), (5, 3, 7, 90), (3, 4, 2000, 30), (8, 2, 2000, 50)])
def test_collocations_equal_brute_force(spark, least, longest, top, percent):
    rows = corpus(least)
    found = collocations(spark, table(spark, rows).repartition(5), least, longest, top, percent)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    expected = brute(rows, least, longest, top, percent)
    assert expected and sorted(map(tuple, found.collect())) == expected


def test_what_the_sample_misses_is_found_by_more_passes(spark, monkeypatch):
    # No document is in the sample, so all pairs fail, then all triples.
    rows = corpus(4)
    passes = []
    counts = phrases._hash_counts

    def counted(*args):
        passes.append(args)
        return counts(*args)

    monkeypatch.setattr(phrases, "SAMPLE_ONE_IN", 10_000_000)
    monkeypatch.setattr(phrases, "_hash_counts", counted)
    found = frequent_phrases(spark, phrases_input(spark, rows), 6, 3)
    got = {(r.lang, r.phrase): r.f for r in found.collect()}
    expected = {(lang, p): c for lang, f in brute_counts(rows, 3).items() for p, c in f.items() if c >= 6}
    assert got == expected and found.count() == len(expected)
    assert len(passes) == 3


def phrases_input(spark, rows):
    return spark.createDataFrame([(lang or "und", text or "") for lang, text in rows], "lang string, text string")


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    rows = corpus(6)
    monkeypatch.setattr(phrases, "LEAST_BITS", 6)
    monkeypatch.setattr(phrases, "MOST_BITS", 6)
    assert sorted(map(tuple, collocations(spark, table(spark, rows)).collect())) == brute(rows, 10, 3, 2000, 50)


def test_long_texts_are_counted_in_blocks(spark, monkeypatch):
    random.seed(5)
    text = " ".join(random.choice(("a", "b", "cc", "d.", "e" * 90, "f,g", ".")) for _ in range(3000))
    rows = [("en", text), ("en", "b" * 500), ("en", "short one"), ("de", "." * 300)]
    expected = brute_counts(rows, 3)
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(phrases, "BLOCK_BYTES", size)
        got = defaultdict(Counter)
        for part in gathered([(lang, t.encode()) for lang, t in rows], 3):
            block = Block(*part)
            for n, starts, *_ in block.phrases(3):
                found, counts = block.counted(starts, n)
                got[block.lang].update(dict(zip([p.decode() for p in found.to_pylist()], counts.tolist(), strict=True)))
        assert got["en"] == expected["en"] and not got["de"]


def test_more_words_than_numbers_hold():
    block = Block("en", b" ".join(b"w%d" % (i % 7) for i in range(100)), 0)
    starts = next(s for n, s, *_ in block.phrases(4) if n == 4)
    few = block.counted(starts, 4)
    ids, words = block.coded
    block.coded = ids, pa.concat_arrays([words, pa.array([b"unused"] * 70_000, pa.binary())])
    many = block.counted(starts, 4)
    assert dict(zip(few[0].to_pylist(), few[1].tolist(), strict=True)) == dict(zip(many[0].to_pylist(), many[1].tolist(), strict=True))


def test_very_long_text(spark):
    rows = [("en", "one two three " * 800_000), ("en", "one two")]
    found = collocations(spark, table(spark, rows)).collect()
    n = 2_400_002
    assert {(r.phrase, r.a, r.n) for r in found} == {("one two three", 800_000, n), ("two three one", 799_999, n), ("three one two", 799_999, n)}


def test_empty_tables(spark):
    assert collocations(spark, table(spark, [])).count() == 0
    assert collocations(spark, table(spark, [("en", "a b"), (None, None)])).count() == 0


def test_exact_arithmetic(spark):
    big = 3 * 10**11
    frequent = spark.createDataFrame([("en", 1, "a", big + 1), ("en", 1, "b", big + 7), ("en", 2, "a b", big)], "lang string, words int, phrase string, f long")
    (row,) = phrases.scored(spark, frequent, 2).collect()
    assert row.score == 10**6 * big * big // ((big + 1) * (big + 7)) and (row.a, row.l, row.r) == (big, big + 1, big + 7)


def test_hashes_and_filter():
    block = Block("en", b"x y z . x  y", 0)
    by_length = {n: (starts.tolist(), hashes, *parts) for n, starts, hashes, *parts in block.phrases(3)}
    assert by_length[2][0] == [0, 1, 3] and by_length[3][0] == [0]
    pairs = by_length[2][1]
    assert pairs[0] == pairs[2] != pairs[1]
    assert by_length[3][2].tolist() == pairs[:1].tolist() and by_length[3][3].tolist() == pairs[1:2].tolist()
    assert Block("de", b"x", 0).hashes != block.hashes[0] == Block("en", b" x", 0).hashes
    put = word_hashes(b" ".join(b"p%d" % i for i in range(1000)))
    slots = np.zeros(1 << 10, np.uint64)
    for at in phrases._bits(put, 16):
        np.bitwise_or.at(slots, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    known = Filter(16, slots)
    assert known.holds(put).all() and known.holds(word_hashes(b" ".join(b"q%d" % i for i in range(1000)))).mean() < 0.01
