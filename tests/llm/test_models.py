import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from bookpipe.llm import language, quality, scoring
from bookpipe.llm.queries import QUERIES


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


# Language identification


def test_language_on_held_out_documents(spark, sf_dir):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op1_language_id"](spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(truth) and all(r.held_out == (remainder(r.doc_id, 5) == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edge_rows(spark):
    texts = {"en": "the quick brown fox and the dog", "de": "der schnelle braune Fuchs über den Hund"}
    rows = [(i, t, lang) for i, (lang, t) in enumerate(list(texts.items()) * 20)] + [(99, None, "en"), (98, "12 34", None), (97, "", None), (None, "der über den", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumnRenamed("lang", "lang")
    from pyspark.sql import functions as F

    model = language.learn(spark, docs)
    found = {r.doc_id: r for r in language.identify(docs.withColumn("score", F.lit("x")), model, F.lit(False)).collect()}
    assert [found[i].lang_pred for i in (99, 98, 97)] == ["und"] * 3 and found[97].score == 0
    assert found[0].lang_pred == "en" and found[None].lang_pred == "de"
    empty = docs.limit(0)
    nothing = language.learn(spark, empty)
    assert nothing.languages == () and [r.lang_pred for r in language.identify(docs.limit(2), nothing, F.lit(False)).collect()] == ["und"] * 2
    assert language.identify(empty, model, F.lit(False)).count() == 0


def test_gram_counts_do_not_depend_on_blocks(monkeypatch):
    text = "".join(random.Random(2).choice("abcdeß é\n1") for _ in range(5_000))
    index, count = language.gram_counts(text)
    assert count.sum() > 10_000 and (np.diff(index) > 0).all()
    monkeypatch.setattr(language, "BLOCK", 977)
    index2, count2 = language.gram_counts(text)
    # Blocks count the letters around a cut again, a few of thousands.
    assert abs(int(count2.sum()) - int(count.sum())) < 60 and len(np.setdiff1d(index, index2)) == 0


def test_leader_gives_sparse_weights_and_temperature_calibrates():
    r = np.random.default_rng(0)
    leader = language.Leader(2)
    for _ in range(400):
        y = int(r.integers(2))
        index = np.unique(np.concatenate(([y], r.integers(10, 2_000, 5))))
        leader.learn(index, np.ones(len(index)) / len(index) ** 0.5, y)
    w = leader.weights(np.arange(2_000))
    assert w[0, 0] > 0 > w[0, 1] and (w == 0).mean() > 0.3
    y = r.integers(2, size=2_000)
    logit = np.where(r.random(2_000) < 0.8, 1, -1) * (2 * y - 1) * 4.0
    t = language.temperature(np.stack([0 * logit, logit], axis=1), y)
    assert abs(4 / t - math.log(4)) < 0.2


# Quality


def test_quality_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = QUERIES["op2_quality"](spark, sf_dir).collect()
    assert len(rows) == 10_000 and all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    held = [(truth[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    good, bad = [s for y, s, _ in held if y], [s for y, s, _ in held if not y]
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert auc > 0.97
    assert np.mean([p for y, _, p in held if y]) > 0.98 and np.mean([p for y, _, p in held if not y]) < 0.15


def test_compiled_rules_equal_the_rules(spark):
    r = np.random.default_rng(1)
    texts = [" ".join(r.choice(["aa", "bbb", "C!", "7", "$$"], 30)) + "\n" * int(r.integers(3)) for _ in range(300)] + ["", None, "x" * 200_000]
    x = np.array([quality.statistics((t or "").encode()) for t in texts])
    model = quality.fit(x, (x[:, 9] > np.median(x[:, 9])).astype(float))
    frame = spark.createDataFrame([(i, t, 5.0) for i, t in enumerate(texts)], "doc_id long, text string, score double")
    found = {q.doc_id: q.score for q in quality.score(frame, model, ["doc_id"]).collect()}
    assert model.rules and np.allclose([found[i] for i in range(len(texts))], model.score(x))
    assert 0 < sum(1 for w in model.weights if w) < quality.TREES * 14


def test_quality_without_rows_or_with_one_label(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (2, None)], "doc_id long, quality int")
    from pyspark.sql import functions as F

    assert quality.learn(docs, labels.limit(0), F.lit(False)).score(np.zeros((1, 16)))[0] == 0.5
    one = quality.learn(docs, labels, F.lit(False))
    assert one.rules == () and one.score(np.zeros((1, 16)))[0] > 0.5
    assert quality.score(docs.limit(0), one, ["doc_id"]).count() == 0


def test_lasso_shrinks_to_nothing_under_a_large_penalty():
    r = np.random.default_rng(3)
    z = r.integers(0, 2, (400, 5)).astype(float)
    y = (r.random(400) < np.where(z[:, 0] > 0, 0.9, 0.2)).astype(float)
    w, b = quality.lasso(z, y, 1.0)
    assert not w.any() and abs(1 / (1 + math.exp(-b)) - y.mean()) < 1e-3
    w, _ = quality.lasso(z, y, 0.01)
    assert w[0] > 1 and np.abs(w[1:]).max() < w[0] / 3


# Language-model scoring


def brute_base(rows):
    split = {d: [w for w in "".join(c.lower() if c.isascii() else c for c in t or "").replace("\n", " ").replace("\t", " ").split(" ") if w] + ["\n"] for d, t in rows}
    counts = Counter(w for d, ws in split.items() if remainder(d, 7) != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    return {d: (len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)) for d, ws in split.items()}


def test_base_scores_and_better_model(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    expected = brute_base(rows)
    found = QUERIES["op3_lm_scoring"](spark, sf_dir).collect()
    assert len(found) == len(rows)
    for r in found:
        n, known, total, base = expected[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total) and r.base_score == pytest.approx(base, rel=1e-9)
        assert r.held_out == (remainder(r.doc_id, 7) == 2)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_small_head_and_edge_rows(spark, monkeypatch):
    from bookpipe.llm.text import held_out

    monkeypatch.setattr(scoring, "HEAD", 6)
    monkeypatch.setattr(scoring, "CLASSED", 4)
    monkeypatch.setattr(scoring, "EXCHANGED", 2)
    rows = [(i, "The cat sat " * (i % 4) + f"w{i} ÄB") for i in range(40)] + [(40, None), (41, ""), (42, "x" * 50_000), (43, "the\tthe\x0bthe")]
    frame = spark.createDataFrame([(*x, 1.0) for x in rows], "doc_id long, text string, score double").repartition(3)
    expected = brute_base([(d, (t or "").replace("\x0b", " ")) for d, t in rows])
    for r in scoring.score(spark, frame, held_out(7, 2)).collect():
        assert (r.n_tokens, r.n_known, r.train_tokens) == expected[r.doc_id][:3] and r.base_score == pytest.approx(expected[r.doc_id][3])
        assert r.score < 0 and math.isfinite(r.score)
    empty = scoring.score(spark, frame.limit(0), held_out(7, 2))
    assert empty.count() == 0
    alone = scoring.score(spark, spark.createDataFrame([(19, "a b")], "doc_id long, text string"), held_out(7, remainder(19, 7))).collect()[0]
    assert (alone.n_tokens, alone.n_known, alone.train_tokens, alone.base_score) == (3, 0, 0, 0.0) and math.isfinite(alone.score)


def test_probabilities_sum_to_one():
    r = np.random.default_rng(5)
    counts = [(scoring.END, 7), *[(b"w%d" % i, int(n)) for i, n in enumerate(sorted(r.integers(1, 50, 30))[::-1])]]
    classes = np.array([33, *r.integers(0, 32, 10), *[32] * 20])
    transitions = r.integers(0, 4, (34, 34))
    total = sum(n for _, n in counts)
    model = scoring.class_model(counts, total, len(counts), classes, transitions)
    used = np.unique(classes)
    transitions[:, [c for c in range(34) if c not in used]] = 0
    assert np.allclose((10.0**model.log_step).sum(1), 1)
    for c in used[used != 32]:
        assert (10.0 ** model.log_emit[classes == c]).sum() == pytest.approx(1)
    assert (10.0 ** model.log_emit[classes == 32]).sum() + 10.0 ** model.emit_rest(0) == pytest.approx(1)


def test_exchange_finds_planted_classes():
    r = np.random.default_rng(7)
    kinds, words = 3, 24
    pairs = np.zeros((words + 1, words + 1), np.int64)
    kind, last = 0, int(r.integers(words))
    for _ in range(20_000):
        kind = (kind + 1) % kinds
        word = int(r.integers(words // kinds)) * kinds + kind
        pairs[last, word] += 1
        last = word
    label = scoring.exchange(pairs, fixed=1, classes=3)
    assert label[-1] == 3 and all(len({label[w] for w in range(k, words, kinds)}) == 1 for k in range(kinds)) and len(set(label[:words])) == 3


def test_words_beyond_the_matrices_get_classes_too(spark, monkeypatch):
    """Scores do not depend on which words the tasks know or which are placed by matrices."""
    from bookpipe.llm.text import held_out
    r = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{int(j)}" for j in r.zipf(1.4, 60) % 70)) for i in range(80)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(scoring, "EXCHANGED", 8)
    found = []
    for classed, head in ((1_000, 1_000), (10, 1_000), (10, 20), (8, 8)):
        monkeypatch.setattr(scoring, "CLASSED", classed)
        monkeypatch.setattr(scoring, "HEAD", head)
        found.append({x.doc_id: (x.n_known, x.score) for x in scoring.score(spark, frame, held_out(7, 2)).collect()})
    for other in found[1:]:
        assert other.keys() == found[0].keys()
        assert all(other[i][0] == found[0][i][0] and other[i][1] == pytest.approx(found[0][i][1], rel=1e-9) for i in other)
    _, placed = scoring.learn(spark, frame)
    words = {w for _, text in rows for w in text.split()}
    assert placed.count() == len(words) - 8 and placed.filter(f"class NOT BETWEEN 0 AND {scoring.CLASSES - 1}").isEmpty()


def test_texts_are_split_twice_only(spark):
    """Once to count the words, once to give them numbers; all other steps work on these."""
    from pyspark.sql import functions as F

    from bookpipe.llm.text import held_out
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def passed(text):
        seen.add(1)
        return text

    frame = spark.createDataFrame([(i, f"the cat w{i} sat") for i in range(50)], "doc_id long, text string").repartition(2)
    assert scoring.score(spark, frame.withColumn("text", passed("text")), held_out(7, 2)).count() == 50
    assert 50 < seen.value <= 100


def test_words_and_numbers_of_texts(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(scoring, "BYTES", 40)
    monkeypatch.setattr(scoring, "FLUSH", 5)
    r = random.Random(4)
    texts = ["".join(r.choice("aBb\u00c4\u00a0\x1c\x85 \t\n\x0b\x0c\r") for _ in range(r.randrange(60))) for _ in range(60)] + [None, "", " ", "x" * 90]
    texts += ["" if t is None else t for t in texts]
    split = [[*(t or "").encode().lower().split(), scoring.END] for t in texts]
    batch = pa.record_batch({"text": pa.array(texts), "doc_id": pa.array(range(len(texts))), "held_out": pa.array([False] * len(texts))})
    counts = Counter()
    for part in scoring._count([batch.slice(0, 7), batch.slice(7), batch.slice(0, 0)]):
        for word, n in zip(*(column.to_pylist() for column in part.columns), strict=True):
            counts[word] += n
    assert counts == Counter(w for words in split for w in words)

    class Shared:
        value = [scoring.END, b"a", b"b", "\u00c4".encode()]

    monkeypatch.setattr(scoring.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 3})())
    found = [row for part in scoring._code(Shared)([batch.slice(0, 7), batch.slice(7)]) for row in part.to_pylist()]
    assert [x["row"] for x in found] == [(3 << 40) + i for i in range(len(texts))] and [x["doc_id"] for x in found] == [*range(len(texts))]
    assert [np.frombuffer(x["ids"], np.int32).tolist() for x in found] == [[Shared.value.index(w) if w in Shared.value else -1 for w in words] for words in split]
    assert [x["tail"].split() for x in found] == [[w for w in words if w not in Shared.value] for words in split]


def test_only_frequent_words_are_sorted(spark, monkeypatch):
    monkeypatch.setattr(scoring, "HEAD", 5)
    counts = spark.createDataFrame([(b"w%d" % i, 1 + i // 2) for i in range(40)], "word binary, n long")
    found = [(bytes(x.word), x.n) for x in scoring._frequent(counts).collect()]
    assert found == [(b"w38", 20), (b"w39", 20), (b"w36", 19), (b"w37", 19), (b"w34", 18)]
    assert scoring._frequent(counts.limit(0)).isEmpty() and scoring._frequent(counts.where("n < 3")).count() == 4
