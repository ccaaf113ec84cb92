"""Quality classifier: an ensemble of tree rules with lasso weights, compiled to column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from bookpipe.llm.text import emit, spans, texts, word_hashes

STATISTICS = ("length", "words", "word_length", "distinct", "repeated", "commonest", "pairs", "upper", "digits", "symbols",
              "marks", "high", "lines", "distinct_lines", "line_words", "longest_word")
# Labelled rows that a fit sees at most, and the shape of the ensemble.
FIT_ROWS, TREES, DEPTH, BINS, LEAST_LEAF, PENALTY = 8_000, 40, 3, 32, 20, 2e-3

_BITS = np.zeros((5, 256), bool)
_BITS[0, 0x41:0x5B] = True  # upper
_BITS[1, 0x30:0x3A] = True  # digits
_BITS[2, list(b"#$%&*+/<=>@[]^_`{|}~\\")] = True  # symbols
_BITS[3, list(b".,;:!?")] = True  # marks
_BITS[4, 0x80:] = True  # high


def statistics(text: bytes) -> list[float]:
    """Shape of one text; all are 0 for an empty one."""
    if not text:
        return [0.0] * len(STATISTICS)
    data = np.frombuffer(text, np.uint8)
    counts = np.bincount(data, minlength=256)
    shares = [float(counts[row].sum() / len(data)) for row in _BITS]
    starts, ends = spans(data)
    words = word_hashes(text)
    lines = [x for x in text.split(b"\n") if x.strip()]
    n = max(1, len(words))
    _, times = np.unique(words, return_counts=True)
    pairs = len(np.unique(words[1:] * np.uint64(3) ^ words[:-1])) / max(1, n - 1)
    return [float(np.log1p(len(data))), float(np.log1p(len(words))), float((ends - starts).sum() / n), len(times) / n,
            float((words[1:] == words[:-1]).sum() / n), float(times.max(initial=0) / n), float(pairs), *shares,
            float(np.log1p(len(lines))), len(set(lines)) / max(1, len(lines)), n / max(1, len(lines)),
            float((ends - starts).max(initial=0))]


def with_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` (kept as they are) and the statistics of ``text``; other columns go."""
    frame = docs.select(*keep, *([] if "text" in keep else ["text"]))
    names = [f"s_{s}" for s in STATISTICS]
    schema = StructType([*(frame.schema[k] for k in keep), *(StructField(n, DoubleType()) for n in names)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([statistics(t) for t in texts(batch)], float).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), *(pa.array(c) for c in found.T)], names=[*keep, *names])

    return frame.mapInArrow(run, schema)


@dataclass(frozen=True)
class Test:
    """A statistic above a cut, or at most it."""

    feature: int
    cut: float
    above: bool

    def holds(self, x: np.ndarray) -> np.ndarray:
        return (x[:, self.feature] > self.cut) == self.above

    def column(self) -> Column:
        value = F.col(f"s_{STATISTICS[self.feature]}")
        return value > F.lit(self.cut) if self.above else value <= F.lit(self.cut)


Rule = tuple[Test, ...]


def _best_split(binned: np.ndarray, grad: np.ndarray, rows: np.ndarray, features: np.ndarray) -> tuple[float, int, int] | None:
    """Largest gain in squared gradient sums over the bins of some features."""
    best = None
    total, n = grad[rows].sum(), len(rows)
    for f in features:
        sums = np.bincount(binned[rows, f], grad[rows], BINS).cumsum()[:-1]
        left = np.bincount(binned[rows, f], minlength=BINS).cumsum()[:-1]
        right = n - left
        ok = (left >= LEAST_LEAF) & (right >= LEAST_LEAF)
        if not ok.any():
            continue
        gain = np.where(ok, sums**2 / np.maximum(left, 1) + (total - sums) ** 2 / np.maximum(right, 1) - total**2 / n, -1)
        at = int(gain.argmax())
        if gain[at] > 1e-9 and (best is None or gain[at] > best[0]):
            best = (float(gain[at]), int(f), at)
    return best


def rules_of_trees(x: np.ndarray, y: np.ndarray, seed: int = 7) -> list[Rule]:
    """Grow boosted trees on the logistic gradient; every node but a root gives the rule of its path."""
    random = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    margin = np.zeros(len(y))
    found: dict[Rule, None] = {}
    for _ in range(TREES):
        probability = 1 / (1 + np.exp(-margin))
        grad = y - probability
        sample = np.flatnonzero(random.random(len(y)) < 0.6)
        features = random.permutation(x.shape[1])[: max(2, x.shape[1] // 2)]
        nodes: list[tuple[Rule, np.ndarray]] = [((), sample)]
        leaves: list[Rule] = []
        for _ in range(DEPTH):
            grown = []
            for path, rows in nodes:
                split = _best_split(binned, grad, rows, features) if len(rows) >= 2 * LEAST_LEAF else None
                if split is None:
                    leaves.append(path)
                    continue
                _, f, at = split
                cut = float(cuts[f][min(at, len(cuts[f]) - 1)])
                above = x[rows, f] > cut
                for side in (False, True):
                    rule = (*path, Test(f, cut, side))
                    found[rule] = None
                    grown.append((rule, rows[above == side]))
            nodes = grown
        for path in [*leaves, *(p for p, _ in nodes)]:
            held = holds(path, x)
            rows = sample[held[sample]]
            if len(rows):
                p = probability[rows]
                margin[held] += 0.3 * grad[rows].sum() / max(1e-3, (p * (1 - p)).sum())
    return list(found)


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    return reduce(np.logical_and, (t.holds(x) for t in rule), np.ones(len(x), bool))


def lasso(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 600) -> tuple[np.ndarray, float]:
    """Logistic weights with an absolute penalty, by accelerated proximal gradient; the intercept is free."""
    mean = z.mean(axis=0)
    z = z - mean
    step = 4 * len(y) / max(np.linalg.norm(z, 2) ** 2 + len(y), 1e-9)
    w, b = np.zeros(z.shape[1]), 0.0
    v, c, t = w, b, 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(z @ v + c))) - y
        new = v - step * (z.T @ error) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        shift = c - step * error.mean()
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        v, c = new + (before - 1) / t * (new - w), shift + (before - 1) / t * (shift - b)
        w, b = new, shift
    return w, b - float(mean @ w)


@dataclass(frozen=True)
class RuleEnsemble:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    intercept: float

    def column(self) -> Column:
        """Probability of label 1 over the statistics, as one expression."""
        margin = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            margin = margin + F.when(reduce(lambda a, b: a & b, (t.column() for t in rule)), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = self.intercept + sum((w * holds(r, x) for r, w in zip(self.rules, self.weights, strict=True)), np.zeros(len(x)))
        return 1 / (1 + np.exp(-margin))


def fit(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> RuleEnsemble:
    """Rules of trees, of which the lasso keeps few. Without rows the score is 0.5; with one label, near it."""
    if len(y) == 0:
        return RuleEnsemble((), (), 0.0)
    share = (y.sum() + 0.5) / (len(y) + 1)
    rules = rules_of_trees(x, y) if 0 < y.sum() < len(y) else []
    if not rules:
        return RuleEnsemble((), (), float(np.log(share / (1 - share))))
    z = np.stack([holds(r, x) for r in rules], axis=1).astype(float)
    z, first = np.unique(z, axis=1, return_index=True)  # rules that hold for the same rows are one
    weights, intercept = lasso(z, y, penalty)
    kept = [(rules[i], float(w)) for i, w in zip(first, weights, strict=True) if w]
    return RuleEnsemble(tuple(r for r, _ in kept), tuple(w for _, w in kept), intercept)


def learn(docs: DataFrame, labels: DataFrame, held_out: Column, fit_rows: int = FIT_ROWS) -> RuleEnsemble:
    """Fit on at most ``fit_rows`` labelled rows outside the held-out part, chosen by a hash of their doc_id.

    The chosen ids are few by this bound and are broadcast; their statistics, 16 numbers a row, reach
    the driver. Rows without label or doc_id are left out; a document with several labels counts by the largest,
    and one with several texts by the least.
    """
    chosen = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out).groupBy("doc_id").agg(
        F.max("quality").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    once = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    rows = with_statistics(once, ["doc_id", "y"]).toPandas()
    rows = rows.sort_values(["doc_id", *(f"s_{s}" for s in STATISTICS)])
    return fit(rows[[f"s_{s}" for s in STATISTICS]].to_numpy(float).reshape(-1, len(STATISTICS)), (rows["y"].to_numpy() > 0).astype(float))


def score(docs: DataFrame, model: RuleEnsemble, keep: list[str]) -> DataFrame:
    """``keep`` and ``score``, from the whole text alone. A null or empty text is scored by its statistics, all 0.

    Repeated rows are scored alike; columns not in ``keep`` are ignored; an empty table gives no row.
    """
    return with_statistics(docs, keep).select(*keep, model.column().alias("score"))
