"""Language identification: sparse multinomial logistic regression over TF-IDF character n-grams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookpipe.llm.text import emit, mixed, store

UNKNOWN = "und"
DIMENSIONS, ORDERS, BLOCK = 1 << 15, 3, 1 << 18
# Rows per language and in all that a fit sees at most, and passes over them.
FIT_ROWS, FIT_TOTAL, PASSES = 600, 20_000, 3
# Follow-the-regularised-leader: step sizes and elastic-net penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.05
SPACE = 32

FEATURES = pa.schema([("y", pa.string()), ("part", pa.float64()), ("h", pa.int64()), ("index", pa.list_(pa.int32())), ("value", pa.list_(pa.float32()))])
PREDICTED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


@cache
def _letters() -> np.ndarray:
    """Each code point's lower-case letter, or a blank for all that are not letters."""
    table = np.full(0x110000, SPACE, np.uint32)
    for code in range(0x110000):
        if (char := chr(code)).isalpha():
            table[code] = ord(char.lower()[0])
    return table


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed runs of 1 to 3 letters; runs of other characters are one blank. Taken in blocks of the text."""
    total = np.zeros(DIMENSIONS, np.int64)
    for low in range(0, len(text), BLOCK):
        part = text[max(0, low - ORDERS + 1) : low + BLOCK]
        codes = _letters()[np.frombuffer(part.encode("utf-32-le", "replace"), np.uint32)]
        codes = np.concatenate(([SPACE], codes, [SPACE])).astype(np.uint64)
        codes = codes[np.concatenate(([True], (codes[1:] != SPACE) | (codes[:-1] != SPACE)))]
        grams = np.zeros(len(codes), np.uint64)
        for order in range(1, min(ORDERS, len(codes)) + 1):
            grams = grams[: len(codes) - order + 1] * np.uint64(0x100000001B3) + codes[order - 1 :]
            kept = grams[grams != SPACE] if order == 1 else grams
            total += np.bincount((mixed(kept + np.uint64(order << 60)) % np.uint64(DIMENSIONS)).astype(np.int64), minlength=DIMENSIONS)
    index = np.flatnonzero(total)
    return index.astype(np.int32), total[index]


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def weighted(index: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    value = (1 + np.log(count)) * idf[index]
    return value / max(1e-12, float(np.linalg.norm(value)))


class Leader:
    """Follow the regularised leader, one row of coordinates per language."""

    def __init__(self, languages: int):
        self.z = np.zeros((languages, DIMENSIONS))
        self.n = np.zeros((languages, DIMENSIONS))

    def weights(self, index: np.ndarray) -> np.ndarray:
        z = self.z[:, index]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(self.n[:, index])) / ALPHA + L2))

    def learn(self, index: np.ndarray, value: np.ndarray, y: int) -> None:
        w = self.weights(index)
        p = softmax(w @ value)
        p[y] -= 1
        grad = p[:, None] * value
        n = self.n[:, index]
        step = (np.sqrt(n + grad**2) - np.sqrt(n)) / ALPHA
        self.z[:, index] += grad - step * w
        self.n[:, index] = n + grad**2


def softmax(margin: np.ndarray) -> np.ndarray:
    e = np.exp(margin - margin.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(margins: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the margins that makes labels unseen by the fit likeliest, by golden-section search on its logarithm."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        return -float(np.log(np.maximum(softmax(margins / np.exp(t))[np.arange(len(y)), y], 1e-300)).mean())

    low, high, ratio = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass(frozen=True)
class LanguageModel:
    """Learned languages, inverse document frequencies, sparse weights and temperature."""

    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        index, count = gram_counts(text)
        p = softmax(self.weights[:, index] @ weighted(index, count, self.idf) / self.temperature)
        return self.languages[int(p.argmax())], float(p.max())


def fit(rows: list[tuple[str, float, np.ndarray, np.ndarray]], idf: np.ndarray) -> LanguageModel:
    """Fit on (language, place in [0, 1), index, count) rows; the last fifth of places is for the temperature."""
    languages = tuple(sorted({y for y, *_ in rows}))
    code = {y: i for i, y in enumerate(languages)}
    data = [(part, code[y], index, weighted(index, count, idf)) for y, part, index, count in rows if len(index)]
    data.sort(key=lambda x: (x[0], x[1], x[2].tobytes()))
    leader = Leader(len(languages))
    fitted, kept = [x for x in data if x[0] < 0.8], [x for x in data if x[0] >= 0.8]
    for k in range(PASSES):
        for i in np.random.default_rng(k).permutation(len(fitted)):
            _, y, index, value = fitted[i]
            leader.learn(index, value, y)
    w = leader.weights(np.arange(DIMENSIONS))
    margins = np.array([w[:, i] @ v for _, _, i, v in kept]).reshape(len(kept), len(languages))
    return LanguageModel(languages, idf, w.astype(np.float32), temperature(margins, np.array([y for _, y, *_ in kept], int)))


def _strings(batch: pa.RecordBatch) -> Iterator[str | None]:
    for value in batch.column("text"):
        yield value.as_py()


def _document_frequency(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per feature of this task's documents, and the number of documents under feature -1."""
    total, n = np.zeros(DIMENSIONS, np.int64), 0
    for batch in batches:
        for text in _strings(batch):
            total[gram_counts(text or "")[0]] += 1
            n += 1
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array([-1, *found], pa.int32()), pa.array([n, *total[found]], pa.int64())], names=["feature", "n"])


def _featured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for y, part, h, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "part", "h")), _strings(batch), strict=True):
            index, count = gram_counts(text)
            rows.append((y, part, h, index, count.astype(np.float32)))
        if rows:
            yield emit(FEATURES, zip(*rows, strict=True))


def _predicted(model: LanguageModel):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t) for t in _strings(batch)]
            yield emit(PREDICTED, [batch.column("doc_id"), batch.column("held_out"), [x for x, _ in found], [s for _, s in found]])
    return run


def learn(spark: SparkSession, docs: DataFrame, fit_rows: int = FIT_ROWS) -> LanguageModel:
    """Learn from the rows of ``docs`` (doc_id, text, lang) that have text and language.

    Document frequencies count all these rows. The regression sees at most ``fit_rows`` of a language,
    chosen by a hash of text and doc_id; of each the driver gets at most 2 ** 15 counts.
    """
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.xxhash64("text", "doc_id").alias("h")).filter("text IS NOT NULL AND lang IS NOT NULL")
    frequency = store(spark, rows.select("text").mapInArrow(_document_frequency, "feature int, n long")).groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(DIMENSIONS)
    n = int(frequency["n"][frequency["feature"] == -1].sum())
    named = frequency[frequency["feature"] >= 0]
    df[named["feature"].to_numpy(int)] = named["n"].to_numpy(float)
    idf = np.log((1 + n) / (1 + df)) + 1
    # Rows below a share of the hash range, so that about fit_rows of each language remain, then exactly that many.
    sizes = rows.groupBy("lang").count()
    fit_rows = min(fit_rows, FIT_TOTAL // max(1, sizes.count()))
    sizes = sizes.select("lang", F.least(F.lit(1.0), 1.5 * fit_rows / F.col("count")).alias("share"))
    place = (F.pmod("h", F.lit(1 << 30)) / float(1 << 30)).alias("place")
    few = rows.select("text", "lang", "h", place).join(F.broadcast(sizes), "lang").filter("place < share")
    few = few.withColumn("part", F.pmod(F.xxhash64("h"), F.lit(1 << 20)) / float(1 << 20))
    found = few.mapInArrow(_featured, "y string, part double, h long, index array<int>, value array<float>").collect()
    by: dict[str, list] = {}
    for r in sorted(found, key=lambda r: (r.y, r.h)):
        own = by.setdefault(r.y, [])
        if len(own) < fit_rows:
            own.append((r.y, r.part, np.array(r["index"], np.int32), np.array(r["value"], float)))
    return fit([x for own in by.values() for x in own], idf)


def identify(docs: DataFrame, model: LanguageModel, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, from the whole text alone.

    The score is the calibrated probability. A null text or one without a letter is ``und`` with score 0,
    as is any text if nothing was learned. Repeated rows are treated alike, other columns are ignored,
    and an empty table gives no row.
    """
    source = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"))
    return source.mapInArrow(_predicted(model), "doc_id long, held_out boolean, lang_pred string, score double")
