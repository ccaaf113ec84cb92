"""Language-model scoring with a Brown class-based bigram model."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bookpipe.llm.text import emit, store

# Words that the exchange places, words whose neighbours each task counts in a matrix, and words that go
# to every task. All three are the most frequent ones. The rest, whose number is not bounded, are grouped by word.
EXCHANGED, CLASSED, HEAD = 512, 8_192, 100_000
CLASSES, SWEEPS, DISCOUNT = 32, 8, 0.75
# No word holds a blank, so a line feed can stand for the end of a text.
END = b"\n"
# Bytes of text, and tokens, that a task works on at once (more if a text is longer); counts that it holds; rows of a matrix that are summed together.
BYTES, FLUSH, ROWS = 1 << 23, 1 << 20, 256

COUNTED = pa.schema([("word", pa.binary()), ("n", pa.int64())])
CODED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("ids", pa.binary()), ("tail", pa.binary())])
CODED_TYPE = "row long, doc_id long, held_out boolean, ids binary, tail binary"
SUMS = pa.schema([("block", pa.int64()), ("cells", pa.binary()), ("n", pa.binary())])
SUMS_TYPE = "block long, cells binary, n binary"
CHOSEN = pa.schema([("code", pa.int64()), ("class", pa.int32())])
MET_TYPE = "word binary, row long, at int, held_out boolean, before int, after int"
PLACED_TYPE = "word binary, n long, class int, row long, at int, held_out boolean, before int, after int"
SCORED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()),
                    ("base", pa.float64()), ("score", pa.float64())])
SCORED_TYPE = "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double"


def _ranges(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` units; the units of row i end at ``ends[i]``."""
    cuts = np.flatnonzero(np.diff((ends - 1) // most)) + 1
    yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(ends)], strict=True)


def _words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words between ASCII blanks of all texts, with A-Z lower-cased, and where those of each text end. Null is an empty text."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(column.fill_null("")))
    flat, ends = parts.flatten(), np.cumsum(parts.value_lengths().to_numpy(), dtype=np.int64)
    full = pc.greater(pc.binary_length(flat), 0)  # blanks at the ends of a text leave empty words
    if not pc.all(full, min_count=0).as_py():
        ends = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64)))[ends]
        flat = flat.filter(full)
    return flat, ends


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.Array, np.ndarray]]:
    """Rows of bounded size with their words."""
    for batch in batches:
        if batch.num_rows:
            sizes = pc.binary_length(batch.column("text").fill_null("")).to_numpy()
            for low, high in _ranges(np.cumsum(sizes, dtype=np.int64), BYTES):
                part = batch.slice(low, high - low)
                yield part, *_words(part.column("text"))


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of this task's words and ends, in parts of bounded size."""
    held, size, ends = [], 0, 0

    def rows():
        table = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
        for batch in table.combine_chunks().to_batches():
            yield emit(COUNTED, [batch.column("word").cast(pa.binary()), batch.column("n_sum")])

    for part, flat, _ in _texts(batches):
        found = pc.value_counts(flat)
        held.append(pa.table({"word": found.field(0), "n": found.field(1)}))
        size, ends = size + len(found), ends + part.num_rows
        if size >= FLUSH:
            yield from rows()
            held, size = [], 0
    if size:
        yield from rows()
    if ends:
        yield emit(COUNTED, [[END], [ends]])


def _code(shared):
    """Each text as the numbers of its words, -1 for those that ``shared`` does not have, then the end's 0; and these other words, joined by blanks."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, row = pa.array(shared.value, pa.binary()).cast(pa.string(), safe=False), TaskContext.get().partitionId() << 40
        for part, flat, ends in _texts(batches):
            known = head if flat.type == head.type else head.cast(flat.type, safe=False)
            code = pc.index_in(flat, value_set=known).fill_null(-1).to_numpy()
            other = code < 0
            places = np.concatenate(([0], np.cumsum(other)))[np.concatenate(([0], ends))]
            tail = pc.binary_join(pa.ListArray.from_arrays(pa.array(places, pa.int32()), flat.filter(pa.array(other))), pa.scalar(" ", flat.type))
            ids = np.insert(code.astype(np.int32), ends, 0)
            places = np.concatenate(([0], 4 * (ends + np.arange(1, len(ends) + 1)))).astype(np.int32)
            blobs = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(places), pa.py_buffer(ids)])
            rows = np.arange(row, row + len(ends))
            row += len(ends)
            yield emit(CODED, [rows, part.column("doc_id"), part.column("held_out"), blobs, tail.cast(pa.binary())])
    return run


def _coded(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of bounded size with the numbers of their words, one text after another, and where each text ends."""
    for batch in batches:
        if batch.num_rows:
            column = batch.column("ids").cast(pa.large_binary())
            places = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset) // 4
            ids = np.frombuffer(column.buffers()[2], np.int32, places[-1])
            for low, high in _ranges(places[1:] - places[0], FLUSH):
                yield batch.slice(low, high - low), ids[places[low] : places[high]], places[low + 1 : high + 1] - places[low]


# Sums over cells of matrices: a task sends a row for each block of cells that it has met.


def _blocks(cells: np.ndarray, n: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """Counts of distinct cells in ascending order, by block."""
    block = cells // width
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(cells)] if len(cells) else [0]
    rows = [(int(block[i]), (cells[i:j] - block[i] * width).astype(np.int32).tobytes(), n[i:j].astype(np.int64).tobytes())
            for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
    if rows:
        yield emit(SUMS, zip(*rows, strict=True))


def _sums(width: int, finish: Callable):
    """Add up the rows of each block. ``finish`` makes batches of a block's number and its sums."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, cells, n in zip(*(batch.column(name).to_pylist() for name in SUMS.names), strict=True):
                total = totals.setdefault(block, np.zeros(width, np.int64))
                total[np.frombuffer(cells, np.int32)] += np.frombuffer(n, np.int64)
        for block, total in totals.items():
            yield from finish(block, total)
    return run


def _matrix(training: DataFrame, label: np.ndarray, k: int) -> np.ndarray:
    """How often ``label`` b follows a, over all neighbours; -1 is not counted. ``label`` is by number, last for other words. A text begins after an end."""
    width = ROWS * k

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k * k, np.int64)
        for _, ids, _ in _coded(batches):
            right = label[ids]
            left = np.concatenate((label[:1], right[:-1]))
            pairs = left * k + right
            total += np.bincount(pairs if label.min() >= 0 else pairs[(left >= 0) & (right >= 0)], minlength=k * k)
        cells = np.flatnonzero(total)
        yield from _blocks(cells, total[cells], width)

    def whole(block: int, total: np.ndarray) -> Iterator[pa.RecordBatch]:
        cells = np.flatnonzero(total)
        yield from _blocks(cells + block * width, total[cells], width)

    out = np.zeros(-(-k // ROWS) * width, np.int64)
    for block, cells, n in training.mapInArrow(run, SUMS_TYPE).repartition("block").mapInArrow(_sums(width, whole), SUMS_TYPE).collect():
        out[np.frombuffer(cells, np.int32) + block * width] = np.frombuffer(n, np.int64)
    return out[: k * k].reshape(k, k)


def _chosen(training: DataFrame, label: np.ndarray, weights: np.ndarray, low: int, k: int) -> np.ndarray:
    """The class of each word from number ``low`` on that the classes before (slots 0 to k-1) and after it (k to 2k-1) make likeliest.

    Neighbours of the most frequent words are counted in a matrix, those of later ones are sorted, some at a time.
    """
    size, width, high = 2 * k, ROWS * 2 * k, max(low, min(CLASSED + 1, len(label) - 1))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, keys, held = np.zeros((high - low) * size, np.int64), [], 0

        def rows():
            yield from _blocks(*np.unique(np.concatenate(keys), return_counts=True), width)

        for _, ids, _ in _coded(batches):
            classes = label[ids]
            at = np.flatnonzero(ids >= low)  # no text's end, so that a word follows
            code = ids[at].astype(np.int64) - low
            both = np.concatenate((code * size + classes[at - 1] * (at > 0) + classes[-1] * (at == 0), code * size + k + classes[at + 1]))
            first = both < len(total)
            total += np.bincount(both[first], minlength=len(total))
            keys.append(both[~first])
            held += len(keys[-1])
            if held >= 4 * FLUSH:
                yield from rows()
                keys, held = [], 0
        if held:
            yield from rows()
        cells = np.flatnonzero(total)
        yield from _blocks(cells, total[cells], width)

    def best(block: int, total: np.ndarray) -> Iterator[pa.RecordBatch]:
        slots = total.reshape(ROWS, size)
        met = np.flatnonzero(slots.any(1))
        yield emit(CHOSEN, [met + block * ROWS + low, (slots[met] @ weights).argmax(1)])

    out = np.zeros(len(label) - 1 - low, np.int64)
    if len(out):
        for code, choice in training.mapInArrow(run, SUMS_TYPE).repartition("block").mapInArrow(_sums(width, best), "code long, class int").collect():
            out[code - low] = choice
    return out


# Words that have no number


def _met(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each place of a word without a number, with the numbers of the words before and after."""
    for part, ids, ends in _coded(batches):
        at = np.flatnonzero(ids < 0)
        if len(at):
            flat, _ = _words(part.column("tail").cast(pa.string(), safe=False))
            text = np.searchsorted(ends, at, "right")
            before = np.where(at > 0, ids[at - 1], 0)
            yield pa.RecordBatch.from_arrays([
                flat.cast(pa.binary()), part.column("row").take(pa.array(text)), pa.array((at - np.concatenate(([0], ends))[text]).astype(np.int32)),
                part.column("held_out").take(pa.array(text)), pa.array(before.astype(np.int32)), pa.array(ids[at + 1])],
                names=["word", "row", "at", "held_out", "before", "after"])


def _place(shared, k: int):
    """Give each word, whose places follow each other, how often it is in training texts and the class that its neighbours there make likeliest.

    A word stands at the first of its places only. Neighbours become classes, -1 for a word without a number. Weights are whole numbers, so sums
    do not depend on their order. The places of a word are held at once: it is rarer than each word that has a number.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, weights, classes, rest = shared.value
        held: pa.Table | None = None

        def rows(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
            before, after = (table.column(name).to_numpy() for name in ("before", "after"))
            taught = ~table.column("held_out").to_numpy()
            n = np.add.reduceat(taught.astype(np.int64), starts)
            values = np.add.reduceat((weights[label[before]] + weights[k + label[after]]) * taught[:, None], starts)
            sizes = np.diff(np.append(starts, table.num_rows))
            later = np.ones(table.num_rows, bool)
            later[starts] = False
            word = table.column("word").take(pa.array(np.arange(len(later)), mask=later))
            out = pa.table([word, pa.array(np.repeat(n, sizes)), pa.array(np.repeat(np.where(n > 0, values.argmax(1), rest), sizes).astype(np.int32)),
                            table.column("row"), table.column("at"), table.column("held_out"), pa.array(classes[before]), pa.array(classes[after])],
                           names=["word", "n", "class", "row", "at", "held_out", "before", "after"])
            yield from out.combine_chunks().to_batches()

        for batch in batches:
            if batch.num_rows:
                parts = [pa.Table.from_batches([batch])]
                table = pa.concat_tables([held, *parts] if held is not None else parts).combine_chunks()
                word = table.column("word").combine_chunks()
                starts = np.append(0, 1 + np.flatnonzero(pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)))
                held = table.slice(starts[-1])
                if starts[-1]:
                    yield from rows(table.slice(0, starts[-1]), starts[:-1])
        if held is not None:
            yield from rows(held.combine_chunks(), np.zeros(1, np.int64))
    return run


def _others(spark: SparkSession, coded: DataFrame, label: np.ndarray, weights: np.ndarray, classes: np.ndarray, k: int) -> DataFrame:
    """Every place of a word without a number: n, class, the class before (of any word) and after (-1 for such a word); ``word`` at one place of each word."""
    shared = spark.sparkContext.broadcast((label, weights, np.append(classes, -1).astype(np.int32), CLASSES))
    met = coded.where("tail <> X''").select("row", "held_out", "ids", "tail").mapInArrow(_met, MET_TYPE)
    # In full order, so that a task that is run again finds the same first place.
    placed = met.repartition("word").sortWithinPartitions("word", "row", "at").mapInArrow(_place(shared, k), PLACED_TYPE)
    last = F.lag("class").over(Window.partitionBy("row").orderBy("at"))
    return store(spark, placed.withColumn("before", F.when(F.col("before") >= 0, F.col("before")).otherwise(last)))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def exchange(pairs: np.ndarray, fixed: int, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each word, by moving one word at a time to the class that makes the class bigrams likeliest.

    ``pairs`` counts neighbours. Its last ``fixed`` rows have a class each and never move; the words
    start in turn. A sweep without a move ends it. Ties go to the class with the least number.
    """
    pairs = pairs.astype(float)
    n = len(pairs) - fixed
    k = classes + fixed
    label = np.concatenate((np.arange(n) % classes, classes + np.arange(fixed)))
    member = np.zeros((len(pairs), k))
    member[np.arange(len(pairs)), label] = 1
    counts = member.T @ pairs @ member

    def value(rows: np.ndarray) -> np.ndarray:
        """Log-likelihood up to constants, for a stack of class count matrices."""
        return _xlogx(rows).sum(axis=(-2, -1)) - _xlogx(rows.sum(-1)).sum(-1) - _xlogx(rows.sum(-2)).sum(-1)

    for _ in range(sweeps):
        moved = False
        for w in range(n):
            old = label[w]
            after, before, own = pairs[w] @ member, pairs[:, w] @ member, pairs[w, w]
            after[old] -= own
            before[old] -= own
            rest = counts.copy()
            rest[old] -= after
            rest[:, old] -= before
            rest[old, old] -= own
            stack = np.broadcast_to(rest, (classes, k, k)).copy()
            each = np.arange(classes)
            stack[each, each] += after
            stack[each, :, each] += before
            stack[each, each, each] += own
            values = value(stack)
            new = int(values.argmax())
            if values[new] > values[old] + 1e-9 * abs(values[old]):
                label[w], moved = new, True
                member[w, old], member[w, new] = 0, 1
                counts = stack[new]
        if not moved:
            break
    return label


@dataclass(frozen=True)
class ClassModel:
    """Counts of the training tokens, classes of the frequent words, and class transitions."""

    train_tokens: int
    types: int
    counts: np.ndarray  # by number
    classes: np.ndarray  # by number; ``rest`` without a class of its own
    log_step: np.ndarray  # log10 P(class | class before)
    log_emit: np.ndarray  # log10 P(word | class), by number
    room: np.ndarray  # tokens of each class that are left to its words by discounting
    rest_tokens: int
    rest_types: int

    @property
    def rest(self) -> int:
        return len(self.log_step) - 2

    def base(self, count):
        return np.log10((np.asarray(count, float) + 1) / (self.train_tokens + self.types + 1))

    def emit_rest(self, count):
        """log10 P(word | rest class); the discounted mass is that of all unseen words, which count as one type, as in the base."""
        count = np.asarray(count, float)
        return np.log10(np.where(count > 0, count - DISCOUNT, DISCOUNT * self.rest_types + 1) / (self.rest_tokens + 1))


def class_model(counts: list[tuple[bytes, int]], train_tokens: int, types: int, classes: np.ndarray, transitions: np.ndarray,
                more: np.ndarray | None = None) -> ClassModel:
    """Smooth transitions by discounting towards the classes' shares; emission is a word's share of its class.

    ``more`` has the tokens and types by class of words that are not in ``counts``. Discounting the words of a class frees a share of the
    steps into it, which are steps into the rest: a word that was not seen is there.
    """
    numbers = np.array([n for _, n in counts], np.int64)
    rest = len(transitions) - 2
    inside = classes != rest
    more = np.zeros((2, len(transitions)), np.int64) if more is None else more
    mass = np.bincount(classes, numbers, minlength=len(transitions)) + more[0]
    kinds = np.bincount(classes[numbers > 0], minlength=len(transitions)) + more[1]
    rest_tokens, rest_types = train_tokens - int(np.delete(mass, rest).sum()), types - int(np.delete(kinds, rest).sum())
    into = transitions.sum(0)
    share = (into + 1) / (into.sum() + len(into))
    total = transitions.sum(1, keepdims=True)
    seen = (transitions > 0).sum(1, keepdims=True)
    step = np.where(total > 0, (np.maximum(transitions - DISCOUNT, 0) + DISCOUNT * seen * share) / np.maximum(total, 1), share)
    free = DISCOUNT * kinds / np.maximum(mass, 1)
    free[rest] = 0
    freed = step * free
    step = step - freed
    step[:, rest] += freed.sum(1)
    room = np.maximum(mass - DISCOUNT * kinds, DISCOUNT)
    model = ClassModel(train_tokens, types, numbers, classes, np.log10(step), np.zeros(0), room,
                       rest_tokens, rest_types)
    emission = np.where(inside, np.log10(np.maximum(numbers - DISCOUNT, 1 - DISCOUNT) / room[classes]), model.emit_rest(numbers))
    return ClassModel(**{**model.__dict__, "log_emit": emission})


@dataclass(frozen=True)
class Fit:
    """A model, the texts as numbers of words, and the places of the words without a number."""

    model: ClassModel
    coded: DataFrame
    others: DataFrame


def _frequent(counts: DataFrame) -> DataFrame:
    """The ``HEAD`` most frequent words. Only words about as frequent as the last of them are sorted, as each task may send that many to the driver."""
    size, found, least = F.floor(F.log2("n") * 8), 0, 0
    for least, words in sorted(counts.groupBy(size.alias("size")).count().collect(), reverse=True):
        found += words
        if found >= HEAD:
            break
    return counts.filter(size >= least).orderBy(F.desc("n"), "word").limit(HEAD)


def fit(spark: SparkSession, source: DataFrame) -> Fit:
    """Learn from the rows (doc_id, text, held_out) that are not held out. Words get their numbers once, in all rows."""
    counts = store(spark, source.filter(~F.col("held_out")).select("text").mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))
    train_tokens, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = counts.filter(F.col("word") == F.lit(END)).select("n").first()
    # Number 0 is the end.
    head = [(END, ends[0] if ends else 0), *((bytes(r.word), r.n) for r in _frequent(counts.filter(F.col("word") != F.lit(END))).collect())]
    coded = store(spark, source.mapInArrow(_code(spark.sparkContext.broadcast([w for w, _ in head])), CODED_TYPE))
    training = coded.filter(~F.col("held_out")).select("ids")
    # Exchange: words 1 to EXCHANGED, then the rest, then the end.
    m = min(EXCHANGED, CLASSED, len(head) - 1)
    place = np.full(len(head) + 1, m, np.int64)
    place[: m + 1] = [m + 1, *range(m)]
    pairs = _matrix(training, place, m + 2)
    found = exchange(pairs, fixed=2)
    rest, end, k = CLASSES, CLASSES + 1, CLASSES + 2
    label = found[place]
    # Other words: the class that makes the classes of their neighbours likeliest.
    member = np.zeros((m + 2, k), np.int64)
    member[np.arange(m + 2), found] = 1
    smooth = member.T @ pairs @ member + 0.5
    step = np.log(smooth / smooth.sum(1, keepdims=True))[:CLASSES]
    back = np.log(smooth / smooth.sum(0, keepdims=True))[:, :CLASSES]
    weights = np.rint(np.vstack((back, step.T)) * (1 << 20)).astype(np.int64)
    classes = np.concatenate(([end], found[:m], _chosen(training, label, weights, m + 1, k)))
    others = _others(spark, coded, label, weights, classes, k)
    known, n = _matrix(training, np.append(classes, -1), k), F.count("*")
    taught, more = others.where("NOT held_out"), np.zeros((2, k), np.int64)
    for a, b, times in taught.groupBy("before", "class").agg(n).collect() + taught.where("after >= 0").groupBy("class", "after").agg(n).collect():
        known[a, b] += times
    for c, tokens_, types_ in others.where("word IS NOT NULL AND n > 0").groupBy("class").agg(F.sum("n"), n).collect():
        more[:, c] = tokens_, types_
    return Fit(class_model(head, train_tokens, types, classes, known, more), coded, others)


def learn(spark: SparkSession, docs: DataFrame) -> tuple[ClassModel, DataFrame]:
    """Model and (word, n, class) of the words without a number, of the texts of ``docs``. Without rows nothing is known."""
    found = fit(spark, docs.select(F.lit(None).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.lit(False).alias("held_out")))
    return found.model, found.others.where("word IS NOT NULL AND n > 0").select("word", "n", "class")


def _score(shared):
    """Sums over the words that have a number and the steps between them."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        k, unseen = len(model.log_step), model.emit_rest(0)
        # By number, last for words without one, which add nothing here.
        known = np.append(model.counts > 0, False).astype(np.int64)  # the end is unseen, if there was no training text
        base = np.append(model.base(model.counts), 0.0)
        emission = np.append(np.where(model.counts > 0, model.log_emit, unseen), 0.0)
        classes = np.append(model.classes, k)
        steps = np.zeros((k + 1, k + 1))
        steps[:k, :k] = model.log_step
        steps = steps.ravel()
        for part, ids, ends in _coded(batches):
            starts = np.concatenate(([0], ends[:-1]))
            right = classes[ids]
            left = np.concatenate((classes[:1], right[:-1]))
            sums = (np.add.reduceat(x, starts) for x in (known[ids], base[ids], emission[ids] + steps[left * (k + 1) + right]))
            yield emit(SCORED, [*(part.column(name) for name in ("row", "doc_id", "held_out")), ends - starts, *sums])
    return run


def score(spark: SparkSession, docs: DataFrame, held_out: Column) -> DataFrame:
    """Learn from the rows that are not ``held_out`` and score every whole text.

    The classes come from an exchange over the most frequent words; each other word gets the one that its neighbours make likeliest. A
    text's probability is the product of class transitions and word emissions. Texts become numbers of frequent words once; the counts and
    classes of rarer words are found by grouping their places by word. Unseen words together are one type, in a class of its own, with the
    mass that discounting frees.

    One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one
    unigrams) and score, both log10. Null is an empty text, which is its end alone. Repeated rows are
    scored each; a doc_id may be null. Other columns are ignored; an empty table gives no row.
    """
    found = fit(spark, docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out.alias("held_out")))
    model, k = found.model, len(found.model.log_step)
    rows = found.coded.drop("tail").mapInArrow(_score(spark.sparkContext.broadcast(model)), SCORED_TYPE)
    n, place = F.col("n"), F.col("class")
    steps, room = F.lit(model.log_step.ravel().tolist()), F.lit(model.room.tolist())

    def step(a: Column, b: Column) -> Column:
        return F.element_at(steps, a * k + b + 1)

    base = F.log10((n + 1) / F.lit(float(model.train_tokens + model.types + 1)))
    emission = F.when(n > 0, F.log10((n - DISCOUNT) / F.element_at(room, place + 1))).otherwise(F.lit(float(model.emit_rest(0))))
    beside = step(F.col("before"), place) + F.when(F.col("after") >= 0, step(place, F.col("after"))).otherwise(0.0)
    sums = found.others.groupBy("row").agg(
        F.count_if(n > 0).alias("other_known"), F.sum(base).alias("other_base"), F.sum(emission + beside).alias("other_score"))
    more = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("other_known", "other_base", "other_score")}
    return rows.join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + more["other_known"]).alias("n_known"), F.lit(int(model.train_tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + more["other_base"]).alias("base_score"), (F.col("score") + more["other_score"]).alias("score"))
