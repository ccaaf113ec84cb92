"""CSV records of large files, found in parallel although quoted values may hold line breaks.

Spark's reader gives such a file to one task. Here the file is read as lines, in splits. Whether a line starts a record depends on
whether a quoted value is open before it, and that on everything above. But each line maps "open before" to "open after", so a
split can be described for both cases without knowing which of them holds.

The text is read twice and never shuffled. The first pass writes a row per split: what it makes of either state, and the few lines
at its edges. From these rows the driver, which schedules a task per split anyway, finds the state before each split. With
the states known, the second pass puts the records of each split together where they lie. Records that cross splits come from the written edges.

Both passes are fed by native expressions, which classify the lines; Python only follows the states, a batch of lines at a time, and cuts
the batch's text by new offsets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bookpipe.session import shared_folder, ship_package

_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
_FIELDS = rf'(?:(?:{_QUOTED}"|[^",][^,]*+|),)*+'
# A line that leaves a quoted value open, if none was open before it and if one was.
_OPENS = rf'^{_FIELDS}{_QUOTED}\z'
_STAYS_OPEN = rf'^[^"]*+(?:""[^"]*+)*+(?:\z|",{_FIELDS}{_QUOTED}\z)'
# What a line does to the state, as (open after if closed before) + 2 * (open after if open before).
CLOSES, SWAPS, KEEPS, OPENS = range(4)
# Lines at an edge of a split that are kept with its marks. Where they are longer, the text is read once more for them.
EDGE_BYTES = 1 << 20
# A file that cannot be split, of this length or more, has its records dealt to other tasks before they are parsed.
UNSPLIT_BYTES = 64 << 20
UNSPLIT = r"\.(gz|gzip|deflate|snappy|lz4|zst)$"
NONE = -1

MARKS = pa.schema([
    ("file", pa.int64()), ("split", pa.int64()), ("end0", pa.int8()), ("end1", pa.int8()), ("start0", pa.int64()), ("start1", pa.int64()),
    ("filled", pa.int64()), ("windows", pa.bool_()), ("head", pa.binary()), ("tail0", pa.binary()), ("tail1", pa.binary())])
PIECES = pa.schema([("file", pa.int64()), ("owner", pa.int64()), ("split", pa.int64()), ("first", pa.bool_()), ("windows", pa.bool_()), ("value", pa.string())])
MARKS_TYPE = ("file long, split long, end0 tinyint, end1 tinyint, start0 long, start1 long, filled long, windows boolean, "
              "head binary, tail0 binary, tail1 binary")
PIECES_TYPE = "file long, owner long, split long, first boolean, windows boolean, value string"


def _opens(line: Column) -> Column:
    """Whether a line, by itself, leaves a quoted value open."""
    return F.contains(line, F.lit('"')) & line.rlike(_OPENS)


def plain(spark: SparkSession, path: str) -> bool:
    """Whether every line of the files is a record, and one that Spark's reader of lines sees as it is.

    That is: no quoted value holds a line break, no line has a carriage return, and no line has blanks alone, which that reader would leave out.
    """
    line = F.col("value")
    other = _opens(line) | F.contains(line, F.lit("\r")) | line.rlike(r"^[\x00-\x20]+\z")
    return not spark.read.text(path, lineSep="\n").agg(F.coalesce(F.bool_or(other), F.lit(False))).first()[0]


def unsplit(spark: SparkSession, path: str) -> bool:
    """Whether there are large files that cannot be split."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return not files.where(F.col("path").rlike(UNSPLIT) & (F.col("length") >= UNSPLIT_BYTES)).isEmpty()


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, code, value): what each line does to the state, and its text with the line end."""
    line = F.rtrim(F.col("value"), F.lit("\r"))
    code = F.when(~F.contains("value", F.lit('"')), KEEPS).otherwise(
        line.rlike(_OPENS).cast("int") + 2 * line.rlike(_STAYS_OPEN).cast("int"))
    return spark.read.text(path, lineSep="\n").select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        code.cast("tinyint").alias("code"), F.concat("value", F.lit("\n")).alias("value"))


def _followed(code: np.ndarray, before: int) -> tuple[np.ndarray, int]:
    """The state before each line, and that after the last one.

    It is that of the last line that closes or opens in any case, turned by the swaps since then.
    """
    places = np.arange(len(code))
    swaps = np.cumsum(code == SWAPS) & 1
    fixed = np.maximum.accumulate(np.where((code == CLOSES) | (code == OPENS), places, NONE))
    after = np.where(fixed >= 0, (code[fixed] == OPENS) ^ swaps ^ swaps[fixed], before ^ swaps)
    return np.concatenate(([before], after[:-1])), int(after[-1])


@dataclass
class _Text:
    """Consecutive lines of one split in one batch: their codes, and their text in a shared buffer."""

    code: np.ndarray
    offsets: np.ndarray
    buffer: pa.Buffer

    def bytes(self, low: int, high: int) -> bytes:
        return self.buffer[int(self.offsets[low]) : int(self.offsets[high])].to_pybytes()


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], _Text]]:
    """((file, split), lines), in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, split, code = (batch.column(name).to_numpy() for name in ("file", "split", "code"))
        value = batch.column("value").cast(pa.string())
        offsets = np.frombuffer(value.buffers()[1], np.int32)[value.offset : value.offset + len(value) + 1]
        cuts = [0, *(np.flatnonzero((np.diff(file) != 0) | (np.diff(split) != 0)) + 1).tolist(), len(code)]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            yield (int(file[low]), int(split[low])), _Text(code[low:high], offsets[low : high + 1], value.buffers()[2])


@dataclass
class _Edge:
    """Lines at an edge of a split, up to ``most`` bytes; None when there are more."""

    most: int
    parts: list[bytes] | None = field(default_factory=list)
    size: int = 0

    def add(self, text: _Text, low: int, high: int) -> None:
        self.size += int(text.offsets[high] - text.offsets[low])
        if self.size > self.most:
            self.parts = None
        if self.parts is not None:
            self.parts.append(text.bytes(low, high))

    def text(self) -> bytes | None:
        return None if self.parts is None else b"".join(self.parts)


class _Marks:
    """What is known of a split before its state is: for either state, where it ends and where its last record starts."""

    def __init__(self, key: tuple[int, int], most: int):
        self.key, self.most, self.lines, self.filled, self.windows = key, most, 0, NONE, False
        self.end, self.start = [0, 1], [NONE, NONE]
        self.head, self.tails = _Edge(most), [_Edge(most), _Edge(most)]

    def add(self, text: _Text) -> None:
        n = len(text.code)
        if not self.lines:
            self.windows = text.bytes(0, 1).endswith(b"\r\n")
        if self.filled == NONE:
            sizes = np.diff(text.offsets)
            for at in np.flatnonzero(sizes > 1):
                if sizes[at] > 2 or text.bytes(at, at + 1) != b"\r\n":
                    self.filled = self.lines + int(at)
                    break
        for state in (0, 1):
            before, self.end[state] = _followed(text.code, self.end[state])
            starts = np.flatnonzero(before == 0)
            if state and self.start[1] == NONE:
                self.head.add(text, 0, int(starts[0]) if len(starts) else n)
            if len(starts):
                self.start[state], self.tails[state] = self.lines + int(starts[-1]), _Edge(self.most)
                self.tails[state].add(text, int(starts[-1]), n)
            elif self.start[state] != NONE:
                self.tails[state].add(text, 0, n)
        self.lines += n

    def row(self) -> pa.RecordBatch:
        tails = [tail.text() if end else b"" for tail, end in zip(self.tails, self.end, strict=True)]
        values = [*self.key, *self.end, *self.start, self.filled, self.windows, self.head.text(), *tails]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, MARKS, strict=True)], schema=MARKS)


def _marked(most: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The marks of each split; edges of more than ``most`` bytes are left out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks: _Marks | None = None
        for key, text in _slices(batches):
            if marks is None or marks.key != key:
                if marks is not None:
                    yield marks.row()
                marks = _Marks(key, most)
            marks.add(text)
        if marks is not None:
            yield marks.row()

    return run


class States:
    """The state before each split, from the marks of all: five numbers a split.

    ``owner`` is the split where the record that is open before a split started. ``single`` is the line from which on each line is
    a record of its own, as the file ends with an open value that started there. ``header`` is the line of the header, in the split that has it.
    """

    def __init__(self, marks: pa.Table):
        marks = marks.sort_by([("file", "ascending"), ("split", "ascending")])
        self.file, self.split, self.filled = (marks.column(name).to_numpy() for name in ("file", "split", "filled"))
        ends = [marks.column(f"end{s}").to_numpy() for s in (0, 1)]
        starts = [marks.column(f"start{s}").to_numpy() for s in (0, 1)]
        n = len(self.file)
        self.before, self.after = np.zeros(n, np.int8), np.zeros(n, np.int8)
        self.owner, self.header = np.full(n, NONE, np.int64), np.full(n, NONE, np.int64)
        self.start, self.single = np.full(n, NONE, np.int64), np.full(n, np.iinfo(np.int64).max)
        self.windows = marks.column("windows").to_numpy(zero_copy_only=False).copy()
        cuts = [0, *(np.flatnonzero(np.diff(self.file)) + 1).tolist(), n] if n else [0]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            self.windows[low:high] = self.windows[low]
            filled = np.flatnonzero(self.filled[low:high] != NONE)
            if len(filled):
                self.header[low + filled[0]] = self.filled[low + filled[0]]
            state, owner = 0, low
            for i in range(low, high):
                self.before[i], self.start[i] = state, starts[state][i]
                self.owner[i] = self.split[owner] if state else NONE
                owner = i if starts[state][i] != NONE else owner
                state = self.after[i] = ends[state][i]
            if state:
                self.single[owner], self.single[owner + 1 : high] = self.start[owner], 0

    def find(self, key: tuple[int, int]) -> int:
        low, high = np.searchsorted(self.file, key[0], "left"), np.searchsorted(self.file, key[0], "right")
        at = int(low + np.searchsorted(self.split[low:high], key[1]))
        if at == high or self.split[at] != key[1]:
            raise ValueError("the files or the settings that divide them have changed since the records were looked for")
        return at

    def edges(self) -> pa.Table:
        """The edges that hold parts of records: (file, split, owner, part, first, windows)."""
        heads = np.flatnonzero((self.before == 1) & (self.single != 0))
        tails = np.flatnonzero((self.after == 1) & (self.start != NONE) & (self.single == np.iinfo(np.int64).max))
        both, n = np.concatenate((heads, tails)), len(heads)
        return pa.table({
            "file": self.file[both], "split": self.split[both],
            "owner": np.concatenate((self.owner[heads], self.split[tails])),
            "part": pa.array(["head"] * n + [f"tail{state}" for state in self.before[tails]], pa.string()),
            # A header that crosses a border starts in a tail.
            "first": (self.header[both] != NONE) & (self.header[both] == self.start[both]) & (np.arange(len(both)) >= n),
            "windows": self.windows[both],
        })


class _Records:
    """Puts the records of one split together, the state before it being known."""

    def __init__(self, states: States, key: tuple[int, int], edges: bool):
        at = states.find(key)
        self.key, self.edges, self.lines = key, edges, 0
        self.state, self.owner = int(states.before[at]), int(states.owner[at])
        self.single, self.header, self.windows = int(states.single[at]), int(states.header[at]), bool(states.windows[at])
        # The record that is not finished yet: its text, and whether it is the header.
        self.open: list[bytes] = []
        self.first = False

    def add(self, text: _Text) -> Iterator[pa.RecordBatch]:
        n = len(text.code)
        before, self.state = _followed(text.code, self.state)
        starts = np.flatnonzero((before == 0) | (self.lines + np.arange(n) >= self.single))
        self.lines += n
        if not len(starts):
            self.open.append(text.bytes(0, n))
            return
        if starts[0]:
            self.open.append(text.bytes(0, int(starts[0])))
        yield from self.finish()
        whole = self.state == 0 or self.lines >= self.single
        bounds = np.append(starts, n) if whole else starts
        heads = self.lines - n + starts == self.header
        if len(bounds) > 1 and not self.edges:
            offsets = pa.py_buffer(np.ascontiguousarray(text.offsets[bounds], np.int32))
            yield self._batch(pa.Array.from_buffers(pa.string(), len(bounds) - 1, [None, offsets, text.buffer]), heads[: len(bounds) - 1])
        self.owner = self.key[1]
        if not whole:
            self.open, self.first = [text.bytes(int(starts[-1]), n)], bool(heads[-1])

    def finish(self, cut: bool = False) -> Iterator[pa.RecordBatch]:
        """The open record is complete, or the split ends in it."""
        edge = cut or self.owner not in (NONE, self.key[1])
        if self.open and edge == self.edges:
            yield self._batch(pa.array([b"".join(self.open)], pa.binary()).cast(pa.string(), safe=False), np.array([self.first]))
        self.open, self.first = [], False

    def _batch(self, values: pa.Array, first: np.ndarray) -> pa.RecordBatch:
        n = len(values)
        place = [pa.array(np.full(n, v)) for v in (self.key[0], self.owner if self.owner != NONE else self.key[1], self.key[1])]
        return pa.RecordBatch.from_arrays([*place, pa.array(first, pa.bool_()), pa.array(np.full(n, self.windows)), values], schema=PIECES)


def _put_together(shared, edges: bool) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Records that lie in one split, or else the parts of those that cross splits."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records: _Records | None = None
        for key, text in _slices(batches):
            if records is None or records.key != key:
                if records is not None:
                    yield from records.finish(cut=records.state == 1)
                records = _Records(shared.value, key, edges)
            yield from records.add(text)
        if records is not None:
            yield from records.finish(cut=records.state == 1)

    return run


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(first, windows, value): the text of every CSV record, blank lines included.

    ``first`` marks the header of each file, its first line that is not blank. ``windows`` says that the file's first line ends in CRLF, which then holds
    for all of it; such ends within a record are given as LF. A record may cross any number of lines and splits; it is held in memory, as it becomes a row.

    A quoted value that is never closed would make the rest of its file one record. Here each line from the record's first one on is a record
    of its own, so that a stray quote spoils its line only, and no more than a line of it is held in memory.

    The files are looked through when this is called, and read again when the result is. They must be the same then, and be divided in the same way,
    or the second reading fails. A compressed file is a single split, of which a task holds a batch of lines at a time. If there are large ones, the records
    are dealt out anew, so that parsing and what follows is not left to the tasks that unpack them.
    """
    ship_package(spark)
    folder = shared_folder(spark)
    lines = _lines(spark, path)
    lines.mapInArrow(_marked(EDGE_BYTES), MARKS_TYPE).write.parquet(folder)
    marks = spark.read.schema(MARKS_TYPE).parquet(folder)
    states = States(marks.drop("head", "tail0", "tail1").toArrow())
    shared = spark.sparkContext.broadcast(states)
    whole = lines.mapInArrow(_put_together(shared, edges=False), PIECES_TYPE)
    edges = states.edges()
    if edges.num_rows:
        parts = spark.createDataFrame(edges).join(marks.drop("windows"), ["file", "split"])
        value = F.coalesce(*[F.when(F.col("part") == name, F.col(name)) for name in ("head", "tail0", "tail1")])
        parts = parts.select("file", "owner", "split", "first", "windows", value.cast("string").alias("value"))
        if not parts.filter("value IS NULL").isEmpty():
            parts = lines.mapInArrow(_put_together(shared, edges=True), PIECES_TYPE)
        ordered = F.array_sort(F.collect_list(F.struct("split", "value")))
        joined = parts.groupBy("file", "owner").agg(
            F.bool_or("first").alias("first"), F.bool_or("windows").alias("windows"),
            F.array_join(F.transform(ordered, lambda part: part["value"]), "").alias("value"))
        whole = whole.unionByName(joined.select(*PIECES.names[:2], F.lit(None).cast("long").alias("split"), *PIECES.names[3:]))
    if unsplit(spark, path):
        whole = whole.hint("rebalance")
    ended = F.when(F.col("windows"), F.regexp_replace("value", "\r+\n", "\n")).otherwise(F.col("value"))
    return whole.select("first", "windows", F.rtrim(ended, F.lit("\n")).alias("value"))


def parse_records(records: DataFrame, schema: StructType, options: dict) -> DataFrame:
    """Typed rows of CSV records. The header of each file must be that of the schema."""
    options = {**options, "header": "false", "multiLine": "true"}
    text = F.col("value")

    def ddl(kinds: dict[str, str]) -> str:
        return ", ".join(f"`{name}` {kind}" for name, kind in kinds.items())

    kinds = {field.name: field.dataType.simpleString() for field in schema}

    def is_header() -> Column:
        found = F.from_csv(text, ddl(dict.fromkeys(kinds, "string")), options)
        return F.lower(F.to_json(found)) == F.lower(F.to_json(F.struct(*[F.lit(name).alias(name) for name in kinds])))

    wrong = F.raise_error(F.concat(F.lit("unexpected CSV header: "), text)).cast("boolean")
    is_row = F.when(~F.col("first"), text != "").when(is_header(), False).otherwise(wrong)
    return records.where(is_row).select(F.from_csv(text, ddl(kinds), options).alias("row")).select("row.*")
