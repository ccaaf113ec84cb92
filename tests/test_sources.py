"""Raw CSV, the processed zone and the landing zone, on hand-made rows."""

import gzip
import random
from collections import Counter
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from bookpipe.schemas import ENTITIES, STAGING_REVIEWS
from bookpipe.sources.processed import read_processed_csv, write_processed, write_processed_csv
from bookpipe.sources.raw import landing_report, read_raw
from bookpipe.operators.align import align

REVIEWS, AUTHORS = ENTITIES["reviews"], ENTITIES["authors"]


def bag(df):
    return Counter(tuple(row) for row in df.collect())


@pytest.fixture
def small_splits(spark):
    """A few hundred bytes per split, so that records cross many borders."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    saved = {name: spark.conf.get(name) for name in names}
    yield lambda size: [spark.conf.set(name, str(size)) for name in names]
    for name, value in saved.items():
        spark.conf.set(name, value)


NASTY = [
    'plain', '', ' edge ', 'comma, inside', 'he said "x"', '"', '""', '"quoted"', 'a\nb', '\n', '\n\n\n',
    'line one\nline "two"\n\nline, four\n', '","', '",\n"', 'ends with quote"', '"starts', 'x' * 900,
    'y\n' * 400, '"\n' * 300, '1,"2",3\n4,"5",6', ',,,\n,,,', '"\n"', "it's 5\" wide", 'tab\tand | pipe',
]


def csv_text(rows):
    def cell(value):
        text = "" if value is None else str(value)
        return '"' + text.replace('"', '""') + '"' if any(c in text for c in '",\n\r') else text
    return "".join(",".join(cell(value) for value in row) + "\n" for row in rows)


@pytest.mark.parametrize("size", [64, 333, 5000, 10_000_000])
def test_large_reader_equals_the_whole_file_reader(spark, tmp_path, small_splits, size):
    rows = [("review_id", "review_text", "spoiler_state")]
    rows += [(i * 100 + j, text, other) for i, text in enumerate(NASTY)
             for j, other in enumerate(("s", 'q"q', "n\nn", ""))]
    source = tmp_path / "reviews.csv"
    source.mkdir()
    (source / "a.csv").write_text(csv_text(rows))
    (source / "b.csv").write_text(csv_text(rows[:1] + [(-n, text, None) for n, text in enumerate(NASTY, 1)]))
    (source / "c.csv").write_text(csv_text(rows[:1]))
    small_splits(size)
    whole = read_raw(spark, str(source), REVIEWS, large=False)
    large = read_raw(spark, str(source), REVIEWS)
    assert whole.schema == large.schema
    assert whole.count() == len(NASTY) * 5
    assert bag(whole) == bag(large)
    texts = {row.review_id: row.review_text for row in large.collect()}
    assert all(texts[i * 100] == (text or None) for i, text in enumerate(NASTY))


@pytest.mark.parametrize("size", [64, 10_000_000])
def test_malformed_rows_do_not_spoil_others(spark, tmp_path, small_splits, size):
    path = tmp_path / "author.csv"
    path.write_text('author_id,name,role,ratings_count\n'
                    '1,5" disk,r,1\n'          # stray quote in an unquoted value
                    '2,"ok",r,2\n'
                    'x,"bad key",r,y\n'
                    '\n'
                    '3,short\n'
                    '4,"multi\nline",r,4,extra\n'
                    '5,"last",r,5')
    small_splits(size)
    for large in (False, True):
        rows = {row.name: row for row in read_raw(spark, str(path), AUTHORS, large).collect()}
        assert set(rows) == {'5" disk', "ok", "bad key", "short", "multi\nline", "last"}
        assert rows["bad key"].author_id is None and rows["bad key"].ratings_count is None
        assert rows["short"].role is None
        assert rows["last"].ratings_count == 5


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_text_is_read_twice_and_not_shuffled(spark, tmp_path, small_splits):
    path = tmp_path / "reviews.csv"
    path.write_text(csv_text([("review_id", "review_text"), *((i, text) for i, text in enumerate(NASTY * 3))]))
    small_splits(10_000_000)
    plan = executed(read_raw(spark, str(path), REVIEWS))
    assert plan.count("FileScan text") == 1 and "Exchange" not in plan and "Window" not in plan and "Sort" not in plan
    small_splits(200)
    plan = executed(read_raw(spark, str(path), REVIEWS))
    # Records that cross splits come from the marks.
    assert plan.count("FileScan text") == 1 and "Window" not in plan


@pytest.mark.parametrize("size", [100, 1000])
def test_records_that_are_longer_than_an_edge(spark, tmp_path, small_splits, monkeypatch, size):
    path = tmp_path / "reviews.csv"
    rows = [(i, text) for i, text in enumerate(NASTY * 2)] + [(1000, "long\n" * 900), (1001, "\"\n" * 700)]
    path.write_text(csv_text([("review_id", "review_text"), *rows]))
    small_splits(size)
    monkeypatch.setattr("bookpipe.sources.records.EDGE_BYTES", 20)
    df = read_raw(spark, str(path), REVIEWS)
    assert executed(df).count("FileScan text") == 2
    assert bag(df) == bag(read_raw(spark, str(path), REVIEWS, large=False)) and df.count() == len(rows)


@pytest.mark.parametrize("size", [64, 300, 10_000_000])
def test_a_quote_that_never_closes_spoils_one_line(spark, tmp_path, small_splits, size):
    source = tmp_path / "author.csv"
    source.mkdir()
    good = "".join(f'{i},"name\n{i}",r\n' for i in range(10, 20))
    rest = "".join(f"{i},name {i},r\n" for i in range(30, 90))
    (source / "a.csv").write_text("author_id,name,role\n" + good + '20,"stray,r\n' + rest)
    (source / "b.csv").write_text("author_id,name,role\n" + good.replace("name", "other"))
    small_splits(size)
    rows = read_raw(spark, str(source), AUTHORS).collect()
    assert sorted(row.author_id for row in rows) == sorted([*range(10, 21), *range(30, 90), *range(10, 20)])
    names = {(row.author_id, row.name) for row in rows}
    assert {(i, f"name {i}") for i in range(30, 90)} <= names and {(i, f"name\n{i}") for i in range(10, 20)} <= names
    assert {(i, f"other\n{i}") for i in range(10, 20)} <= names


def test_the_first_line_opens_a_value_that_never_closes(spark, tmp_path, small_splits):
    path = tmp_path / "author.csv"
    path.write_text('author_id,name\n"1,x\n' + "2,y\n" * 100)
    small_splits(50)
    assert Counter(row.name for row in read_raw(spark, str(path), AUTHORS).collect()) == Counter({"y": 100, None: 1})


@pytest.mark.parametrize("size", [16, 10_000_000])
def test_blank_lines_before_the_header(spark, tmp_path, small_splits, size):
    path = tmp_path / "author.csv"
    for end in ("\n", "\r\n"):
        path.write_bytes((end * 40 + f'author_id,name{end}{end}1,"Ann{end}Lee"{end}{end}').encode())
        small_splits(size)
        assert [(row.author_id, row.name) for row in read_raw(spark, str(path), AUTHORS).collect()] == [(1, "Ann\nLee")]


def test_compressed_source(spark, tmp_path):
    source = tmp_path / "reviews.csv"
    source.mkdir()
    text = csv_text([("review_id", "review_text"), *((i, t) for i, t in enumerate(NASTY * 40))])
    (source / "a.csv.gz").write_bytes(gzip.compress(text.encode()))
    (source / "b.csv.gz").write_bytes(gzip.compress(csv_text([("review_id", "review_text"), (-1, "x\ny")]).encode()))
    df = read_raw(spark, str(source), REVIEWS)
    # A task follows the lines of its file; nothing gathers them.
    assert all(word not in executed(df) for word in ("Window", "Sort", "Exchange"))
    got = {row.review_id: row.review_text for row in df.collect()}
    assert got == {-1: "x\ny", **{i: t or None for i, t in enumerate(NASTY * 40)}}


def test_records_of_large_compressed_files_are_dealt_out(spark, tmp_path, monkeypatch):
    path, texts = tmp_path / "reviews.csv.gz", {i: f"{random.Random(i).randbytes(150).hex()}\n{i}" for i in range(3000)}
    path.write_bytes(gzip.compress(csv_text([("review_id", "review_text"), *texts.items()]).encode()))
    assert read_raw(spark, str(path), REVIEWS).rdd.getNumPartitions() == 1
    monkeypatch.setattr("bookpipe.sources.records.UNSPLIT_BYTES", 1)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        df = read_raw(spark, str(path), REVIEWS)
        assert "REBALANCE" in executed(df)
        assert {row.review_id: row.review_text for row in df.collect()} == texts
        assert df.rdd.getNumPartitions() > 1
    finally:
        spark.conf.set(merging, "true")


def test_other_splits_at_the_second_reading_are_refused(spark, tmp_path, small_splits):
    path = tmp_path / "author.csv"
    path.write_text("author_id,name\n" + '1,"a\nb"\n' * 500)
    small_splits(100)
    df = read_raw(spark, str(path), AUTHORS)
    small_splits(130)
    with pytest.raises(Exception, match="have changed"):
        df.collect()


def test_empty_files(spark, tmp_path):
    source = tmp_path / "author.csv"
    source.mkdir()
    (source / "a.csv").write_text("author_id,name\n")
    (source / "b.csv").write_text("")
    (source / "c.csv").write_text("author_id,name\n1,a")
    assert [(row.author_id, row.name) for row in read_raw(spark, str(source), AUTHORS).collect()] == [(1, "a")]


def test_many_quotes_in_one_line(spark, tmp_path):
    text = '"' * 200_001 + "x" * 200_000
    path = tmp_path / "author.csv"
    path.write_text(csv_text([("author_id", "name"), (1, text), (2, "next")]))
    rows = {row.author_id: row.name for row in read_raw(spark, str(path), AUTHORS, large=True).collect()}
    assert rows == {1: text, 2: "next"}


def test_windows_line_ends(spark, tmp_path, small_splits):
    path = tmp_path / "author.csv"
    path.write_bytes(b'author_id,name,role\r\n1,"a\r\nb",x\r\n2,c,y\r\n')
    small_splits(16)
    for large in (False, True):
        rows = {row.author_id: (row.name, row.role) for row in read_raw(spark, str(path), AUTHORS, large).collect()}
        assert rows == {1: ("a\nb", "x"), 2: ("c", "y")}
    path.write_bytes(b'author_id,name,role\n1,"a\r\nb",x\n2,c,y\n')
    for large in (False, True):
        rows = {row.author_id: (row.name, row.role) for row in read_raw(spark, str(path), AUTHORS, large).collect()}
        assert rows == {1: ("a\r\nb", "x"), 2: ("c", "y")}


def test_header_order_missing_and_unknown_columns(spark, tmp_path):
    path = tmp_path / "author.csv"
    path.write_text("name,author_id,mood\nAnn,7,glad\n")
    df = read_raw(spark, str(path), AUTHORS)
    assert df.dtypes == [("name", "string"), ("author_id", "bigint"), ("mood", "string")]
    assert df.first() == ("Ann", 7, "glad")


def test_files_with_another_header_are_refused(spark, tmp_path):
    source = tmp_path / "author.csv"
    source.mkdir()
    (source / "a.csv").write_text("author_id,name\n1,Ann\n")
    (source / "b.csv").write_text("name,author_id\nBob,2\n")
    for large in (False, True):
        with pytest.raises(Exception, match="(?i)header"):
            read_raw(spark, str(source), AUTHORS, large).collect()


def test_raw_timestamps(spark, tmp_path):
    path = tmp_path / "author.csv"
    path.write_text("author_id,record_create_timestamp\n1,2024-01-10 01:02:03.456789\n"
                    "2,2024-01-10T01:02:03+02:00\n3,soon\n")
    got = {row.author_id: row.record_create_timestamp for row in read_raw(spark, str(path), AUTHORS).collect()}
    assert got == {1: datetime(2024, 1, 10, 1, 2, 3, 456789), 2: datetime(2024, 1, 9, 23, 2, 3), 3: None}


PROCESSED = [
    (1, "p|q", datetime(2024, 1, 1, 1, 2, 3, 456789)),
    (2, 'he said "x"', datetime(2024, 1, 1)),
    (3, "two\nlines", None),
    (4, None, None),
    (5, "", None),
]


def processed_rows(spark):
    rows = spark.createDataFrame(PROCESSED, "review_id long, review_text string, record_create_timestamp timestamp_ntz")
    return align(rows, STAGING_REVIEWS)


def test_processed_csv(spark, tmp_path):
    path = str(tmp_path / "reviews")
    write_processed_csv(processed_rows(spark), path)
    write_processed_csv(processed_rows(spark), path)
    files = list(Path(path).glob("*.csv.gz"))
    assert 1 <= len(files) <= 10
    back = read_processed_csv(spark, path, STAGING_REVIEWS)
    assert back.schema == STAGING_REVIEWS
    got = {row.review_id: (row.review_text, row.record_create_timestamp) for row in back.collect()}
    assert got == {1: ("p|q", datetime(2024, 1, 1, 1, 2, 3, 456000)), 2: ('he said "x"', datetime(2024, 1, 1)),
                   3: ("two\nlines", None), 4: (None, None), 5: (None, None)}


def test_processed_csv_writes_ten_files(spark, tmp_path):
    path = str(tmp_path / "reviews")
    write_processed_csv(spark.range(100).select(F.col("id").alias("review_id")), path, files=10)
    assert len(list(Path(path).glob("*.csv.gz"))) == 10


def test_processed_parquet_tells_null_from_empty(spark, tmp_path):
    path = str(tmp_path / "reviews")
    write_processed(processed_rows(spark), path)
    got = {row.review_id: (row.review_text, row.record_create_timestamp) for row in spark.read.parquet(path).collect()}
    assert got[1] == ("p|q", datetime(2024, 1, 1, 1, 2, 3, 456000))
    assert got[4][0] is None and got[5][0] == ""


def test_landing_report(spark, tmp_path):
    (tmp_path / "author.csv").write_text("author_id\n1\n")
    (tmp_path / "reviews.csv").mkdir()
    (tmp_path / "reviews.csv" / "part-0.csv").write_text("review_id\n")
    (tmp_path / "reviews.csv" / "part-1.csv").write_text("review_id\n1\n")
    (tmp_path / "notes.csv").write_text("x")
    for landing in (str(tmp_path), f"file://{tmp_path}/"):
        got = {row.source: tuple(row)[1:] for row in landing_report(spark, landing).collect()}
        assert got == {"author.csv": (True, 1, 12, 12), "reviews.csv": (True, 2, 22, 12), "notes.csv": (False, 1, 1, 1)}


def test_allowed_sources_can_be_narrowed(spark, tmp_path):
    (tmp_path / "author.csv").write_text("author_id\n1\n")
    (tmp_path / "book.csv").write_text("book_id\n1\n")
    got = {row.source: row.selected for row in landing_report(spark, str(tmp_path), ["book.csv"]).collect()}
    assert got == {"author.csv": False, "book.csv": True}


def test_empty_landing_zone(spark, tmp_path):
    assert landing_report(spark, str(tmp_path)).count() == 0


def test_header_in_any_case_and_without_its_key(spark, tmp_path):
    path = tmp_path / "author.csv"
    path.write_text("AUTHOR_ID,Name,Extra,record_create_timestamp\n7,Ann,x,2024-01-01 00:00:00\n")
    (row,) = align(read_raw(spark, str(path), AUTHORS), AUTHORS.staging).collect()
    assert (row.author_id, row.name, row.record_create_timestamp) == (7, "Ann", datetime(2024, 1, 1))
    path.write_text("author,name\n7,Ann\n")
    with pytest.raises(ValueError, match="author_id"):
        read_raw(spark, str(path), AUTHORS)


def test_landing_report_of_relative_and_qualified_folders(spark, tmp_path, monkeypatch):
    (tmp_path / "land it").mkdir()
    (tmp_path / "land it/book.csv").write_text("x")
    for n in range(30):
        (tmp_path / f"land it/other{n:02}.txt").write_text("x")
    for landing in (str(tmp_path / "land it"), f"file:{tmp_path}/land it/", f"file://{tmp_path}/land it"):
        found = {row.source: row.selected for row in landing_report(spark, landing).collect()}
        assert len(found) == 31 and [name for name, selected in found.items() if selected] == ["book.csv"]


def test_files_without_line_breaks_in_values_are_read_by_the_reader_of_lines(spark, tmp_path, small_splits):
    texts = [text for text in NASTY if "\n" not in text and text.strip()]
    path = tmp_path / "reviews.csv"
    path.write_text(csv_text([("review_id", "review_text", "spoiler_state"), *((i, text, 'q"q') for i, text in enumerate(texts))]) + "\n\n7,short\n")
    small_splits(100)
    df = read_raw(spark, str(path), REVIEWS)
    assert "FileScan csv" in executed(df) and "MapInArrow" not in executed(df)
    assert bag(df) == bag(read_raw(spark, str(path), REVIEWS, large=False)) and df.count() == len(texts) + 1
    # Blanks alone are a record, and a carriage return may end a line.
    for more in (b"  \n", b"8,x,y\r\n", b'8,"x\ny",z\n'):
        path.write_bytes(b"review_id,review_text,spoiler_state\n1,a,b\n" + more)
        df = read_raw(spark, str(path), REVIEWS)
        assert "FileScan csv" not in executed(df) and df.count() == 2
