"""Operators on hand-made rows: what the supplied tables cannot show."""

from collections import Counter
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from bookpipe.operators.align import align, clustered, with_load_time, with_record_date
from bookpipe.operators.latest import latest, latest_lookup, latest_stored
from bookpipe.operators.quality import EmptyTableError, gate, non_empty_report
from bookpipe.operators.ranking import enrich, top_groups
from bookpipe.operators.timewindow import day_bounds, day_window
from bookpipe.operators.upsert import replaced, replaced_keys, survivors, upsert, unchanged_keys
from bookpipe.plans.analytics import AUTHORS, BOOKS, best, popular_by_average, popular_by_count
from bookpipe.schemas import ANALYTICS, ENTITIES, TS, WAREHOUSE_AUTHORS, WAREHOUSE_REVIEWS

D1, D2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def bag(df):
    return Counter(tuple(row) for row in df.collect())


def rows_of(spark, rows, columns):
    return spark.createDataFrame(rows, columns)


VERSIONS = [(1, "a", D1), (1, "b", D2), (1, "c", D2), (None, "n", D1), (2, "z", None), (3, "x", None), (3, "y", D1)]
KEPT = Counter([(1, "b", D2), (1, "c", D2), (3, "y", D1)])


@pytest.mark.parametrize("how", [latest, latest_stored, lambda df, key: latest_stored(df, key, broadcast_keys=0)])
def test_latest_keeps_ties_and_drops_nulls(spark, how):
    df = rows_of(spark, VERSIONS, f"k long, v string, {TS} timestamp_ntz")
    got = how(df, "k")
    assert got.columns == df.columns
    assert bag(got) == KEPT


def test_latest_keeps_column_order(spark):
    df = rows_of(spark, [(v, t, k) for k, v, t in VERSIONS], f"v string, {TS} timestamp_ntz, k long")
    assert latest(df, "k").columns == ["v", TS, "k"] == latest_stored(df, "k").columns


def test_latest_keeps_exact_copies(spark):
    df = rows_of(spark, [(1, "a", D1)] * 3, f"k long, v string, {TS} timestamp_ntz")
    for how in (latest, latest_stored):
        assert how(df, "k").count() == 3


def test_latest_lookup(spark):
    df = rows_of(spark, VERSIONS, f"k long, v string, {TS} timestamp_ntz")
    assert bag(latest_lookup(df, "k")) == Counter([(1, D2), (None, D1), (2, None), (3, D1)])


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 5) | st.none(), st.integers(0, 3) | st.none()), min_size=20, max_size=60))
def test_both_ways_to_the_latest_agree_with_brute_force(spark, pairs):
    df = rows_of(spark, [(k, i, t) for i, (k, t) in enumerate(pairs)], f"k int, v int, {TS} int")
    newest = {}
    for k, t in pairs:
        if k is not None and t is not None:
            newest[k] = max(t, newest.get(k, t))
    expected = Counter((k, i, t) for i, (k, t) in enumerate(pairs) if k in newest and newest[k] == t)
    assert bag(latest(df, "k")) == bag(latest_stored(df, "k")) == expected


# Windows

MOMENTS = {
    datetime(2024, 1, 9, 23, 59, 59, 999999): False,
    datetime(2024, 1, 10): False,
    datetime(2024, 1, 10, 0, 0, 0, 1): True,
    datetime(2024, 1, 10, 23, 59, 59, 999998): True,
    datetime(2024, 1, 10, 23, 59, 59, 999999): False,
    datetime(2024, 1, 11): False,
    None: False,
}


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("dated", [False, True])
def test_day_window_is_strict(spark, kind, dated):
    df = rows_of(spark, [(m,) for m in MOMENTS], f"{TS} timestamp_ntz").withColumn(TS, F.col(TS).cast(kind))
    df = with_record_date(df) if dated else df
    got = {row[0] for row in day_window(df, "2024-01-10").select(F.col(TS).cast("timestamp_ntz")).collect()}
    assert got == {m for m, inside in MOMENTS.items() if inside}


def test_day_bounds_rejects_what_is_no_day():
    assert day_bounds("2024-01-10") == ("2024-01-10 00:00:00.000000", "2024-01-10 23:59:59.999999")
    with pytest.raises(ValueError):
        day_bounds("2024-01-10' OR '1'='1")


# Rankings

def reviews(spark, rows):
    return rows_of(spark, rows, f"review_id long, author_id long, book_id long, review_rating double, {TS} timestamp_ntz")


WIDE = ("2024-01-01 00:00:00", "2024-02-01 00:00:00")
NOON = datetime(2024, 1, 10, 12)


def authors(spark, keys):
    return align(rows_of(spark, [(k, f"A{k}") for k in keys], "author_id long, name string"), WAREHOUSE_AUTHORS)


def test_ties_go_to_the_smallest_keys(spark):
    df = reviews(spark, [(k, k, k, 1.0, NOON) for k in range(12, 0, -1)])
    top = top_groups(df, "author_id", F.count("review_id"), "n")
    assert [row.author_id for row in top.collect()] == list(range(1, 11))


def test_missing_ratings_rank_last(spark):
    df = reviews(spark, [(1, 1, 1, None, NOON), (2, 2, 2, -5.0, NOON), (3, 3, 3, None, NOON), (4, 3, 3, 2.0, NOON)])
    top = top_groups(df, "author_id", F.avg("review_rating"), "mean", 3)
    assert [tuple(row) for row in top.collect()] == [(3, 2.0), (2, -5.0), (1, None)]


def test_count_ignores_missing_review_ids(spark):
    df = reviews(spark, [(None, 1, 1, 1.0, NOON), (2, 1, 1, 1.0, NOON)])
    assert top_groups(df, "author_id", F.count("review_id"), "n").first().n == 1


def test_unknown_subjects_vanish_after_the_limit(spark):
    df = reviews(spark, [(k, k, k, 1.0, NOON) for k in range(1, 13)])
    got = popular_by_count(df, authors(spark, range(6, 13)), AUTHORS, *WIDE)
    assert got.columns == ANALYTICS["popular_authors_review_count"].names
    assert {row.author_id for row in got.collect()} == {6, 7, 8, 9, 10}


def test_large_n_needs_no_broadcast(spark):
    df = reviews(spark, [(k, k, k, 1.0, NOON) for k in range(1, 5)])
    top = top_groups(df, "author_id", F.count("review_id"), "n", 1_000_000)
    got = enrich(top, authors(spark, [1, 2]), "author_id", "n", {"name": "name"}, 1_000_000)
    assert bag(got) == Counter([(1, 1, "A1"), (2, 1, "A2")])


def test_settled_rankings_are_the_same(spark):
    df = reviews(spark, [(k, k % 15, k, float(k), NOON) for k in range(60)])
    for popular in (popular_by_count, popular_by_average):
        assert bag(popular(df, authors(spark, range(4, 15)), AUTHORS, *WIDE, settled=True)) == bag(
            popular(df, authors(spark, range(4, 15)), AUTHORS, *WIDE))
    assert popular_by_count(df.limit(0), authors(spark, [1]), AUTHORS, *WIDE, settled=True).isEmpty()
    # A ranking too long to be settled takes the other way.
    for n in (10, 10_000):
        assert bag(popular_by_count(df, authors(spark, range(15)), AUTHORS, *WIDE, n=n, settled=True)) == bag(
            popular_by_count(df, authors(spark, range(15)), AUTHORS, *WIDE, n=n))


def test_best_is_the_overlap(spark):
    by_count = rows_of(spark, [(k, 10 - k) for k in (1, 2, 3)], "author_id long, review_count long")
    by_average = authors(spark, (2, 3, 4)).select("author_id", F.lit(4.5).alias("average_review_rating"), *[
        F.col(source).alias(name) for source, name in AUTHORS.columns.items()])
    got = best(by_average, by_count, AUTHORS)
    assert got.schema.names == ANALYTICS["best_authors"].names
    assert {(row.author_id, row.review_count, row.average_review_rating) for row in got.collect()} == {(2, 8, 4.5), (3, 7, 4.5)}
    assert best(by_average, by_count.where("author_id = 1"), AUTHORS).isEmpty()


def test_report_layouts(spark):
    df = reviews(spark, [(1, 1, 1, 3.0, NOON)])
    books = align(rows_of(spark, [(1, "T")], "book_id long, title string"), ENTITIES["books"].warehouse)
    for subject, dimension in ((AUTHORS, authors(spark, [1])), (BOOKS, books)):
        by_count = popular_by_count(df, dimension, subject, *WIDE)
        by_average = popular_by_average(df, dimension, subject, *WIDE)
        for name, got in ((subject.by_count, by_count), (subject.by_average, by_average),
                          (subject.best, best(by_average, by_count, subject))):
            assert got.dtypes == [(field.name, field.dataType.simpleString()) for field in ANALYTICS[name]]
            assert got.count() == 1


# Upsert and alignment

TARGET, STAGED = [(1, "old"), (2, "keep"), (None, "null")], [(1, "new"), (3, "ins"), (3, "tie")]


@pytest.mark.parametrize("few", [False, True])
def test_survivors(spark, few):
    target, staged = rows_of(spark, TARGET, "k long, v string"), rows_of(spark, STAGED, "k long, v string")
    assert bag(survivors(target, staged, "k", few)) == Counter([(2, "keep"), (None, "null")])


def test_upsert(spark):
    target, staged = rows_of(spark, TARGET, "k long, v string"), rows_of(spark, STAGED, "k long, v string")
    once = upsert(target, staged, "k")
    assert bag(once) == Counter([(2, "keep"), (None, "null"), (1, "new"), (3, "ins"), (3, "tie")])
    assert bag(upsert(once, staged, "k")) == bag(once)
    assert bag(upsert(target, staged.where("false"), "k")) == bag(target)
    assert bag(replaced(target, staged, "k")) == Counter([(1, "old")])
    assert bag(replaced_keys(target.union(target), staged, "k")) == Counter([(1,)])


def test_align_authors(spark):
    df = rows_of(spark, [("n", 7)], "name string, author_id int")
    got = align(df, WAREHOUSE_AUTHORS)
    assert got.columns == WAREHOUSE_AUTHORS.names and got.columns[3] == "profile_url"
    assert got.dtypes == [(field.name, field.dataType.simpleString()) for field in WAREHOUSE_AUTHORS]
    assert got.first()[:4] == (7, "n", None, None)


def test_align_reviews(spark):
    df = rows_of(spark, [(1, "http", D1)], "review_id long, review_url string, review_updated_date timestamp_ntz")
    got = align(df, WAREHOUSE_REVIEWS, ENTITIES["reviews"].renames)
    assert got.columns == WAREHOUSE_REVIEWS.names and "review_url" not in got.columns
    assert got.first().review_update_date == D1


def test_align_fails_on_overflow(spark):
    from pyspark.errors import ArithmeticException
    layout = ENTITIES["books"].warehouse
    df = rows_of(spark, [(1, 70_000)], "book_id long, published int")
    with pytest.raises(ArithmeticException):
        align(df, layout).collect()


def test_load_time_fills_only_a_missing_column(spark):
    df = rows_of(spark, [(1, None), (2, D1)], f"k long, {TS} timestamp_ntz")
    assert bag(with_load_time(df)) == bag(df)
    added = with_load_time(df.drop(TS))
    assert dict(added.dtypes)[TS] == "timestamp_ntz"
    assert added.where(F.col(TS).isNull()).isEmpty()


def test_clustered_keeps_the_rows(spark):
    df = spark.range(1000).select("id", F.lit(D1).cast("timestamp_ntz").alias(TS))
    assert bag(clustered(df, "id")) == bag(clustered(df, TS)) == bag(df)


# Gate

def test_gate(spark):
    schema = StructType().add("k", LongType())
    full, empty = spark.range(3).select(F.col("id").alias("k")), spark.createDataFrame([], schema)
    assert gate({"a": full, "b": full}) == {"a": 3, "b": 3}
    assert bag(non_empty_report({"a": full, "b": empty})) == Counter([("a", 3, True), ("b", 0, False)])
    with pytest.raises(EmptyTableError, match="table b "):
        gate({"a": full, "b": empty, "c": empty})


def test_unchanged_keys(spark):
    layout = "id long, a int, b int"
    target = spark.createDataFrame([(1, 1, None), (2, 1, None), (3, 1, 1), (3, 1, 1), (4, 1, 1), (None, 1, 1), (6, 0, 0)], layout)
    staged = spark.createDataFrame([(1, 1, None), (2, None, 1), (3, 1, 1), (4, 1, 2), (None, 1, 1), (5, 1, 1), (6, 0, 0)], layout)
    assert {row.id for row in unchanged_keys(target, staged, "id").collect()} == {1, 6}
