"""The same queries as plain SQL over the supplied tables, for an independent engine."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql.types import StructType

from bookpipe.queries import (
    AUTHORS_SINCE, BATCH_DAY, BATCH_OFFSET, BOOKS_SINCE, DAY, NEXT_DAY, UPSERT_SINCE, YEAR)
from bookpipe.schemas import BOOKS, RECORD_DATE, STAGING_REVIEWS, TS, USERS, WAREHOUSE_AUTHORS, WAREHOUSE_REVIEWS

_SQL_TYPES = {"string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}


def _columns(layout: StructType, given: Mapping[str, str]) -> str:
    """Every column of a layout: the given expression or a typed null."""
    return ", ".join(
        f'{given.get(field.name, "NULL")}::{_SQL_TYPES.get(field.dataType.simpleString(), field.dataType.simpleString())}'
        f' AS "{field.name}"'
        for field in layout)


AUTHOR_VALUES = {"author_id": "s_suppkey", "name": "s_name", "average_rating": "s_acctbal"}
BOOK_VALUES = {"book_id": "p_partkey", "title": "p_name", "publisher": "p_brand", "format": "p_type",
               "num_pages": "p_size", "average_rating": "p_retailprice"}
USER_VALUES = {"user_id": "c_custkey", "user_name": "c_name", "location": "c_mktsegment"}
REVIEW_VALUES = {"review_id": "l_orderkey * 10 + l_linenumber", "user_id": "o_custkey",
                 "book_id": "l_partkey", "author_id": "l_suppkey", "review_rating": "l_quantity",
                 "review_added_date": "o_orderdate", "review_update_date": "l_shipdate", TS: "l_shipdate"}

AUTHORS_SQL = f"SELECT {_columns(WAREHOUSE_AUTHORS, AUTHOR_VALUES)} FROM supplier"
BOOKS_SQL = f"SELECT {_columns(BOOKS, BOOK_VALUES)} FROM part"
USERS_SQL = f"SELECT {_columns(USERS, USER_VALUES)} FROM customer"
REVIEWS_SQL = f"SELECT {_columns(WAREHOUSE_REVIEWS, REVIEW_VALUES)} FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
ACTIVE_SQL = f"""SELECT {_columns(WAREHOUSE_AUTHORS, {
    "author_id": "c_custkey", "name": "c_name", "average_rating": "c_acctbal"})} FROM customer"""
RATINGS_SQL = f"""SELECT l_orderkey * 10 + l_linenumber AS review_id, l_partkey AS book_id,
    l_suppkey AS author_id, l_quantity AS review_rating, l_shipdate AS {TS} FROM lineitem"""
ACTIVITY_SQL = f"SELECT event_id AS review_id, user_id AS author_id, ts AS {TS} FROM events"
REVIEWED_AUTHORS_SQL = f"""SELECT l_suppkey AS author_id, l_returnflag || ' ' || l_linestatus AS name,
    l_shipdate AS {TS} FROM lineitem"""
REVIEWED_BOOKS_SQL = f"""SELECT l_partkey AS book_id, l_returnflag AS title,
    l_quantity::INT AS num_pages, l_shipdate AS {TS} FROM lineitem"""
ACTIVE_USERS_SQL = f"SELECT user_id, event_type AS user_name, ts AS {TS} FROM events"


def _same(layout: StructType, rows: str, *names: str) -> str:
    """Rows in a layout, of which they have these columns."""
    return f"SELECT {_columns(layout, {name: name for name in names})} FROM ({rows})"


def _latest(rows: str, key: str) -> str:
    return f"""SELECT r.* FROM ({rows}) r
        JOIN (SELECT {key}, max({TS}) AS newest FROM ({rows}) GROUP BY {key}) m
        ON r.{key} = m.{key} AND r.{TS} = m.newest"""


def _upsert(target: str, staging: str, key: str, columns: str = "*") -> str:
    return f"""WITH target AS ({target}), staging AS ({staging})
        SELECT {columns} FROM target WHERE {key} NOT IN (SELECT {key} FROM staging)
        UNION ALL SELECT {columns} FROM staging"""


def _day(day: str) -> tuple[str, str]:
    return f"{day} 00:00:00.000000", f"{day} 23:59:59.999999"


AUTHOR_REPORT = """name, role, profile_url, average_rating, ratings_count AS rating_count,
    text_reviews_count AS text_review_count, record_create_timestamp"""
BOOK_REPORT = """title, title_without_series, image_url, book_url, num_pages, format,
    edition_information, publisher, average_rating, ratings_count, description, authors,
    record_create_timestamp"""


def _popular(reviews: str, dimension: str, key: str, measure: str, name: str, window: tuple[str, str],
             report: str, n: int = 10) -> str:
    return f"""SELECT {key}, {name}, {report} FROM (
            SELECT {key}, {measure} AS {name} FROM ({reviews})
            WHERE {TS} > TIMESTAMP '{window[0]}' AND {TS} < TIMESTAMP '{window[1]}'
            GROUP BY {key} ORDER BY {name} DESC NULLS LAST, {key} LIMIT {n}
        ) JOIN ({dimension}) USING ({key})"""


def _by_count(reviews, dimension, key, window, report, n=10):
    return _popular(reviews, dimension, key, "count(review_id)", "review_count", window, report, n)


def _by_average(reviews, dimension, key, name, window, report, n=10):
    return _popular(reviews, dimension, key, "avg(review_rating)", name, window, report, n)


def _best(by_average: str, by_count: str, key: str) -> str:
    return f"""SELECT a.*, c.review_count FROM ({by_average}) a
        JOIN (SELECT {key}, review_count FROM ({by_count})) c ON a.{key} = c.{key}"""


def _best_of(subject_key: str, average: str, dimension: str, report: str, n: int, reviews: str = RATINGS_SQL,
             window: tuple[str, str] = YEAR) -> str:
    return _best(_by_average(reviews, dimension, subject_key, average, window, report, n),
                 _by_count(reviews, dimension, subject_key, window, report, n), subject_key)


def _filled(table: str, layout: StructType, values: Mapping[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{field.name}' AS column_name, "
        f"'{field.dataType.simpleString()}' AS data_type, "
        f"{'count(' + values[field.name] + ')' if field.name in values else '0'} AS filled_rows"
        + (f" FROM {source}" if field.name in values else "")
        for field in layout)


LINES_WITH_ORDERS = "lineitem JOIN orders ON l_orderkey = o_orderkey"
# Batch reviews: shipping date plus the line number in seconds plus a fraction, cut to milliseconds.
BATCH_MOMENT = f"l_shipdate + to_microseconds(l_linenumber * 1000000 + ({BATCH_OFFSET} * 1000000)::BIGINT)"
BATCH_REVIEWS = f"""SELECT l_orderkey * 10 + l_linenumber AS review_id, l_partkey AS book_id,
    l_suppkey AS author_id, l_quantity AS review_rating,
    date_trunc('millisecond', {BATCH_MOMENT}) AS {TS}
    FROM {LINES_WITH_ORDERS}"""
BATCH_FULL_REVIEWS = f"""SELECT {_columns(WAREHOUSE_REVIEWS, {
    **{name: value for name, value in REVIEW_VALUES.items() if name != "review_update_date"},
    "review_added_date": f"date_trunc('second', {BATCH_MOMENT})", TS: f"date_trunc('millisecond', {BATCH_MOMENT})"})}
    FROM {LINES_WITH_ORDERS}"""
BATCH_LATEST = _latest(BATCH_REVIEWS, "review_id")


def _batch_report() -> str:
    window = _day(BATCH_DAY)
    tables = {}
    for layer in ("staging", "warehouse"):
        tables |= {f"{layer}.authors": ("author_id", AUTHORS_SQL), f"{layer}.books": ("book_id", BOOKS_SQL),
                   f"{layer}.users": ("user_id", USERS_SQL), f"{layer}.reviews": ("review_id", BATCH_LATEST)}
    for entity, key, average, dimension, report in (
            ("authors", "author_id", "average_review_rating", AUTHORS_SQL, AUTHOR_REPORT),
            ("books", "book_id", "average_reviews_rating", BOOKS_SQL, BOOK_REPORT)):
        tables |= {
            f"analytics.popular_{entity}_review_count": (key, _by_count(BATCH_LATEST, dimension, key, window, report)),
            f"analytics.popular_{entity}_average_rating": (
                key, _by_average(BATCH_LATEST, dimension, key, average, window, report)),
            f"analytics.best_{entity}": (key, _best_of(key, average, dimension, report, 10, BATCH_LATEST, window)),
        }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count({key}) AS row_count, coalesce(sum({key}), 0)::BIGINT AS key_sum FROM ({rows})"
        for name, (key, rows) in tables.items())


def _batch_rankings() -> str:
    parts, window = [], _day(BATCH_DAY)
    for entity, key, average, dimension, report, label, more in (
            ("authors", "author_id", "average_review_rating", AUTHORS_SQL, AUTHOR_REPORT, "name", "NULL, NULL, NULL::INT"),
            ("books", "book_id", "average_reviews_rating", BOOKS_SQL, BOOK_REPORT, "title", "publisher, format, num_pages")):
        tables = {
            f"popular_{entity}_review_count": ("review_count", "NULL", _by_count(BATCH_LATEST, dimension, key, window, report)),
            f"popular_{entity}_average_rating": ("NULL", average, _by_average(BATCH_LATEST, dimension, key, average, window, report)),
            f"best_{entity}": ("review_count", average, _best_of(key, average, dimension, report, 10, BATCH_LATEST, window))}
        parts += [f"""SELECT '{name}' AS table_name, {key} AS id, {count}::BIGINT AS review_count, {mean}::DOUBLE AS mean_rating, {label} AS label,
            average_rating, {more}, DATE '{BATCH_DAY}' AS ds FROM ({rows})""" for name, (count, mean, rows) in tables.items()]
    names = "table_name, id, review_count, mean_rating, label, average_rating, publisher, format, num_pages, ds"
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) AS r({names})"


def _dq(tables: Mapping[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, count(*) >= 1 AS passed FROM {source}"
        for name, source in tables.items())


def _sources(counts: Mapping[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS source, true AS selected, count(*) AS row_count FROM {table}"
        for name, table in counts.items()) + " UNION ALL SELECT 'notes.csv', false, 0"


# White space as Unicode and the ASCII separators define it, spelled out for an ASCII-only \s.
WHITESPACE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"

_REVIEWS_BEFORE = _latest(f"{RATINGS_SQL} WHERE l_shipdate < TIMESTAMP '{UPSERT_SINCE}'", "review_id")
_REVIEWS_SINCE = _latest(f"{RATINGS_SQL} WHERE l_shipdate >= TIMESTAMP '{UPSERT_SINCE}'", "review_id")
_AUTHORS_SINCE = _latest(f"{REVIEWED_AUTHORS_SQL} WHERE l_shipdate >= TIMESTAMP '{AUTHORS_SINCE}'", "author_id")
_BOOKS_SINCE = _latest(f"{REVIEWED_BOOKS_SQL} WHERE l_shipdate >= TIMESTAMP '{BOOKS_SINCE}'", "book_id")

RAW_REVIEW_VALUES = {**REVIEW_VALUES, "review_updated_date": "l_shipdate"}
del RAW_REVIEW_VALUES["review_update_date"]
RAW_REVIEWS_SQL = f"SELECT {', '.join(f'{value} AS {name}' for name, value in RAW_REVIEW_VALUES.items())} FROM {LINES_WITH_ORDERS}"

ORACLE = {
    "latest_lookup": f"SELECT review_id, max({TS}) AS {TS} FROM ({RATINGS_SQL}) GROUP BY review_id",
    "latest_reviews": _latest(RAW_REVIEWS_SQL, "review_id"),
    "latest_users": _latest(ACTIVE_USERS_SQL, "user_id"),
    "latest_authors": _latest(REVIEWED_AUTHORS_SQL, "author_id"),
    "latest_books": _latest(REVIEWED_BOOKS_SQL, "book_id"),
    "clean_text": f"SELECT doc_id, trim(regexp_replace(text, '{WHITESPACE}', ' ', 'g')) AS text FROM documents",
    "parse_datetime": "SELECT event_id, date_trunc('second', ts) AS posted_at FROM events",
    "day_window_filter": f"SELECT * FROM ({ACTIVITY_SQL}) WHERE {TS} > TIMESTAMP '{_day(DAY)[0]}' AND {TS} < TIMESTAMP '{_day(DAY)[1]}'",
    "popular_authors_review_count": _by_count(ACTIVITY_SQL, ACTIVE_SQL, "author_id", _day(DAY), AUTHOR_REPORT),
    "popular_authors_average_rating": _by_average(RATINGS_SQL, AUTHORS_SQL, "author_id", "average_review_rating", YEAR, AUTHOR_REPORT),
    "best_authors": _best_of("author_id", "average_review_rating", AUTHORS_SQL, AUTHOR_REPORT, 10),
    "popular_books_review_count": _by_count(RATINGS_SQL, BOOKS_SQL, "book_id", YEAR, BOOK_REPORT),
    "popular_books_average_rating": _by_average(RATINGS_SQL, BOOKS_SQL, "book_id", "average_reviews_rating", YEAR, BOOK_REPORT),
    "best_books": _best_of("book_id", "average_reviews_rating", BOOKS_SQL, BOOK_REPORT, 500),
    "align_authors": AUTHORS_SQL,
    "align_reviews": REVIEWS_SQL,
    "upsert_reviews": _upsert(_REVIEWS_BEFORE, _REVIEWS_SINCE, "review_id"),
    "upsert_replaced": f"WITH staging AS ({_REVIEWS_SINCE}) SELECT * FROM ({_REVIEWS_BEFORE}) WHERE review_id IN (SELECT review_id FROM staging)",
    "upsert_authors": _upsert(AUTHORS_SQL, _same(WAREHOUSE_AUTHORS, _AUTHORS_SINCE, "author_id", "name", TS), "author_id"),
    "upsert_books": _upsert(BOOKS_SQL, _same(BOOKS, _BOOKS_SINCE, "book_id", "title", "num_pages", TS), "book_id"),
    "upsert_users": _upsert(USERS_SQL, _same(USERS, _latest(ACTIVE_USERS_SQL, "user_id"), "user_id", "user_name", TS), "user_id"),
    "dq_non_empty": _dq({"reviews": "lineitem", "authors": "supplier", "books": "part", "users": "customer"}),
    "default_timestamp": "SELECT s_suppkey AS author_id, true AS has_timestamp FROM supplier",
    "csv_ingest": "SELECT doc_id AS review_id, text AS review_text, lang AS spoiler_state, n_chars::INT AS review_read_count, source AS review_url FROM documents",
    "stage_roundtrip": f"""SELECT {_columns(STAGING_REVIEWS, {
        "review_id": "event_id", "author_id": "user_id", "review_rating": "value", "spoiler_state": "event_type",
        "review_url": "props", TS: "date_trunc('millisecond', ts)"})} FROM events""",
    "source_allowlist": _sources({"author.csv": "supplier", "book.csv": "part", "user.csv": "customer", "reviews.csv": LINES_WITH_ORDERS}),
    "analytics_append": " UNION ALL ".join(
        f"SELECT *, DATE '{day}' AS ds FROM ({_by_count(ACTIVITY_SQL, ACTIVE_SQL, 'author_id', _day(day), AUTHOR_REPORT)})"
        for day in (DAY, NEXT_DAY)),
    "table_schemas": " UNION ALL ".join(f"({part})" for part in (
        _filled("authors", WAREHOUSE_AUTHORS, AUTHOR_VALUES, "supplier"),
        _filled("books", BOOKS, BOOK_VALUES, "part"),
        _filled("users", USERS, USER_VALUES, "customer"),
        _filled("reviews", WAREHOUSE_REVIEWS, REVIEW_VALUES, LINES_WITH_ORDERS))),
    "warehouse_upsert": f"SELECT *, {TS}::DATE AS {RECORD_DATE} FROM ({_same(WAREHOUSE_REVIEWS, _upsert(_REVIEWS_BEFORE, _REVIEWS_SINCE, 'review_id'), 'review_id', 'book_id', 'author_id', 'review_rating', TS)})",
    "batch_rankings": _batch_rankings(),
    "batch_reviews": f"SELECT *, {TS}::DATE AS {RECORD_DATE} FROM ({_latest(BATCH_FULL_REVIEWS, 'review_id')})",
    "nightly_batch": _batch_report(),
}
