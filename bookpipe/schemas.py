"""Fixed table layouts of the book-review warehouse and the entity registry.

All timestamps are zone-free (``timestamp_ntz``): the values do not move with the session zone.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    BooleanType, DoubleType, IntegerType, LongType, ShortType, StringType, StructField, StructType,
    TimestampNTZType)

TS = "record_create_timestamp"
# Storage-only column of warehouse reviews, the day of TS. Parquet skips row groups by a date but, as
# of Spark 4.1, not by a zone-free timestamp.
RECORD_DATE = "record_date"
# Of all parquet files that a batch writes, whatever the session's default is.
CODEC = "zstd"

_TYPES = {
    "BIGINT": LongType(), "INT": IntegerType(), "SMALLINT": ShortType(), "DOUBLE": DoubleType(),
    "STRING": StringType(), "BOOLEAN": BooleanType(), "TIMESTAMP_NTZ": TimestampNTZType(),
}


def _layout(columns: str) -> StructType:
    """``name TYPE, …`` as a struct; unlike Spark's own reader this needs no session."""
    pairs = (column.split() for column in columns.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


# The column names, order and types below are the data contract.

STAGING_AUTHORS = _layout("""
    author_id BIGINT, name STRING, role STRING, average_rating DOUBLE, ratings_count INT,
    text_reviews_count INT, record_create_timestamp TIMESTAMP_NTZ
""")

WAREHOUSE_AUTHORS = _layout("""
    author_id BIGINT, name STRING, role STRING, profile_url STRING, average_rating DOUBLE,
    ratings_count INT, text_reviews_count INT, record_create_timestamp TIMESTAMP_NTZ
""")

BOOKS = _layout("""
    book_id BIGINT, title STRING, title_without_series STRING, image_url STRING, book_url STRING,
    num_pages INT, format STRING, edition_information STRING, publisher STRING,
    publication_day SMALLINT, publication_year SMALLINT, publication_month SMALLINT,
    average_rating DOUBLE, ratings_count INT, description STRING, authors BIGINT,
    published SMALLINT, record_create_timestamp TIMESTAMP_NTZ
""")

USERS = _layout("""
    user_id BIGINT, user_name STRING, user_display_name STRING, location STRING,
    profile_link STRING, uri STRING, user_image_url STRING, small_image_url STRING,
    has_image BOOLEAN, record_create_timestamp TIMESTAMP_NTZ
""")

# Raw reviews carry their two dates as text, and name the second one differently.
RAW_REVIEWS = _layout("""
    review_id BIGINT, user_id BIGINT, book_id BIGINT, author_id BIGINT, review_text STRING,
    review_rating DOUBLE, review_votes INT, spoiler_flag BOOLEAN, spoiler_state STRING,
    review_added_date STRING, review_updated_date STRING, review_read_count INT,
    comments_count INT, review_url STRING, record_create_timestamp TIMESTAMP_NTZ
""")

STAGING_REVIEWS = _layout("""
    review_id BIGINT, user_id BIGINT, book_id BIGINT, author_id BIGINT, review_text STRING,
    review_rating DOUBLE, review_votes INT, spoiler_flag BOOLEAN, spoiler_state STRING,
    review_added_date TIMESTAMP_NTZ, review_update_date TIMESTAMP_NTZ, review_read_count INT,
    comments_count INT, review_url STRING, record_create_timestamp TIMESTAMP_NTZ
""")

WAREHOUSE_REVIEWS = _layout("""
    review_id BIGINT, user_id BIGINT, book_id BIGINT, author_id BIGINT, review_text STRING,
    review_rating DOUBLE, review_votes INT, spoiler_flag BOOLEAN, spoiler_state STRING,
    review_added_date TIMESTAMP_NTZ, review_update_date TIMESTAMP_NTZ, review_read_count INT,
    comments_count INT, record_create_timestamp TIMESTAMP_NTZ
""")

_AUTHOR_ATTRIBUTES = """
    name STRING, role STRING, profile_url STRING, average_rating DOUBLE, rating_count INT,
    text_review_count INT, record_create_timestamp TIMESTAMP_NTZ
"""

_BOOK_ATTRIBUTES = """
    title STRING, title_without_series STRING, image_url STRING, book_url STRING, num_pages INT,
    format STRING, edition_information STRING, publisher STRING, average_rating DOUBLE,
    ratings_count INT, description STRING, authors BIGINT, record_create_timestamp TIMESTAMP_NTZ
"""

ANALYTICS = {
    name: _layout(columns)
    for name, columns in {
        "popular_authors_review_count": f"author_id BIGINT, review_count BIGINT, {_AUTHOR_ATTRIBUTES}",
        "popular_authors_average_rating": f"author_id BIGINT, average_review_rating DOUBLE, {_AUTHOR_ATTRIBUTES}",
        "best_authors": f"author_id BIGINT, review_count BIGINT, average_review_rating DOUBLE, {_AUTHOR_ATTRIBUTES}",
        "popular_books_review_count": f"book_id BIGINT, review_count BIGINT, {_BOOK_ATTRIBUTES}",
        "popular_books_average_rating": f"book_id BIGINT, average_reviews_rating DOUBLE, {_BOOK_ATTRIBUTES}",
        "best_books": f"book_id BIGINT, average_reviews_rating DOUBLE, review_count BIGINT, {_BOOK_ATTRIBUTES}",
    }.items()
}


@dataclass(frozen=True)
class Entity:
    """One source: where it comes from, its key, its three layouts and its cleaned columns."""

    name: str
    source: str
    key: str
    raw: StructType
    staging: StructType
    warehouse: StructType
    renames: dict[str, str] = field(default_factory=dict)
    text_columns: tuple[str, ...] = ()
    date_columns: tuple[str, ...] = ()
    # Stored with its record date and clustered by time.
    dated: bool = False


ENTITIES = {
    entity.name: entity
    for entity in (
        Entity("authors", "author.csv", "author_id", STAGING_AUTHORS, STAGING_AUTHORS,
               WAREHOUSE_AUTHORS, text_columns=("name",)),
        Entity("books", "book.csv", "book_id", BOOKS, BOOKS, BOOKS),
        Entity("reviews", "reviews.csv", "review_id", RAW_REVIEWS, STAGING_REVIEWS,
               WAREHOUSE_REVIEWS, renames={"review_updated_date": "review_update_date"},
               date_columns=("review_added_date", "review_updated_date"),
               dated=True),
        Entity("users", "user.csv", "user_id", USERS, USERS, USERS),
    )
}

SOURCES = {entity.source: entity for entity in ENTITIES.values()}
