"""Daily rankings of authors and books."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookpipe.operators.ranking import enrich, overlap, settle, top_groups
from bookpipe.operators.timewindow import within


@dataclass(frozen=True)
class Subject:
    """What is ranked: its key in reviews and dimension, and its reported columns."""

    entity: str
    key: str
    average: str
    columns: dict[str, str]
    best_order: tuple[str, ...]

    @property
    def by_count(self) -> str:
        return f"popular_{self.entity}_review_count"

    @property
    def by_average(self) -> str:
        return f"popular_{self.entity}_average_rating"

    @property
    def best(self) -> str:
        return f"best_{self.entity}"


COUNT = "review_count"

# Warehouse column -> reported column.
AUTHORS = Subject(
    "authors", "author_id", "average_review_rating",
    {
        "name": "name",
        "role": "role",
        "profile_url": "profile_url",
        "average_rating": "average_rating",
        "ratings_count": "rating_count",
        "text_reviews_count": "text_review_count",
        "record_create_timestamp": "record_create_timestamp",
    },
    (COUNT, "average_review_rating"),
)
BOOKS = Subject(
    "books", "book_id", "average_reviews_rating",
    {name: name for name in (
        "title", "title_without_series", "image_url", "book_url", "num_pages", "format",
        "edition_information", "publisher", "average_rating", "ratings_count", "description",
        "authors", "record_create_timestamp",
    )},
    ("average_reviews_rating", COUNT),
)
SUBJECTS = {subject.entity: subject for subject in (AUTHORS, BOOKS)}


def _popular(reviews: DataFrame, dimension: DataFrame, subject: Subject, measure: Column, name: str,
             window: tuple[str, str], n: int, settled: bool) -> DataFrame:
    key = subject.key
    top = top_groups(within(reviews, *window), key, measure, name, n)
    if settled:
        top, keys = settle(top, n)
        dimension = dimension.where(F.col(key).isin(keys))
    return enrich(top, dimension, key, name, subject.columns, n)


def popular_by_count(reviews: DataFrame, dimension: DataFrame, subject: Subject, low: str, high: str,
                     n: int = 10, settled: bool = False) -> DataFrame:
    """Top ``n`` by number of reviews strictly between the bounds, with the subject's columns.

    ``settled`` computes the ranking at once, so that its keys reach the scan of the dimension: in
    a table clustered by key that leaves a few row groups of it to read.
    """
    return _popular(reviews, dimension, subject, F.count("review_id"), COUNT, (low, high), n, settled)


def popular_by_average(reviews: DataFrame, dimension: DataFrame, subject: Subject, low: str, high: str,
                       n: int = 10, settled: bool = False) -> DataFrame:
    """Top ``n`` by mean review rating; missing ratings do not count."""
    return _popular(reviews, dimension, subject, F.avg("review_rating"), subject.average, (low, high), n, settled)


def best(by_average: DataFrame, by_count: DataFrame, subject: Subject) -> DataFrame:
    """Subjects in both rankings of the same window. May be empty."""
    both = overlap(by_average, by_count, subject.key, COUNT)
    return both.select(subject.key, *subject.best_order, *subject.columns.values())
