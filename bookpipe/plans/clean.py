"""Cleaning of one raw entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookpipe.functions.dates import parse_posted_date
from bookpipe.functions.text import remove_extra_spaces
from bookpipe.operators.latest import latest, latest_stored
from bookpipe.schemas import Entity


def clean(raw: DataFrame, entity: Entity, stored: bool = False) -> DataFrame:
    """Latest record per key in the input's columns, with text and date columns cleaned.

    ``stored`` says that the input lies in columnar files, so that reading two of its columns
    first is cheap.
    """
    newest = (latest_stored if stored else latest)(raw, entity.key)
    cleaned = {name: remove_extra_spaces(F.col(name)) for name in entity.text_columns}
    cleaned |= {name: parse_posted_date(F.col(name)) for name in entity.date_columns}
    return newest.select([cleaned.get(name, F.col(name)).alias(name) for name in raw.columns])
