"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Inside a character class with Unicode matching: white space plus the ASCII separator controls.
WHITESPACE = r"\s\x1c-\x1f"


def remove_extra_spaces(text: Column) -> Column:
    """Every run of white space becomes one space; none is left at the ends. Null stays null."""
    return F.trim(F.regexp_replace(text, f"(?U)[{WHITESPACE}]+", " "))
