"""Tags out of a tag text such as ``<mysql><innodb>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Angle brackets and white space separate tags.
SEPARATORS = r"[<>\s]+"
TWO_TAGS = r"[^<>\s][<>\s]+[^<>\s]"


def extract_tags(text: Column) -> Column:
    """Array of the tags in order, repeats kept; NULL for a NULL text."""
    return F.filter(F.split(text, SEPARATORS), lambda tag: F.length(tag) > 0)


def has_two_tags(text: Column) -> Column:
    """Whether the text holds at least two tags, without building the array."""
    return text.rlike(TWO_TAGS)
