"""Attribute text to typed values: a bad value becomes a default, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.schemas import Field

# The accepted number and timestamp forms and the stand-in date. \z and not $,
# which would let a final line break pass.
WHOLE_NUMBER = r"^[+-]?[0-9]+\z"
TIMESTAMP = r"^\d{4}-\d{2}-\d{2}T\d{1,2}:\d{2}:\d{2}[.,]\d{3}\z"
NO_DATE = "0001-01-01 00:00:00"


def number(text: Column, type_name: str) -> Column:
    """0 if the text is absent, not a whole number or out of range."""
    # The pattern comes first because a cast alone would trim spaces.
    parsed = F.when(text.rlike(WHOLE_NUMBER), text.try_cast(type_name))
    return F.coalesce(parsed, F.lit(0).cast(type_name))


def optional_number(text: Column, type_name: str) -> Column:
    """NULL if absent or empty, 0 if present but bad."""
    return F.when(text != "", number(text, type_name))


def optional_timestamp(text: Column) -> Column:
    """NULL unless the text has exactly three decimals. Free of the session zone."""
    return F.when(
        text.rlike(TIMESTAMP), F.replace(text, F.lit(","), F.lit(".")).try_cast("timestamp_ntz")
    )


def timestamp(text: Column, bad: str = "sentinel") -> Column:
    """A required timestamp: the year 1 if bad, or NULL with ``bad="null"``."""
    parsed = optional_timestamp(text)
    if bad == "null":
        return parsed
    return F.coalesce(parsed, F.lit(NO_DATE).cast("timestamp_ntz"))


def flag(text: Column) -> Column:
    return F.coalesce(F.lower(text) == "true", F.lit(False))


def typed(field: Field, text: Column, bad_time: str = "sentinel") -> Column:
    """The value of ``field`` out of its attribute text, named as the column."""
    type_name = field.type.simpleString()
    if field.rule in ("id", "int"):
        value = number(text, type_name)
    elif field.rule in ("id?", "int?"):
        value = optional_number(text, type_name)
    elif field.rule == "time":
        value = timestamp(text, bad_time)
    elif field.rule == "time?":
        value = optional_timestamp(text)
    elif field.rule == "flag":
        value = flag(text)
    else:
        value = F.coalesce(text, F.lit(""))
    return value.alias(field.column)
