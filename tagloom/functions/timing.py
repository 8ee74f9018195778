"""Time between two timestamps without a zone.

Interval parts are used rather than ``timestampdiff``, which would read the
timestamps in the session's zone and be off across a clock change.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _gap(start: Column, end: Column, per_second: int) -> Column:
    """``end - start`` in whole fractions of a second."""
    gap = end - start
    whole = (
        F.extract(F.lit("DAY"), gap).cast("bigint") * 86400
        + F.extract(F.lit("HOUR"), gap) * 3600
        + F.extract(F.lit("MINUTE"), gap) * 60
    )
    return whole * per_second + (F.extract(F.lit("SECOND"), gap) * per_second).cast("bigint")


def micros_between(start: Column, end: Column) -> Column:
    return _gap(start, end, 1_000_000)


def minutes_between(start: Column, end: Column) -> Column:
    return micros_between(start, end) / F.lit(6e7)


def epoch_millis(time: Column) -> Column:
    """Whole milliseconds since 1970; dump timestamps have no finer part."""
    return _gap(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), time, 1_000)
