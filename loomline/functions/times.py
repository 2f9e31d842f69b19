"""Time arithmetic that does not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column


def seconds_between(later: Column, earlier: Column) -> Column:
    """Seconds, to the microsecond, between two timestamps of the same type."""
    gap = (later - earlier).cast("interval second")
    return gap.cast("decimal(20,6)").cast("double")
