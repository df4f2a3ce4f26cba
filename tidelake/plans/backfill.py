"""Replay of a date range from bronze: one silver job and one gold scan for the whole range."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import SparkSession

from tidelake.plans import gold, silver
from tidelake.sources import intents
from tidelake.sources.lake import Lake


def days_between(first: dt.date, last: dt.date) -> list[dt.date]:
    return [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]


def rebuild(spark: SparkSession, lake: Lake, first: dt.date, last: dt.date) -> None:
    """Rebuild silver and gold for the event days ``first`` to ``last`` (both included)."""
    days = days_between(first, last)
    intents.note(spark, lake, intents.SILVER, days)
    refresh(spark, lake, days)


def refresh(spark: SparkSession, lake: Lake, dates: Collection[dt.date] = ()) -> list[dt.date]:
    """Carry changed file dates, and all that earlier runs left open, through silver and gold.

    Returns the event days rebuilt in gold.
    """
    silver.process_dates(spark, lake, dates)
    return gold.build_pending(spark, lake)
