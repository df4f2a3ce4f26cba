"""Bronze to silver, day by whole day.

A row belongs to the day it happened, whatever the date of its file. A small table notes which file
dates hold valid rows of which event days. Changed files touch the days they held before and the days
they hold now; each of these is rebuilt from all file dates noted for it, so an overwrite neither loses
rows that another file contributed nor keeps rows that a corrected file no longer has. Of an id with copies
on several days one survives; a day whose copy starts or stops being the first is rebuilt as well.

What is to be done is noted before anything is overwritten (``sources.intents``), and every step can be
repeated, so a run that dies is finished by the next.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Collection

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidelake.operators.conform import quarantined, reject_reason, typed, valid_rows
from tidelake.operators.dedup import one_per_day
from tidelake.schemas import DAY_PAIRS_SCHEMA, QUARANTINE_SCHEMA, SILVER_COLUMNS, SILVER_SCHEMA
from tidelake.session import configure
from tidelake.sources import ids, intents
from tidelake.sources.lake import (
    Lake,
    clear_days,
    clear_partition,
    only,
    overwrite_partitions,
    read_bad_rows,
    read_bronze,
    read_day_pairs,
    remove,
)


def _days(df, column: str) -> set[dt.date]:
    """The values of a day column: as many rows as days."""
    return {r[column] for r in df.select(column).distinct().collect()}


def take_in(spark: SparkSession, lake: Lake) -> None:
    """Note the event days that changed file dates touch, and store their rejected rows.

    One scan of four columns tells which days the dates hold and which of them have rejected rows.
    """
    entries = intents.pending(spark, lake, intents.DATE)
    dates = intents.days_of(entries)
    if not dates:
        return
    staged = lake.staging(f"pairs-{uuid.uuid4().hex}")
    rows = typed(read_bronze(spark, lake, dates)).select("date", "event_day", reject_reason().alias("reason"))
    found = rows.groupBy("date", F.when(F.col("reason").isNull(), F.col("event_day")).alias("event_day"), F.col("reason").isNotNull().alias("bad"))
    found.agg(F.count("*").alias("rows")).write.parquet(staged)
    found = spark.read.schema("date date, event_day date, bad boolean, rows bigint").parquet(staged)
    pairs = found.where("NOT bad").select(*DAY_PAIRS_SCHEMA.fieldNames())
    before = only(read_day_pairs(spark, lake), "date", dates)
    intents.note(spark, lake, intents.SILVER, _days(before, "event_day") | _days(pairs, "event_day"))

    stale = _days(before, "date") - _days(pairs, "date")
    overwrite_partitions(pairs, lake.day_pairs, ["date"])
    for date in stale:
        clear_partition(spark, lake.day_pairs, DAY_PAIRS_SCHEMA, date=date)
    quarantine_dates(spark, lake, dates, _days(found.where("bad"), "date"))
    intents.tick_off(spark, lake, entries)
    remove(spark, staged)


def quarantine_dates(spark: SparkSession, lake: Lake, dates: Collection[dt.date], with_bad: Collection[dt.date]) -> None:
    """Rewrite the rejected rows of the given file dates, of which only ``with_bad`` have any."""
    known = _days(only(read_bad_rows(spark, lake), "date", dates), "date")
    if with_bad:
        overwrite_partitions(quarantined(read_bronze(spark, lake, with_bad)), lake.bad_rows, ["date"])
    for date in known - set(with_bad):
        clear_partition(spark, lake.bad_rows, QUARANTINE_SCHEMA, date=date)


def _valid(spark: SparkSession, lake: Lake, days: Collection[dt.date]):
    """Valid rows of the given event days, read from the file dates noted for them."""
    dates = _days(only(read_day_pairs(spark, lake), "event_day", days), "date")
    return only(valid_rows(typed(read_bronze(spark, lake, dates))), "event_day", days)


def index_days(spark: SparkSession, lake: Lake, days: Collection[dt.date]) -> list:
    """Bring the id index of ``days`` up to date; returns entries for other days whose copies are concerned.

    The entries are noted before the index changes: afterwards nothing would tell that those days are stale.
    """
    staged = lake.staging(f"ids-{uuid.uuid4().hex}")
    ids.first_copies(_valid(spark, lake, days)).write.parquet(staged)
    new = spark.read.schema("event_id string, ingest_ts string, source_file string, created_at string, event_day date").parquet(staged)
    changed = ids.changed_ids(ids.read_ids(spark, lake, days), new)
    entries = intents.note(spark, lake, intents.SILVER, ids.days_sharing(spark, lake, changed, days))
    ids.replace_days(spark, lake, new, days)
    remove(spark, staged)
    return entries


def build_days(spark: SparkSession, lake: Lake, days: Collection[dt.date]) -> tuple[set[dt.date], list]:
    """Rewrite the given event days, and those that share ids with what changed there.

    Returns all of them, and the entries that were noted for the latter. Days without rows are emptied.
    """
    configure(spark)
    days = set(days)
    if ids.read_ids(spark, lake).isEmpty():  # a lake from before the index
        days |= _days(read_day_pairs(spark, lake), "event_day")
    entries = index_days(spark, lake, days)
    days |= intents.days_of(entries)
    later = ids.later_copies(spark, lake, days)
    held = _days(ids.read_ids(spark, lake, days).join(later, ["event_id", "event_day"], "left_anti"), "event_day")
    if held:
        rows = one_per_day(_valid(spark, lake, held)).join(later, ["event_id", "event_day"], "left_anti")
        overwrite_partitions(rows.select(*SILVER_COLUMNS), lake.silver, ["event_day"])
    if days - held:
        clear_days(spark, lake.silver, SILVER_SCHEMA, days - held)
    return days, entries


def build_pending(spark: SparkSession, lake: Lake) -> list[dt.date]:
    """Rebuild the days noted for silver and note them for gold; returns them."""
    entries = intents.pending(spark, lake, intents.SILVER)
    days = intents.days_of(entries)
    if not days:
        return []
    built, shared = build_days(spark, lake, days)
    intents.note(spark, lake, intents.GOLD, built)
    intents.tick_off(spark, lake, [*entries, *shared])
    return sorted(built)


def process_dates(spark: SparkSession, lake: Lake, dates: Collection[dt.date] = ()) -> list[dt.date]:
    """Take in the given file dates and all noted ones; rebuilds and returns every event day they touch."""
    configure(spark)
    intents.note(spark, lake, intents.DATE, dates)
    take_in(spark, lake)
    return build_pending(spark, lake)
