"""What is still to be done to the layers: a log that outlives a crash.

Before a job changes anything that a later step depends on, it notes what that step has to do; the step
ticks its entries off when it is through. A run that dies in between leaves them open, and the next one
starts with them. Steps: ``date`` (a file date to take into silver), ``silver`` and ``gold`` (an event day to
rebuild there). Only entries that were read before the work began are ticked off, so what another writer
notes meanwhile stays open.

Both tables are append-only and partitioned by the day of the note; ``tidy`` empties days that are done.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Collection

from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.sources.lake import Lake, clear_partition, read_table

DATE, SILVER, GOLD = "date", "silver", "gold"
INTENT_SCHEMA = T.StructType(
    [
        T.StructField("token", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("noted_on", T.DateType()),
    ]
)


def _append(spark: SparkSession, path: str, entries: Collection[Row]) -> None:
    if entries:
        rows = spark.createDataFrame([tuple(e) for e in entries], INTENT_SCHEMA).coalesce(1)
        rows.write.mode("append").partitionBy("noted_on").parquet(path)


def note(spark: SparkSession, lake: Lake, step: str, days: Collection[dt.date]) -> list[Row]:
    """Open an entry for each day; they are on disk when this returns."""
    token, today = uuid.uuid4().hex, dt.datetime.now(dt.timezone.utc).date()
    entries = [Row(token=token, step=step, day=d, noted_on=today) for d in sorted(days)]
    _append(spark, lake.intents, entries)
    return entries


def pending(spark: SparkSession, lake: Lake, step: str) -> list[Row]:
    """Open entries of a step: as many rows as days of the runs that are not through."""
    opened, done = (read_table(spark, p, INTENT_SCHEMA).where(F.col("step") == step) for p in (lake.intents, lake.intents_done))
    return opened.join(done, ["token", "step", "day"], "left_anti").select(*INTENT_SCHEMA.fieldNames()).collect()


def tick_off(spark: SparkSession, lake: Lake, entries: Collection[Row]) -> None:
    _append(spark, lake.intents_done, entries)


def days_of(entries: Collection[Row]) -> set[dt.date]:
    return {e["day"] for e in entries}


def tidy(spark: SparkSession, lake: Lake, before: dt.date) -> list[dt.date]:
    """Empty the log of the days before ``before`` on which nothing noted is open; returns those days."""
    open_days = {e["noted_on"] for step in (DATE, SILVER, GOLD) for e in pending(spark, lake, step)}
    noted = read_table(spark, lake.intents, INTENT_SCHEMA).where(F.col("noted_on") < F.lit(before))
    spent = sorted({r["noted_on"] for r in noted.select("noted_on").distinct().collect()} - open_days)
    for day in spent:
        # The entries go first: without them, what is left of their ticks means nothing.
        clear_partition(spark, lake.intents, INTENT_SCHEMA, noted_on=day)
        clear_partition(spark, lake.intents_done, INTENT_SCHEMA, noted_on=day)
    return spent
