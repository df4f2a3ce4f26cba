"""Silver to the eight gold tables.

Silver is scanned once: all hourly counts come out of one aggregation, which is written to
staging; the hourly and daily tables are cut from that small result.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Collection
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tidelake.operators.counts import daily_from_hourly, entity_from_cube, hourly_cube
from tidelake.schemas import ENTITIES, Entity
from tidelake.session import configure
from tidelake.sources import intents
from tidelake.sources.lake import Lake, clear_days, overwrite_partitions, read_silver, remove, side_by_side


def build_days(spark: SparkSession, lake: Lake, days: Collection[dt.date]) -> None:
    """Recompute all gold tables for the given days; repeating it changes nothing."""
    configure(spark)
    if not days:
        return
    staged = lake.staging(f"gold-{uuid.uuid4().hex}")
    hourly_cube(read_silver(spark, lake, days)).write.mode("overwrite").partitionBy("entity").parquet(staged)
    cube = spark.read.schema(
        "event_day date, event_hour_ts timestamp, key string, n bigint, entity string"
    ).parquet(staged)
    present = {(r["entity"], r["event_day"]) for r in cube.select("entity", "event_day").distinct().collect()}

    def write(table: str, entity: Entity, rows: DataFrame) -> None:
        schema = entity.schema(table)
        overwrite_partitions(
            rows.select(*schema.fieldNames()), lake.gold(table), ["event_day"]
        )
        gone = {d for d in days if (entity.name, d) not in present}
        if gone:
            clear_days(spark, lake.gold(table), schema, gone)

    jobs = []
    for e in ENTITIES.values():
        hourly = entity_from_cube(cube, e)
        jobs.append(partial(write, e.hourly, e, hourly))
        jobs.append(partial(write, e.daily, e, daily_from_hourly(hourly, e)))
    side_by_side(jobs)
    remove(spark, staged)


def build_pending(spark: SparkSession, lake: Lake) -> list[dt.date]:
    """Recompute gold for the days noted for it; returns them."""
    entries = intents.pending(spark, lake, intents.GOLD)
    days = sorted(intents.days_of(entries))
    build_days(spark, lake, days)
    intents.tick_off(spark, lake, entries)
    return days
