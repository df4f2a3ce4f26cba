"""Additive count tables: one pair (hourly, daily) per entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.schemas import ENTITIES, Entity


def counted(entity: Entity) -> Column:
    """Which silver rows an entity counts. A NULL ``is_bot`` is not a human: the row drops."""
    condition = F.col(entity.key).isNotNull()
    if entity.event_type:
        condition = (F.col("event_type") == entity.event_type) & condition
    if entity.humans_only:
        condition = condition & ~F.col("is_bot")
    return condition


def daily_counts(silver: DataFrame, entity: Entity) -> DataFrame:
    return (
        silver.where(counted(entity))
        .groupBy("event_day", entity.key)
        .agg(F.count("*").alias(entity.metric))
    )


def hourly_counts(silver: DataFrame, entity: Entity) -> DataFrame:
    """Grouping also by the day adds no groups; it lets day filters reach the silver scan."""
    return (
        silver.where(counted(entity))
        .groupBy("event_day", "event_hour_ts", entity.key)
        .agg(F.count("*").alias(entity.metric))
    )


def daily_from_hourly(hourly: DataFrame, entity: Entity) -> DataFrame:
    """Exact, because the counts are additive."""
    return hourly.groupBy("event_day", entity.key).agg(F.sum(entity.metric).alias(entity.metric))


def hourly_cube(silver: DataFrame) -> DataFrame:
    """All hourly counts in one scan and one shuffle: ``entity, event_day, event_hour_ts, key, n``.

    Each event becomes one (entity, key) pair per table it counts in. The pairs are combined
    within every map task, so hot keys reach the exchange as one row per task.
    """
    pairs = [
        F.when(counted(e), F.struct(F.lit(e.name).alias("entity"), F.col(e.key).alias("key")))
        for e in ENTITIES.values()
    ]
    return (
        silver.select("event_day", "event_hour_ts", F.explode(F.array_compact(F.array(*pairs))).alias("pair"))
        .select("pair.entity", "event_day", "event_hour_ts", "pair.key")
        .groupBy("entity", "event_day", "event_hour_ts", "key")
        .agg(F.count("*").alias("n"))
    )


def entity_from_cube(cube: DataFrame, entity: Entity) -> DataFrame:
    return cube.where(F.col("entity") == entity.name).select(
        "event_day", "event_hour_ts", F.col("key").alias(entity.key), F.col("n").alias(entity.metric)
    )


def gold_tables(silver: DataFrame) -> dict[str, DataFrame]:
    """All gold tables as lazy plans over ``silver``, keyed by table name."""
    tables = {}
    for e in ENTITIES.values():
        tables[e.daily] = daily_counts(silver, e)
        tables[e.hourly] = hourly_counts(silver, e)
    return tables


def resummed(daily: DataFrame, entity: Entity) -> DataFrame:
    return daily.groupBy("event_day", entity.key).agg(F.sum(entity.metric).alias(entity.metric))
