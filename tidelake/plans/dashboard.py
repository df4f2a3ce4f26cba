"""Preset time ranges and the dashboard queries over gold.

``gold`` is any mapping from gold table name to DataFrame: lazy plans, lake tables or a snapshot.
Short presets read hourly tables and end after the newest hour in the data; long presets read
daily tables and end at ``as_of`` (now by default).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions import bucket_label, naive_utc, as_naive_utc, or_zero
from tidelake.schemas import ENTITIES, Entity

Gold = Mapping[str, DataFrame]

SHORT_PRESETS = {"1h": dt.timedelta(hours=1), "4h": dt.timedelta(hours=4), "24h": dt.timedelta(hours=24)}
LONG_PRESETS = {"7d": dt.timedelta(days=7), "30d": dt.timedelta(days=30), "max": None}
PRESETS = (*SHORT_PRESETS, *LONG_PRESETS)
LIMITS = range(1, 51)


class UnsupportedPreset(ValueError):
    pass


class NoHourlyData(RuntimeError):
    pass


@dataclass(frozen=True)
class TimeRange:
    """Bounds as values, or as expressions that are known when the query runs."""

    preset: str
    start: dt.datetime | Column | None
    end: dt.datetime | Column

    @property
    def hourly(self) -> bool:
        return is_short_preset(self.preset)

    def keep(self) -> Column:
        """Half-open on hours for short presets, closed on calendar days for long ones.

        ``max`` has no bound at all. Both forms restrict the partition column ``event_day``.
        """
        if self.start is None:
            return F.lit(True)
        days = F.col("event_day").between(F.to_date(_instant(self.start)), F.to_date(_instant(self.end)))
        hour = F.col("event_hour_ts")
        return days & (hour >= _instant(self.start)) & (hour < _instant(self.end)) if self.hourly else days

    def stamp(self, rows: DataFrame) -> DataFrame:
        """Put the request envelope in front of the result columns."""
        start = F.lit(self.start).cast("timestamp_ntz") if self.start is None else _naive(self.start)
        return rows.select(
            F.lit(self.preset).alias("preset"), start.alias("start_ts"), _naive(self.end).alias("end_ts"), *rows.columns
        )


def _naive(value: dt.datetime | Column) -> Column:
    if isinstance(value, Column):
        return naive_utc(value)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _instant(value: dt.datetime | Column) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(value.isoformat(sep=" ")).cast("timestamp")


def is_short_preset(preset: str) -> bool:
    return preset in SHORT_PRESETS


def resolve_range_from_clock(preset: str, as_of: dt.datetime | None = None) -> TimeRange:
    if preset not in PRESETS:
        raise UnsupportedPreset(f"{preset!r} is none of the presets {sorted(PRESETS)}")
    end = as_naive_utc(as_of or dt.datetime.now(dt.timezone.utc))
    back = {**SHORT_PRESETS, **LONG_PRESETS}[preset]
    return TimeRange(preset, end - back if back else None, end)


def latest_hour(gold: Gold) -> DataFrame:
    return gold["event_type_hourly"].agg(naive_utc(F.max("event_hour_ts")).alias("latest_hour"))


def resolve_short_range_from_data(gold: Gold, preset: str) -> TimeRange:
    """Anchored on the newest hour in gold; brings that single value to the driver."""
    if not is_short_preset(preset):
        raise UnsupportedPreset(f"{preset!r} does not end at the newest hour; such presets: {sorted(SHORT_PRESETS)}")
    newest = latest_hour(gold).first()["latest_hour"]
    if newest is None:
        raise NoHourlyData("the hourly event types have no row to take the newest hour from")
    end = newest + dt.timedelta(hours=1)
    return TimeRange(preset, end - SHORT_PRESETS[preset], end)


def resolve_range(gold: Gold, preset: str, as_of: dt.datetime | None = None) -> TimeRange:
    """The range of any preset. Building it runs no job.

    A short one ends at a scalar subquery for the newest hour; its days prune partitions when the query
    runs, and a query on gold without any hour raises then.
    """
    if not is_short_preset(preset):
        return resolve_range_from_clock(preset, as_of)
    none = F.raise_error(F.lit("the hourly event types have no row to take the newest hour from")).cast("timestamp")
    newest = gold["event_type_hourly"].agg(F.max("event_hour_ts").alias("newest")).select(F.coalesce("newest", none)).scalar()
    end = newest + F.expr("INTERVAL 1 HOUR")
    hours = int(SHORT_PRESETS[preset].total_seconds()) // 3600
    return TimeRange(preset, end - F.expr(f"INTERVAL {hours} HOUR"), end)


def preset_ranges(gold: Gold, as_of: dt.datetime) -> DataFrame:
    """All presets with their bounds as rows, without leaving the cluster."""
    clock = as_naive_utc(as_of)
    rows = []
    for preset in PRESETS:
        if is_short_preset(preset):
            rows.append((preset, int(SHORT_PRESETS[preset].total_seconds()), None))
        else:
            back = LONG_PRESETS[preset]
            rows.append((preset, int(back.total_seconds()) if back else None, clock))
    table = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(p).alias("preset"),
                    F.lit(s).cast("bigint").alias("seconds"),
                    (_naive(e) if e else F.lit(None).cast("timestamp_ntz")).alias("clock_end"),
                )
                for p, s, e in rows
            ]
        )
    ).alias("p")
    end = F.coalesce("p.clock_end", F.col("latest_hour") + F.expr("INTERVAL 1 HOUR"))
    back = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("p.seconds"))
    return latest_hour(gold).select("latest_hour", table).select(
        "p.preset", (end - back).alias("start_ts"), end.alias("end_ts")
    )


def _rows_in_range(gold: Gold, entity: Entity, span: TimeRange) -> DataFrame:
    return gold[entity.hourly if span.hourly else entity.daily].where(span.keep())


def summary(gold: Gold, preset: str = "7d", as_of: dt.datetime | None = None) -> DataFrame:
    span = resolve_range(gold, preset, as_of)
    rows = _rows_in_range(gold, ENTITIES["event_type"], span)
    return span.stamp(rows.agg(or_zero(F.sum("event_count")).alias("total_events")))


def event_types(gold: Gold, preset: str = "7d", as_of: dt.datetime | None = None) -> DataFrame:
    span = resolve_range(gold, preset, as_of)
    rows = _rows_in_range(gold, ENTITIES["event_type"], span)
    totals = rows.groupBy("event_type").agg(F.sum("event_count").alias("event_count"))
    return span.stamp(totals.orderBy(F.desc("event_count"), "event_type"))


def event_type_series(gold: Gold, preset: str = "7d", as_of: dt.datetime | None = None) -> DataFrame:
    """Counts per bucket and type: hourly buckets for short presets, daily ones otherwise."""
    span = resolve_range(gold, preset, as_of)
    time_key = "event_hour_ts" if span.hourly else "event_day"
    rows = _rows_in_range(gold, ENTITIES["event_type"], span)
    totals = rows.groupBy(time_key, "event_type").agg(F.sum("event_count").alias("event_count"))
    ordered = totals.orderBy(time_key, F.desc("event_count"), "event_type")
    return span.stamp(
        ordered.select(bucket_label(F.col(time_key), span.hourly).alias("bucket"), "event_type", "event_count")
    )


def ranked(
    gold: Gold, entity: Entity, preset: str = "7d", limit: int = 10, as_of: dt.datetime | None = None
) -> DataFrame:
    """Top ``limit`` keys by total, ties broken by key. Only ``limit`` rows leave the executors."""
    if limit not in LIMITS:
        raise ValueError(f"limit must be within {LIMITS.start}..{LIMITS.stop - 1}, got {limit}")
    span = resolve_range(gold, preset, as_of)
    totals = _rows_in_range(gold, entity, span).groupBy(entity.key).agg(F.sum(entity.metric).alias(entity.metric))
    return span.stamp(totals.orderBy(F.desc(entity.metric), entity.key).limit(limit))


def top_push_users(gold: Gold, preset: str = "7d", limit: int = 10, as_of: dt.datetime | None = None) -> DataFrame:
    return ranked(gold, ENTITIES["push_user"], preset, limit, as_of)


def top_pr_orgs(gold: Gold, preset: str = "7d", limit: int = 10, as_of: dt.datetime | None = None) -> DataFrame:
    return ranked(gold, ENTITIES["pr_org"], preset, limit, as_of)


def top_pr_repos(gold: Gold, preset: str = "7d", limit: int = 10, as_of: dt.datetime | None = None) -> DataFrame:
    return ranked(gold, ENTITIES["pr_repo"], preset, limit, as_of)


def trailing_totals(
    gold: Gold, entity: Entity, days: int = 30, as_of: dt.date | None = None
) -> DataFrame:
    """Every key's total since ``days`` days before ``as_of``, with no upper bound, largest first."""
    today = F.lit(as_of) if as_of else F.current_date()
    return (
        gold[entity.daily]
        .where(F.col("event_day") >= F.date_sub(today, days))
        .groupBy(entity.key)
        .agg(F.sum(entity.metric).alias(entity.metric))
        .orderBy(F.desc(entity.metric), entity.key)
    )
