"""Which hours exist, which are done.

The ledger is an append-only table with one row per landed hour and run; of several rows for one
hour the newest counts, so a repeated run changes nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.schemas import LEDGER_SCHEMA

RETENTION_DAYS = 150


def hour_spine(
    bounds: DataFrame, hours_back: int | None = 6, retention_days: int = RETENTION_DAYS
) -> DataFrame:
    """Expected hours from ``bounds(start_from, latest_complete)``, at most the retention long.

    A NULL ``start_from`` means the last ``hours_back`` hours. The clamp bounds the spine at
    ``retention_days * 24 + 1`` rows.
    """
    latest = F.col("latest_complete")
    default_start = latest - F.make_dt_interval(F.lit(0), F.lit((hours_back or 1) - 1))
    start = F.greatest(
        F.coalesce("start_from", default_start), latest - F.make_dt_interval(F.lit(retention_days))
    )
    # `least` keeps the sequence valid where constants are folded ahead of the filter.
    hours = F.sequence(F.least(start, latest), latest, F.expr("INTERVAL 1 HOUR"))
    return bounds.where(start <= latest).select(F.explode(hours).alias("hour_ts"))


def clock_bounds(spark: SparkSession, as_of: dt.datetime, start_from: dt.datetime | None = None) -> DataFrame:
    """Bounds for ``hour_spine``: the hour before the one ``as_of`` (UTC) falls into is complete."""

    def ts(value: dt.datetime | None) -> Column:
        return F.lit(value.isoformat(sep=" ") if value else None).cast("timestamp")

    return spark.range(1).select(
        ts(start_from).alias("start_from"),
        (F.date_trunc("hour", ts(as_of)) - F.expr("INTERVAL 1 HOUR")).alias("latest_complete"),
    )


def missing_hours(spine: DataFrame, ledger: DataFrame) -> DataFrame:
    """Expected hours the ledger does not know. Both sides are at most one row per hour."""
    return spine.join(ledger.select("hour_ts").distinct(), "hour_ts", "left_anti")


def latest_entries(ledger: DataFrame) -> DataFrame:
    others = [c for c in LEDGER_SCHEMA.fieldNames() if c not in ("hour_ts", "ingested_at")]
    newest = F.max(F.struct("ingested_at", *others)).alias("entry")
    return ledger.groupBy("hour_ts").agg(newest).select("hour_ts", "entry.*").select(*LEDGER_SCHEMA.fieldNames())


def hour_completeness(files: DataFrame, ledger: DataFrame, stored: DataFrame) -> DataFrame:
    """Every hour that a file, the ledger or stored bronze knows, and what is wrong with it.

    ``files`` has hour_ts of listed files, ``ledger`` its entries (the newest of an hour counts), ``stored``
    rows by hour_ts. All three are one row per hour before they meet. Columns: hour_ts, files, ledger_rows,
    stored_rows, problem: ``not_landed`` (a file the ledger does not know), ``lost`` (rows in the ledger, none
    stored), ``unrecorded`` (stored, not in the ledger), ``count_differs``, or NULL. A file that is gone after
    its hour was landed is no problem.
    """
    listed = files.where(F.col("hour_ts").isNotNull()).groupBy("hour_ts").agg(F.count("*").alias("files"))
    told = latest_entries(ledger).select("hour_ts", F.col("rows").alias("ledger_rows"))
    held = stored.groupBy("hour_ts").agg(F.sum("rows").alias("stored_rows"))
    all_hours = listed.join(told, "hour_ts", "full_outer").join(held, "hour_ts", "full_outer")
    rows = F.coalesce("stored_rows", F.lit(0))
    problem = (
        F.when(F.col("ledger_rows").isNull() & (rows > 0), "unrecorded")
        .when(F.col("ledger_rows").isNull(), "not_landed")
        .when((F.col("ledger_rows") > 0) & (rows == 0), "lost")
        .when(F.col("ledger_rows") != rows, "count_differs")
    )
    return all_hours.select("hour_ts", F.coalesce("files", F.lit(0)).alias("files"), "ledger_rows", rows.alias("stored_rows"), problem.alias("problem"))
