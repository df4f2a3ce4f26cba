"""Duplicate removal.

Every rule here is ``row_number() = 1``, which Spark plans with a WindowGroupLimit below the
exchange: each map task sends at most one row per key, so a key that holds a third of all rows
costs the reducer one row per map task. Keys start with the event id: it differs early, so most
comparisons of the sort end at its first bytes, which they would not on file paths or days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions import has_id
from tidelake.schemas import BRONZE_COLUMNS


def keep_first(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """The first row of every key group under ``order``."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def first_per_file(lines: DataFrame) -> DataFrame:
    """Within one source file keep the first line of every event id.

    Lines without an id (NULL or empty) are all kept: their own position joins the grouping key,
    so each is its own group and they spread evenly instead of meeting in one task.
    """
    position = F.struct("block_start", "line_pos")
    anonymous = F.when(~has_id(F.col("event_id")), position)
    keyed = lines.withColumn("_own_group", anonymous)
    kept = keep_first(keyed, ["event_id", "source_path", "_own_group"], [F.col("block_start"), F.col("line_pos")])
    return kept.drop("_own_group")


def copy_order() -> list[Column]:
    """Earliest ingest, then file name, then time of the event, then all columns."""
    first = ["ingest_ts", "source_file", "created_at"]
    rest = [c for c in BRONZE_COLUMNS if c not in ("event_id", *first)]
    return [F.col(c).asc_nulls_last() for c in (*first, *rest)]


def one_per_id(events: DataFrame) -> DataFrame:
    """One row per event id, whatever days its copies name: the first under ``copy_order``."""
    return keep_first(events, ["event_id"], copy_order())


def one_per_day(events: DataFrame) -> DataFrame:
    """One row per event id and event day.

    The day is part of the key, so filters on it reach below the window. A rebuild of some days takes
    these rows and leaves out those of which the id index knows an earlier copy on another day.
    """
    return keep_first(events, ["event_id", "event_day"], copy_order())
