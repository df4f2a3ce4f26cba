"""The index of event ids: which days hold a copy of an id, and how early each copy is.

One row per (id, event day) with the order of that day's first copy. The table is bucketed by id and sorted
within its buckets, so joins on the id read it as it lies and only the other side is shuffled.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.sources.lake import Lake, only

ORDER = ["ingest_ts", "source_file", "created_at"]
COLUMNS = ["event_id", *ORDER, "event_day"]


def index_table(spark: SparkSession, lake: Lake) -> str:
    """Name of the index in this session's catalog; made known with all its days where it is not."""
    name = "tidelake_ids_" + hashlib.sha256(lake.root.encode()).hexdigest()[:16]
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE {name} (event_id STRING, {', '.join(f'{c} STRING' for c in ORDER)}, event_day DATE) USING parquet"
            f" PARTITIONED BY (event_day) CLUSTERED BY (event_id) SORTED BY (event_id) INTO {lake.id_buckets} BUCKETS LOCATION '{lake.ids}'"
        )
        spark.sql(f"INSERT INTO {name} SELECT * FROM {name} WHERE false")  # makes the folder of a new lake
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


def read_ids(spark: SparkSession, lake: Lake, days: Collection[dt.date] | None = None) -> DataFrame:
    return only(spark.table(index_table(spark, lake)), "event_day", days)


def first_copies(rows: DataFrame) -> DataFrame:
    """Index rows of typed, valid rows. Minima are combined in the map tasks, so a hot id is one row of each."""
    first = rows.groupBy("event_id", "event_day").agg(F.min(F.struct(*ORDER)).alias("first"))
    return first.select("event_id", "first.*", "event_day")


def changed_ids(old: DataFrame, new: DataFrame) -> DataFrame:
    """Ids that gained, lost or changed a copy on some day."""
    keys = ["event_id", "event_day"]
    before, after = (df.select(*keys, F.struct(*ORDER).alias(side)) for df, side in ((old, "before"), (new, "after")))
    return before.join(after, keys, "full_outer").where(~F.col("before").eqNullSafe(F.col("after"))).select("event_id").distinct()


def replace_days(spark: SparkSession, lake: Lake, rows: DataFrame, days: Collection[dt.date]) -> None:
    """Make ``rows`` the whole index of ``days``."""
    name = index_table(spark, lake)
    empty = set(days) - {r["event_day"] for r in rows.select("event_day").distinct().collect()}
    # One task per bucket writes one file per day; the hash is the one of the buckets.
    dealt = rows.select(*COLUMNS).repartition(lake.id_buckets, "event_id").sortWithinPartitions("event_day", "event_id")
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        dealt.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, before)
    held = {r["event_day"] for r in only(spark.table(name), "event_day", empty).select("event_day").distinct().collect()}
    for day in held:
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (event_day = DATE'{day}') SELECT {', '.join('STRING(NULL)' for _ in COLUMNS[:-1])} WHERE false")


def _within(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` in the span of ``ids``: files are sorted by id, so this skips most of those of far days."""
    span = ids.agg(F.min("event_id").alias("low"), F.max("event_id").alias("high")).first()
    return rows.where(F.col("event_id").between(F.lit(span["low"]), F.lit(span["high"])))


def days_sharing(spark: SparkSession, lake: Lake, ids: DataFrame, besides: Collection[dt.date]) -> set[dt.date]:
    """Days other than ``besides`` that hold a copy of one of ``ids``."""
    others = _within(read_ids(spark, lake), ids).where(~F.col("event_day").isin([F.lit(d) for d in sorted(besides)]))
    return {r["event_day"] for r in others.join(ids, "event_id", "left_semi").select("event_day").distinct().collect()}


def later_copies(spark: SparkSession, lake: Lake, days: Collection[dt.date]) -> DataFrame:
    """(event_id, event_day) of copies on ``days`` of which another day has an earlier one."""
    here = read_ids(spark, lake, days).select("event_id", "event_day", F.struct(*ORDER, "event_day").alias("here"))
    first = _within(read_ids(spark, lake), here).groupBy("event_id").agg(F.min(F.struct(*ORDER, "event_day")).alias("first"))
    return here.join(first, "event_id").where("here <> first").select("event_id", "event_day")
