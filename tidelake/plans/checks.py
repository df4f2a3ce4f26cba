"""The quality checks run against a lake's stored layers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions import as_naive_utc
from tidelake.operators import quality
from tidelake.operators.flatten import stored_hours
from tidelake.schemas import BRONZE_SCHEMA
from tidelake.session import configure
from tidelake.sources import ledger, snapshot
from tidelake.sources.lake import Lake, read_bronze, read_gold, read_ledger, read_silver
from tidelake.sources.raw import hour_start, list_files


def day_report(spark: SparkSession, lake: Lake, day: dt.date) -> DataFrame:
    """``check_name, value`` for one event day: the silver checks and the gold reconciliation."""
    configure(spark)
    silver, gold = read_silver(spark, lake, [day]), read_gold(spark, lake, [day])
    checks = quality.silver_report(silver, day=day).select("check_name", "value")
    return checks.unionByName(quality.reconciliation(silver, gold["event_type_daily"], day))


def gold_report(spark: SparkSession, lake: Lake) -> DataFrame:
    """Rows and negative counts of every gold table."""
    gold = read_gold(configure(spark), lake)
    return quality.row_counts(gold).join(quality.negative_counts(gold), "table_name")


def freshness(
    spark: SparkSession, lake: Lake, as_of: dt.datetime | None = None, sla: dt.timedelta = dt.timedelta(hours=2)
) -> DataFrame:
    now = as_naive_utc(as_of or dt.datetime.now(dt.timezone.utc))
    return quality.freshness(read_gold(configure(spark), lake)["event_type_hourly"], now, sla)


def missing_hours(
    spark: SparkSession, lake: Lake, as_of: dt.datetime | None = None, hours_back: int = 6
) -> DataFrame:
    """Expected hours that have not been landed."""
    now = as_naive_utc(as_of or dt.datetime.now(dt.timezone.utc))
    spine = ledger.hour_spine(ledger.clock_bounds(configure(spark), now), hours_back)
    return ledger.missing_hours(spine, read_ledger(spark, lake))


def hour_completeness(spark: SparkSession, lake: Lake, raw_folder: str) -> DataFrame:
    """File listing, ledger and stored rows side by side, per hour; stored rows come from file footers."""
    stored = stored_hours(read_bronze(configure(spark), lake)).withColumn("hour_ts", hour_start())
    return ledger.hour_completeness(list_files(spark, raw_folder), read_ledger(spark, lake), stored)


def stored_columns(spark: SparkSession, lake: Lake) -> DataFrame:
    """Column names and types of every stored bronze file: ``date, hour, path, column, type``.

    The files are listed by Spark; their footers are read on the executors, which must reach the lake's
    store with pyarrow. No data page is read.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(lake.bronze)
    keys = [F.regexp_extract("path", f"/{k}=([^/]+)/", 1).alias(k) for k in ("date", "hour")]
    files = listed.select(*keys, "path").where("date <> '' AND hour <> ''")

    def footers(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow.fs import FileSystem

        for batch in batches:
            for row in batch.to_pylist():
                scheme, _, place = row["path"].partition(":")
                store, path = FileSystem.from_uri(f"{scheme}:///{place.lstrip('/')}" if scheme == "file" else row["path"])
                with store.open_input_file(path) as file:
                    fields = pq.read_schema(file)
                names = pa.array(fields.names, pa.string())
                same = [pa.array([row[k]] * len(names), pa.string()) for k in ("date", "hour", "path")]
                types = pa.array([str(t) for t in fields.types], pa.string())
                yield pa.RecordBatch.from_arrays([*same, names, types], names=["date", "hour", "path", "column", "type"])

    found = files.mapInArrow(footers, "date string, hour string, path string, column string, type string")
    return found.withColumn("date", F.col("date").cast("date"))


def bronze_columns(spark: SparkSession, lake: Lake) -> DataFrame:
    """What is wrong with the columns of stored hours: ``date, hour, column, problem``, no row if all is well.

    A column is ``missing`` if any file of the hour lacks it; otherwise the problem names the stored type.
    """
    return quality.column_problems(stored_columns(configure(spark), lake), BRONZE_SCHEMA)


def bronze_columns_missing(spark: SparkSession, lake: Lake) -> list[str]:
    """Required columns that some hour does not have in the required type."""
    return sorted({r["column"] for r in bronze_columns(spark, lake).select("column").distinct().collect()})


def _newest_day(df: DataFrame, day: str) -> DataFrame:
    """The rows of the newest partition; finding it reads no data column."""
    newest = df.agg(F.max(day).alias("day")).first()["day"]
    return df.where(F.col(day) == F.lit(newest)) if newest else df.limit(0)


def layer_lag(spark: SparkSession, lake: Lake) -> DataFrame:
    """Newest hour in every layer, to see where a stale dashboard got stuck."""
    configure(spark)
    hour = F.col("event_hour_ts")
    layers = {
        "bronze": (_newest_day(read_bronze(spark, lake), "date"), hour_start()),
        "silver": (_newest_day(read_silver(spark, lake), "event_day"), hour),
        "gold": (_newest_day(read_gold(spark, lake)["event_type_hourly"], "event_day"), hour),
    }
    try:
        layers["snapshot"] = (snapshot.open_current(spark, lake)["event_type_hourly"], hour)
    except snapshot.NothingPublished:
        pass
    return quality.layer_lag(layers)
