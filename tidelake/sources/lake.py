"""Where the layers live and how they are read and written."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable, Collection, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from tidelake.schemas import (
    BAD_LINE_SCHEMA,
    DAY_PAIRS_SCHEMA,
    BRONZE_TABLE_SCHEMA,
    GOLD_TABLES,
    LEDGER_SCHEMA,
    QUARANTINE_SCHEMA,
    SILVER_SCHEMA,
)

# Copies of one row compress to almost nothing, so file sizes alone would let a single file, and
# the one task that later reads it, hold any number of them.
ROWS_PER_FILE = 1_000_000


@dataclass(frozen=True)
class Lake:
    """Folder layout under one root (any file system Spark can write)."""

    root: str
    #: Buckets of the id index, fixed when a lake is made.
    id_buckets: int = 16

    def path(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    @property
    def bronze(self) -> str:
        return self.path("bronze", "events")

    @property
    def silver(self) -> str:
        return self.path("silver", "events")

    @property
    def day_pairs(self) -> str:
        return self.path("silver", "day_pairs")

    @property
    def ids(self) -> str:
        return self.path("silver", "ids")

    @property
    def intents(self) -> str:
        return self.path("intents", "opened")

    @property
    def intents_done(self) -> str:
        return self.path("intents", "done")

    @property
    def ledger(self) -> str:
        return self.path("ledger")

    @property
    def bad_lines(self) -> str:
        return self.path("quarantine", "bronze_bad_lines")

    @property
    def bad_rows(self) -> str:
        return self.path("quarantine", "silver_bad_rows")

    @property
    def late_rows(self) -> str:
        return self.path("quarantine", "late_rows")

    @property
    def frontier(self) -> str:
        return self.path("quarantine", "frontier")

    @property
    def snapshots(self) -> str:
        return self.path("snapshots")

    def gold(self, table: str) -> str:
        return self.path("gold", table)

    def staging(self, name: str) -> str:
        return self.path("staging", name)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table of known schema; a path nothing was written to yet reads as empty."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def only(df: DataFrame, column: str, values: Iterable | None) -> DataFrame:
    return df if values is None else df.where(F.col(column).isin([F.lit(v) for v in sorted(values)]))


def read_bronze(spark: SparkSession, lake: Lake, dates: Collection[dt.date] | None = None) -> DataFrame:
    """Bronze with ``date`` and ``hour`` from the path; ``dates`` prunes partitions."""
    return only(read_table(spark, lake.bronze, BRONZE_TABLE_SCHEMA), "date", dates)


def read_silver(spark: SparkSession, lake: Lake, days: Collection[dt.date] | None = None) -> DataFrame:
    return only(read_table(spark, lake.silver, SILVER_SCHEMA), "event_day", days)


def read_day_pairs(spark: SparkSession, lake: Lake) -> DataFrame:
    """Which file dates hold valid rows of which event days."""
    return read_table(spark, lake.day_pairs, DAY_PAIRS_SCHEMA)


def read_gold(spark: SparkSession, lake: Lake, days: Collection[dt.date] | None = None) -> dict[str, DataFrame]:
    return {
        t: only(read_table(spark, lake.gold(t), e.schema(t)), "event_day", days) for t, e in GOLD_TABLES.items()
    }


def read_ledger(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_table(spark, lake.ledger, LEDGER_SCHEMA)


def read_bad_rows(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_table(spark, lake.bad_rows, QUARANTINE_SCHEMA)


def read_bad_lines(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_table(spark, lake.bad_lines, BAD_LINE_SCHEMA)


def read_by_name(spark: SparkSession, path: str) -> DataFrame:
    """All files under a table, columns matched by name across files that differ."""
    return spark.read.option("mergeSchema", True).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, keys: list[str]) -> None:
    """Replace exactly the partitions ``df`` has rows for.

    Rows are regrouped first, so a partition becomes a few files; REBALANCE lets AQE split a
    partition that holds most of the rows instead of giving it to one task.
    """
    (
        df.hint("rebalance", *[F.col(k) for k in keys]).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(*keys)
        .parquet(path)
    )


def clear_partition(spark: SparkSession, path: str, schema: StructType, **partition: object) -> None:
    """Empty one partition; overwriting partitions dynamically leaves those without new rows."""
    stored = StructType([f for f in schema.fields if f.name not in partition])
    folder = "/".join(f"{k}={v}" for k, v in partition.items())
    spark.createDataFrame([], stored).write.mode("overwrite").parquet(f"{path}/{folder}")


def clear_days(spark: SparkSession, path: str, schema: StructType, days: Collection[dt.date]) -> None:
    """Empty the day partitions that exist among ``days``."""
    stored = only(read_table(spark, path, schema), "event_day", days).select("event_day").distinct()
    for row in stored.collect():
        clear_partition(spark, path, schema, event_day=row["event_day"])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more, such as a run's staging."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def side_by_side(jobs: Iterable[Callable[[], None]], at_once: int = 4) -> None:
    """Submit independent small writes together, so they fill the cluster instead of queueing."""
    with ThreadPoolExecutor(at_once) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()
