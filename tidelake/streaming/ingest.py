"""The lake as a stream of hourly files: every new file is landed exactly once.

Each micro-batch goes through the batch plans, which overwrite whole hours and whole days, so a
batch that is repeated after a failure leaves the same tables.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelake.functions import naive_utc
from tidelake.operators.conform import typed, valid_rows
from tidelake.plans.backfill import refresh
from tidelake.plans.bronze import land_lines, record_empty_hours
from tidelake.schemas import QUARANTINE_SCHEMA
from tidelake.session import configure
from tidelake.sources import raw
from tidelake.sources.lake import Lake, read_bronze, remove

LATE_AFTER = dt.timedelta(hours=6)
TICK = "900 seconds"


def late_rows(bronze: DataFrame, newest_hour: dt.datetime | None, late_after: dt.timedelta = LATE_AFTER) -> DataFrame:
    """Rows further behind the newest known hour (naive UTC) than a live watermark would accept."""
    rows = typed(bronze).withColumn("reason", F.lit("late"))
    if newest_hour is None:
        return rows.where(F.lit(False)).select(*QUARANTINE_SCHEMA.fieldNames())
    oldest = F.lit((newest_hour - late_after).isoformat(sep=" ")).cast("timestamp")
    return rows.where(F.col("event_ts") < oldest).select(*QUARANTINE_SCHEMA.fieldNames())


def _land(batch: DataFrame, batch_id: int, lake: Lake) -> None:
    spark = configure(batch.sparkSession)
    now = dt.datetime.now(dt.timezone.utc)
    dates = land_lines(raw.with_line_position(batch), lake, now, slot=f"stream-{uuid.uuid4().hex}")
    landed = read_bronze(spark, lake, dates).where(F.col("ingest_ts") == now.isoformat())
    # Late rows are noted here and still counted: the refresh rebuilds the days they belong to.
    newest = frontier(spark, lake, landed, batch_id)
    late_rows(landed, newest).write.mode("overwrite").parquet(f"{lake.late_rows}/batch_id={batch_id}")
    refresh(spark, lake, dates)


def frontier(spark: SparkSession, lake: Lake, landed: DataFrame, batch_id: int) -> dt.datetime | None:
    """Note the newest hour of this batch; returns the newest of the batches before it (naive UTC).

    It depends on earlier batches only, so a batch that is repeated finds the same late rows.
    """
    hours = valid_rows(typed(landed)).agg(F.max("event_hour_ts").alias("newest"))
    hours.write.mode("overwrite").parquet(f"{lake.frontier}/batch_id={batch_id}")
    noted = spark.read.schema("newest timestamp, batch_id bigint").parquet(lake.frontier)
    return noted.where(F.col("batch_id") < batch_id).agg(naive_utc(F.max("newest"))).first()[0]


def start(
    spark: SparkSession,
    lake: Lake,
    raw_folder: str,
    checkpoint: str,
    max_files: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Start the ingest; ``every`` keeps it running at that pace, otherwise it takes what is there."""
    lines = raw.stream_lines(configure(spark), raw_folder, max_files)
    writer = (
        lines.writeStream.queryName("tidelake-ingest")
        .foreachBatch(lambda batch, batch_id: _land(batch, batch_id, lake))
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def ingest_available(
    spark: SparkSession, lake: Lake, raw_folder: str, checkpoint: str, max_files: int | None = None
) -> None:
    """One tick: land all files not landed yet, then mark the hours whose files held no line.

    Files are listed before the stream starts, so every listed file has been through it.
    """
    configure(spark)
    listing = lake.staging(f"listing-{uuid.uuid4().hex}")
    raw.list_files(spark, raw_folder).write.parquet(listing)
    query = start(spark, lake, raw_folder, checkpoint, max_files)
    query.awaitTermination()
    record_empty_hours(spark.read.parquet(listing), lake, dt.datetime.now(dt.timezone.utc))
    remove(spark, listing)
