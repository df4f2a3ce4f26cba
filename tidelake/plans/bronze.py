"""Raw lines to bronze, with quarantine and ledger.

A batch of files is decompressed and parsed once, into a staging table; everything else reads
that narrow table. The staging table also cuts the lineage: a lost executor costs a re-read of
Parquet, not another pass over gzip files that cannot be split.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions import as_naive_utc
from tidelake.operators.dedup import first_per_file
from tidelake.operators.flatten import bad_lines, file_stats, flatten_lines, good_lines, stored_hours
from tidelake.schemas import BAD_LINE_SCHEMA, BRONZE_COLUMNS, BRONZE_TABLE_SCHEMA, LEDGER_SCHEMA
from tidelake.session import configure
from tidelake.sources import intents, ledger, raw
from tidelake.sources.lake import (
    ROWS_PER_FILE,
    Lake,
    clear_partition,
    overwrite_partitions,
    read_bad_lines,
    read_bronze,
    read_ledger,
    remove,
)


def _record(stats: DataFrame, lake: Lake, ingest_at: dt.datetime) -> None:
    """Append ledger entries for files whose name carries an hour."""
    entries = stats.where(F.col("date").isNotNull()).withColumns(
        {"hour_ts": raw.hour_start(), "ingested_at": F.lit(ingest_at.isoformat()).cast("timestamp")}
    )
    entries.select(*LEDGER_SCHEMA.fieldNames()).coalesce(1).write.mode("append").partitionBy("date").parquet(lake.ledger)


def land_lines(lines: DataFrame, lake: Lake, ingest_at: dt.datetime, slot: str) -> list[dt.date]:
    """Land positioned lines; returns the file dates that changed.

    Safe to repeat: hours are overwritten as a whole and the ledger counts the newest entry. The
    ledger is written last, so an hour that is listed there is complete; that its date has to go
    into silver is noted first, so it does even if nobody refreshes before a crash. ``slot`` names the
    staging area, which is gone afterwards; one writer per slot.
    """
    spark = lines.sparkSession
    staged = flatten_lines(lines, ingest_at).write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE)
    staged.parquet(lake.staging(slot))
    flat = spark.read.parquet(lake.staging(slot))

    # One row per file of the batch, so bounded by the number of files.
    found = (
        flat.groupBy("source_file", "date", "hour")
        .agg((F.count("*") > F.count("bad_reason")).alias("good"), (F.count("bad_reason") == 0).alias("clean"))
        .collect()
    )
    if not found:
        remove(spark, lake.staging(slot))
        return []
    hours = {(f["date"], f["hour"]) for f in found if f["date"]}
    touched = sorted({date for date, _ in hours})
    intents.note(spark, lake, intents.DATE, touched)
    rows = first_per_file(good_lines(flat)).select(*BRONZE_COLUMNS, "date", "hour")
    overwrite_partitions(rows, lake.bronze, ["date", "hour"])
    overwrite_partitions(bad_lines(flat), lake.bad_lines, ["source_file"])
    clean = [f["source_file"] for f in found if f["clean"]]
    outdated = read_bad_lines(spark, lake).where(F.col("source_file").isin(clean)).select("source_file").distinct()
    for row in outdated.collect():
        clear_partition(spark, lake.bad_lines, BAD_LINE_SCHEMA, source_file=row["source_file"])

    # Hours are folders, so which of them are stored is told without reading a data column; the counts
    # read one column of the hours that were written.
    known = {(r["date"], r["hour"]) for r in stored_hours(read_bronze(spark, lake, touched)).select("date", "hour").collect()}
    good = {(f["date"], f["hour"]) for f in found if f["good"]}
    for date, hour in (hours - good) & known:
        clear_partition(spark, lake.bronze, BRONZE_TABLE_SCHEMA, date=date, hour=hour)
    names = F.struct("date", "hour").isin([F.struct(F.lit(d).alias("date"), F.lit(h).alias("hour")) for d, h in sorted(hours)])
    _record(file_stats(flat, read_bronze(spark, lake, touched).where(names)), lake, ingest_at)
    remove(spark, lake.staging(slot))
    return touched


def record_empty_hours(files: DataFrame, lake: Lake, ingest_at: dt.datetime) -> None:
    """Mark listed files as done that held no line at all and so never reached ``land_lines``."""
    named = files.where(F.col("hour_ts").isNotNull())
    zero = F.lit(0).cast("bigint")
    empty = ledger.missing_hours(named, read_ledger(files.sparkSession, lake))
    _record(empty.withColumns({"rows": zero, "duplicates": zero, "bad": zero}), lake, ingest_at)


def ingest_hours(
    spark: SparkSession,
    lake: Lake,
    raw_folder: str,
    as_of: dt.datetime | None = None,
    start_from: dt.datetime | None = None,
    hours_back: int = 6,
    retention_days: int = ledger.RETENTION_DAYS,
) -> list[dt.date]:
    """Land every expected hour that has a file and is not in the ledger; returns changed dates.

    The file list that reaches the driver is bounded by the retention (one file per hour). A
    ``start_from`` beyond the retention is refused, so no hour is left out unnoticed.
    """
    configure(spark)
    now, first = as_naive_utc(as_of or dt.datetime.now(dt.timezone.utc)), as_naive_utc(start_from)
    if first is not None and now - first > dt.timedelta(days=retention_days, hours=2):
        raise ValueError(f"start_from is more than {retention_days} days back; raise retention_days to land those hours")
    spine = ledger.hour_spine(ledger.clock_bounds(spark, now, first), hours_back, retention_days)
    wanted = ledger.missing_hours(spine, read_ledger(spark, lake))
    files = raw.list_files(spark, raw_folder).join(wanted, "hour_ts", "left_semi")
    paths = [r["path"] for r in files.select("path").collect()]
    if not paths:
        return []
    dates = land_lines(raw.scan_lines(spark, paths), lake, dt.datetime.now(dt.timezone.utc), slot=f"batch-{uuid.uuid4().hex}")
    record_empty_hours(files, lake, dt.datetime.now(dt.timezone.utc))
    return dates
