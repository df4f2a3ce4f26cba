"""A stream of typed events with one row per id and hourly counts, however late and often a row comes.

Every micro-batch adds to two logs under its batch id and rewrites nothing, so what is written grows with
the batch and not with the days it touches:

- ``winners``: rows that are the first copy of their id so far, by (ingest_ts, event_ts, event_type);
- ``deltas``: signed hourly counts, +1 for a row that became the first copy, -1 for the one it replaces.

Readers take the first winner of each id and the sum of the deltas, so the files may come in any order and
any number of batches. A batch that is repeated after a failure looks only at earlier batches and
overwrites what it wrote. ``fold`` merges finished batches into a base now and then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions import hour_of
from tidelake.sources.lake import read_table, remove

LATE_AFTER = "6 hours"
BUCKETS = 64
EVENT = "event_id string, ingest_ts string, event_ts timestamp, event_type string"
COUNT = "event_hour_ts timestamp, event_type string, n bigint"


def order() -> Column:
    return F.struct("ingest_ts", "event_ts", "event_type")


def first_of_each(rows: DataFrame, *keys: str) -> DataFrame:
    """The first row of every id; minima are combined in the map tasks, so a hot id is one row of each."""
    return rows.groupBy("event_id", *keys).agg(F.min(order()).alias("first")).select("event_id", "first.*", *keys)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return read_table(spark, path, spark.createDataFrame([], schema).schema)


def _folded(spark: SparkSession, folder: str) -> int:
    """The newest batch that the base holds, -1 before the first fold."""
    return _read(spark, f"{folder}/folds", "upto bigint").agg(F.coalesce(F.max("upto"), F.lit(-1))).first()[0]


def _with_base(spark: SparkSession, folder: str, log: str, schema: str) -> DataFrame:
    """The base of a log, as batch -1, and the batches after it."""
    upto, names = _folded(spark, folder), [f.split()[0] for f in schema.split(", ")]
    later = _read(spark, f"{folder}/{log}", f"{schema}, batch_id bigint").where(F.col("batch_id") > upto)
    base = _read(spark, f"{folder}/{log}_base/upto={upto}", schema)
    return later.select(*names, "batch_id").unionByName(base.select(*names, F.lit(-1).cast("bigint").alias("batch_id")))


def _winners(spark: SparkSession, folder: str) -> DataFrame:
    return _with_base(spark, folder, "winners", f"{EVENT}, bucket int")


def land(batch: DataFrame, batch_id: int, folder: str, late_after: str = LATE_AFTER) -> None:
    """Add one micro-batch (event_id, event_type, event_ts, ingest_ts) to the logs."""
    spark, here = batch.sparkSession, f"batch_id={batch_id}"
    bucket = F.pmod(F.xxhash64("event_id"), F.lit(BUCKETS)).cast("int")
    batch.select("event_id", "ingest_ts", "event_ts", "event_type").write.mode("overwrite").parquet(f"{folder}/rows/{here}")
    rows = _read(spark, f"{folder}/rows/{here}", EVENT)
    rows.agg(F.max("event_ts").alias("newest")).write.mode("overwrite").parquet(f"{folder}/newest/{here}")
    noted = _read(spark, f"{folder}/newest", "newest timestamp, batch_id bigint")
    newest = noted.where(F.col("batch_id") < batch_id).agg((F.max("newest") - F.expr(f"INTERVAL {late_after}")).cast("string")).first()[0]
    late = rows.where(F.col("event_ts") < F.lit(newest).cast("timestamp"))
    late.select("event_id", "event_type", "event_ts").write.mode("overwrite").parquet(f"{folder}/late_rows/{here}")

    new = first_of_each(rows).withColumn("bucket", bucket)
    # At most BUCKETS numbers; files of a bucket are sorted by id, so the span skips row groups as well.
    span = new.agg(F.collect_set("bucket").alias("buckets"), F.min("event_id").alias("low"), F.max("event_id").alias("high")).first()
    known = _winners(spark, folder).where(F.col("batch_id") < batch_id).where(F.col("bucket").isin(span["buckets"]))
    known = known.where(F.col("event_id").between(F.lit(span["low"]), F.lit(span["high"])))
    known = first_of_each(known.join(new.select("event_id"), "event_id", "left_semi")).select("event_id", order().alias("before"))
    gained = new.join(known, "event_id", "left").where(F.col("before").isNull() | (order() < F.col("before")))
    gained.write.mode("overwrite").parquet(f"{folder}/gained/{here}")
    gained = spark.read.schema(gained.schema).parquet(f"{folder}/gained/{here}")
    sorted_rows = gained.drop("before").hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "event_id")
    sorted_rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/winners/{here}")
    gains = gained.select("event_ts", "event_type", F.lit(1).alias("sign"))
    losses = gained.where(F.col("before").isNotNull()).select("before.event_ts", "before.event_type", F.lit(-1).alias("sign"))
    _counted(gains.unionByName(losses), "sign").write.mode("overwrite").parquet(f"{folder}/deltas/{here}")
    for spent in ("rows", "gained"):
        remove(spark, f"{folder}/{spent}/{here}")


def _counted(rows: DataFrame, sign: str) -> DataFrame:
    return rows.groupBy(hour_of(F.col("event_ts")).alias("event_hour_ts"), "event_type").agg(F.sum(sign).alias("n"))


def take_available(events: DataFrame, folder: str, checkpoint: str, late_after: str = LATE_AFTER) -> None:
    """Land everything the stream has now. Rows behind the newest time by ``late_after`` are noted in ``late_rows`` and kept."""
    writer = events.writeStream.foreachBatch(lambda batch, batch_id: land(batch, batch_id, folder, late_after))
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def events(spark: SparkSession, folder: str) -> DataFrame:
    """One row per id: event_id, event_type, event_ts."""
    return first_of_each(_winners(spark, folder)).select("event_id", "event_type", "event_ts")


def hourly_type_counts(spark: SparkSession, folder: str) -> DataFrame:
    """event_hour_ts, event_type, event_count, from the signed counts alone."""
    deltas = _with_base(spark, folder, "deltas", COUNT)
    return deltas.groupBy("event_hour_ts", "event_type").agg(F.sum("n").alias("event_count")).where("event_count <> 0")


def fold(spark: SparkSession, folder: str) -> int:
    """Merge the batches that are through into the base; returns the newest of them.

    The base counts from the moment its number is noted, after it is complete. Batches of the fold before
    this one are deleted; readers that began before keep what they listed.
    """
    before = _folded(spark, folder)
    done = _read(spark, f"{folder}/deltas", f"{COUNT}, batch_id bigint").agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0]
    if done <= before:
        return before
    merged = first_of_each(_winners(spark, folder).where(F.col("batch_id") <= done), "bucket")
    merged = merged.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "event_id")
    merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/winners_base/upto={done}")
    deltas = _with_base(spark, folder, "deltas", COUNT).where(F.col("batch_id") <= done)
    sums = deltas.groupBy("event_hour_ts", "event_type").agg(F.sum("n").alias("n")).where("n <> 0")
    sums.write.mode("overwrite").parquet(f"{folder}/deltas_base/upto={done}")
    spark.range(1).select(F.lit(done).cast("bigint").alias("upto")).write.mode("append").parquet(f"{folder}/folds")
    for batch_id in range(before + 1):
        for log in ("winners", "deltas"):
            remove(spark, f"{folder}/{log}/batch_id={batch_id}")
    return done
