"""Bronze rows to typed silver rows, and the rows that do not qualify."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions import hour_of, is_bot, parse_ts
from tidelake.operators.dedup import one_per_id
from tidelake.schemas import QUARANTINE_SCHEMA, SILVER_COLUMNS

MISSING_ID = "missing_event_id"
MISSING_TYPE = "missing_event_type"
BAD_TS = "bad_event_ts"


def typed(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("event_ts", parse_ts(F.col("created_at"))).withColumns(
        {
            "event_day": F.to_date("event_ts"),
            "event_hour_ts": hour_of(F.col("event_ts")),
            "is_bot": is_bot(F.col("actor_login")),
        }
    )


def reject_reason() -> Column:
    """Why a typed row may not enter silver; NULL when it may."""
    return (
        F.when(F.col("event_id").isNull(), MISSING_ID)
        .when(F.col("event_type").isNull(), MISSING_TYPE)
        .when(F.col("event_ts").isNull(), BAD_TS)
    )


def valid_rows(typed_rows: DataFrame) -> DataFrame:
    """Rows without a ``reject_reason``, however far their day is from the date of their file."""
    return typed_rows.dropna(subset=["event_id", "event_type", "event_ts"])


def to_silver(bronze: DataFrame) -> DataFrame:
    """Valid, typed and de-duplicated rows in the silver column order."""
    return one_per_id(valid_rows(typed(bronze))).select(*SILVER_COLUMNS)


def quarantined(bronze: DataFrame) -> DataFrame:
    """The complement of ``valid_rows``, one reason per row."""
    rows = typed(bronze).withColumn("reason", reject_reason())
    return rows.where(F.col("reason").isNotNull()).select(*QUARANTINE_SCHEMA.fieldNames())


def accounting(bronze: DataFrame) -> DataFrame:
    """Where every bronze row of each file date went; the parts add up to ``bronze_rows``.

    Ids are counted exactly with partial aggregation, so copies of one id collapse before the shuffle.
    """
    rows = typed(bronze).select("event_id", reject_reason().alias("reason"))
    per_id = (
        rows.groupBy("reason", F.when(F.col("reason").isNull(), F.col("event_id")).alias("event_id"))
        .agg(F.count("*").alias("copies"))
    )
    kept = F.col("reason").isNull()
    return per_id.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("bronze_rows"),
        F.count_if(kept).alias("silver_rows"),
        F.coalesce(F.sum(F.when(kept, F.col("copies") - 1)), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum(F.when(~kept, F.col("copies"))), F.lit(0)).alias("quarantined_rows"),
    )
