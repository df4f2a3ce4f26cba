"""Data-quality checks. Every check returns rows; nothing here raises except the publish gate."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelake.functions import naive_utc, or_zero
from tidelake.schemas import ENTITIES, GOLD_TABLES


class EmptyGoldTable(RuntimeError):
    pass


def _nulls(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def _silver_checks() -> dict[str, Column]:
    """Checks of one silver day. They are columns of one aggregate, so a report is one scan."""
    return {
        "silver_event_count": F.count("*"),
        "null_event_id": _nulls("event_id"),
        "null_event_type": _nulls("event_type"),
        "null_event_ts": _nulls("event_ts"),
        "duplicate_event_ids": F.count("*") - F.count_distinct("event_id"),
        "day_mismatch": F.count_if(F.to_date("event_ts") != F.col("event_day")),
    }


def long_form(wide: DataFrame, keys: list[str], checks: Iterable[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("check_name"), F.col(c).cast("bigint").alias("value")) for c in checks])
    return wide.select(*keys, F.explode(pairs).alias("check")).select(*keys, "check.check_name", "check.value")


def silver_report(silver: DataFrame, *names: str, day: dt.date | None = None) -> DataFrame:
    """``event_day, check_name, value`` for the named checks (all by default), per day.

    A given ``day`` yields its rows even when silver holds nothing for it.
    """
    checks = _silver_checks()
    chosen = {n: checks[n] for n in (names or checks)}
    columns = [c.alias(n) for n, c in chosen.items()]
    if day is None:
        return long_form(silver.groupBy("event_day").agg(*columns), ["event_day"], chosen)
    wide = silver.where(F.col("event_day") == F.lit(day)).agg(*columns)
    return long_form(wide.withColumn("event_day", F.lit(day)), ["event_day"], chosen)


def null_counts(rows: DataFrame, columns: Iterable[str]) -> DataFrame:
    names = list(columns)
    return long_form(rows.agg(*[_nulls(c).alias(c) for c in names]), [], names)


def reconciliation(silver: DataFrame, daily_types: DataFrame, day: dt.date | None = None) -> DataFrame:
    """Silver rows minus gold total, one row; NULL when gold is empty, as a sum over nothing is."""
    if day is not None:
        silver, daily_types = (d.where(F.col("event_day") == F.lit(day)) for d in (silver, daily_types))
    gold_total = daily_types.agg(F.sum("event_count")).scalar()
    return silver.agg(F.count("*").alias("total_events")).select(
        F.lit("gold_event_type_reconciliation").alias("check_name"),
        (F.col("total_events") - gold_total).alias("value"),
    )


def reconciliation_by_day(silver: DataFrame, daily_types: DataFrame) -> DataFrame:
    """Days either side knows about; both sides are already one row per day when they meet."""
    in_silver = silver.groupBy("event_day").agg(F.count("*").alias("silver_events"))
    in_gold = daily_types.groupBy("event_day").agg(F.sum("event_count").alias("gold_events"))
    both = in_silver.join(in_gold, "event_day", "full_outer")
    return both.select(
        "event_day",
        or_zero(F.col("silver_events")).alias("silver_events"),
        or_zero(F.col("gold_events")).alias("gold_events"),
    ).withColumn("value", F.col("silver_events") - F.col("gold_events"))


def day_mismatch(bronze_typed: DataFrame) -> DataFrame:
    """Rows per file date whose event day differs from that date."""
    return bronze_typed.groupBy("date").agg(
        F.count("*").alias("row_count"), F.count_if(F.col("event_day") != F.col("date")).alias("mismatched")
    )


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_counts(gold: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        gold[t].agg(F.count("*").alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
        for t in GOLD_TABLES
    ).withColumn("passed", F.col("row_count") > 0)


def require_non_empty(gold: Mapping[str, DataFrame]) -> None:
    """Publish gate: raises and names the gold tables without rows."""
    empty = [r["table_name"] for r in row_counts(gold).where(~F.col("passed")).collect()]
    if empty:
        raise EmptyGoldTable("nothing to publish in " + ", ".join(sorted(empty)))


def negative_counts(gold: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        gold[t].agg(F.count_if(F.col(e.metric) < 0).alias("negative_rows")).select(
            F.lit(t).alias("table_name"), "negative_rows"
        )
        for t, e in GOLD_TABLES.items()
    )


def freshness(
    hourly_types: DataFrame, as_of: dt.datetime, sla: dt.timedelta = dt.timedelta(hours=2)
) -> DataFrame:
    """Age of the newest completed hour at ``as_of`` against the allowed age."""
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp")
    age = F.unix_timestamp(now) - (F.unix_timestamp("latest") + 3600)
    return hourly_types.agg(F.max("event_hour_ts").alias("latest")).select(
        F.lit("freshness").alias("check_name"),
        naive_utc(F.col("latest")).alias("latest_hour"),
        age.alias("lag_seconds"),
        F.coalesce(age <= int(sla.total_seconds()), F.lit(False)).alias("within_sla"),
    )


def layer_lag(layers: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Newest hour present per layer; each layer names the column or expression holding its hour."""
    return _union(
        df.agg(naive_utc(F.max(hour)).alias("latest_hour")).select(F.lit(name).alias("layer"), "latest_hour")
        for name, (df, hour) in layers.items()
    )


def missing_columns(df: DataFrame, required: StructType) -> list[str]:
    """Required columns that are absent or carry another type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return [f.name for f in required.fields if have.get(f.name) != f.dataType]


#: Names of stored types, by Spark's.
STORED_TYPES = {"string": "string", "bigint": "int64"}


def column_problems(stored: DataFrame, required: StructType) -> DataFrame:
    """``date, hour, column, problem`` from rows (date, hour, path, column, type) of all files.

    Every file is held against the required columns; files of an hour with the same fault are one row.
    """
    wanted = F.array(*[F.struct(F.lit(f.name).alias("column"), F.lit(STORED_TYPES[f.dataType.simpleString()]).alias("wanted")) for f in required.fields])
    have = stored.groupBy("date", "hour", "path").agg(F.map_from_entries(F.collect_list(F.struct("column", "type"))).alias("have"))
    each = have.select("date", "hour", "have", F.explode(wanted).alias("w")).select("date", "hour", "w.*", F.col("have")[F.col("w.column")].alias("type"))
    problem = F.when(F.col("type").isNull(), "missing").when(F.col("type") != F.col("wanted"), F.concat(F.col("type"), F.lit(" instead of "), F.col("wanted")))
    return each.select("date", "hour", "column", problem.alias("problem")).where("problem IS NOT NULL").distinct()


def totals_agree(daily: DataFrame, hourly: DataFrame, entity_name: str) -> DataFrame:
    """Days on which a daily table differs from the sum of its hourly table; empty when all agree."""
    e = ENTITIES[entity_name]
    from_hours = hourly.groupBy("event_day", e.key).agg(F.sum(e.metric).alias("hourly_total"))
    joined = daily.join(from_hours, ["event_day", e.key], "full_outer")
    return joined.where(~F.col(e.metric).eqNullSafe(F.col("hourly_total")))
