"""SQL tables and views over the lake's folders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from tidelake.schemas import BRONZE_TABLE_SCHEMA, ENTITIES, GOLD_TABLES, SILVER_SCHEMA
from tidelake.sources.lake import Lake

DATABASE = "tidelake"


def table_layout(lake: Lake) -> dict[str, tuple[StructType, list[str], str]]:
    """Table name -> (schema, partition columns, folder)."""
    layout = {
        "bronze_events": (BRONZE_TABLE_SCHEMA, ["date", "hour"], lake.bronze),
        "silver_events": (SILVER_SCHEMA, ["event_day"], lake.silver),
    }
    for table, entity in GOLD_TABLES.items():
        layout[f"gold_{table}"] = (entity.schema(table), ["event_day"], lake.gold(table))
    return layout


def create_tables(spark: SparkSession, lake: Lake, database: str = DATABASE) -> list[str]:
    """External tables over the folders. They hold no rows until ``repair_tables`` ran."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, (schema, partitions, folder) in table_layout(lake).items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        keys = ", ".join(f"`{p}`" for p in partitions)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING PARQUET "
            f"PARTITIONED BY ({keys}) LOCATION '{folder}'"
        )
    return list(table_layout(lake))


def repair_tables(spark: SparkSession, lake: Lake, database: str = DATABASE) -> None:
    """Pick up partitions that were written since the last call."""
    for name in table_layout(lake):
        spark.sql(f"MSCK REPAIR TABLE {database}.{name}")


def create_views(spark: SparkSession, database: str = DATABASE, as_of: dt.date | None = None) -> None:
    """The reporting views; trailing ones count from ``as_of`` or from the day they are read."""
    today = f"DATE '{as_of}'" if as_of else "current_date()"
    spark.sql(
        f"CREATE OR REPLACE VIEW {database}.v_event_type_daily AS "
        f"SELECT event_day, event_type, sum(event_count) AS event_count "
        f"FROM {database}.gold_event_type_daily GROUP BY event_day, event_type"
    )
    for view, name in (("push_users", "push_user"), ("pr_orgs", "pr_org"), ("pr_repos", "pr_repo")):
        e = ENTITIES[name]
        spark.sql(
            f"CREATE OR REPLACE VIEW {database}.v_top_{view}_30d AS "
            f"SELECT {e.key}, sum({e.metric}) AS {e.metric} FROM {database}.gold_{e.daily} "
            f"WHERE event_day >= {today} - INTERVAL '30' DAY "
            f"GROUP BY {e.key} ORDER BY {e.metric} DESC, {e.key}"
        )
