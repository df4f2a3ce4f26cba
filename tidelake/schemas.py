"""Fixed column layouts of the three layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_S, _L = T.StringType(), T.LongType()

# The bronze column order is part of the stored format.
BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("event_id", _S),
        T.StructField("event_type", _S),
        T.StructField("created_at", _S),
        T.StructField("repo_id", _L),
        T.StructField("repo_name", _S),
        T.StructField("repo_owner", _S),
        T.StructField("org_id", _L),
        T.StructField("org_login", _S),
        T.StructField("actor_id", _L),
        T.StructField("actor_login", _S),
        T.StructField("actor_type", _S),
        T.StructField("payload_size", _L),
        T.StructField("payload_distinct_size", _L),
        T.StructField("payload_ref", _S),
        T.StructField("payload_action", _S),
        T.StructField("pr_user_login", _S),
        T.StructField("watch_action", _S),
        T.StructField("repo_language", _S),
        T.StructField("repo_created_at", _S),
        T.StructField("ingest_ts", _S),
        T.StructField("source_file", _S),
    ]
)
BRONZE_COLUMNS = BRONZE_SCHEMA.fieldNames()

# The hour is stored as it is spelled in the file name: text, without zero padding.
BRONZE_PARTITIONS = T.StructType([T.StructField("date", T.DateType()), T.StructField("hour", _S)])
BRONZE_TABLE_SCHEMA = T.StructType(BRONZE_SCHEMA.fields + BRONZE_PARTITIONS.fields)

SILVER_SCHEMA = T.StructType(
    BRONZE_SCHEMA.fields
    + [
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("event_hour_ts", T.TimestampType()),
        T.StructField("is_bot", T.BooleanType()),
        T.StructField("event_day", T.DateType()),
    ]
)
SILVER_COLUMNS = SILVER_SCHEMA.fieldNames()

QUARANTINE_SCHEMA = T.StructType(
    BRONZE_TABLE_SCHEMA.fields + [T.StructField("event_day", T.DateType()), T.StructField("reason", _S)]
)

BAD_LINE_SCHEMA = T.StructType(
    BRONZE_PARTITIONS.fields
    + [T.StructField("reason", _S), T.StructField("line", _S), T.StructField("source_file", _S)]
)

POINTER_SCHEMA = T.StructType([T.StructField("snapshot", _S), T.StructField("published_at", T.TimestampType())])

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("hour_ts", T.TimestampType()),
        T.StructField("hour", _S),
        T.StructField("rows", _L),
        T.StructField("duplicates", _L),
        T.StructField("bad", _L),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("date", T.DateType()),
    ]
)


@dataclass(frozen=True)
class Entity:
    """One counted thing: gold keeps an hourly and a daily table per entity."""

    name: str
    key: str
    metric: str
    event_type: str | None = None
    humans_only: bool = False

    @property
    def daily(self) -> str:
        return f"{self.name}_daily"

    @property
    def hourly(self) -> str:
        return f"{self.name}_hourly"

    def schema(self, table: str) -> T.StructType:
        hour = [T.StructField("event_hour_ts", T.TimestampType())] if table == self.hourly else []
        return T.StructType(
            hour + [T.StructField(self.key, _S), T.StructField(self.metric, _L), T.StructField("event_day", T.DateType())]
        )


ENTITIES = {
    e.name: e
    for e in (
        Entity("event_type", "event_type", "event_count"),
        Entity("push_user", "actor_login", "push_count", "PushEvent", humans_only=True),
        Entity("pr_org", "org_login", "pr_count", "PullRequestEvent"),
        Entity("pr_repo", "repo_name", "pr_count", "PullRequestEvent"),
    )
}
GOLD_TABLES = {table: e for e in ENTITIES.values() for table in (e.daily, e.hourly)}

DAY_PAIRS_SCHEMA = T.StructType([T.StructField("event_day", T.DateType()), T.StructField("rows", _L), T.StructField("date", T.DateType())])
