"""Every query the lake answers, as ``name -> callable(spark, folder)`` over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake import functions as X
from tidelake.operators import conform, counts, dedup, flatten, metrics, quality
from tidelake.plans import checks, dashboard
from tidelake.schemas import BRONZE_COLUMNS, ENTITIES, SILVER_COLUMNS
from tidelake.session import configure, scratch_dir, written_out
from tidelake.sources import ledger, raw, sample
from tidelake.sources.lake import Lake, overwrite_partitions, read_bronze, read_ledger
from tidelake.streaming import live

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.datetime(2024, 1, 30, 12, 0, 0)
INGEST_AT = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(configure(spark), folder)

        QUERIES[name] = run
        return fn

    return register


def events(spark: SparkSession, folder: str) -> DataFrame:
    return sample.events_table(spark, folder)


def bronze(spark: SparkSession, folder: str) -> DataFrame:
    return sample.bronze_rows(events(spark, folder))


def silver(spark: SparkSession, folder: str) -> DataFrame:
    return conform.to_silver(bronze(spark, folder))


def gold(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return counts.gold_tables(silver(spark, folder))


def flat_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Flattened lines behind a written table, as the ingest keeps them."""
    flat = flatten.flatten_lines(sample.raw_lines(events(spark, folder)), INGEST_AT)
    return written_out(flat, "flat_lines")


def naive_hours(df: DataFrame) -> DataFrame:
    """Hand hours and times out without a zone."""
    casts = {c: X.naive_utc(F.col(c)) for c, t in df.dtypes if t == "timestamp"}
    return df.withColumns(casts) if casts else df


# ---- raw and bronze -------------------------------------------------------------------------


@query("file_hour_parse")
def _(spark, folder):
    names = bronze(spark, folder).select("source_file")
    return names.groupBy("source_file").agg(F.count("*").alias("row_count")).select(
        "source_file",
        X.file_date(F.col("source_file")).alias("file_date"),
        X.file_hour(F.col("source_file")).alias("file_hour"),
        "row_count",
    )


@query("json_path_get")
def _(spark, folder):
    doc = F.try_parse_json("props")
    return events(spark, folder).select(
        "event_id",
        X.json_string(doc, "$.k").alias("k_text"),
        X.json_long(doc, "$.k").alias("k"),
        X.json_string(doc, "$.k.deeper").alias("below_leaf"),
        X.json_string(doc, "$.absent").alias("absent"),
    )


@query("to_int_rules")
def _(spark, folder):
    """Lenient whole numbers over values spelled as JSON number, fraction, text and boolean."""
    v = F.col("value").cast("string")
    doc = F.try_parse_json(
        F.concat(
            F.lit('{"number":'), v, F.lit(',"negative":-'), v, F.lit(',"text":"'), v,
            F.lit('","padded":" '), F.col("event_id").cast("string"), F.lit(' ","flag":true,"none":null,"list":[1]}'),
        )
    )
    names = ("number", "negative", "text", "padded", "flag", "none", "list", "absent")
    return events(spark, folder).select("event_id", *[X.json_long(doc, f"$.{n}").alias(f"{n}_value") for n in names])


@query("repo_owner")
def _(spark, folder):
    n = F.col("event_id")
    name = F.when(n % 4 == 0, "noslash").when(n % 4 == 1, F.concat(F.lit("/r"), n.cast("string"))).when(
        n % 4 == 2, F.concat(F.lit("own"), (n % 7).cast("string"), F.lit("/a/b"))
    )
    fallback = F.when(n % 3 == 0, "fallback")
    return events(spark, folder).select("event_id", X.repo_owner(name, fallback).alias("repo_owner"))


@query("watch_action")
def _(spark, folder):
    rows = bronze(spark, folder).select(
        "event_type", X.watch_action(F.col("event_type"), F.col("payload_action")).alias("watch_action")
    )
    return rows.groupBy("event_type", "watch_action").agg(F.count("*").alias("row_count"))


@query("bronze_from_json")
def _(spark, folder):
    kept = dedup.first_per_file(flat_lines(spark, folder))
    return flatten.good_lines(kept).select(*BRONZE_COLUMNS, "date", "hour")


@query("bronze_bad_lines")
def _(spark, folder):
    rejected = flatten.bad_lines(flat_lines(spark, folder))
    return rejected.select("source_file", "date", "hour", "reason", (F.col("line") == "").alias("is_blank"))


@query("bronze_dedup")
def _(spark, folder):
    kept = dedup.first_per_file(flat_lines(spark, folder))
    return flatten.good_lines(kept).select("source_file", "event_id", "payload_size")


@query("bronze_stats")
def _(spark, folder):
    flat = flat_lines(spark, folder)
    return flatten.file_stats(flat, flatten.good_lines(dedup.first_per_file(flat)))


# ---- expected and missing hours -------------------------------------------------------------


def _bounds(spark, folder):
    span = events(spark, folder).agg(
        F.date_trunc("hour", F.min(F.col("ts").cast("timestamp"))).alias("start_from"),
        F.date_trunc("hour", F.max(F.col("ts").cast("timestamp"))).alias("latest_complete"),
    )
    return span


@query("expected_hours")
def _(spark, folder):
    last_day = _bounds(spark, folder).withColumn("start_from", F.lit(None).cast("timestamp"))
    return naive_hours(ledger.hour_spine(last_day, hours_back=24))


@query("missing_hours")
def _(spark, folder):
    """Hours of the whole span a ledger lacks that knows only the hours with a purchase."""
    bought = events(spark, folder).where("event_type = 'purchase'")
    done = bought.select(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour_ts"))
    return naive_hours(ledger.missing_hours(ledger.hour_spine(_bounds(spark, folder)), done))


# Hours with a planted fault, by their number since the epoch modulo 37.
LOST, UNRECORDED, MISCOUNTED, NOT_LANDED, FILE_GONE = 3, 5, 7, 9, 11
NO_COLUMN, WRONG_TYPE = 3, 5


def _hour_number() -> F.Column:
    return F.pmod(F.floor(F.unix_timestamp(raw.hour_start()) / 3600), F.lit(37))


@query("dq_hour_completeness")
def _(spark, folder):
    """A stored lake in which some hours lost their files, ledger entries or rows."""
    lake = Lake(scratch_dir(spark, "dq_hour_completeness"))
    rows, fault = bronze(spark, folder), _hour_number()
    overwrite_partitions(rows.where(~fault.isin(LOST, NOT_LANDED)), lake.bronze, ["date", "hour"])
    hours = rows.groupBy("date", "hour").agg(F.count("*").alias("rows")).withColumn("hour_ts", raw.hour_start())
    counted = F.col("rows") + F.when(fault == MISCOUNTED, 1).otherwise(0)
    zero = F.lit(0).cast("bigint")
    entries = hours.where(~fault.isin(UNRECORDED, NOT_LANDED)).select(
        "hour_ts", "hour", counted.alias("rows"), zero.alias("duplicates"), zero.alias("bad"), F.lit(INGEST_AT.isoformat()).cast("timestamp").alias("ingested_at"), "date"
    )
    entries.write.partitionBy("date").parquet(lake.ledger)
    stored = flatten.stored_hours(read_bronze(spark, lake)).withColumn("hour_ts", raw.hour_start())
    return naive_hours(ledger.hour_completeness(hours.where(fault != FILE_GONE), read_ledger(spark, lake), stored))


@query("dq_bronze_columns")
def _(spark, folder):
    """A stored lake with hours that lack a column or hold it as another type."""
    lake = Lake(scratch_dir(spark, "dq_bronze_columns"))
    rows, fault = bronze(spark, folder), _hour_number()
    parts = (
        rows.where(fault == NO_COLUMN).drop("repo_id"),
        rows.where(fault == WRONG_TYPE).withColumn("actor_id", F.col("actor_id").cast("string")),
        rows.where(~fault.isin(NO_COLUMN, WRONG_TYPE)),
    )
    for part in parts:
        part.hint("rebalance", F.col("date"), F.col("hour")).write.mode("append").partitionBy("date", "hour").parquet(lake.bronze)
    return checks.bronze_columns(spark, lake)


# ---- silver ---------------------------------------------------------------------------------


@query("parse_created_at")
def _(spark, folder):
    return bronze(spark, folder).select(
        "event_id", "created_at", X.naive_utc(X.parse_ts(F.col("created_at"))).alias("event_ts")
    )


@query("bot_flag")
def _(spark, folder):
    rows = bronze(spark, folder).select("actor_login", X.is_bot(F.col("actor_login")).alias("is_bot"))
    return rows.groupBy("actor_login", "is_bot").agg(F.count("*").alias("row_count"))


@query("silver_events")
def _(spark, folder):
    return naive_hours(silver(spark, folder).select(*SILVER_COLUMNS))


@query("quarantine_rows")
def _(spark, folder):
    return conform.quarantined(bronze(spark, folder)).select(
        "event_id", "event_type", "created_at", "source_file", "ingest_ts", "event_day", "reason"
    )


@query("quarantine_accounting")
def _(spark, folder):
    return conform.accounting(bronze(spark, folder))


# ---- gold -----------------------------------------------------------------------------------


def _gold_query(table: str) -> None:
    @query(f"gold_{table}")
    def _(spark, folder):
        return naive_hours(gold(spark, folder)[table])


for _entity in ENTITIES.values():
    _gold_query(_entity.daily)
    _gold_query(_entity.hourly)


@query("gold_hourly_cube")
def _(spark, folder):
    return naive_hours(counts.hourly_cube(silver(spark, folder)))


@query("gold_daily_from_hourly")
def _(spark, folder):
    e = ENTITIES["push_user"]
    return counts.daily_from_hourly(counts.hourly_counts(silver(spark, folder), e), e)


@query("gold_union_by_name")
def _(spark, folder):
    tables = gold(spark, folder)
    orgs = tables["pr_org_daily"].select("event_day", "org_login", "pr_count")
    repos = tables["pr_repo_daily"].select("pr_count", "repo_name", "event_day")
    return orgs.unionByName(repos, allowMissingColumns=True)


@query("view_event_type_daily")
def _(spark, folder):
    return counts.resummed(gold(spark, folder)["event_type_daily"], ENTITIES["event_type"])


def _view_query(name: str, entity: str) -> None:
    @query(name)
    def _(spark, folder):
        return dashboard.trailing_totals(gold(spark, folder), ENTITIES[entity], 30, AS_OF.date())


_view_query("view_top_push_users_30d", "push_user")
_view_query("view_top_pr_orgs_30d", "pr_org")
_view_query("view_top_pr_repos_30d", "pr_repo")


# ---- dashboard ------------------------------------------------------------------------------


@query("latest_hour")
def _(spark, folder):
    return dashboard.latest_hour(gold(spark, folder))


@query("preset_ranges")
def _(spark, folder):
    return dashboard.preset_ranges(gold(spark, folder), AS_OF)


DASHBOARD = {
    "summary": dashboard.summary,
    "event_types": dashboard.event_types,
    "event_type_series": dashboard.event_type_series,
    "top_push_users": dashboard.top_push_users,
    "top_pr_orgs": dashboard.top_pr_orgs,
    "top_pr_repos": dashboard.top_pr_repos,
}


def _dashboard_query(name: str, preset: str) -> None:
    @query(f"{name}_{preset}")
    def _(spark, folder):
        return DASHBOARD[name](gold(spark, folder), preset, as_of=AS_OF)


for _name in DASHBOARD:
    for _preset in dashboard.PRESETS:
        _dashboard_query(_name, _preset)


# ---- quality --------------------------------------------------------------------------------


def _silver_check_query(name: str, *checks: str) -> None:
    @query(name)
    def _(spark, folder):
        return quality.silver_report(silver(spark, folder), *checks)


_silver_check_query("dq_silver_event_count", "silver_event_count")
_silver_check_query("dq_null_event_type", "null_event_type")
_silver_check_query("dq_duplicate_event_ids", "duplicate_event_ids")
_silver_check_query("dq_silver_report")


@query("dq_bronze_nulls")
def _(spark, folder):
    return quality.null_counts(bronze(spark, folder), ["event_id", "event_type", "created_at", "actor_login"])


@query("dq_bronze_duplicate_ids")
def _(spark, folder):
    """The id check on rows that still hold duplicates and NULL ids (which inflate it)."""
    rows = bronze(spark, folder).withColumnRenamed("date", "event_day")
    ids = rows.groupBy("event_day").agg(
        (F.count("*") - F.count_distinct("event_id")).alias("duplicate_event_ids")
    )
    return quality.long_form(ids, ["event_day"], ["duplicate_event_ids"])


@query("dq_gold_reconciliation")
def _(spark, folder):
    rows = silver(spark, folder)
    return quality.reconciliation(rows, counts.daily_counts(rows, ENTITIES["event_type"]))


@query("dq_gold_reconciliation_by_day")
def _(spark, folder):
    rows = silver(spark, folder)
    return quality.reconciliation_by_day(rows, counts.daily_counts(rows, ENTITIES["event_type"]))


@query("dq_day_mismatch")
def _(spark, folder):
    return quality.day_mismatch(conform.typed(bronze(spark, folder)))


@query("dq_gold_nonempty")
def _(spark, folder):
    return quality.row_counts(gold(spark, folder))


@query("dq_nonnegative")
def _(spark, folder):
    return quality.negative_counts(gold(spark, folder))


@query("dq_freshness")
def _(spark, folder):
    return quality.freshness(gold(spark, folder)["event_type_hourly"], AS_OF)


@query("dq_layer_lag")
def _(spark, folder):
    rows, tables = bronze(spark, folder), gold(spark, folder)
    file_hour = F.col("date").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("hour").cast("int"))
    return quality.layer_lag(
        {
            "bronze": (rows, file_hour),
            "silver": (silver(spark, folder), F.col("event_hour_ts")),
            "gold": (tables["event_type_hourly"], F.col("event_hour_ts")),
        }
    )


# ---- extended metrics -----------------------------------------------------------------------


def _silver_metric(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    @query(name)
    def _(spark, folder):
        return fn(silver(spark, folder))


_silver_metric("repo_daily_activity", metrics.repo_daily_activity)
_silver_metric("org_daily_activity", metrics.org_daily_activity)
_silver_metric("actor_daily_activity", metrics.actor_daily_activity)
_silver_metric("language_daily_activity", metrics.language_daily_activity)

REPO_METRICS = {
    "repo_watch_daily": "WatchEvent",
    "repo_fork_daily": "ForkEvent",
    "repo_issue_daily": "IssuesEvent",
    "repo_release_daily": "ReleaseEvent",
    "repo_create_daily": "CreateEvent",
    "repo_delete_daily": "DeleteEvent",
}
for _name, _type in REPO_METRICS.items():
    _silver_metric(_name, lambda rows, t=_type: metrics.repo_activity(rows, t))


@query("rolling_7d")
def _(spark, folder):
    return metrics.rolling(gold(spark, folder)["event_type_daily"], "event_type", "event_count", 7)


@query("rolling_30d")
def _(spark, folder):
    return metrics.rolling(gold(spark, folder)["event_type_daily"], "event_type", "event_count", 30)


@query("dod_change")
def _(spark, folder):
    return metrics.day_over_day(gold(spark, folder)["event_type_daily"], "event_type", "event_count")


@query("hoh_change")
def _(spark, folder):
    return naive_hours(
        metrics.hour_over_hour(gold(spark, folder)["event_type_hourly"], "event_type", "event_count")
    )


@query("repo_dod_change")
def _(spark, folder):
    rows = silver(spark, folder).where("repo_name IS NOT NULL")
    return metrics.day_over_day_runs(rows.groupBy("event_day", "repo_name").agg(F.count("*").alias("event_count")), "repo_name", "event_count")


@query("repo_hoh_change")
def _(spark, folder):
    rows = silver(spark, folder).where("repo_name IS NOT NULL")
    counts = rows.groupBy("event_hour_ts", "repo_name").agg(F.count("*").alias("event_count"))
    return naive_hours(metrics.hour_over_hour_runs(counts, "repo_name", "event_count"))


@query("push_pr_ratio")
def _(spark, folder):
    return metrics.push_pr_ratio(gold(spark, folder)["event_type_daily"])


# ---- streaming ------------------------------------------------------------------------------


OUT_OF_ORDER_FILES = 4


def live_events(spark, folder, work):
    """The events table as a stream of typed rows, in several batches that each span all of its time."""
    table = events(spark, folder)
    table.repartition(OUT_OF_ORDER_FILES).write.parquet(f"{work}/in")
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/in")
    rows = conform.valid_rows(conform.typed(sample.bronze_rows(stream)))
    return rows.select("event_id", "event_type", "event_ts", "ingest_ts")


def _landed(spark, folder, label):
    work = scratch_dir(spark, label)
    live.take_available(live_events(spark, folder, work), f"{work}/live", f"{work}/checkpoint")
    return f"{work}/live"


@query("stream_dedup")
def _(spark, folder):
    return naive_hours(live.events(spark, _landed(spark, folder, "stream_dedup")))


@query("stream_event_type_hourly")
def _(spark, folder):
    return naive_hours(live.hourly_type_counts(spark, _landed(spark, folder, "stream_event_type_hourly")))
