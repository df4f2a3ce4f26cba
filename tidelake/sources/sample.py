"""Presents a generic ``events`` table as archive events.

Input columns: ``event_id long, ts, user_id long, event_type string, value double, props string``.
The mapping plants the conditions the lake must handle: missing ids, types and times, repeated
events, ids with copies on two days, bots in mixed case, unknown logins, organisations and repositories, rows that arrive in a
neighbouring day's file, and lines that are not events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.schemas import BRONZE_COLUMNS

EARLY_INGEST = "2024-01-31T18:00:00+00:00"
FIRST_INGEST = "2024-02-01T00:00:00+00:00"
SECOND_INGEST = "2024-02-01T06:00:00+00:00"


def events_table(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def _type() -> Column:
    n = F.col("src_id")
    return (
        F.when(n % 499 == 1, F.lit(None))
        .when(F.col("kind") == "click", "PushEvent")
        .when(F.col("kind") == "purchase", "PullRequestEvent")
        .when(F.col("kind") == "view", "WatchEvent")
        .when(F.col("kind") == "signup", "ForkEvent")
        .when(n % 4 == 0, "IssuesEvent")
        .when(n % 4 == 1, "ReleaseEvent")
        .when(n % 4 == 2, "CreateEvent")
        .otherwise("DeleteEvent")
    )


def _file_ts() -> Column:
    """Time the carrying file is named after: some rows sit in a neighbouring day's file."""
    n, ts = F.col("src_id"), F.col("ts")
    day = F.expr("INTERVAL 1 DAY")
    return F.when(n % 211 == 5, ts - day).when(n % 211 == 6, ts + day).otherwise(ts)


def _columns(copies: DataFrame) -> DataFrame:
    n, user, copy = F.col("src_id"), F.col("user_id"), F.col("copy")
    org = F.concat(F.lit("org_"), (user % 7).cast("string"))
    login = F.concat(F.lit("user_"), user.cast("string"))
    named = copies.select(
        "*",
        _type().alias("event_type"),
        F.when(user % 17 == 0, F.lit(None))
        .when(user % 10 == 1, F.concat(login, F.lit("[Bot]")))
        .otherwise(login)
        .alias("actor_login"),
        F.when(user % 3 != 0, org).alias("org_login"),
        F.when(n % 101 != 0, F.concat(org, F.lit("/repo_"), (n % 23).cast("string"))).alias("repo_name"),
        _file_ts().alias("file_ts"),
    )
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    action = F.when(F.col("event_type") == "WatchEvent", "started").when(
        F.col("event_type") == "PullRequestEvent", "opened"
    )
    return named.select(
        "src_id",
        "copy",
        F.when(n % 997 != 0, n.cast("string")).alias("event_id"),
        "event_type",
        F.when(n % 998 == 2, "not a time")
        .when(n % 998 == 501, F.lit(None))
        .otherwise(F.date_format("ts", iso))
        .alias("created_at"),
        F.when(n % 101 != 0, n % 23).alias("repo_id"),
        "repo_name",
        F.when(n % 101 != 0, org).alias("repo_owner"),
        F.when(user % 3 != 0, user % 7).alias("org_id"),
        "org_login",
        user.alias("actor_id"),
        "actor_login",
        F.lit("User").alias("actor_type"),
        (F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint") + 1000 * copy).alias("payload_size"),
        F.lit(None).cast("bigint").alias("payload_distinct_size"),
        F.when(F.col("event_type") == "CreateEvent", F.concat(F.lit("branch_"), (n % 5).cast("string"))).alias(
            "payload_ref"
        ),
        action.alias("payload_action"),
        F.when(F.col("event_type") == "PullRequestEvent", login).alias("pr_user_login"),
        F.when(F.col("event_type") == "WatchEvent", action).alias("watch_action"),
        F.when(n % 5 == 0, "Python").when(n % 5 == 1, "Go").when(n % 5 == 2, "Rust").when(n % 5 == 3, "Java").alias(
            "repo_language"
        ),
        F.lit(None).cast("string").alias("repo_created_at"),
        F.when(copy == 0, FIRST_INGEST).when(n % 700 == 0, EARLY_INGEST).otherwise(SECOND_INGEST).alias("ingest_ts"),
        F.concat(
            F.date_format("file_ts", "yyyy-MM-dd"), F.lit("-"), F.hour("file_ts").cast("string"), F.lit(".json.gz")
        ).alias("source_file"),
        F.to_date("file_ts").alias("date"),
        F.hour("file_ts").cast("string").alias("hour"),
    )


def _copies(events: DataFrame) -> DataFrame:
    """Every fiftieth event appears twice; every seventh of the second copies names the day after."""
    times = F.when(F.col("event_id") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    copies = events.select(
        F.col("event_id").alias("src_id"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        "user_id",
        F.col("event_type").alias("kind"),
        "props",
        F.explode(times).alias("copy"),
    )
    other_day = (F.col("copy") == 1) & (F.col("src_id") % 350 == 0)
    return copies.withColumn("ts", F.when(other_day, F.col("ts") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("ts")))


def bronze_rows(events: DataFrame) -> DataFrame:
    """Bronze columns plus the partition columns ``date`` and ``hour``."""
    return _columns(_copies(events)).select(*BRONZE_COLUMNS, "date", "hour")


def raw_lines(events: DataFrame) -> DataFrame:
    """The same events as JSON lines in the shape a raw file scan delivers.

    Numbers appear as whole numbers, text and fractions; some payloads are not objects; some
    lines are cut off, empty, or hold an array.
    """
    n = F.col("src_id")
    # A struct may repeat a field name; NULL fields are left out, so each line shows one form.
    repo = F.struct(
        F.when(n % 4 == 0, F.col("repo_id")).alias("id"),
        F.when(n % 4 == 1, F.col("repo_id").cast("string")).alias("id"),
        F.when(n % 4 == 2, F.col("repo_id") + F.lit(0.75)).alias("id"),
        F.when(n % 4 == 3, F.concat(F.col("repo_id").cast("string"), F.lit(".5"))).alias("id"),
        F.when(n % 29 == 0, F.concat(F.lit("/"), F.col("repo_name")))
        .when(n % 29 == 1, "noslash")
        .otherwise(F.col("repo_name"))
        .alias("name"),
        F.when(n % 58 < 29, "fallback").alias("owner"),
        F.col("repo_language").alias("language"),
    )
    author = F.struct(F.struct(F.col("pr_user_login").alias("login")).alias("user"))
    payload = F.struct(
        F.col("payload_size").alias("size"),
        F.col("payload_ref").alias("ref"),
        F.col("payload_action").alias("action"),
        F.when(F.col("pr_user_login").isNotNull(), author).alias("pull_request"),
    )
    org = F.struct(F.col("org_id").alias("id"), F.col("org_login").alias("login"))
    actor = F.struct(
        F.col("actor_id").alias("id"), F.col("actor_login").alias("login"), F.col("actor_type").alias("type")
    )
    line = F.to_json(
        F.struct(
            F.col("event_id").alias("id"),
            F.col("event_type").alias("type"),
            "created_at",
            actor.alias("actor"),
            repo.alias("repo"),
            F.when(F.col("org_login").isNotNull(), org).alias("org"),
            F.when(n % 13 != 0, payload).alias("payload"),
            F.when(n % 13 == 0, F.array(F.lit(1))).alias("payload"),
        )
    )
    text = F.col("line")
    value = (
        F.when(n % 331 == 3, F.left(text, F.length(text) - 5))
        .when(n % 331 == 4, F.concat(text, F.lit(" {}")))
        .when(n % 331 == 5, F.lit(""))
        .when(n % 331 == 6, F.concat(F.lit("["), text, F.lit("]")))
        .otherwise(text)
    )
    return _columns(_copies(events)).select("src_id", "copy", "source_file", line.alias("line")).select(
        value.alias("value"),
        F.concat(F.lit("raw/"), F.col("source_file")).alias("source_path"),
        "source_file",
        F.lit(0).cast("bigint").alias("block_start"),
        (n * 2 + F.col("copy")).alias("line_pos"),
    )
