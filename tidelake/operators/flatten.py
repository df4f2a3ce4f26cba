"""Raw JSON lines to bronze columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions import file_date, file_hour, json_string, repo_owner, watch_action
from tidelake.schemas import BRONZE_COLUMNS

# Closes the array a line is parsed in. The variant parser ignores text after the first complete
# value; with this marker as second and last element such lines are told apart.
END_MARK = "~end of line~"

BAD_JSON = "bad_json"
NOT_AN_OBJECT = "not_an_object"
NO_FILE_HOUR = "no_file_hour"

# The parts of an event the lake keeps. Reading a variant as this type converts each leaf on its
# own: an absent step, or a value that does not fit, is a NULL leaf and never an error.
EVENT_TYPE = (
    "struct<id: string, type: string, created_at: string,"
    " repo: struct<id: bigint, name: string, owner: string, language: string, created_at: string>,"
    " org: struct<id: bigint, login: string>,"
    " actor: struct<id: bigint, login: string, type: string>,"
    " payload: struct<size: bigint, distinct_size: bigint, ref: string, action: string,"
    " pull_request: struct<user: struct<login: string>>>>"
)


def _event_columns(e: Column, ingest_ts: Column, source_file: Column) -> dict[str, Column]:
    return {
        "event_id": e["id"],
        "event_type": e["type"],
        "created_at": e["created_at"],
        "repo_id": e["repo"]["id"],
        "repo_name": e["repo"]["name"],
        "repo_owner": repo_owner(e["repo"]["name"], e["repo"]["owner"]),
        "org_id": e["org"]["id"],
        "org_login": e["org"]["login"],
        "actor_id": e["actor"]["id"],
        "actor_login": e["actor"]["login"],
        "actor_type": e["actor"]["type"],
        "payload_size": e["payload"]["size"],
        "payload_distinct_size": e["payload"]["distinct_size"],
        "payload_ref": e["payload"]["ref"],
        "payload_action": e["payload"]["action"],
        "pr_user_login": e["payload"]["pull_request"]["user"]["login"],
        "watch_action": watch_action(e["type"], e["payload"]["action"]),
        "repo_language": e["repo"]["language"],
        "repo_created_at": e["repo"]["created_at"],
        "ingest_ts": ingest_ts,
        "source_file": source_file,
    }


def flatten_lines(lines: DataFrame, ingest_at: dt.datetime) -> DataFrame:
    """One output row per line: bronze columns, partition columns, position and ``bad_reason``.

    Expects ``value, source_path, source_file, block_start, line_pos``. Nothing is filtered here,
    so a line is parsed once and its event read in one pass; rejected lines carry their reason
    and text.
    """
    value, doc = F.col("value"), F.col("_doc")
    one_value = (json_string(doc, "$[1]") == END_MARK) & json_string(doc, "$[2]").isNull()
    is_object = F.startswith(F.ltrim(value, F.lit(" \t\r\n")), F.lit("{"))
    parsed = (
        lines.withColumn("_doc", F.try_parse_json(F.concat(F.lit("["), value, F.lit(f',"{END_MARK}"]'))))
        .withColumns(
            {
                "_event": F.try_variant_get(doc, "$[0]", EVENT_TYPE),
                "date": file_date(F.col("source_file")),
                "hour": file_hour(F.col("source_file")),
                "_flaw": F.when(~F.coalesce(one_value, F.lit(False)), BAD_JSON).when(~is_object, NOT_AN_OBJECT),
            }
        )
        .drop("_doc")
    )
    reason = F.coalesce("_flaw", F.when(F.col("date").isNull(), NO_FILE_HOUR))
    columns = _event_columns(F.col("_event"), F.lit(ingest_at.isoformat()), F.col("source_file"))
    return parsed.select(
        *[columns[name].alias(name) for name in BRONZE_COLUMNS],
        "date",
        "hour",
        "source_path",
        "block_start",
        "line_pos",
        reason.alias("bad_reason"),
        F.when(reason.isNotNull(), value).alias("bad_line"),
    )


def good_lines(flat: DataFrame) -> DataFrame:
    return flat.where(F.col("bad_reason").isNull())


def bad_lines(flat: DataFrame) -> DataFrame:
    """Quarantine view of a flattened batch: which file, which reason, the whole line."""
    return flat.where(F.col("bad_reason").isNotNull()).select(
        "date", "hour", "source_file", F.col("bad_reason").alias("reason"), F.col("bad_line").alias("line")
    )


def stored_hours(bronze: DataFrame) -> DataFrame:
    """Rows of every hour of stored bronze; both keys are folders, so no data column is read."""
    return bronze.groupBy("date", "hour").agg(F.count("*").alias("rows"))


def file_stats(flat: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows written, duplicates dropped and lines rejected per source file."""
    keys = ["source_file", "date", "hour"]
    seen = flat.groupBy(*keys).agg(F.count("*").alias("lines"), F.count("bad_reason").alias("bad"))
    written = kept.groupBy("source_file").agg(F.count("*").alias("rows"))
    rows = F.coalesce("rows", F.lit(0).cast("bigint"))
    return seen.join(written, "source_file", "left").select(
        *keys, rows.alias("rows"), (F.col("lines") - F.col("bad") - rows).alias("duplicates"), "bad"
    )
