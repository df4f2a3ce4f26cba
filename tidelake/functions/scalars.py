"""Column expressions shared by the layers. All of them stay inside the JVM."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

FILE_HOUR_PATTERN = r"(\d{4}-\d{2}-\d{2})-(\d{1,2})"


def json_string(doc: Column, path: str) -> Column:
    """Text at ``path`` of a variant; NULL when any step is absent or not an object."""
    return F.try_variant_get(doc, path, "string")


def json_long(doc: Column, path: str) -> Column:
    """Lenient whole number at ``path``: floats lose their fraction, bad values become NULL."""
    return F.try_variant_get(doc, path, "bigint")


def repo_owner(repo_name: Column, fallback: Column) -> Column:
    """Text before the first slash; ``fallback`` when there is no slash or nothing before it."""
    prefix = F.when(F.contains(repo_name, F.lit("/")), F.split_part(repo_name, F.lit("/"), F.lit(1)))
    return F.coalesce(F.nullif(prefix, F.lit("")), fallback)


def watch_action(event_type: Column, action: Column) -> Column:
    return F.when(event_type == "WatchEvent", action)


def file_date(file_name: Column) -> Column:
    """Date spelled in an hourly file name, NULL when the name carries none."""
    return F.regexp_extract(file_name, FILE_HOUR_PATTERN, 1).try_cast("date")


def file_hour(file_name: Column) -> Column:
    """Hour spelled in an hourly file name as text (not zero padded), NULL when absent."""
    return F.nullif(F.regexp_extract(file_name, FILE_HOUR_PATTERN, 2), F.lit(""))


def parse_ts(text: Column) -> Column:
    """ISO text to timestamp; NULL instead of an error when it cannot be read."""
    return F.try_to_timestamp(text)


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def is_bot(login: Column) -> Column:
    """Literal ``[bot]`` anywhere in the login, any case. NULL for a NULL login."""
    return F.contains(F.lower(login), F.lit("[bot]"))


def has_id(event_id: Column) -> Column:
    return F.coalesce(event_id != "", F.lit(False))


def naive_utc(ts: Column) -> Column:
    """Instant to a zone-less timestamp, the type results are handed out in (session zone: UTC)."""
    return ts.cast("timestamp_ntz")


def bucket_label(bucket: Column, hourly: bool) -> Column:
    """ISO spelling of a day or hour bucket."""
    return F.date_format(bucket, "yyyy-MM-dd'T'HH:mm:ss") if hourly else bucket.cast("string")


def or_zero(total: Column) -> Column:
    return F.coalesce(total, F.lit(0).cast("bigint"))


def as_naive_utc(moment: dt.datetime | None) -> dt.datetime | None:
    """A clock reading the way the lake stores times; readings without a zone are taken as UTC."""
    offset = moment.utcoffset() if moment else None
    return moment if offset is None else moment.replace(tzinfo=None) - offset
