"""Extended activity metrics over silver and gold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ONE_DAY = "INTERVAL 1 DAY"
ONE_HOUR = "INTERVAL 1 HOUR"


def activity(silver: DataFrame, *keys: str) -> DataFrame:
    """Events per day and key; rows with a NULL key are left out."""
    present = [F.col(k).isNotNull() for k in keys]
    rows = silver
    for condition in present:
        rows = rows.where(condition)
    return rows.groupBy("event_day", *keys).agg(F.count("*").alias("event_count"))


def repo_daily_activity(silver: DataFrame) -> DataFrame:
    return activity(silver, "repo_name", "event_type")


def org_daily_activity(silver: DataFrame) -> DataFrame:
    return activity(silver, "org_login")


def actor_daily_activity(silver: DataFrame) -> DataFrame:
    """Bots are kept and flagged; the flag follows from the login, so it adds no groups."""
    return activity(silver, "actor_login", "is_bot")


def language_daily_activity(silver: DataFrame) -> DataFrame:
    return activity(silver, "repo_language")


def repo_activity(silver: DataFrame, event_type: str) -> DataFrame:
    """Daily events of one type per repository (stars, forks, issues, releases, ...)."""
    return activity(silver.where(F.col("event_type") == event_type), "repo_name")


def rolling(daily: DataFrame, key: str, metric: str, days: int) -> DataFrame:
    """Sum over the calendar window of ``days`` days ending at each row's day."""
    window = (
        Window.partitionBy(key).orderBy(F.unix_date("event_day")).rangeBetween(-(days - 1), Window.currentRow)
    )
    return daily.select("event_day", key, F.sum(metric).over(window).alias(f"rolling_{days}d"))


def _dense(counts: DataFrame, key: str, time_key: str, metric: str, step: str) -> DataFrame:
    """Every bucket between the global first and last one for every key, absent ones as 0.

    Each row fills the gap up to its successor (the first row also the gap before it), so the
    missing buckets appear inside the key's own partition and nothing is joined. The two global
    bounds are scalar subqueries over the same counts.
    """
    bounds = counts.agg(F.min(time_key).alias("lo"), F.max(time_key).alias("hi"))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    window = Window.partitionBy(key).orderBy(time_key)
    one = F.expr(step)
    bucket = F.col(time_key)
    start = F.when(F.lag(time_key).over(window).isNull(), lo).otherwise(bucket)
    following = F.lead(time_key).over(window)
    end = F.when(following.isNull(), hi).otherwise((following - one).cast(counts.schema[time_key].dataType))
    spans = counts.select(key, time_key, metric, start.alias("_from"), end.alias("_to"))
    filled = spans.select(key, bucket.alias("_at"), metric, F.explode(F.sequence("_from", "_to", one)).alias(time_key))
    return filled.select(
        key, time_key, F.when(F.col(time_key) == F.col("_at"), F.col(metric)).otherwise(0).alias(metric)
    )


def percent_change(current: Column, previous: Column) -> Column:
    """NULL when there is no previous bucket or it counted nothing."""
    return F.round(F.try_divide(F.lit(100.0) * (current - previous), previous), 6)


def _change(counts: DataFrame, key: str, time_key: str, metric: str, step: str) -> DataFrame:
    dense = _dense(counts, key, time_key, metric, step)
    previous = F.lag(metric).over(Window.partitionBy(key).orderBy(time_key))
    return dense.select(time_key, key, metric, previous.alias("_previous")).select(
        time_key, key, metric, percent_change(F.col(metric), F.col("_previous")).alias("pct_change")
    )


def day_over_day(daily: DataFrame, key: str, metric: str) -> DataFrame:
    return _change(daily, key, "event_day", metric, ONE_DAY)


def hour_over_hour(hourly: DataFrame, key: str, metric: str) -> DataFrame:
    return _change(hourly.select("event_hour_ts", key, metric), key, "event_hour_ts", metric, ONE_HOUR)


def _runs_change(counts: DataFrame, key: str, time_key: str, metric: str, step: str) -> DataFrame:
    """``_change`` without its rows in which neither the bucket nor the one before counted anything.

    Each row looks at its neighbours only: a missing bucket before it counts as 0, and where a run of
    buckets ends one row with 0 follows, unless that is beyond the last bucket of all. So the output is at
    most twice the counts, however many keys there are and however seldom they occur.
    """
    bounds = counts.agg(F.min(time_key).alias("lo"), F.max(time_key).alias("hi"))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    window = Window.partitionBy(key).orderBy(time_key)
    kind = counts.schema[time_key].dataType
    bucket, one, zero = F.col(time_key), F.expr(step), F.lit(0).cast(counts.schema[metric].dataType)
    after = (bucket + one).cast(kind)
    adjoins = F.lag(time_key).over(window) == (bucket - one).cast(kind)
    before = F.when(bucket == lo, None).otherwise(F.when(adjoins, F.lag(metric).over(window)).otherwise(zero))
    ends = F.coalesce(F.lead(time_key).over(window) > after, F.lit(True)) & (after <= hi)
    own = F.struct(bucket.alias("at"), F.col(metric).alias("value"), before.alias("previous"))
    end = F.struct(after.alias("at"), zero.alias("value"), F.col(metric).alias("previous"))
    rows = counts.select(key, F.when(ends, F.array(own, end)).otherwise(F.array(own)).alias("_rows"))
    each = rows.select(key, F.explode("_rows").alias("r")).where("r.value > 0 OR r.previous > 0")
    return each.select(
        F.col("r.at").alias(time_key), key, F.col("r.value").alias(metric),
        percent_change(F.col("r.value"), F.col("r.previous")).alias("pct_change"),
    )


def day_over_day_runs(daily: DataFrame, key: str, metric: str) -> DataFrame:
    """Day-over-day change for keys with many values: only days that counted something, or whose day before did."""
    return _runs_change(daily.select("event_day", key, metric), key, "event_day", metric, ONE_DAY)


def hour_over_hour_runs(hourly: DataFrame, key: str, metric: str) -> DataFrame:
    """Hour-over-hour change for keys with many values: only hours that counted something, or whose hour before did."""
    return _runs_change(hourly.select("event_hour_ts", key, metric), key, "event_hour_ts", metric, ONE_HOUR)


def push_pr_ratio(daily_types: DataFrame) -> DataFrame:
    """Pushes per pull request and day, from the daily type counts; NULL without pull requests."""

    def total(event_type: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("event_type") == event_type, F.col("event_count"))), F.lit(0))

    return daily_types.groupBy("event_day").agg(
        total("PushEvent").alias("push_count"), total("PullRequestEvent").alias("pr_count")
    ).select(
        "event_day",
        "push_count",
        "pr_count",
        F.round(F.try_divide(F.col("push_count").cast("double"), F.col("pr_count")), 6).alias("push_pr_ratio"),
    )
