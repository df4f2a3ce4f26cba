import datetime as dt
import random

import pytest

from conftest import day, rows
from tidelake.operators import metrics, quality
from tidelake.schemas import GOLD_TABLES
from tidelake.sources import ledger

DAYS = "event_day date, event_type string, event_count bigint"
HOURS = "event_day date, event_hour_ts timestamp, event_type string, event_count bigint"


def ts(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


@pytest.fixture
def daily(spark):
    data = [
        (day("2024-01-01"), "A", 10),
        (day("2024-01-02"), "A", 15),
        (day("2024-01-05"), "A", 3),
        (day("2024-01-02"), "B", 4),
        (day("2024-01-08"), "B", 6),
    ]
    return spark.createDataFrame(data, DAYS)


def test_rolling_window_counts_calendar_days(daily):
    assert rows(metrics.rolling(daily, "event_type", "event_count", 7)) == [
        (day("2024-01-01"), "A", 10),
        (day("2024-01-02"), "A", 25),
        (day("2024-01-02"), "B", 4),
        (day("2024-01-05"), "A", 28),
        (day("2024-01-08"), "B", 10),
    ]


def test_day_over_day_fills_missing_days_with_zero(daily):
    change = {(r[0].day, r[1]): (r[2], r[3]) for r in metrics.day_over_day(daily, "event_type", "event_count").collect()}
    assert len(change) == 16
    assert change[1, "A"] == (10, None) and change[2, "A"] == (15, 50.0)
    assert change[3, "A"] == (0, -100.0) and change[4, "A"] == (0, None) and change[5, "A"] == (3, None)
    assert change[1, "B"] == (0, None) and change[2, "B"] == (4, None) and change[3, "B"] == (0, -100.0)
    assert change[8, "B"] == (6, None) and change[8, "A"] == (0, None)


def test_hour_over_hour_crosses_midnight(spark):
    hourly = spark.createDataFrame(
        [(day("2024-01-01"), ts("2024-01-01 23:00"), "A", 8), (day("2024-01-02"), ts("2024-01-02 00:00"), "A", 2)],
        HOURS,
    )
    assert rows(metrics.hour_over_hour(hourly, "event_type", "event_count"), "event_count", "pct_change") == [
        (2, -75.0),
        (8, None),
    ]


def test_change_by_runs_is_the_dense_form_without_empty_pairs(spark):
    rng = random.Random(3)
    data = [(day(f"2024-01-{d:02d}"), f"k{k}", rng.randint(0, 5)) for k in range(30) for d in range(1, 29) if rng.random() < 0.05 * (k % 20)]
    counts = spark.createDataFrame(data, DAYS)
    dense = {(r.event_day, r.event_type): (r.event_count, r.pct_change) for r in metrics.day_over_day(counts, "event_type", "event_count").collect()}
    runs = metrics.day_over_day_runs(counts, "event_type", "event_count").collect()
    kept = {k: v for k, v in dense.items() if v[0] or v[1] is not None}
    assert {(r.event_day, r.event_type): (r.event_count, r.pct_change) for r in runs} == kept
    assert len(runs) == len(kept) <= 2 * len(data)
    assert metrics.day_over_day_runs(counts.limit(0), "event_type", "event_count").count() == 0


def test_hourly_change_by_runs(spark):
    data = [(day("2024-01-01"), ts("2024-01-01 23:00"), "A", 8), (day("2024-01-02"), ts("2024-01-02 00:00"), "A", 2), (day("2024-01-02"), ts("2024-01-02 05:00"), "B", 1)]
    got = metrics.hour_over_hour_runs(spark.createDataFrame(data, HOURS), "event_type", "event_count")
    assert rows(got, "event_type", "event_count", "pct_change") == [("A", 0, -100.0), ("A", 2, -75.0), ("A", 8, None), ("B", 1, None)]


def test_change_needs_one_shuffle_of_the_counts(daily):
    plan = metrics.day_over_day(daily, "event_type", "event_count")._jdf.queryExecution().executedPlan().toString()
    # the global bounds are aggregates to one row; only the windows move the counts
    assert plan.count("Exchange hashpartitioning(event_type") == 1


def test_push_pr_ratio(spark):
    table = spark.createDataFrame(
        [
            (day("2024-01-01"), "PushEvent", 10),
            (day("2024-01-01"), "PullRequestEvent", 3),
            (day("2024-01-02"), "PushEvent", 5),
            (day("2024-01-03"), "ForkEvent", 5),
        ],
        DAYS,
    )
    assert rows(metrics.push_pr_ratio(table)) == [
        (day("2024-01-01"), 10, 3, 3.333333),
        (day("2024-01-02"), 5, 0, None),
        (day("2024-01-03"), 0, 0, None),
    ]


def test_reconciliation(spark, daily):
    silver = daily.selectExpr("event_day", "explode(sequence(1L, event_count)) AS n").where("event_day > '2024-01-01'")
    assert rows(quality.reconciliation(silver, daily), "value") == [(-10,)]
    assert rows(quality.reconciliation(silver, daily, day("2024-01-02")), "value") == [(0,)]
    assert rows(quality.reconciliation(silver, daily.limit(0)), "value") == [(None,)]
    by_day = rows(quality.reconciliation_by_day(silver, daily), "event_day", "value")
    assert by_day[0] == (day("2024-01-01"), -10) and {v for _, v in by_day[1:]} == {0}


def test_report_of_one_day_without_rows(spark):
    silver = spark.createDataFrame(
        [("1", "A", ts("2024-01-01 01:00"), day("2024-01-02")), ("1", None, ts("2024-01-02 01:00"), day("2024-01-02"))],
        "event_id string, event_type string, event_ts timestamp, event_day date",
    )
    found = {r["check_name"]: r["value"] for r in quality.silver_report(silver, day=day("2024-01-02")).collect()}
    assert found == {
        "silver_event_count": 2,
        "null_event_id": 0,
        "null_event_type": 1,
        "null_event_ts": 0,
        "duplicate_event_ids": 1,
        "day_mismatch": 1,
    }
    none = quality.silver_report(silver, "silver_event_count", day=day("2020-01-01"))
    assert rows(none) == [(day("2020-01-01"), "silver_event_count", 0)]


def test_freshness(spark, daily):
    hourly = spark.createDataFrame([(day("2024-01-01"), ts("2024-01-01 09:00"), "A", 8)], HOURS)
    fresh = quality.freshness(hourly, dt.datetime(2024, 1, 1, 12))
    assert rows(fresh, "lag_seconds", "within_sla") == [(7200, True)]
    stale = quality.freshness(hourly, dt.datetime(2024, 1, 1, 12, 0, 1))
    assert rows(stale, "within_sla") == [(False,)]
    assert rows(quality.freshness(hourly.limit(0), dt.datetime(2024, 1, 1)), "within_sla") == [(False,)]


def test_gold_gates(spark):
    gold = {
        t: spark.createDataFrame([tuple([None] * (len(e.schema(t)) - 2) + [-1, None])], e.schema(t))
        for t, e in GOLD_TABLES.items()
    }
    assert {r["negative_rows"] for r in quality.negative_counts(gold).collect()} == {1}
    quality.require_non_empty(gold)
    gold["pr_org_daily"] = gold["pr_org_daily"].limit(0)
    with pytest.raises(quality.EmptyGoldTable, match="^nothing to publish in pr_org_daily$"):
        quality.require_non_empty(gold)


def hours(df):
    return [r[0] for r in df.selectExpr("cast(hour_ts AS string) AS h").orderBy("h").collect()]


def test_expected_hours(spark):
    now = dt.datetime(2024, 3, 5, 2, 59)
    spine = ledger.hour_spine(ledger.clock_bounds(spark, now))
    assert hours(spine) == [f"2024-03-0{d} {h:02d}:00:00" for d, h in ((4, 20), (4, 21), (4, 22), (4, 23), (5, 0), (5, 1))]
    since = ledger.hour_spine(ledger.clock_bounds(spark, now, dt.datetime(2024, 3, 5, 0)))
    assert hours(since) == ["2024-03-05 00:00:00", "2024-03-05 01:00:00"]
    clamped = ledger.hour_spine(ledger.clock_bounds(spark, now, dt.datetime(2000, 1, 1)))
    assert clamped.count() == 150 * 24 + 1
    assert ledger.hour_spine(ledger.clock_bounds(spark, now, dt.datetime(2024, 4, 1))).count() == 0


def test_newest_ledger_entry_counts(spark):
    hour = ts("2024-03-05 01:00")
    table = spark.createDataFrame(
        [(hour, "1", 5, 0, 0, ts("2024-03-05 03:00"), day("2024-03-05")), (hour, "1", 9, 1, 2, ts("2024-03-05 04:00"), day("2024-03-05"))],
        "hour_ts timestamp, hour string, rows bigint, duplicates bigint, bad bigint, ingested_at timestamp, date date",
    )
    assert rows(ledger.latest_entries(table), "rows", "duplicates", "bad") == [(9, 1, 2)]
    spine = table.select("hour_ts").distinct().selectExpr("explode(sequence(hour_ts, hour_ts + INTERVAL 2 HOUR, INTERVAL 1 HOUR)) AS hour_ts")
    assert hours(ledger.missing_hours(spine, table)) == ["2024-03-05 02:00:00", "2024-03-05 03:00:00"]
