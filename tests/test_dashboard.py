"""Preset ranges and queries over small handmade gold tables."""

import datetime as dt

import pytest

from conftest import day
from tidelake.functions import as_naive_utc
from tidelake.plans import dashboard
from tidelake.schemas import ENTITIES, GOLD_TABLES

AS_OF = dt.datetime(2024, 1, 30, 12)


def ts(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


@pytest.fixture
def gold(spark):
    tables = {t: spark.createDataFrame([], e.schema(t)) for t, e in GOLD_TABLES.items()}

    def fill(table, rows):
        e = GOLD_TABLES[table]
        tables[table] = spark.createDataFrame(rows, e.schema(table))

    fill(
        "event_type_daily",
        [
            ("A", 1, day("2024-01-22")),
            ("A", 10, day("2024-01-23")),
            ("B", 100, day("2024-01-30")),
            ("B", 1000, day("2024-01-31")),
            ("A", 10000, day("2023-12-31")),
        ],
    )
    fill(
        "event_type_hourly",
        [
            (ts("2024-02-03 09:00"), "A", 1, day("2024-02-03")),
            (ts("2024-02-03 06:00"), "A", 2, day("2024-02-03")),
            (ts("2024-02-03 05:00"), "B", 4, day("2024-02-03")),
            (ts("2024-02-02 10:00"), "B", 8, day("2024-02-02")),
            (ts("2024-02-02 09:00"), "B", 16, day("2024-02-02")),
        ],
    )
    fill("pr_repo_daily", [(f"r{i:02d}", 5 if i % 2 else i, day("2024-01-29")) for i in range(60)])
    return tables


def found(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_aware_times_lose_their_zone():
    aware = dt.datetime(2026, 4, 26, 14, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    assert as_naive_utc(aware) == dt.datetime(2026, 4, 26, 12)
    assert as_naive_utc(AS_OF) is AS_OF
    assert as_naive_utc(None) is None


@pytest.mark.parametrize("preset, hours", [("1h", 1), ("4h", 4), ("24h", 24), ("7d", 168), ("30d", 720)])
def test_clock_ranges(preset, hours):
    span = dashboard.resolve_range_from_clock(preset, AS_OF)
    assert (span.start, span.end) == (AS_OF - dt.timedelta(hours=hours), AS_OF)


def test_max_has_no_start_and_the_clock_is_the_default():
    span = dashboard.resolve_range_from_clock("max")
    assert span.start is None and span.end.tzinfo is None
    assert abs(span.end - as_naive_utc(dt.datetime.now(dt.timezone.utc))) < dt.timedelta(minutes=1)


def test_unknown_presets_and_limits_are_refused(gold):
    with pytest.raises(dashboard.UnsupportedPreset):
        dashboard.summary(gold, "2d")
    with pytest.raises(dashboard.UnsupportedPreset):
        dashboard.resolve_short_range_from_data(gold, "7d")
    for limit in (0, 51):
        with pytest.raises(ValueError, match="limit"):
            dashboard.top_pr_repos(gold, "7d", limit)


def test_short_ranges_need_hourly_rows(gold):
    empty = {**gold, "event_type_hourly": gold["event_type_hourly"].limit(0)}
    with pytest.raises(dashboard.NoHourlyData):
        dashboard.resolve_short_range_from_data(empty, "1h")
    with pytest.raises(Exception, match="no row to take the newest hour from"):
        dashboard.summary(empty, "1h").collect()


def test_building_a_query_runs_no_job_and_days_prune_when_it_runs(spark, gold, tmp_path):
    stored = str(tmp_path / "hourly")
    gold["event_type_hourly"].write.partitionBy("event_day").parquet(stored)
    tables = {**gold, "event_type_hourly": spark.read.schema(gold["event_type_hourly"].schema).parquet(stored)}
    spark.sparkContext.setJobGroup("building", "building")
    built = [fn(tables, preset, as_of=AS_OF) for fn in (dashboard.summary, dashboard.event_type_series) for preset in dashboard.SHORT_PRESETS]
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
    spark.sparkContext.setJobGroup("other", "other")
    plan = built[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_day" in plan and "Subquery" in plan


@pytest.mark.parametrize(
    "preset, total",
    [("1h", 1), ("4h", 3), ("24h", 15), ("7d", 110), ("30d", 10111), ("max", 11111)],
)
def test_summary(gold, preset, total):
    (row,) = dashboard.summary(gold, preset, AS_OF).collect()
    assert row["preset"] == preset and row["total_events"] == total
    if preset == "4h":
        assert (row["start_ts"], row["end_ts"]) == (dt.datetime(2024, 2, 3, 6), dt.datetime(2024, 2, 3, 10))
    if preset == "max":
        assert row["start_ts"] is None and row["end_ts"] == AS_OF


def test_summary_of_nothing_is_zero(gold):
    far = dt.datetime(2020, 1, 1)
    assert found(dashboard.summary(gold, "7d", far), "total_events") == [(0,)]


def test_event_types_sorted_by_count(gold):
    assert found(dashboard.event_types(gold, "24h"), "event_type", "event_count") == [("B", 12), ("A", 3)]
    assert found(dashboard.event_types(gold, "max", AS_OF), "event_type", "event_count") == [("A", 10011), ("B", 1100)]


def test_series_buckets(gold):
    assert found(dashboard.event_type_series(gold, "4h"), "bucket", "event_type", "event_count") == [
        ("2024-02-03T06:00:00", "A", 2),
        ("2024-02-03T09:00:00", "A", 1),
    ]
    assert found(dashboard.event_type_series(gold, "7d", AS_OF), "bucket", "event_count") == [
        ("2024-01-23", 10),
        ("2024-01-30", 100),
    ]


def test_ranking_breaks_ties_by_key_and_takes_only_the_top(gold):
    top = dashboard.top_pr_repos(gold, "7d", 3, AS_OF)
    assert found(top, "repo_name", "pr_count") == [("r58", 58), ("r56", 56), ("r54", 54)]
    wide = found(dashboard.top_pr_repos(gold, "7d", 50, AS_OF), "repo_name", "pr_count")
    assert len(wide) == 50 and [k for k, v in wide if v == 5][:2] == ["r01", "r03"]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and plan.count("Exchange") == 1
    assert found(dashboard.top_push_users(gold, "max", as_of=AS_OF), "actor_login") == []


def test_trailing_view_has_no_upper_bound(gold):
    totals = dashboard.trailing_totals(gold, ENTITIES["event_type"], 30, AS_OF.date())
    assert found(totals, "event_type", "event_count") == [("A", 10011), ("B", 1100)]
    later = dashboard.trailing_totals(gold, ENTITIES["event_type"], 30, day("2024-02-22"))
    assert found(later, "event_type", "event_count") == [("B", 1100), ("A", 10)]


def test_preset_table(gold):
    table = {r["preset"]: (r["start_ts"], r["end_ts"]) for r in dashboard.preset_ranges(gold, AS_OF).collect()}
    assert table["24h"] == (dt.datetime(2024, 2, 2, 10), dt.datetime(2024, 2, 3, 10))
    assert table["30d"] == (dt.datetime(2023, 12, 31, 12), AS_OF)
    assert table["max"] == (None, AS_OF)
    assert list(table) == list(dashboard.PRESETS)
