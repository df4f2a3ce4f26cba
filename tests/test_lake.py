"""Bronze to silver to gold on disk: late rows, replays, empty days, snapshots, catalog."""

import datetime as dt
from pathlib import Path

import pytest

from conftest import day, event, rows
from tidelake.operators import quality
from tidelake.operators.conform import accounting, quarantined, to_silver, typed
from tidelake.plans import backfill, bronze, dashboard, gold, silver
from tidelake.schemas import ENTITIES, GOLD_TABLES, SILVER_SCHEMA
from tidelake.sources import catalog, snapshot
from tidelake.sources import raw as raw_source
from tidelake.sources.lake import (
    read_bad_lines,
    read_bad_rows,
    read_bronze,
    read_by_name,
    read_gold,
    read_silver,
)

AT = dt.datetime(2024, 3, 6, 12, tzinfo=dt.timezone.utc)


@pytest.fixture
def land(spark, lake, raw):
    def run(stamp, lines, at=AT):
        raw.write(stamp, lines)
        path = str(raw.folder / f"{stamp}.json.gz")
        return bronze.land_lines(raw_source.scan_lines(spark, [path]), lake, at, "test")

    return run


def gold_rows(spark, lake):
    return {t: rows(df) for t, df in read_gold(spark, lake).items()}


def test_silver_rules(spark, lake, land):
    land(
        "2024-03-05-10",
        [
            event("1", login="dependabot[Bot]"),
            event("2", login=None),
            event("3", login="Robot[x]"),
            event(None),
            event("", login="empty"),
            event("4", type=None),
            event("5", created_at="nope"),
            event("6", created_at=None),
            event("7", created_at="2024-03-01T00:00:00Z"),
            event("8", created_at="2024-03-05T23:59:59+02:00"),
        ],
    )
    land("2024-03-05-11", [event("1", login="later copy")], at=AT + dt.timedelta(hours=1))
    days = silver.process_dates(spark, lake, [day("2024-03-05")])
    assert days == [day("2024-03-01"), day("2024-03-05")]
    stored = read_silver(spark, lake)
    assert stored.schema == SILVER_SCHEMA
    assert rows(stored, "event_id", "actor_login", "is_bot") == [
        ("", "empty", False),
        ("1", "dependabot[Bot]", True),
        ("2", None, None),
        ("3", "Robot[x]", False),
        ("7", "ann", False),
        ("8", "ann", False),
    ]
    hour = stored.where("event_id = '8'").selectExpr("string(event_ts)", "string(event_hour_ts)").first()
    assert tuple(hour) == ("2024-03-05 21:59:59", "2024-03-05 21:00:00")
    assert rows(read_bad_rows(spark, lake), "event_id", "reason") == [
        ("4", "missing_event_type"),
        ("5", "bad_event_ts"),
        ("6", "bad_event_ts"),
        (None, "missing_event_id"),
    ]
    totals = accounting(read_bronze(spark, lake)).first()
    assert tuple(totals) == (11, 6, 1, 4)
    assert rows(quality.silver_report(stored, "duplicate_event_ids", "day_mismatch"), "check_name", "value") == [
        *[("day_mismatch", 0)] * 2,  # a row for each of the two days
        *[("duplicate_event_ids", 0)] * 2,
    ]


def test_a_late_row_joins_its_day_and_keeps_the_others(spark, lake, land):
    dates = land("2024-03-06-0", [event("b", created_at="2024-03-06T00:10:00Z")])
    backfill.refresh(spark, lake, dates)
    dates = land("2024-03-05-23", [event("a"), event("stray", created_at="2024-03-06T00:00:01Z")])
    assert backfill.refresh(spark, lake, dates) == [day("2024-03-05"), day("2024-03-06")]
    expected = [("a", day("2024-03-05")), ("b", day("2024-03-06")), ("stray", day("2024-03-06"))]
    assert rows(read_silver(spark, lake), "event_id", "event_day") == expected
    assert rows(read_gold(spark, lake)["push_user_daily"]) == [
        ("ann", 1, day("2024-03-05")),
        ("ann", 2, day("2024-03-06")),
    ]
    # a row of the fifth that arrives in a file of the sixth
    dates = land("2024-03-06-1", [event("back", created_at="2024-03-05T23:59:00Z")])
    backfill.refresh(spark, lake, dates)
    assert rows(read_gold(spark, lake)["push_user_daily"], "event_day", "push_count") == [
        (day("2024-03-05"), 2),
        (day("2024-03-06"), 2),
    ]
    by_day = quality.reconciliation_by_day(read_silver(spark, lake), read_gold(spark, lake)["event_type_daily"])
    assert rows(by_day, "value") == [(0,), (0,)]


def test_a_corrected_hour_takes_its_rows_back(spark, lake, land):
    far = event("far", created_at="2024-03-01T10:00:00Z")
    dates = land("2024-03-05-23", [event("a"), event("stray", created_at="2024-03-06T00:00:01Z"), far])
    assert backfill.refresh(spark, lake, dates) == [day("2024-03-01"), day("2024-03-05"), day("2024-03-06")]
    assert rows(read_gold(spark, lake)["push_user_daily"], "event_day", "push_count") == [
        (day("2024-03-01"), 1),
        (day("2024-03-05"), 1),
        (day("2024-03-06"), 1),
    ]
    dates = land("2024-03-05-23", [event("a")], at=AT + dt.timedelta(hours=1))
    backfill.refresh(spark, lake, dates)
    assert rows(read_silver(spark, lake), "event_id") == [("a",)]
    dates = land("2024-03-05-23", [event("a", created_at="nope")], at=AT + dt.timedelta(hours=2))
    assert backfill.refresh(spark, lake, dates) == [day("2024-03-05")]
    assert read_silver(spark, lake).isEmpty()
    assert all(table.isEmpty() for table in read_gold(spark, lake).values())


@pytest.fixture
def three_days(spark, lake, raw):
    kinds = ["PushEvent", "PullRequestEvent", "WatchEvent"]
    for d in (4, 5, 6):
        for h in (0, 12, 23):
            lines = [
                event(
                    f"{d}-{h}-{i}",
                    created_at=f"2024-03-0{d}T{h:02d}:{i:02d}:00Z",
                    type=kinds[i % 3],
                    login=["ann", "bob", "ci[bot]", None][i % 4],
                    repo=f"acme/r{i % 5}",
                    org={"id": 1, "login": f"org{i % 2}"},
                )
                for i in range(30)
            ]
            if h == 23:
                lines.append(event(f"{d}-late", created_at=f"2024-03-0{d + 1}T00:00:30Z"))
            raw.write(f"2024-03-0{d}-{h}", lines + lines[:3])
    return bronze.land_lines(raw_source.scan_lines(spark, str(raw.folder)), lake, AT, "test")


def test_rebuild_equals_incremental_and_repeats(spark, lake, three_days):
    for date in three_days:
        backfill.refresh(spark, lake, [date])
    silver_once, gold_once = rows(read_silver(spark, lake)), gold_rows(spark, lake)
    assert len(silver_once) == 3 * 91
    backfill.rebuild(spark, lake, day("2024-03-04"), day("2024-03-07"))
    assert rows(read_silver(spark, lake)) == silver_once
    assert gold_rows(spark, lake) == gold_once
    backfill.refresh(spark, lake, three_days)
    assert rows(read_silver(spark, lake)) == silver_once
    assert gold_rows(spark, lake) == gold_once


def test_tables_from_the_cube_equal_direct_counts(spark, lake, three_days):
    from tidelake.operators.counts import gold_tables

    backfill.refresh(spark, lake, three_days)
    direct = gold_tables(read_silver(spark, lake))
    for table, entity in GOLD_TABLES.items():
        names = entity.schema(table).fieldNames()
        assert rows(read_gold(spark, lake)[table], *names) == rows(direct[table], *names)
    for name in ENTITIES:
        assert quality.totals_agree(direct[f"{name}_daily"], direct[f"{name}_hourly"], name).isEmpty()


def test_rebuild_empties_days_that_lost_their_rows(spark, lake, land, three_days):
    backfill.refresh(spark, lake, three_days)
    for h in (0, 12, 23):
        land(f"2024-03-06-{h}", [event("other", created_at="2024-03-06T08:00:00Z", type="ForkEvent")])
    backfill.rebuild(spark, lake, day("2024-03-05"), day("2024-03-07"))
    assert rows(read_silver(spark, lake, [day("2024-03-06")]), "event_id") == [("5-late",), ("other",)]
    assert rows(read_silver(spark, lake, [day("2024-03-07")])) == []
    tables = read_gold(spark, lake, [day("2024-03-06"), day("2024-03-07")])
    assert rows(tables["pr_repo_hourly"]) == [] and rows(tables["pr_org_daily"]) == []
    assert rows(tables["event_type_daily"], "event_type", "event_count") == [("ForkEvent", 1), ("PushEvent", 1)]


def test_files_of_a_day_stay_few(spark, lake, three_days):
    import pathlib

    backfill.rebuild(spark, lake, day("2024-03-01"), day("2024-03-09"))
    files = list(pathlib.Path(lake.silver).glob("event_day=2024-03-05/*.parquet"))
    assert len(files) == 1


def test_snapshot_follows_the_pointer(spark, lake, three_days):
    backfill.refresh(spark, lake, three_days)
    with pytest.raises(snapshot.NothingPublished):
        snapshot.open_current(spark, lake)
    first = snapshot.publish(spark, lake)
    before = dashboard.summary(snapshot.open_current(spark, lake), "max", as_of=AT).first()["total_events"]
    assert before == 3 * 91
    gold.build_days(spark, lake, [day("2024-03-04")])
    second = snapshot.publish(spark, lake)
    assert first != second == snapshot.current(spark, lake)
    # an unfinished publication is not followed
    unfinished = lake.path("snapshots", "data", "event_type_daily", "version=unfinished")
    read_gold(spark, lake)["event_type_daily"].limit(1).write.partitionBy("event_day").parquet(unfinished)
    assert snapshot.current(spark, lake) == second
    assert dashboard.summary(snapshot.open_current(spark, lake), "max", as_of=AT).first()["total_events"] == before


def test_publishing_writes_the_changed_days_alone(spark, lake, three_days, land):
    backfill.refresh(spark, lake, three_days)
    first = snapshot.publish(spark, lake)
    assert snapshot.publish(spark, lake) != first
    dates = land("2024-03-05-13", [event("more", created_at="2024-03-05T13:00:00Z")])
    days = backfill.refresh(spark, lake, dates)  # a stray row of the fifth's files makes it two
    assert days == [day("2024-03-05"), day("2024-03-06")]
    second = snapshot.publish(spark, lake)
    for table in GOLD_TABLES:
        written = sorted(p.name for p in Path(lake.snapshots, "data", table, f"version={second}").glob("event_day=*"))
        assert written == [f"event_day={d}" for d in days]
    totals = [dashboard.summary(snapshot.open_snapshot(spark, lake, s), "max", as_of=AT).first()["total_events"] for s in (first, second)]
    assert totals == [3 * 91, 3 * 91 + 1]
    assert snapshot.expire(spark, lake, keep=1) == 2 * len(GOLD_TABLES)
    assert rows(snapshot.open_current(spark, lake)["event_type_daily"]) == rows(read_gold(spark, lake)["event_type_daily"])
    assert not Path(lake.snapshots, "data", "event_type_daily", f"version={first}", "event_day=2024-03-05").exists()


def test_publish_refuses_empty_tables(spark, lake, land):
    dates = land("2024-03-05-10", [event("1")])
    backfill.refresh(spark, lake, dates)
    with pytest.raises(quality.EmptyGoldTable, match="nothing to publish in .*pr_org_daily"):
        snapshot.publish(spark, lake)
    with pytest.raises(snapshot.NothingPublished):
        snapshot.current(spark, lake)


def test_catalog_tables_and_views(spark, lake, three_days):
    backfill.refresh(spark, lake, three_days)
    names = catalog.create_tables(spark, lake, "lake_test")
    assert len(names) == 10
    assert spark.table("lake_test.silver_events").count() == 0
    catalog.repair_tables(spark, lake, "lake_test")
    assert spark.table("lake_test.silver_events").count() == 3 * 91
    assert spark.table("lake_test.bronze_events").where("date = DATE '2024-03-05' AND hour = '0'").count() == 30
    catalog.create_views(spark, "lake_test", as_of=day("2024-03-30"))
    want = dashboard.trailing_totals(read_gold(spark, lake), ENTITIES["push_user"], 30, day("2024-03-30"))
    assert [tuple(r) for r in spark.table("lake_test.v_top_push_users_30d").collect()] == [
        tuple(r) for r in want.collect()
    ]
    assert spark.table("lake_test.v_event_type_daily").count() == len(
        rows(read_gold(spark, lake)["event_type_daily"])
    )
    spark.sql("DROP DATABASE lake_test CASCADE")


def test_reading_by_name_unites_differing_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT 1 AS a, 'x' AS b").write.parquet(f"{path}/event_day=2024-01-01")
    spark.sql("SELECT 'y' AS b, 2 AS a, 3.5D AS c").write.parquet(f"{path}/event_day=2024-01-02")
    assert rows(read_by_name(spark, path), "a", "b", "c") == [(1, "x", None), (2, "y", 3.5)]


def test_one_hot_id_is_cut_down_before_the_shuffle(spark, lake, land):
    copies = [event("hot", created_at=f"2024-03-05T10:00:{i % 60:02d}Z") for i in range(40)]
    for h in range(6):
        land(f"2024-03-05-{h}", [event(f"{h}"), *copies])
    plan = to_silver(read_bronze(spark, lake))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1
    assert to_silver(read_bronze(spark, lake)).count() == 7
    assert quarantined(read_bronze(spark, lake)).isEmpty()
    assert "event_day" in typed(read_bronze(spark, lake)).columns


def test_dated_reads_prune_partitions(spark, lake, three_days):
    backfill.refresh(spark, lake, three_days)
    one = [day("2024-03-05")]
    for df in (
        read_silver(spark, lake, one),
        read_bronze(spark, lake, one),
        dashboard.top_pr_repos(read_gold(spark, lake), "7d", as_of=AT),
        dashboard.top_pr_repos(read_gold(spark, lake), "24h", as_of=AT),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: []" not in plan


def test_reports_over_the_stored_layers(spark, lake, three_days):
    from tidelake.plans import checks

    assert rows(checks.layer_lag(spark, lake), "layer", "latest_hour")[1:] == [("gold", None), ("silver", None)]
    backfill.refresh(spark, lake, three_days)
    snapshot.publish(spark, lake)
    assert rows(checks.layer_lag(spark, lake)) == [
        ("bronze", dt.datetime(2024, 3, 6, 23)),
        ("gold", dt.datetime(2024, 3, 7, 0)),
        ("silver", dt.datetime(2024, 3, 7, 0)),
        ("snapshot", dt.datetime(2024, 3, 7, 0)),
    ]
    report = dict(rows(checks.day_report(spark, lake, day("2024-03-05"))))
    assert report.pop("silver_event_count") == 91 and set(report.values()) == {0} and len(report) == 6
    tables = checks.gold_report(spark, lake)
    assert tables.count() == 8 and rows(tables.select("passed", "negative_rows").distinct()) == [(True, 0)]
    assert checks.bronze_columns_missing(spark, lake) == []
    assert rows(checks.freshness(spark, lake, dt.datetime(2024, 3, 7, 2)), "within_sla") == [(True,)]
    missing = checks.missing_hours(spark, lake, dt.datetime(2024, 3, 7, 1, 30), hours_back=4)
    assert [r["hour_ts"].hour for r in missing.orderBy("hour_ts").collect()] == [21, 22, 0]


def test_command_line_jobs(spark, lake, raw, capsys):
    from tidelake.__main__ import main

    kinds = ["PushEvent", "PullRequestEvent"]
    lines = [event(str(i), type=kinds[i % 2], org={"id": 1, "login": "acme"}) for i in range(4)]
    raw.write("2024-03-05-10", lines)
    at = ["--lake", lake.root]
    start = ["--start-from", "2024-03-05T00:00:00", "--retention-days", "100000"]
    main(["ingest", *at, "--raw", str(raw.folder), *start])
    main(["silver", *at, "--date", "2024-03-05"])
    main(["gold", *at, "--date", "2024-03-05"])
    main(["publish", *at])
    capsys.readouterr()
    main(["query", "top-push-users", *at, "--preset", "max", "--limit", "1"])
    assert "ann\t2" in capsys.readouterr().out
    main(["rebuild", *at, "--first", "2024-03-04", "--last", "2024-03-06"])
    main(["check", *at, "--date", "2024-03-05"])
    assert "|silver_event_count            |4    |" in capsys.readouterr().out


def test_quarantine_follows_a_corrected_hour(spark, lake, land):
    dates = land("2024-03-05-10", [event("1"), event("2", type=None), "{bad"])
    backfill.refresh(spark, lake, dates)
    assert rows(read_bad_lines(spark, lake), "line") == [("{bad",)]
    assert rows(read_bad_rows(spark, lake), "event_id") == [("2",)]
    dates = land("2024-03-05-10", [event("1"), event("2")])
    backfill.refresh(spark, lake, dates)
    assert rows(read_bad_lines(spark, lake)) == [] and rows(read_bad_rows(spark, lake)) == []
    assert rows(read_silver(spark, lake), "event_id") == [("1",), ("2",)]
