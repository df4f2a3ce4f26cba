"""Runs that die between two steps, ids with copies on several days, and the log of what is left to do."""

import datetime as dt

import pytest

from conftest import day, event, rows
from tidelake.plans import backfill, bronze, gold, silver
from tidelake.sources import ids, intents
from tidelake.sources import raw as raw_source
from tidelake.sources.lake import Lake, read_bad_rows, read_gold, read_silver

AT = dt.datetime(2024, 3, 9, tzinfo=dt.timezone.utc)


@pytest.fixture
def land(spark, lake, raw):
    def run(stamp, lines, hours=0):
        raw.write(stamp, lines)
        lines = raw_source.scan_lines(spark, [str(raw.folder / f"{stamp}.json.gz")])
        return bronze.land_lines(lines, lake, AT + dt.timedelta(hours=hours), f"test-{stamp}")

    return run


def two(at):
    return event("two", created_at=at)


def first_state(land):
    """An id with copies on the 5th and the 8th, a stray of the 6th, a row far back, and a rejected row."""
    land(
        "2024-03-05-23",
        [event("a"), event("stray", created_at="2024-03-06T00:00:01Z"), event("far", created_at="2024-03-01T10:00:00Z"),
         two("2024-03-05T22:00:00Z"), event("bad", created_at="nope")],
    )
    land("2024-03-06-1", [event("b", created_at="2024-03-06T01:00:00Z")])
    land("2024-03-08-1", [event("c", created_at="2024-03-08T01:00:00Z"), two("2024-03-08T01:30:00Z")], hours=1)


FIRST = [("a", 5), ("b", 6), ("c", 8), ("far", 1), ("stray", 6), ("two", 5)]
SECOND = [("a", 5), ("b", 6), ("c", 8), ("two", 8)]


def state(spark, lake):
    stored = [(k, d.day) for k, d in rows(read_silver(spark, lake), "event_id", "event_day")]
    counts = {d.day: n for d, n in rows(read_gold(spark, lake)["event_type_daily"], "event_day", "event_count")}
    assert counts == {d: sum(x == d for _, x in stored) for d in {x for _, x in stored}}
    return stored


class Died(Exception):
    pass


@pytest.mark.parametrize(
    ("module", "name", "at_call"),
    [
        (silver, "overwrite_partitions", 1),  # the touched days are noted, the pairs are still the old ones
        (ids, "replace_days", 1),
        (ids, "later_copies", 1),
        (intents, "tick_off", 2),  # silver is rebuilt and gold noted
        (gold, "build_days", 1),
    ],
)
def test_a_run_that_dies_is_finished_by_the_next(spark, lake, land, monkeypatch, module, name, at_call):
    first_state(land)
    backfill.refresh(spark, lake)
    assert state(spark, lake) == FIRST
    assert rows(read_bad_rows(spark, lake), "event_id") == [("bad",)]
    land("2024-03-05-23", [event("a")], hours=2)  # takes its other rows back; the copy of the 8th is the first now
    calls, real = [], getattr(module, name)

    def dies(*args, **kwargs):
        calls.append(name)
        if len(calls) == at_call:
            raise Died
        return real(*args, **kwargs)

    with monkeypatch.context() as patched:
        patched.setattr(module, name, dies)
        with pytest.raises(Died):
            backfill.refresh(spark, lake)
    backfill.refresh(spark, lake)
    assert state(spark, lake) == SECOND
    assert read_bad_rows(spark, lake).isEmpty()
    assert all(not intents.pending(spark, lake, step) for step in (intents.DATE, intents.SILVER, intents.GOLD))
    assert backfill.refresh(spark, lake) == []


def test_landed_hours_reach_silver_though_nobody_refreshed(spark, lake, land):
    land("2024-03-05-10", [event("a")])
    land("2024-03-05-11", [event("b")])
    assert backfill.refresh(spark, lake) == [day("2024-03-05")]
    assert rows(read_silver(spark, lake), "event_id") == [("a",), ("b",)]


def test_an_id_survives_once_over_all_days(spark, lake, land):
    land("2024-03-08-1", [event("c", created_at="2024-03-08T01:00:00Z"), two("2024-03-08T01:30:00Z")], hours=5)
    backfill.refresh(spark, lake)
    assert state(spark, lake) == [("c", 8), ("two", 8)]
    # an earlier copy arrives later, in a file of another date: the day that loses its copy is rebuilt too
    land("2024-03-05-23", [event("a"), two("2024-03-05T22:00:00Z")], hours=1)
    assert backfill.refresh(spark, lake) == [day("2024-03-05"), day("2024-03-08")]
    assert state(spark, lake) == [("a", 5), ("c", 8), ("two", 5)]
    # a change elsewhere leaves the other days alone
    land("2024-03-08-2", [event("d", created_at="2024-03-08T02:00:00Z")], hours=6)
    assert backfill.refresh(spark, lake) == [day("2024-03-08")]
    assert state(spark, lake) == [("a", 5), ("c", 8), ("d", 8), ("two", 5)]
    assert rows(ids.read_ids(spark, lake), "event_id", "event_day") == [
        ("a", day("2024-03-05")), ("c", day("2024-03-08")), ("d", day("2024-03-08")),
        ("two", day("2024-03-05")), ("two", day("2024-03-08")),
    ]


def test_a_rebuild_of_all_days_gives_the_same_rows(spark, lake, land):
    first_state(land)
    backfill.refresh(spark, lake)
    backfill.rebuild(spark, lake, day("2024-03-01"), day("2024-03-08"))
    assert state(spark, lake) == FIRST


def test_joins_on_the_id_read_the_index_as_it_lies(spark, lake, land):
    first_state(land)
    backfill.refresh(spark, lake)
    spark.catalog.clearCache()
    some = spark.createDataFrame([("two",)], "event_id string")
    plan = ids.read_ids(spark, lake).join(some.hint("merge"), "event_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and f"SelectedBucketsCount: {lake.id_buckets}" in plan


def test_log_is_emptied_of_days_that_are_done(spark, tmp_path):
    lake = Lake(str(tmp_path / "log"))
    entries = intents.note(spark, lake, intents.GOLD, [day("2024-03-05"), day("2024-03-06")])
    intents.tick_off(spark, lake, entries[:1])
    tomorrow = dt.datetime.now(dt.timezone.utc).date() + dt.timedelta(days=1)
    assert intents.tidy(spark, lake, tomorrow) == []
    assert intents.days_of(intents.pending(spark, lake, intents.GOLD)) == {day("2024-03-06")}
    intents.tick_off(spark, lake, entries[1:])
    assert intents.tidy(spark, lake, tomorrow) == [entries[0]["noted_on"]]
    assert intents.tidy(spark, lake, tomorrow) == [] == intents.pending(spark, lake, intents.GOLD)
