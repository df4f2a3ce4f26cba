"""One line per parsing rule, and the rules for duplicates, rejected lines and the ledger."""

import datetime as dt

import pytest

from conftest import day, event, rows
from tidelake.operators.dedup import first_per_file
from tidelake.operators.flatten import bad_lines, flatten_lines, good_lines
from tidelake.operators.quality import missing_columns
from tidelake.plans import bronze
from tidelake.schemas import BRONZE_COLUMNS, BRONZE_SCHEMA, BRONZE_TABLE_SCHEMA
from tidelake.sources import raw as raw_source
from tidelake.sources.lake import read_bad_lines, read_bronze, read_ledger

AT = dt.datetime(2024, 3, 5, 12, tzinfo=dt.timezone.utc)


@pytest.fixture
def parse(spark, raw):
    def run(*lines, stamp="2024-03-05-10"):
        raw.write(stamp, list(lines))
        return flatten_lines(raw_source.scan_lines(spark, str(raw.folder)), AT)

    return run


def one(flat, *columns):
    (row,) = good_lines(flat).select(*columns).collect()
    return tuple(row)


def test_all_columns_of_a_full_event(parse):
    line = event(
        "11",
        type="PullRequestEvent",
        repo="acme/one",
        org={"id": "5", "login": "acme"},
        actor={"id": 9, "login": "ann", "type": "User"},
        payload={
            "size": 3,
            "distinct_size": 2,
            "ref": "refs/heads/main",
            "action": "opened",
            "pull_request": {"user": {"login": "bob"}},
        },
    )
    line["repo"].update({"language": "Go", "created_at": "2020-01-01T00:00:00Z", "owner": "unused"})
    assert one(parse(line), *BRONZE_COLUMNS) == (
        "11", "PullRequestEvent", "2024-03-05T10:15:30Z", 7, "acme/one", "acme", 5, "acme", 9, "ann", "User", 3, 2,
        "refs/heads/main", "opened", "bob", None, "Go", "2020-01-01T00:00:00Z", AT.isoformat(),
        "2024-03-05-10.json.gz",
    )


def test_bronze_has_the_required_columns(parse):
    flat = parse(event("1"))
    assert missing_columns(flat.select(*BRONZE_COLUMNS), BRONZE_SCHEMA) == []
    assert missing_columns(flat.drop("repo_id"), BRONZE_SCHEMA) == ["repo_id"]


def by_case(flat, column):
    """Column values of lines whose ids are running numbers, in that order."""
    found = good_lines(flat).select("event_id", column).collect()
    return [v for _, v in sorted((int(i), v) for i, v in found)]


def test_whole_numbers_are_lenient(parse):
    cases = [
        (7, 7), ("7", 7), (8.9, 8), (-8.9, -8), ("8.9", None), (" 12 ", 12), (True, 1), (None, None), ("x", None),
        ("", None), ([1], None), ({"a": 1}, None), ("+5", 5), (10**20, None),
    ]
    flat = parse(*[event(str(i), repo={"id": value}) for i, (value, _) in enumerate(cases)])
    assert by_case(flat, "repo_id") == [expected for _, expected in cases]


def test_repo_owner(parse):
    cases = [
        ("acme/one", "own", "acme"), ("/x", "own", "own"), ("/x", None, None), ("noslash", None, None),
        ("noslash", "own", "own"), ("a/b/c", None, "a"), (None, "own", "own"), ("", "own", "own"),
    ]
    flat = parse(*[event(str(i), repo={"name": n, "owner": o}) for i, (n, o, _) in enumerate(cases)])
    assert by_case(flat, "repo_owner") == [expected for _, _, expected in cases]


def test_watch_action_only_for_watch_events(parse):
    watch = event("1", type="WatchEvent", payload={"action": "started"})
    other = event("2", type="IssuesEvent", payload={"action": "opened"})
    found = rows(good_lines(parse(watch, other)), "payload_action", "watch_action")
    assert found == [("opened", None), ("started", "started")]


def test_steps_that_are_not_objects_give_nulls(parse):
    line = event("1", org=None, payload=[1], actor="text")
    assert one(parse(line), "org_id", "org_login", "payload_size", "actor_login") == (None, None, None, None)


def test_numeric_ids_become_text(parse):
    assert one(parse(event(12345678901)), "event_id") == ("12345678901",)


def test_repeated_key_keeps_the_last(parse):
    assert one(parse('{"id":"1","type":"A","type":"B"}'), "event_type") == ("B",)


def test_unusual_text_survives(parse):
    assert one(parse(event("1", login='a"b\\c ü 🚀 ', repo="x/y")), "actor_login") == ('a"b\\c ü 🚀 ',)


def test_rejected_lines(parse):
    cases = [
        ("{bad json", "bad_json"), ("", "bad_json"), ("   ", "bad_json"), ('{"id":"1"} x', "bad_json"),
        ('{"id":"1"}{"id":"2"}', "bad_json"), ('{"id":"1"},{"id":"2"}', "bad_json"), ('{"id":"1"}] x', "bad_json"),
        ('{"id":NaN}', "bad_json"), ("[1,2]", "not_an_object"), ("null", "not_an_object"), ('"x"', "not_an_object"),
        ("17", "not_an_object"),
    ]
    flat = parse(event("ok"), *[line for line, _ in cases])
    assert rows(good_lines(flat), "event_id") == [("ok",)]
    assert rows(bad_lines(flat), "line", "reason") == sorted(cases, key=repr)


def test_surrounding_white_space_is_fine(parse):
    assert one(parse(' \t{"id":"1"}  '), "event_id") == ("1",)


def test_file_without_hour_is_rejected(parse):
    flat = parse(event("1"), stamp="notes")
    assert rows(bad_lines(flat), "reason", "date", "hour") == [("no_file_hour", None, None)]


def test_first_line_of_an_id_survives(parse):
    lines = [event(str(i % 50), payload={"size": i}) for i in range(5000)]
    kept = first_per_file(parse(*lines))
    assert rows(kept, "payload_size") == sorted([(i,) for i in range(50)], key=repr)


def test_first_line_survives_in_a_file_that_is_split(spark, raw):
    lines = [event(str(i % 7), payload={"size": i, "ref": "x" * 200}) for i in range(3000)]
    raw.write("2024-03-05-10", lines, suffix=".json")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        scanned = raw_source.scan_lines(spark, str(raw.folder))
        assert scanned.rdd.getNumPartitions() > 4
        kept = first_per_file(flatten_lines(scanned, AT))
        assert rows(kept, "payload_size") == [(i,) for i in range(7)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_lines_without_id_are_all_kept(parse):
    flat = parse(event(None), event(None), event(""), event(""), event("1"), event("1"))
    assert len(rows(first_per_file(flat), "event_id")) == 5


def test_dedup_limits_rows_before_the_shuffle(parse):
    plan = first_per_file(parse(event("1")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_landing_writes_partitions_quarantine_and_ledger(spark, lake, raw):
    raw.write("2024-03-05-9", [event("1"), event("2"), event("1"), "{bad", event(None)])
    raw.write("2024-03-05-10", [event("2"), event("3")])
    raw.write("2024-03-06-0", ["[1]"])
    raw.write("2024-03-06-1", [])
    found = bronze.ingest_hours(spark, lake, str(raw.folder), as_of=dt.datetime(2024, 3, 6, 2, 30), hours_back=24)
    assert found == [day("2024-03-05"), day("2024-03-06")]

    stored = read_bronze(spark, lake)
    assert stored.schema == BRONZE_TABLE_SCHEMA
    assert rows(stored, "date", "hour", "event_id") == rows(
        spark.createDataFrame(
            [("2024-03-05", "9", "1"), ("2024-03-05", "9", "2"), ("2024-03-05", "9", None), ("2024-03-05", "10", "2"),
             ("2024-03-05", "10", "3")],
            "d string, h string, id string",
        ).selectExpr("cast(d as date)", "h", "id")
    )
    assert (lake.bronze and (raw.folder.parent / "lake/bronze/events/date=2024-03-05/hour=9").is_dir())
    assert rows(read_bad_lines(spark, lake), "reason", "line") == [("bad_json", "{bad"), ("not_an_object", "[1]")]
    entries = rows(read_ledger(spark, lake), "date", "hour", "rows", "duplicates", "bad")
    assert entries == sorted(
        [
            (day("2024-03-05"), "9", 3, 1, 1),
            (day("2024-03-05"), "10", 2, 0, 0),
            (day("2024-03-06"), "0", 0, 0, 1),
            (day("2024-03-06"), "1", 0, 0, 0),
        ],
        key=repr,
    )


def test_hours_in_the_ledger_are_skipped(spark, lake, raw):
    raw.write("2024-03-05-9", [event("1")])
    now = dt.datetime(2024, 3, 5, 11, 20)
    assert bronze.ingest_hours(spark, lake, str(raw.folder), as_of=now) == [day("2024-03-05")]
    raw.write("2024-03-05-9", [event("changed")])
    raw.write("2024-03-05-10", [event("2")])
    assert bronze.ingest_hours(spark, lake, str(raw.folder), as_of=now) == [day("2024-03-05")]
    assert rows(read_bronze(spark, lake), "event_id") == [("1",), ("2",)]
    assert bronze.ingest_hours(spark, lake, str(raw.folder), as_of=now) == []


def test_incomplete_and_old_hours_are_left_out(spark, lake, raw):
    for stamp in ("2024-03-05-3", "2024-03-05-4", "2024-03-05-9", "2024-03-05-10"):
        raw.write(stamp, [event(stamp)])
    bronze.ingest_hours(spark, lake, str(raw.folder), as_of=dt.datetime(2024, 3, 5, 10, 59), hours_back=6)
    assert rows(read_bronze(spark, lake), "hour") == [("4",), ("9",)]


def test_landing_again_replaces_the_hour(spark, lake, raw):
    raw.write("2024-03-05-9", [event("1"), event("2")])
    raw.write("2024-03-05-10", [event("3")])

    def land(at):
        return bronze.land_lines(raw_source.scan_lines(spark, str(raw.folder)), lake, at, "test")

    land(AT)
    raw.write("2024-03-05-9", ["{broken"])
    land(AT + dt.timedelta(hours=1))
    assert rows(read_bronze(spark, lake), "event_id") == [("3",)]
    from tidelake.sources.ledger import latest_entries

    assert rows(latest_entries(read_ledger(spark, lake)), "hour", "rows", "duplicates", "bad") == [
        ("10", 1, 0, 0),
        ("9", 0, 0, 1),
    ]
