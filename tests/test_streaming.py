"""The stream lands every file once and ends with the tables the batch plans give."""

import datetime as dt
import random
from pathlib import Path

import pytest

from conftest import day, event, rows
from tidelake.plans import backfill, bronze
from tidelake.schemas import GOLD_TABLES, QUARANTINE_SCHEMA
from tidelake.sources import raw as raw_source
from tidelake.sources.lake import Lake, read_bronze, read_gold, read_ledger, read_silver
from tidelake.streaming import ingest, live

STABLE = [c for c in QUARANTINE_SCHEMA.fieldNames() if c not in ("ingest_ts", "event_day", "reason")]


def fill(raw, hours, d=5):
    for h in hours:
        lines = [
            event(
                f"{d}-{h}-{i % 12}",
                created_at=f"2024-03-0{d}T{h:02d}:{i % 12:02d}:00Z",
                type=["PushEvent", "PullRequestEvent"][i % 2],
                org={"id": 1, "login": "acme"},
            )
            for i in range(15)
        ]
        raw.write(f"2024-03-0{d}-{h}", lines)


def test_stream_equals_batch(spark, lake, raw, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    fill(raw, [0, 1, 2])
    raw.write("2024-03-05-3", [])
    ingest.ingest_available(spark, lake, str(raw.folder), checkpoint, max_files=2)
    fill(raw, [22, 23])
    # a row eight hours behind the newest one, in a file of its own
    raw.write("2024-03-05-21", [event("late", created_at="2024-03-04T16:00:00Z")])
    ingest.ingest_available(spark, lake, str(raw.folder), checkpoint)
    landed = read_ledger(spark, lake)
    assert rows(landed, "hour", "rows", "duplicates") == [
        ("0", 12, 3), ("1", 12, 3), ("2", 12, 3), ("21", 1, 0), ("22", 12, 3), ("23", 12, 3), ("3", 0, 0),
    ]
    before = rows(read_silver(spark, lake))
    ingest.ingest_available(spark, lake, str(raw.folder), checkpoint)
    assert read_ledger(spark, lake).count() == 7 and rows(read_silver(spark, lake)) == before

    late = spark.read.parquet(lake.late_rows)
    assert rows(late, "event_id", "reason") == [("late", "late")]
    assert rows(read_silver(spark, lake, [day("2024-03-04")]), "event_id") == [("late",)]

    other = Lake(str(tmp_path / "batch"))
    now = dt.datetime(2024, 3, 6, tzinfo=dt.timezone.utc)
    dates = bronze.land_lines(raw_source.scan_lines(spark, str(raw.folder)), other, now, "batch")
    backfill.refresh(spark, other, dates)
    assert rows(read_bronze(spark, lake), *STABLE) == rows(read_bronze(spark, other), *STABLE)
    for table in GOLD_TABLES:
        assert rows(read_gold(spark, lake)[table]) == rows(read_gold(spark, other)[table])


SCHEMA = "event_id string, event_type string, event_ts timestamp, ingest_ts string"


@pytest.fixture
def tick(spark, tmp_path):
    """Appends rows (id, type, time, ingest) to a source, one file each call, and lets the stream take them."""

    def run(*events, out="out"):
        data = [(i, kind, dt.datetime.fromisoformat(t).replace(tzinfo=dt.timezone.utc), at) for i, kind, t, at in events]
        source = str(tmp_path / f"in-{out}")
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        live.take_available(stream, str(tmp_path / out), str(tmp_path / f"checkpoint-{out}"))
        return str(tmp_path / out)

    return run


def kept(spark, out):
    return rows(live.events(spark, out).selectExpr("event_id", "event_type", "string(event_ts)"))


def counts(spark, out):
    return rows(live.hourly_type_counts(spark, out).selectExpr("string(event_hour_ts)", "event_type", "event_count"))


def test_live_keeps_late_rows_and_takes_counts_back(spark, tick):
    out = tick(*[("hot", "A", "2024-03-05 10:01", "2")] * 40, ("a", "A", "2024-03-05 10:05", "2"))
    assert counts(spark, out) == [("2024-03-05 10:00:00", "A", 2)]
    tick(("b", "A", "2024-03-05 18:00", "2"), ("hot", "A", "2024-03-05 10:01", "2"))
    # late rows; an earlier copy of one id on another day, with another type; a later copy of another id
    tick(("c", "B", "2024-03-05 11:00", "3"), ("a", "B", "2024-03-04 09:00", "1"), ("b", "A", "2024-03-06 18:00", "4"))
    expected = [("a", "B", "2024-03-04 09:00:00"), ("b", "A", "2024-03-05 18:00:00"), ("c", "B", "2024-03-05 11:00:00"), ("hot", "A", "2024-03-05 10:01:00")]
    assert kept(spark, out) == expected
    sums = [("2024-03-04 09:00:00", "B", 1), ("2024-03-05 10:00:00", "A", 1), ("2024-03-05 11:00:00", "B", 1), ("2024-03-05 18:00:00", "A", 1)]
    assert counts(spark, out) == sums
    late = spark.read.parquet(f"{out}/late_rows")
    assert rows(late, "event_id") == [("a",), ("c",)]
    # merging batches changes nothing, neither for readers nor for batches that follow or are repeated
    assert live.fold(spark, out) == 2 == live.fold(spark, out)
    assert kept(spark, out) == expected and counts(spark, out) == sums
    live.land(spark.createDataFrame([("c", "B", dt.datetime(2024, 3, 5, 11), "3")], SCHEMA), 2, out)
    tick(("c", "B", "2024-03-05 11:00", "3"), ("d", "A", "2024-03-05 18:30", "3"))
    assert kept(spark, out) == [*expected[:3], ("d", "A", "2024-03-05 18:30:00"), expected[3]]
    assert live.fold(spark, out) == 3
    assert counts(spark, out) == [*sums[:3], ("2024-03-05 18:00:00", "A", 2)]


def test_number_of_batches_does_not_matter(spark, tick):
    rng = random.Random(6)
    rows_ = [(str(rng.randrange(60)), rng.choice("AB"), f"2024-03-0{rng.randint(4, 6)} {rng.randrange(24):02d}:00", str(rng.randrange(5))) for _ in range(240)]
    found = []
    for n in (1, 3, 8):
        for k in range(n):
            out = tick(*rows_[k::n], out=f"out{n}")
        found.append((kept(spark, out), counts(spark, out)))
    assert found[0] == found[1] == found[2]
    first = {}
    for i, kind, t, at in rows_:
        first[i] = min(first.get(i, (at, t, kind)), (at, t, kind))
    assert [(i, kind, t[:16]) for i, kind, t in found[0][0]] == sorted((i, kind, t) for i, (_, t, kind) in first.items())


def test_a_small_batch_writes_little(spark, tick):
    out = tick(*[(f"{k:05d}", "A", "2024-03-05 10:00", "1") for k in range(5000)])
    tick(("new", "A", "2024-03-05 10:00", "1"), ("00007", "A", "2024-03-05 10:00", "1"))

    def size(batch):
        return sum(f.stat().st_size for log in ("winners", "deltas") for f in Path(out, log, f"batch_id={batch}").rglob("*.parquet"))

    assert size(1) < 0.1 * size(0)
    assert not Path(out, "rows", "batch_id=1").exists()


def test_a_repeated_batch_finds_the_same_late_rows(spark, lake, raw):
    raw.write("2024-03-05-22", [event("new", created_at="2024-03-05T22:00:00Z")])
    raw.write("2024-03-05-23", [event("late", created_at="2024-03-05T02:00:00Z")])
    batches = [raw_source._with_origin(spark.read.text(str(raw.folder / f"2024-03-05-{h}.json.gz"))) for h in (22, 23)]
    ingest._land(batches[0], 0, lake)
    for _ in range(2):
        ingest._land(batches[1], 1, lake)
        assert rows(spark.read.parquet(lake.late_rows), "event_id") == [("late",)]
    ingest._land(batches[0], 0, lake)  # gold is ahead by now; the batch is still not late
    assert rows(spark.read.parquet(lake.late_rows), "event_id") == [("late",)]
