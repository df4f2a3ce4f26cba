"""Published versions of gold for readers.

Days of a gold table are published as immutable folders. A manifest names, for each table and day, the
folder that holds it; a publication copies the days whose gold files changed since the manifest before,
writes its own manifest, checks it, and only then appends one row to the pointer log. Readers follow the
newest pointer, so they never see a partial publication, and an unchanged day is stored once.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tidelake.operators.quality import require_non_empty
from tidelake.schemas import GOLD_TABLES, POINTER_SCHEMA
from tidelake.sources.lake import Lake, only, read_table, remove, side_by_side

#: ``files`` stands for the names, sizes and times of the gold files that a folder was copied from.
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("event_day", T.DateType()),
        T.StructField("version", T.StringType()),
        T.StructField("files", T.LongType()),
    ]
)


class NothingPublished(RuntimeError):
    pass


def _data(lake: Lake, table: str) -> str:
    return lake.path("snapshots", "data", table)


def _manifest(lake: Lake, snapshot: str) -> str:
    return lake.path("snapshots", "manifests", f"snapshot={snapshot}")


def _pointers(lake: Lake) -> str:
    return lake.path("snapshots", "pointers")


def gold_files(spark: SparkSession, lake: Lake) -> DataFrame:
    """``table_name, event_day, files``: one value for the files of each gold day; no file is opened."""
    try:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(lake.path("gold"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "table_name string, event_day date, files bigint")
    named = listed.select(
        F.regexp_extract("path", "/gold/([^/]+)/event_day=", 1).alias("table_name"),
        F.to_date(F.regexp_extract("path", "/event_day=([0-9-]+)/", 1)).alias("event_day"),
        F.xxhash64(F.regexp_extract("path", "([^/]+)$", 1), "length", "modificationTime").alias("file"),
    )
    return named.groupBy("table_name", "event_day").agg(F.bit_xor("file").alias("files"))


def publish(spark: SparkSession, lake: Lake, at: dt.datetime | None = None) -> str:
    """Publish gold as it is now; raises without publishing if a table is empty.

    What reaches the driver is one row per table and day.
    """
    stamp = at or dt.datetime.now(dt.timezone.utc)
    snapshot = f"{stamp:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    before = _current(spark, lake)
    old = {(r["table_name"], r["event_day"]): r for r in _entries(spark, lake, before)} if before else {}
    now = {(r["table_name"], r["event_day"]): r["files"] for r in gold_files(spark, lake).collect()}
    kept = [tuple(old[k]) for k, files in now.items() if k in old and old[k]["files"] == files]
    changed = {t: [d for (name, d), files in now.items() if name == t and ((t, d) not in old or old[t, d]["files"] != files)] for t in GOLD_TABLES}
    added: list[tuple] = []

    def copy(table: str, days: list[dt.date]) -> None:
        schema = GOLD_TABLES[table].schema(table)
        rows = only(read_table(spark, lake.gold(table), schema), "event_day", days)
        place = f"{_data(lake, table)}/version={snapshot}"
        rows.hint("rebalance", F.col("event_day")).write.partitionBy("event_day").parquet(place)
        held = read_table(spark, place, schema).select("event_day").distinct().collect()
        added.extend((table, r["event_day"], snapshot, now[table, r["event_day"]]) for r in held)

    side_by_side(partial(copy, t, days) for t, days in changed.items() if days)
    spark.createDataFrame([*kept, *added], MANIFEST_SCHEMA).coalesce(1).write.parquet(_manifest(lake, snapshot))
    require_non_empty(open_snapshot(spark, lake, snapshot))
    pointer = spark.range(1).select(F.lit(snapshot).alias("snapshot"), F.lit(stamp.isoformat()).cast("timestamp").alias("published_at"))
    pointer.write.mode("append").parquet(_pointers(lake))
    return snapshot


def _entries(spark: SparkSession, lake: Lake, snapshot: str) -> list:
    return read_table(spark, _manifest(lake, snapshot), MANIFEST_SCHEMA).collect()


def _folder(lake: Lake, table: str, version: str, day: dt.date) -> str:
    return f"{_data(lake, table)}/version={version}/event_day={day}"


def open_snapshot(spark: SparkSession, lake: Lake, snapshot: str) -> dict[str, DataFrame]:
    """The tables of a publication; only the folders that its manifest names are listed."""
    folders: dict[str, list[str]] = {t: [] for t in GOLD_TABLES}
    for r in _entries(spark, lake, snapshot):
        folders[r["table_name"]].append(_folder(lake, r["table_name"], r["version"], r["event_day"]))

    def read(table: str) -> DataFrame:
        schema = GOLD_TABLES[table].schema(table)
        if not folders[table]:
            return spark.createDataFrame([], schema)
        stored = spark.read.schema(schema).option("basePath", _data(lake, table)).parquet(*sorted(folders[table]))
        return stored.select(*schema.fieldNames())

    return {t: read(t) for t in GOLD_TABLES}


def _current(spark: SparkSession, lake: Lake) -> str | None:
    newest = read_table(spark, _pointers(lake), POINTER_SCHEMA).agg(
        F.max_by("snapshot", F.struct("published_at", "snapshot")).alias("snapshot")
    )
    return newest.first()["snapshot"]


def current(spark: SparkSession, lake: Lake) -> str:
    """Id of the newest publication: one row to the driver."""
    snapshot = _current(spark, lake)
    if snapshot is None:
        raise NothingPublished(f"no snapshot under {lake.snapshots}")
    return snapshot


def open_current(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """Gold as last published, ready for the dashboard queries."""
    return open_snapshot(spark, lake, current(spark, lake))


def expire(spark: SparkSession, lake: Lake, keep: int = 3) -> int:
    """Delete the manifests of all but the newest ``keep`` publications, and the folders that no kept one names.

    Returns the number of folders deleted. Readers that opened an expired publication lose it.
    """
    pointers = read_table(spark, _pointers(lake), POINTER_SCHEMA).orderBy(F.desc("published_at"), F.desc("snapshot")).collect()
    names = list(dict.fromkeys(r["snapshot"] for r in pointers))

    def reached(snapshots: list[str]) -> set[str]:
        return {_folder(lake, r["table_name"], r["version"], r["event_day"]) for s in snapshots for r in _entries(spark, lake, s)}

    spent = reached(names[keep:]) - reached(names[:keep])
    for folder in sorted(spent):
        remove(spark, folder)
    for snapshot in names[keep:]:
        remove(spark, _manifest(lake, snapshot))
    return len(spent)
