"""Times the lake's jobs and queries; prints one JSON line.

The given ``events`` table is turned into bronze rows and raw lines. ``lake_*`` are the real jobs
on stored tables; the dashboard and metric queries then read what those jobs published. ``adhoc_*``
run registered queries straight from the events table, with every layer in one plan.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import registry  # noqa: E402
from tidelake.operators import flatten, metrics, quality  # noqa: E402
from tidelake.operators.dedup import first_per_file  # noqa: E402
from tidelake.plans import backfill, dashboard, gold, silver  # noqa: E402
from tidelake.schemas import ENTITIES  # noqa: E402
from tidelake.session import build_session, scratch_dir  # noqa: E402
from tidelake.sources import lake as store  # noqa: E402
from tidelake.sources import sample, snapshot  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ADHOC = (
    "bronze_from_json silver_events gold_event_type_hourly gold_hourly_cube gold_push_user_daily summary_7d "
    "top_push_users_7d top_pr_repos_30d dq_silver_report rolling_30d dod_change stream_event_type_hourly"
).split()


def main() -> None:
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    home = store.Lake(scratch_dir(spark, "bench"))
    seconds: dict[str, float] = {}

    def timed(name, action):
        began = time.perf_counter()
        result = action()
        seconds[name] = round(time.perf_counter() - began, 3)
        return result

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    events = sample.events_table(spark, SF_DIR)
    run(events)  # the first job also pays for starting up

    # Inputs of the jobs under test; storing them is not what is measured.
    lines_path = home.path("input", "lines")
    sample.raw_lines(events).repartition(int(CPUS)).write.parquet(lines_path)
    store.overwrite_partitions(sample.bronze_rows(events), home.bronze, ["date", "hour"])
    bounds = events.agg(F.date_sub(F.min("ts"), 2).alias("lo"), F.date_add(F.max("ts"), 2).alias("hi")).first()
    days = backfill.days_between(bounds["lo"], bounds["hi"])

    def flatten_and_dedup():
        flatten.flatten_lines(spark.read.parquet(lines_path), registry.INGEST_AT).write.parquet(home.staging("bench"))
        run(flatten.good_lines(first_per_file(spark.read.parquet(home.staging("bench")))))

    timed("lake_lines_to_bronze", flatten_and_dedup)
    timed("lake_bronze_to_silver", lambda: silver.process_dates(spark, home, days))
    timed("lake_silver_to_gold", lambda: gold.build_days(spark, home, days))
    timed("lake_publish", lambda: snapshot.publish(spark, home))

    def published():
        return snapshot.open_current(spark, home)

    for name, fn in registry.DASHBOARD.items():
        for preset in ("24h", "7d", "max"):
            timed(f"{name}_{preset}", lambda fn=fn, p=preset: run(fn(published(), p, as_of=registry.AS_OF)))
    rows = store.read_silver(spark, home)
    tables = published()
    types = ENTITIES["event_type"]
    timed("view_top_push_users_30d", lambda: run(dashboard.trailing_totals(tables, ENTITIES["push_user"], 30, registry.AS_OF.date())))
    timed("dq_silver_report", lambda: run(quality.silver_report(rows)))
    timed("dq_gold_reconciliation_by_day", lambda: run(quality.reconciliation_by_day(rows, tables[types.daily])))
    timed("dq_gold_nonempty", lambda: run(quality.row_counts(tables)))
    timed("repo_daily_activity", lambda: run(metrics.repo_daily_activity(rows)))
    timed("actor_daily_activity", lambda: run(metrics.actor_daily_activity(rows)))
    timed("rolling_7d", lambda: run(metrics.rolling(tables[types.daily], types.key, types.metric, 7)))
    timed("dod_change", lambda: run(metrics.day_over_day(tables[types.daily], types.key, types.metric)))
    timed("hoh_change", lambda: run(metrics.hour_over_hour(tables[types.hourly], types.key, types.metric)))

    for name in ADHOC:
        timed(f"adhoc_{name}", lambda n=name: run(registry.QUERIES[n](spark, SF_DIR)))

    print(
        json.dumps(
            {
                "metric": "total wall time of lake jobs and queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
