"""Command line for the lake's jobs: ``python -m tidelake <job> --lake <folder> ...``."""

from __future__ import annotations

import argparse
import datetime as dt

from tidelake.plans import backfill, bronze, checks, dashboard, gold, silver
from tidelake.session import build_session
from tidelake.sources import catalog, snapshot
from tidelake.sources.lake import Lake
from tidelake.streaming import ingest

QUERIES = {
    "summary": dashboard.summary,
    "event-types": dashboard.event_types,
    "event-types-daily": dashboard.event_type_series,
    "top-push-users": dashboard.top_push_users,
    "top-pr-orgs": dashboard.top_pr_orgs,
    "top-pr-repos": dashboard.top_pr_repos,
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidelake")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, help: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=help)
        sub.add_argument("--lake", required=True, help="root folder of the lake")
        return sub

    day, stamp = dt.date.fromisoformat, dt.datetime.fromisoformat
    sub = job("ingest", "land expected hours that have a raw file")
    sub.add_argument("--raw", required=True)
    sub.add_argument("--start-from", type=stamp)
    sub.add_argument("--hours-back", type=int, default=6)
    sub.add_argument("--retention-days", type=int, default=150)
    sub = job("stream", "land every new raw file and refresh silver and gold")
    sub.add_argument("--raw", required=True)
    sub.add_argument("--checkpoint", required=True)
    sub.add_argument("--max-files", type=int, default=64, help="raw files per batch")
    sub.add_argument("--every", help=f"keep running at this pace, for example '{ingest.TICK}'")
    job("refresh", "carry landed hours, and what earlier runs left open, through silver and gold")
    job("silver", "take changed file dates into silver").add_argument("--date", type=day, required=True)
    job("gold", "recompute gold for an event day").add_argument("--date", type=day, required=True)
    sub = job("rebuild", "replay a range of event days from bronze")
    sub.add_argument("--first", type=day, required=True)
    sub.add_argument("--last", type=day, required=True)
    job("publish", "publish gold for readers")
    job("check", "quality report of one event day").add_argument("--date", type=day, required=True)
    job("lag", "newest hour per layer")
    job("tables", "create or repair SQL tables and views")
    sub = job("query", "run a dashboard query on the published snapshot")
    sub.add_argument("name", choices=QUERIES)
    sub.add_argument("--preset", default="7d", choices=dashboard.PRESETS)
    sub.add_argument("--limit", type=int, default=10)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark, lake = build_session(f"tidelake-{args.job}"), Lake(args.lake)
    if args.job == "ingest":
        dates = bronze.ingest_hours(
            spark, lake, args.raw, start_from=args.start_from, hours_back=args.hours_back,
            retention_days=args.retention_days,
        )
        print(*dates)
    elif args.job == "stream":
        if args.every:
            ingest.start(spark, lake, args.raw, args.checkpoint, args.max_files, every=args.every).awaitTermination()
        else:
            ingest.ingest_available(spark, lake, args.raw, args.checkpoint, args.max_files)
    elif args.job == "refresh":
        print(*backfill.refresh(spark, lake))
    elif args.job == "silver":
        print(*silver.process_dates(spark, lake, [args.date]))
    elif args.job == "gold":
        gold.build_days(spark, lake, [args.date])
    elif args.job == "rebuild":
        backfill.rebuild(spark, lake, args.first, args.last)
    elif args.job == "publish":
        print(snapshot.publish(spark, lake))
    elif args.job == "check":
        checks.day_report(spark, lake, args.date).show(100, truncate=False)
    elif args.job == "lag":
        checks.layer_lag(spark, lake).show(truncate=False)
    elif args.job == "tables":
        catalog.create_tables(spark, lake)
        catalog.repair_tables(spark, lake)
        catalog.create_views(spark)
    else:
        extra = {"limit": args.limit} if args.name.startswith("top-") else {}
        rows = QUERIES[args.name](snapshot.open_current(spark, lake), args.preset, **extra)
        for row in rows.toLocalIterator():
            print(*row, sep="\t")


if __name__ == "__main__":
    main()
