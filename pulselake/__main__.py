"""Command line:

    python -m pulselake ingest --root R [--users CSV] [--activities CSV] [--events DIR --checkpoint C]
    python -m pulselake refresh --root R [--since YYYY-MM-DD | --arrived-since YYYY-MM-DD]
"""

from __future__ import annotations

import argparse
import datetime

from pulselake.plans import refresh
from pulselake.registry import Lake
from pulselake.session import build_session
from pulselake.sources import ingest


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="pulselake")
    commands = top.add_subparsers(dest="command", required=True)
    load = commands.add_parser("ingest", help="load raw files into bronze")
    load.add_argument("--users")
    load.add_argument("--activities")
    load.add_argument("--events")
    load.add_argument("--checkpoint")
    load.add_argument("--look-back", help="leave out event files older than the newest loaded one by more, e.g. 3d")
    load.add_argument("--archive", help="directory that loaded event files are moved to")
    build = commands.add_parser("refresh", help="build silver and gold")
    build.add_argument("--since", type=datetime.date.fromisoformat,
                       help="only the days from this one on; without it, everything")
    build.add_argument("--arrived-since", type=datetime.date.fromisoformat,
                       help="only the days of the readings that arrived from this day on")
    for command in (load, build):
        command.add_argument("--root", required=True)
        command.add_argument("--master")
    return top


def run(lake: Lake, args: argparse.Namespace) -> None:
    if args.command == "ingest":
        if args.users:
            ingest.load_users(lake, args.users)
        if args.activities:
            ingest.load_activities(lake, args.activities)
        if args.events:
            ingest.load_events(lake, args.events, args.checkpoint or f"{lake.root}/checkpoints/events",
                               args.look_back, args.archive)
    elif args.since or args.arrived_since:
        refresh.incremental_refresh(lake, args.since, args.arrived_since)
    else:
        refresh.full_refresh(lake)


def main() -> None:
    args = parser().parse_args()
    spark = build_session("pulselake", args.master)
    run(Lake(spark, args.root), args)
    spark.stop()


if __name__ == "__main__":
    main()
