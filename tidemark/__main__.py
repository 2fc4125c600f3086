"""Command line: one sub-command per job, plus ``query`` for the named queries."""

from __future__ import annotations

import argparse

from tidemark import catalog, plans
from tidemark.forecast.events import HALVINGS
from tidemark.session import build_session
from tidemark.sources import stream_topic
from tidemark.sources.storage import sweep_scratch
from tidemark.streaming import fold_sinks, run_streams


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    parser.add_argument("--master", default=None)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, help: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=help)
        sub.add_argument("--root", required=True, help="folder that holds all tables")
        return sub

    convert = job("convert", "raw CSV to the bar table")
    given = convert.add_mutually_exclusive_group(required=True)
    given.add_argument("--source", action="append", metavar="SYMBOL=PATH")
    given.add_argument("--folder", help="CSV files of many series, each named by its file")
    convert.add_argument("--epoch-unit", choices=("s", "ms", "us"), required=True)
    job("clean", "unique, filled bars")
    job("daily", "daily bars, per-day counts, gaps")
    fill = job("fill", "full calendar, averages, reports")
    fill.add_argument("--volume-policy", choices=("zero", "carry"), default="zero")
    backfill = job("backfill", "landed kline pages behind the stored days")
    backfill.add_argument("--pages", required=True)
    backfill.add_argument("--as-of", required=True)
    job("merge", "batch and speed layer to the serving table")
    for name, text in (("speed-batch", "bounded topic read"), ("speed-stream", "continuous topic read")):
        speed = job(name, text)
        speed.add_argument("--servers", required=True)
        speed.add_argument("--topic", required=True)
        speed.add_argument("--volume-mode", choices=("sum", "last"), default="sum")
        if name == "speed-stream":
            speed.add_argument("--window", default="1 day")
            speed.add_argument("--delay", default="1 hour")
            speed.add_argument(
                "--stats",
                choices=("table", "snapshot", "memory"),
                default="table",
                help="changed windows per batch; all windows per batch; or all windows in driver memory, for few series only",
            )
            speed.add_argument("--replaces", action="store_true", help="a new checkpoint folder takes the place of earlier runs")
            speed.add_argument("--max-offsets-per-trigger", type=int, default=None, help="no limit unless given")
            speed.add_argument("--ignore-lost-offsets", action="store_true", help="go on where the broker has dropped data")
    job("compact", "fold the folders of the stream's sinks")
    sweep = jobs.add_parser("sweep", help="remove scratch folders below the checkpoint folder")
    sweep.add_argument("--older-than-hours", type=float, required=True, help="above the age of the longest job")
    train = job("train", "fit, choose, cross-validate, store")
    train.add_argument("--timing", choices=("lagged", "same_day"), default="lagged")
    query = jobs.add_parser("query", help="run a named query over a test-data folder")
    query.add_argument("name", choices=sorted(catalog.queries()))
    query.add_argument("folder")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"tidemark-{args.job}", args.master)
    if args.job == "query":
        catalog.queries()[args.name](spark, args.folder).show(20, truncate=False)
        return
    if args.job == "sweep":
        print("\n".join(sweep_scratch(spark, args.older_than_hours)))
        return
    layout = plans.Layout(args.root)
    if args.job == "convert" and args.folder:
        plans.convert_folder(spark, layout, args.folder, epoch_unit=args.epoch_unit)
    elif args.job == "convert":
        plans.convert(spark, layout, dict(s.split("=", 1) for s in args.source), args.epoch_unit)
    elif args.job == "clean":
        print(plans.clean(spark, layout))
    elif args.job == "daily":
        plans.daily(spark, layout)
    elif args.job == "fill":
        plans.fill(spark, layout, args.volume_policy)
    elif args.job == "backfill":
        plans.backfill(spark, layout, args.pages, args.as_of)
    elif args.job == "merge":
        print("merged with speed layer" if plans.merge(spark, layout) else "batch layer only")
    elif args.job == "speed-batch":
        plans.topic_to_daily(spark, layout, args.servers, args.topic, args.volume_mode)
    elif args.job == "speed-stream":
        raw = stream_topic(spark, args.servers, args.topic, args.max_offsets_per_trigger, not args.ignore_lost_offsets)
        plans.start_speed_layer(raw, layout, args.window, args.delay, stats=args.stats, volume_mode=args.volume_mode, replaces=args.replaces)
        run_streams(spark)
    elif args.job == "compact":
        print(fold_sinks(spark, layout.speed_sinks))
    elif args.job == "train":
        plans.train(spark, layout, HALVINGS, timing=args.timing)


if __name__ == "__main__":
    main()
