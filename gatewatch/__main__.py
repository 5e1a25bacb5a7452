"""Command line: ``python -m gatewatch {ingest,daily,backfill,refresh,fold-history,sla,quality,stream} ...``."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import date, datetime, timezone

from gatewatch import schemas
from gatewatch.config import PipelineConfig, RiskConfig, StreamConfig, TablePaths
from gatewatch.plans import changes, jobs, quality
from gatewatch.plans.history import fold_pairs, known_pairs
from gatewatch.session import build_session
from gatewatch.sources import tables as scans
from gatewatch.sources.logs import read_log
from gatewatch.streaming.pipeline import run


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="gatewatch")
    parser.add_argument("--base", required=True, help="base path of the lake tables")
    parser.add_argument("--risk", type=json.loads, default={}, help="rule settings as JSON, laid over the defaults")
    commands = parser.add_subparsers(dest="command", required=True)

    ingest = commands.add_parser("ingest", help="append log files to the raw table")
    ingest.add_argument("input")
    ingest.add_argument("--start-line", type=int, default=0)
    ingest.add_argument("--max-events", type=int)
    ingest.add_argument("--base-epoch", type=int, default=0)

    first, last = jobs.default_range()
    for name, text in (("daily", "refresh both rollups"), ("backfill", "rebuild curated days and rollups")):
        dated = commands.add_parser(name, help=text)
        dated.add_argument("--start-date", type=date.fromisoformat, default=first)
        dated.add_argument("--end-date", type=date.fromisoformat, default=last)

    commands.add_parser("refresh", help="build again what new raw files have changed, in all tables")
    commands.add_parser("fold-history", help="fold the stored history to one row per pair")

    levels = commands.add_parser("sla", help="list violated service levels")
    levels.add_argument("--start-date", type=date.fromisoformat, default=first)
    levels.add_argument("--end-date", type=date.fromisoformat, default=last)

    checks = commands.add_parser("quality", help="run a suite over the curated table")
    checks.add_argument("--suite", help="YAML or JSON file; the curated suite if left out")
    checks.add_argument("--markdown", action="store_true")

    stream = commands.add_parser("stream", help="run the streaming pipeline")
    stream.add_argument("--format", default="text")
    stream.add_argument("--path")
    stream.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")
    stream.add_argument("--payload-column", default="value")
    stream.add_argument("--payload-format", choices=("json", "csv"), default="json")
    stream.add_argument("--start-from", default="latest")
    stream.add_argument("--trigger-seconds", type=int, default=30)
    stream.add_argument("--watermark", default="5 minutes")
    stream.add_argument("--checkpoint", help="folder of the checkpoints; below the base path if left out")
    stream.add_argument("--state-ttl", help="forget a (user, host) pair that was idle for longer")
    stream.add_argument("--state-shards", type=int, default=256)
    stream.add_argument("--max-files-per-trigger", type=int)
    stream.add_argument("--max-offsets-per-trigger", type=int)
    stream.add_argument("--commit-delay", default="1 minute")
    stream.add_argument("--stored-history", action="store_true", help="seed a new query's state from the stored history")
    stream.add_argument("--trigger-once", action="store_true", help="process what there is, then end")
    return parser


def _stream_config(args: argparse.Namespace) -> StreamConfig:
    return StreamConfig(
        source_format=args.format,
        source_options=dict(pair.split("=", 1) for pair in args.option),
        source_path=args.path,
        payload_column=args.payload_column,
        payload_format=args.payload_format,
        start_from=args.start_from,
        trigger_seconds=args.trigger_seconds,
        trigger_once=args.trigger_once,
        watermark=args.watermark,
        checkpoint_location=args.checkpoint,
        state_ttl=args.state_ttl,
        state_shards=args.state_shards,
        max_files_per_trigger=args.max_files_per_trigger,
        max_offsets_per_trigger=args.max_offsets_per_trigger,
        commit_delay=args.commit_delay,
    )


def main(argv: list[str] | None = None) -> int:
    parser = _parser()
    args = parser.parse_args(argv)
    if getattr(args, "end_date", None) and args.end_date <= args.start_date:
        parser.error("the days asked for are none: the last must come after the first")
    tables, risk = TablePaths(args.base), RiskConfig.of(args.risk)
    spark = build_session()

    if args.command == "ingest":
        events = read_log(spark, args.input, args.start_line, args.max_events, args.base_epoch)
        jobs.ingest(events, tables)
    elif args.command == "daily":
        jobs.run_daily(spark, tables, args.start_date, args.end_date)
    elif args.command == "backfill":
        jobs.backfill(spark, tables, args.start_date, args.end_date, PipelineConfig(risk=risk))
    elif args.command == "refresh":
        print(json.dumps([day.isoformat() for day in changes.refresh_changed(spark, tables, PipelineConfig(risk=risk))]))
    elif args.command == "fold-history":
        fold_pairs(spark, tables)
    elif args.command == "sla":
        violated = [row.asDict() for row in jobs.sla_violations(spark, tables, args.start_date, args.end_date).collect()]
        print(json.dumps(violated, indent=2))
        return 2 if violated else 0
    elif args.command == "quality":
        suite = quality.load_suite(args.suite) if args.suite else quality.CURATED_SUITE
        stored = scans.files_schema(spark, tables.curated, schemas.CURATED)
        results = quality.run_suite(scans.curated_events(spark, tables), suite, stored=stored)
        report = quality.report(results, suite, datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"))
        print(quality.report_markdown(report) if args.markdown else json.dumps(report, indent=2))
        print(quality.metric_line(report))
        return 0 if report["overall_status"] == "PASS" else 2
    else:
        cfg = PipelineConfig(risk=risk, tables=tables, stream=_stream_config(args))
        run(spark, cfg, known_pairs(spark, tables) if args.stored_history else None)
    return 0


if __name__ == "__main__":
    sys.exit(main())
