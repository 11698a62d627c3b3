"""Run a load: ``spark-submit`` this package, or ``python -m strata``."""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import SparkSession

from strata.plans.medallion import Options, run_pipeline
from strata.streaming.intake import stream_pipeline


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="strata", description=__doc__)
    parser.add_argument("--mode", choices=("full", "incremental", "stream"), default="full")
    parser.add_argument("--lake", required=True, help="root folder of the tables")
    parser.add_argument(
        "--landing", nargs="+", metavar="SOURCE=PATH", help="landed bodies, one path per source"
    )
    parser.add_argument("--responses", help="landed responses with their envelope, instead")
    parser.add_argument(
        "--bodies", action="store_true", help="a file is one body; else a line is one"
    )
    parser.add_argument(
        "--mark-per-source", action="store_true", help="a high-water mark for each source"
    )
    parser.add_argument("--nan-is-bad", action="store_true", help="flag quotes with a NaN price")
    parser.add_argument(
        "--keep-ties",
        action="store_true",
        help="an increment also takes unseen records of the mark's very time",
    )
    parser.add_argument(
        "--all-files", action="store_true", help="an increment reads old files again"
    )
    parser.add_argument(
        "--rewrite-unchanged",
        action="store_true",
        help="a merge also rewrites rows that the table has already",
    )
    parser.add_argument(
        "--drop-repeats",
        action="store_true",
        help="a stream drops records that repeat what it last saw of their key",
    )
    parser.add_argument(
        "--extra-fields", nargs="+", default=[], help="further fields that Bronze keeps as text"
    )
    parser.add_argument(
        "--keep-generations", type=int, help="delete older generations of the tables"
    )
    parser.add_argument("--checkpoint", help="checkpoint folder of the stream mode")
    args = parser.parse_args(argv)
    if bool(args.landing) == bool(args.responses):
        parser.error("give either --landing or --responses")
    if args.mode == "stream" and not (args.checkpoint and args.landing):
        parser.error("--mode stream needs --checkpoint and --landing")
    if args.landing:
        if not all("=" in item for item in args.landing):
            parser.error("--landing takes SOURCE=PATH")
        args.landing = dict(item.split("=", 1) for item in args.landing)
    return args


def main(argv: Sequence[str] | None = None) -> None:
    args = parse_args(argv)
    spark = SparkSession.builder.appName("strata").getOrCreate()
    options = Options(
        args.bodies,
        nan_is_bad=args.nan_is_bad,
        mark_per_source=args.mark_per_source,
        keep_ties=args.keep_ties,
        new_files_only=not args.all_files,
        skip_unchanged=not args.rewrite_unchanged,
        drop_repeats=args.drop_repeats,
        extra_fields=tuple(args.extra_fields),
    )
    if args.mode == "stream":
        counts = stream_pipeline(
            spark, args.landing, args.lake, args.checkpoint, options=options
        )
    else:
        landing = args.landing or args.responses
        counts = run_pipeline(
            spark,
            args.mode,
            landing,
            args.lake,
            options=options,
            keep_generations=args.keep_generations,
        )
    print(json.dumps(counts))


if __name__ == "__main__":
    main()
