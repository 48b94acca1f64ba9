"""Command line: all steps of a run, or one of them.

    spark-submit --py-files eventmart.zip -m eventmart run --base DIR --control FILE --masters DIR
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging

from pyspark.sql import SparkSession

from eventmart.plans import flow
from eventmart.session import Workspace, fitted_shuffles, tune
from eventmart.specs import DEFAULT_RULES, load_specs, read_control, read_rules

STEPS = ("run", "intake", "landing", "normalize", "marts", "export", "rebuild")


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="eventmart")
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--base", required=True, help="folder of all layers")
    parser.add_argument("--control", help="control table, one row per feed")
    parser.add_argument("--rules", help="JSON file with keys, checks and names per feed type")
    parser.add_argument("--masters", help="folder of the master data")
    parser.add_argument(
        "--run-ts",
        type=dt.datetime.fromisoformat,
        help="time of the run; the steps of one run share it",
    )
    parser.add_argument("--without-deleted", action="store_true", help="leave deleted events out")
    parser.add_argument("--keep-unbranded", action="store_true", help="keep events without brand")
    parser.add_argument(
        "--strict-masters", action="store_true", help="fail if a key of the master data repeats"
    )
    parser.add_argument(
        "--kept-marts", action="store_true", help="marts from their state and the run's own rows"
    )
    parser.add_argument(
        "--follow-merges", action="store_true", help="survivors at the end of chains of merges"
    )
    args = parser.parse_args(argv)
    if args.step in ("run", "intake", "landing", "normalize", "rebuild") and not args.control:
        parser.error(f"{args.step} needs --control")
    if args.step in ("run", "normalize") and not args.masters:
        parser.error(f"{args.step} needs --masters")
    if args.step == "marts" and args.kept_marts and not (args.control and args.masters):
        parser.error("--kept-marts needs --control and --masters")
    if args.run_ts is None:
        if args.step not in ("run", "normalize"):
            parser.error(f"{args.step} needs the --run-ts of its run")
        args.run_ts = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    return args


def main(argv: list[str] | None = None) -> flow.Counts:
    args = parse(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = tune(SparkSession.builder.appName(f"eventmart {args.step}").getOrCreate())
    layout, specs = flow.Layout(args.base), {}
    if args.control:
        rules = read_rules(spark, args.rules) if args.rules else DEFAULT_RULES
        specs = load_specs(read_control(spark, args.control), rules)
    masters = flow.read_masters(spark, args.masters) if args.masters else None
    options = (args.without_deleted, args.keep_unbranded, args.strict_masters)
    if args.step == "run":
        counts = flow.run(spark, specs, masters, layout, args.run_ts, *options, args.kept_marts, args.follow_merges)
    else:
        size = flow.input_bytes(spark, specs, layout)
        with fitted_shuffles(spark, size), Workspace(spark) as work:
            if args.step == "intake":
                counts = flow.intake(spark, specs, layout, args.run_ts, work.settle)
            elif args.step == "landing":
                counts = flow.landing(spark, specs, layout, args.run_ts, work.settle)
            elif args.step == "normalize":
                counts = flow.normalize(
                    spark, specs, masters, layout, work.settle, *options, args.follow_merges
                )
            elif args.step == "rebuild":
                counts = flow.rebuild(spark, specs, layout, args.run_ts, work.settle)
            elif args.step == "marts" and args.kept_marts:
                counts = flow.keep_marts(
                    spark, specs, masters, layout, args.run_ts, work.settle, *options
                )
            elif args.step == "marts":
                counts = flow.summarize(spark, layout, args.run_ts, work.settle)
            else:
                counts = flow.export(spark, layout, args.run_ts)
    for name, rows in counts.items():
        logging.info("%s: %d", name, rows)
    return counts


if __name__ == "__main__":
    main()
