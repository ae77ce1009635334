"""Command-line run: ``python -m almanac --data DIR --out DIR [--config run.json]``.

Reads the tables, builds the monthly features, fits the requested models, prints the loss
table and the winner, and writes the winner's test-period forecasts (CSV with header, or
parquet) as ``{model}_{dept}_forecasts`` under ``--out``.
"""

from __future__ import annotations

import argparse

from almanac.plans import runner
from almanac.plans.features import load_wide_features
from almanac.session import get_session
from almanac.sources.config import RunConfig, load_config


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="almanac")
    ap.add_argument("--data", help="folder holding <table>.parquet")
    ap.add_argument("--wide", help="wide daily table (CSV with header or parquet) instead of --data")
    ap.add_argument("--calendar", help="calendar table (d, date) for --wide")
    ap.add_argument("--where", help="filter on the wide table, e.g. dept_id = 'R'")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--config", help="run config JSON (split points, lags, spaces, max_evals)")
    ap.add_argument("--models", default=",".join(runner.ALL_MODELS))
    ap.add_argument("--select-on", default="test", choices=["test", "validation"])
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--master", default=None, help="only for local runs, e.g. local[8]")
    args = ap.parse_args(argv)

    cfg = load_config(args.config) if args.config else RunConfig()
    spark = get_session(args.master)
    if bool(args.wide) == bool(args.data) or bool(args.wide) != bool(args.calendar):
        ap.error("give --data, or --wide with --calendar")
    features = load_wide_features(spark, args.wide, args.calendar, cfg, args.where) if args.wide else None
    res = runner.run(spark, args.data, cfg, models=tuple(args.models.split(",")),
                     select_on=args.select_on, out_path=args.out, fmt=args.format, features=features)
    res["losses"].orderBy("position", "split").show(truncate=False)
    print(f"best model, selected on the {res['selected_on']} slice:")
    res["best"].show(truncate=False)


if __name__ == "__main__":
    main()
