"""Command line: build a wide table from a configuration or from arguments."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from staygrid.plans.build import run_config, write_all, write_variables
from staygrid.session import build_session
from staygrid.sources.config import BuildConfig
from staygrid.sources.place import Place


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="staygrid", description=__doc__)
    p.add_argument("--config", help="YAML configuration; all else but --output is taken from it")
    p.add_argument("--all-concepts", metavar="WORKSPACE", help="write every concept found in a workspace")
    p.add_argument("--concept-root")
    p.add_argument("--stay-table")
    p.add_argument("--concept-dict")
    p.add_argument("--dataset", default="mimic-iv")
    p.add_argument("--version", default="1.0.0", help="of the concepts")
    p.add_argument("--dataset-version")
    p.add_argument("--aggregation-mode", choices=("mean", "dictionary"), default="dictionary")
    p.add_argument("--output")
    p.add_argument("--max-hours", type=int, default=168, help="-1: no limit")
    p.add_argument("--grid-end-rounding", choices=("floor", "ceil"), default="floor")
    p.add_argument("--no-grid", action="store_true")
    p.add_argument("--no-window-filter", action="store_true")
    p.add_argument("--no-sort", action="store_true", help="leave rows in no order")
    p.add_argument("--buckets", type=int, help="deal stays to so many files, sorted inside, instead of sorting all rows")
    p.add_argument("--missing-concepts", choices=("warn", "fail", "ignore"), default="warn")
    return p


def main(argv: Sequence[str] | None = None) -> int:
    p = parser()
    args = p.parse_args(argv)
    spark = build_session()
    hours = None if args.max_hours == -1 else args.max_hours
    if args.config:
        export = run_config(spark, args.config, args.output)
    elif args.all_concepts:
        export = write_all(spark, args.dataset, args.all_concepts, stay_table=args.stay_table, max_hours=hours, grid=not args.no_grid, concept_dict=args.concept_dict, dataset_version=args.dataset_version, buckets=args.buckets)
    else:
        if not args.concept_root or not args.output:
            p.error("--concept-root and --output are needed without --config")
        path = lambda v: Place(v) if v else None
        config = BuildConfig(
            concept_root=path(args.concept_root), dataset=args.dataset, version=args.version, dataset_version=args.dataset_version, stay_table=path(args.stay_table), concept_dict=path(args.concept_dict),
            aggregation=args.aggregation_mode, grid=not args.no_grid, max_hours=hours, rounding=args.grid_end_rounding, window=not args.no_window_filter, missing=args.missing_concepts, output=path(args.output), sort=not args.no_sort, buckets=args.buckets,
        )
        export = write_variables(spark, config)
    print(export.path)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
