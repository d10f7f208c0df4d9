"""Command line for the end-to-end jobs, reading the reference's CSV layout.

    python -m clickroll.cli features  --raw data/raw --out data/processed [--version v1|v2]
    python -m clickroll.cli baseline  --raw data/raw --out submissions
    python -m clickroll.cli profile   --raw data/raw
    python -m clickroll.cli fulltrain --raw data/raw --out submissions [--features data/processed]
                                      [--winsorize 0.995] [--trees 200] [--patience 300]
    python -m clickroll.cli cv        --raw data/raw --out submissions [--folds 10] [--seeds 2025,2027,2031]
    python -m clickroll.cli blend     --a A.csv --b B.csv --out blend.csv

``--raw`` holds train.csv, test.csv and sample_submission.csv. Runs on the cluster the
session is configured for (``spark-submit`` settings), or locally with ``--master``.
"""

from __future__ import annotations

import argparse
import json

from clickroll.plans import jobs
from clickroll.session import build_session
from clickroll.sources.adapters import csv_source


def report(frame) -> None:
    """Every row of a report frame as a JSON line."""
    for row in frame.toLocalIterator():
        print(json.dumps(row.asDict(), default=str))


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="clickroll")
    ap.add_argument("command", choices=["features", "baseline", "profile", "fulltrain", "cv", "blend"])
    ap.add_argument("--raw", default="data/raw")
    ap.add_argument("--out", default="out")
    ap.add_argument("--version", default="v2")
    ap.add_argument("--master", default=None)
    ap.add_argument("--winsorize", type=float, default=0.0)
    ap.add_argument("--trees", type=int, default=200)
    ap.add_argument("--depth", type=int, default=6)
    ap.add_argument("--rate", type=float, default=0.05)
    ap.add_argument("--rows-share", type=float, default=0.8, help="share of rows a tree is fitted on")
    ap.add_argument("--columns-share", type=float, default=0.7, help="share of features a tree sees")
    ap.add_argument("--leaves", type=int, default=31, help="most leaves of a tree")
    ap.add_argument("--least-rows", type=int, default=6, help="fewest rows of a leaf")
    ap.add_argument("--l1", type=float, default=0.0, help="penalty alpha on leaf values")
    ap.add_argument("--l2", type=float, default=0.0, help="penalty lambda on leaf values")
    ap.add_argument("--patience", type=int, default=300,
                    help="stop after this many rounds without a better validation error")
    ap.add_argument("--folds", type=int, default=10)
    ap.add_argument("--seeds", default="2025,2027,2031")
    ap.add_argument("--features", default=None,
                    help="folder written by the features command (v2 preferred, else v1)")
    ap.add_argument("--a")
    ap.add_argument("--b")
    args = ap.parse_args(argv)
    spark = build_session(args.master)
    if args.command == "blend":
        print(json.dumps({"blended": jobs.blend_files(spark, args.a, args.b, args.out)}))
        return
    raw = args.raw.rstrip("/")
    src = csv_source(spark, f"{raw}/train.csv", f"{raw}/test.csv", f"{raw}/sample_submission.csv")
    from clickroll.plans.modeling import GBTParams
    params = GBTParams(max_iter=args.trees, max_depth=args.depth, step_size=args.rate,
                       subsampling_rate=args.rows_share, column_sample=args.columns_share, max_leaves=args.leaves,
                       min_instances_per_node=args.least_rows, reg_alpha=args.l1, reg_lambda=args.l2, patience=args.patience)
    features = None
    if args.features and args.command in ("fulltrain", "cv"):
        version, tr, te = jobs.read_features(spark, args.features)
        features = (tr, te)
        print(json.dumps({"features": version}))
    if args.command == "features":
        print(json.dumps(jobs.build_features(src, args.out, args.version)))
    elif args.command == "baseline":
        report(jobs.run_baseline(src, args.out))
    elif args.command == "profile":
        report(jobs.profile_report(src))
    elif args.command == "fulltrain":
        print(json.dumps(jobs.run_fulltrain(src, args.out, params, args.winsorize, features), default=str))
    elif args.command == "cv":
        seeds = tuple(int(x) for x in args.seeds.split(","))
        report(jobs.run_cv_ensemble(src, args.out, params, args.folds, seeds, features))


if __name__ == "__main__":
    main()
