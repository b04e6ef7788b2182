"""Command line for ``spark-submit``: one sub-command per job.

    spark-submit gableframe_job.py all --root s3a://bucket/house --raw s3a://bucket/raw.csv
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from ..config import Settings
from . import jobs


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description="Housing regression jobs on Spark.")
    sub = top.add_subparsers(dest="job", required=True)
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("--root", required=True, help="Folder of the project on a shared file system.")
    shared.add_argument("--metros", help="Location lookup, CSV or Parquet.")
    shared.add_argument("--no-register", action="store_true", help="Leave the registry alone.")
    shared.add_argument("--eval-start", help="First day of eval.")
    shared.add_argument("--holdout-start", help="First day of holdout.")
    shared.add_argument("--sample-fraction", type=float, help="Share of rows to train on.")
    shared.add_argument("--trials", type=int, help="Number of tuning trials.")

    data = sub.add_parser("data", parents=[shared], help="Split and clean.")
    data.add_argument("--raw", required=True)
    sub.add_parser("features", parents=[shared], help="Fit encoders, build features.")
    training = sub.add_parser("training", parents=[shared], help="Compare the candidates.")
    training.add_argument("--save-candidates", action="store_true")
    sub.add_parser("tuning", parents=[shared], help="Tune the winner.")
    scoring = sub.add_parser("scoring", parents=[shared], help="Score a raw-compatible table.")
    scoring.add_argument("--input", help="Default: the raw holdout split.")
    scoring.add_argument("--output")
    scoring.add_argument("--model", help="Default: the tuned model, else the best one.")
    stream = sub.add_parser("stream", parents=[shared], help="Score the JSON requests that arrive in a folder.")
    stream.add_argument("--input", required=True)
    stream.add_argument("--output")
    stream.add_argument("--checkpoint")
    stream.add_argument("--files-each", type=int, default=100, help="Files of one micro-batch.")
    stream.add_argument("--once", action="store_true", help="Drain the folder and stop.")
    whole = sub.add_parser("all", parents=[shared], help="All stages in order.")
    whole.add_argument("--raw")
    for stage in ("data", "features", "training", "tuning"):
        whole.add_argument(f"--skip-{stage}", action="store_true")
    whole.add_argument("--include-scoring", action="store_true")
    whole.add_argument("--scoring-input")
    whole.add_argument("--scoring-output")
    whole.add_argument("--scoring-model")
    return top


def settings_from(args: argparse.Namespace) -> Settings:
    cfg = Settings()
    if args.eval_start:
        cfg = cfg.with_(split={"eval_start": args.eval_start})
    if args.holdout_start:
        cfg = cfg.with_(split={"holdout_start": args.holdout_start})
    if args.sample_fraction is not None:
        share = {"sample_fraction": args.sample_fraction}
        cfg = cfg.with_(train=share, tune=share)
    if args.trials is not None:
        cfg = cfg.with_(tune={"n_trials": args.trials})
    return cfg


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"gableframe-{args.job}").getOrCreate()
    project = jobs.Project(
        spark, jobs.Layout(args.root), settings_from(args), register=not args.no_register
    )
    if args.job == "data":
        jobs.run_split(project, args.raw)
        jobs.run_clean(project, args.metros)
    elif args.job == "features":
        jobs.run_features(project)
    elif args.job == "training":
        jobs.run_training(project, save_candidates=args.save_candidates)
    elif args.job == "tuning":
        jobs.run_tuning(project)
    elif args.job == "scoring":
        jobs.run_scoring(project, args.input, args.metros, args.model, args.output)
    elif args.job == "stream":
        trigger = {"availableNow": True} if args.once else {"processingTime": "10 seconds"}
        jobs.run_stream(project, args.input, args.metros, args.output, args.checkpoint, args.files_each, trigger).awaitTermination()
    else:
        jobs.run_pipeline(
            project,
            args.raw,
            args.metros,
            data=not args.skip_data,
            features=not args.skip_features,
            training=not args.skip_training,
            tuning=not args.skip_tuning,
            scoring=args.include_scoring,
            scoring_input=args.scoring_input,
            scoring_output=args.scoring_output,
            scoring_model=args.scoring_model,
        )
