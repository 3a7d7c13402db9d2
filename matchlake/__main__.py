"""Command line: ``python -m matchlake <job> --base <folder or URI>``."""

from __future__ import annotations

import argparse

from matchlake.plans.jobs import JOBS, list_teams, predict_pairing, profile_sources, run_job
from matchlake.session import create_session
from matchlake.sources import rows_frame


def main() -> None:
    parser = argparse.ArgumentParser(prog="matchlake")
    parser.add_argument("job", choices=[*JOBS, "profile", "predict", "teams"])
    parser.add_argument("--base", required=True, help="folder or URI that holds all datasets")
    parser.add_argument("--overwrite", choices=["static", "dynamic", "publish"], default="static")
    parser.add_argument("--season", type=int, help="resolve, candidates: season of the teams")
    parser.add_argument("--distance", type=int, help="candidates: most edits between two names")
    parser.add_argument("--tasks", type=int, help="model: tasks of the fit, as model_fit records them")
    parser.add_argument("--dumps", help="slices: folder of the registry's csv.gz files")
    parser.add_argument("--home", help="predict: home team")
    parser.add_argument("--away", help="predict: away team")
    args = parser.parse_args()
    if args.job == "slices" and not args.dumps:
        parser.error("slices needs --dumps")
    if args.job == "candidates" and args.distance is None:
        parser.error("candidates needs --distance")
    if args.job == "predict" and not (args.home and args.away):
        parser.error("predict needs --home and --away")

    spark = create_session(f"matchlake {args.job}")
    if args.job == "profile":
        profile_sources(spark, args.base).show(100, truncate=False)
    elif args.job == "teams":
        list_teams(spark, args.base).show(100, truncate=False)
    elif args.job == "predict":
        asked = [{"home_team": args.home, "away_team": args.away}]
        pairing = rows_frame(spark, asked, "home_team string, away_team string")
        predict_pairing(spark, args.base, pairing).show(truncate=False)
    else:
        options = {}
        if args.job in ("resolve", "candidates"):
            options["season"] = args.season
        if args.job == "candidates":
            options["max_distance"] = args.distance
        if args.job == "model":
            options["tasks"] = args.tasks
        if args.job == "slices":
            options["dumps"] = args.dumps
        for name, path in run_job(spark, args.job, args.base, args.overwrite, **options).items():
            print(f"{name} written to {path}")
    spark.stop()


if __name__ == "__main__":
    main()
