"""``python -m spendlens JOB --out FOLDER [--raw FOLDER] [--regions FILE]``"""

from __future__ import annotations

import argparse

from .plans import jobs
from .session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="spendlens")
    parser.add_argument("job", choices=["ingest", "clean", "master", "marts", "analysis", "all"])
    parser.add_argument("--out", required=True, help="folder of the stored tables")
    parser.add_argument("--raw", help="folder of the raw tables (job clean)")
    parser.add_argument("--regions", help="GeoJSON file with a polygon per region (job clean)")
    parser.add_argument("--landing", help="folder of page files (job ingest)")
    parser.add_argument("--name", default="expenses", help="dataset that the pages belong to (job ingest)")
    parser.add_argument("--rule", default="empty", choices=["empty", "next"], help="what ends a request (job ingest)")
    parser.add_argument("--entities", nargs="*", default=[], help="tables of entities, earliest term first (job ingest)")
    parser.add_argument("--years", nargs="*", type=int, default=[], help="years of the worklist (job ingest)")
    parser.add_argument("--source-names", action="store_true", help="write tables under the source's column names")
    args = parser.parse_args()
    if args.job in ("clean", "all") and not args.raw:
        parser.error("--raw is needed to clean")
    if args.job == "ingest" and not args.landing:
        parser.error("--landing is needed to ingest")
    spark = build_session()
    if args.job == "ingest":
        jobs.ingest_job(
            spark, args.landing, args.out, args.name, entities=args.entities, years=args.years, rule=args.rule
        )
    if args.job in ("clean", "all"):
        jobs.clean_job(spark, args.raw, args.out, args.regions, args.source_names)
    if args.job in ("master", "all"):
        jobs.master_job(spark, args.out, source_names=args.source_names)
    if args.job in ("marts", "all"):
        jobs.marts_job(spark, args.out)
    if args.job in ("analysis", "all"):
        jobs.analysis_job(spark, args.out)


if __name__ == "__main__":
    main()
