"""Command line of the nightly batch: ``python -m bookpipe --landing L --root R --ds YYYY-MM-DD``.

The exit code is 2 if the landing zone holds no registered source.
"""

from __future__ import annotations

import argparse
import logging
import sys

from bookpipe.plans.nightly import Zones, run_batch
from bookpipe.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="bookpipe", description="Run the nightly batch for one day.")
    parser.add_argument("--landing", required=True, help="folder with the raw CSV sources")
    parser.add_argument("--root", required=True, help="shared folder for zones and tables")
    parser.add_argument("--ds", required=True, help="day to rank, YYYY-MM-DD")
    parser.add_argument("--processed-csv", action="store_true", help="processed zone as gzip CSV")
    parser.add_argument("--changed-only", action="store_true", help="do not read the files of an entity again that have not changed")
    args = parser.parse_args()
    logging.basicConfig(level=logging.INFO)
    spark = build_session("bookpipe-nightly")
    zones = Zones(args.landing, args.root, processed_csv=args.processed_csv, changed_only=args.changed_only)
    try:
        found = run_batch(spark, zones, args.ds)
    finally:
        spark.stop()
    if not found:
        sys.exit(2)


if __name__ == "__main__":
    main()
