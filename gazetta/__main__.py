"""Command line: build the gazetteer from a folder of dump files.

    python -m gazetta --data /data/geonames --out /warehouse/gazetteer [-n]

``-n`` keeps alternate names that are not 'Latin' (both names tables grow).
On a cluster run it through spark-submit; the session, its resources and its
shared ``spark.checkpoint.dir`` come from the launcher.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from gazetta.plans.gazetteer import build_gazetteer
from gazetta.session import checkpoint_dir
from gazetta.sources.geonames import QUOTE_CSV, QUOTE_NONE


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="gazetta", description="Build the gazetteer from GeoNames dump files.")
    p.add_argument("--data", required=True, help="folder holding the seven dump files")
    p.add_argument("--out", required=True, help="output folder (runs are published under it)")
    p.add_argument("-n", "--include-nonlatin", action="store_true",
                   help="keep alternate names that are not Latin")
    p.add_argument("--quoting", choices=[QUOTE_CSV, QUOTE_NONE], default=QUOTE_CSV,
                   help="csv: '\"' quotes fields (default); none: quotes are data")
    p.add_argument("--reduce-alternates", action="store_true",
                   help="aggregate only alternates of known countries and cities (table geo.used_alt_names in place of geo.alt_names)")
    p.add_argument("--multi-line", action="store_true", help="accept quoted line breaks in the input")
    p.add_argument("--keep-runs", type=int, help="delete all but so many of the newest published runs")
    p.add_argument("--in-place", action="store_true",
                   help="rebuild the tables in place instead of publishing a new run")
    args = p.parse_args(argv)

    logging.basicConfig(level=logging.WARNING, format="%(asctime)s %(message)s")
    logging.getLogger("gazetta").setLevel(logging.INFO)
    spark = SparkSession.builder.appName("gazetta").getOrCreate()
    checkpoint_dir(spark)
    build_gazetteer(
        spark, args.data, args.out,
        include_nonlatin=args.include_nonlatin, quoting=args.quoting,
        keep_all_alt_names=not args.reduce_alternates, publish=not args.in_place,
        multi_line=args.multi_line, keep_runs=args.keep_runs,
    )
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
