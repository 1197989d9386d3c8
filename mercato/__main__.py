"""Batch run from the command line (``spark-submit -m`` style entry point).

    python -m mercato --input s3a://bucket/marketplace --output s3a://bucket/out \
        [--start-date 2018-01-01] [--end-date 2018-06-30] [--seller-state SP] [--parallel 4]
    python -m mercato --catalog-db marketplace --output ...

Same parameters as the reference product: dates as ``YYYY-MM-DD`` (empty =
no filter), seller state (empty = all). Exit code 1 on a bad date or when no
input table is found; failed checks and failed analyses are logged and the
run goes on.
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from mercato.params import Params
from mercato.plans.batch import run_batch
from mercato.session import tune
from mercato.sources.tables import Tables


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="mercato", description="Marketplace analytics on Spark")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--input", help="folder with one dataset per table (see --format)")
    src.add_argument("--catalog-db", help="Spark catalog database holding the tables")
    src.add_argument("--tpch", help="folder of the TPC-H-like test data (test mapping)")
    ap.add_argument("--format", default="parquet", help="format of --input: parquet, csv, orc, json")
    ap.add_argument("--output", required=True, help="output folder (shared file system or object store)")
    ap.add_argument("--start-date", default="")
    ap.add_argument("--end-date", default="")
    ap.add_argument("--seller-state", default="")
    ap.add_argument("--parallel", type=int, default=4, help="analyses that run at a time")
    args = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    log = logging.getLogger("mercato")
    try:
        params = Params(args.start_date, args.end_date, args.seller_state)
    except ValueError as exc:
        log.error(str(exc))
        return 1
    spark = tune(SparkSession.builder.appName("mercato").config("spark.scheduler.mode", "FAIR").getOrCreate())
    if args.input:
        tables = Tables.from_files(spark, args.input, args.format)
    elif args.catalog_db:
        tables = Tables.from_catalog(spark, args.catalog_db)
    else:
        tables = Tables.from_tpch(spark, args.tpch)
    if not tables:
        log.error("no input table found")
        return 1
    result = run_batch(tables, args.output, params, parallel=max(1, args.parallel))
    log.info("checks passed: %s; written: %s; errors: %s", result.checks_passed, result.written, result.errors)
    return 0


if __name__ == "__main__":
    sys.exit(main())
