"""``spark-submit`` entry: ``import``, ``queries`` or ``all``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tagloom.plans.importing import import_sites
from tagloom.plans.job import run_all, run_queries


def main() -> None:
    parser = argparse.ArgumentParser(prog="tagloom")
    parser.add_argument("job", choices=["import", "queries", "all"])
    parser.add_argument("--site", action="append", default=[], help="folder of one unpacked dump")
    parser.add_argument("--store", required=True)
    parser.add_argument("--results", default="results")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("tagloom").getOrCreate()
    if args.job == "import":
        import_sites(spark, args.site, args.store)
    elif args.job == "queries":
        run_queries(spark, args.store, args.results)
    else:
        run_all(spark, args.site, args.store, args.results)
    spark.stop()


if __name__ == "__main__":
    main()
