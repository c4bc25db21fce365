"""Runs a registered query: ``python -m postloom QUERY DATA OUT [--format csv]``; ``--list`` names the queries."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from postloom.plans.queries import QUERIES
from postloom.sources import sinks


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="postloom", description="Run one query over a folder of parquet tables.")
    parser.add_argument("query", nargs="?", choices=sorted(QUERIES), metavar="QUERY", help="name of a query, see --list")
    parser.add_argument("data", nargs="?", help="folder of the tables")
    parser.add_argument("out", nargs="?", help="folder of the result")
    parser.add_argument("--format", choices=("parquet", "json", "csv"), default="parquet")
    parser.add_argument("--list", action="store_true", help="name the queries and stop")
    chosen = parser.parse_args(argv)
    if not chosen.list and not (chosen.query and chosen.data and chosen.out):
        parser.error("QUERY, DATA and OUT are needed")
    return chosen


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    chosen = arguments(argv)
    if chosen.list:
        print("\n".join(sorted(QUERIES)))
        return
    spark = spark or SparkSession.builder.appName(f"postloom {chosen.query}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    result = QUERIES[chosen.query](spark, chosen.data)
    if chosen.format == "parquet":
        result.write.mode("overwrite").parquet(chosen.out)
    elif chosen.format == "json":
        sinks.write_json(result, chosen.out)
    else:
        sinks.write_csv(result, chosen.out)


if __name__ == "__main__":
    main()
