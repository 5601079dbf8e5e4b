"""Command line: python -m homespan --step all --source <folder> --out <folder>."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from homespan.plans.base import Workspace, properties_from
from homespan.plans.stages import ORDER, Stages


def main() -> None:
    parser = argparse.ArgumentParser(prog="homespan")
    parser.add_argument("--step", required=True, choices=[*ORDER, "all"])
    parser.add_argument("--source", required=True, help="folder with the source tables")
    parser.add_argument("--out", required=True, help="shared folder for the stage tables and models")
    parser.add_argument("--force", action="store_true", help="ingest again although the raw table exists")
    parser.add_argument("--no-tune", action="store_true", help="train without the parameter search")
    parser.add_argument("--models", nargs="*", choices=["knn", "cart", "random_forest", "boosted"])
    args = parser.parse_args()
    spark = SparkSession.builder.appName("homespan").getOrCreate()
    ws = Workspace(spark, args.source)
    seconds = Stages(spark, args.out, lambda: properties_from(ws.table)).run(
        args.step, args.force, not args.no_tune, args.models)
    for name, s in seconds.items():
        print(f"{name}: {s}s")


if __name__ == "__main__":
    main()
