"""Command line: build all tables from a source, or check the tables of an earlier build.

    python -m kinomart build --source dump --folder /data/dump --out /data/marts
    python -m kinomart check --out /data/marts

Both store the report under ``<out>/checks`` and exit with 1 if a check fails.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from kinomart.plans import checks, pipeline
from kinomart.session import SETTINGS, folder_bytes, materialize, remove_work_folders, shuffle_settings
from kinomart.sources.tables import loader


def _session(folder: str | None) -> SparkSession:
    """A session whose shuffles fit the size of the input folder."""
    builder = SparkSession.builder.appName("kinomart")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if folder:
        sized = shuffle_settings(folder_bytes(spark, folder), spark.sparkContext.defaultParallelism)
        for key, value in sized.items():
            spark.conf.set(key, value)
    return spark


def _conclude(report: DataFrame, out: str) -> int:
    stored = materialize(report, f"{out}/checks")
    failed = stored.where("not passed").orderBy("relation", "check").collect()
    for row in failed:
        print(f"FAIL {row.relation} {row.check}: {row.failures}")
    print(f"{stored.count() - len(failed)} checks passed, {len(failed)} failed")
    return 1 if failed else 0


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="kinomart")
    commands = parser.add_subparsers(dest="command", required=True)
    build = commands.add_parser("build")
    build.add_argument("--source", choices=["parquet", "dump", "table", "tpch"], required=True)
    build.add_argument("--folder", required=True, help="folder, or database of catalog tables")
    build.add_argument(
        "--file", action="append", default=[], metavar="TABLE=NAME", help="dump file of another name"
    )
    build.add_argument("--defaults", action="store_true", help="fill missing values with the columns' defaults")
    check = commands.add_parser("check")
    for command in (build, check):
        command.add_argument("--out", required=True)
    options = parser.parse_args(arguments)
    if options.command == "build":
        spark = _session(options.folder if options.source != "table" else None)
        files = dict(pair.split("=", 1) for pair in options.file)
        load = loader(spark, options.source, options.folder, files, options.defaults)
        code = _conclude(pipeline.build(spark, load, options.out)[1], options.out)
    else:
        spark = _session(options.out)
        code = _conclude(checks.everything(pipeline.stored(spark, options.out)), options.out)
    remove_work_folders(spark)
    return code


if __name__ == "__main__":
    sys.exit(main())
