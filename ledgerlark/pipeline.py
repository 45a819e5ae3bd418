"""Run the pipeline over landing sheets and write its tables.

    spark-submit ledgerlark/pipeline.py --sheet 2010=/landing/2010 --sheet 2011=/landing/2011 --out /tables

Without `--only`, all stage tables and the serving tables are written; with it,
the named stages or results.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession

from ledgerlark.catalog import RESULTS
from ledgerlark.plans.workspace import STAGES, Workspace
from ledgerlark.settings import Settings
from ledgerlark.sources.landing import BUNDLE, landing_identity, load_raw, write_bundle, write_table


def run_pipeline(
    spark: SparkSession,
    sheets: dict[str, str],
    out: str,
    sheet_format: str = "csv",
    table_format: str = "parquet",
    only: list[str] | None = None,
    settings: Settings = Settings(),
    resume: bool = False,
    multi_line: bool = False,
) -> Workspace:
    """Build the tables of the given sheets and write them below `out`.

    Parquet stage tables are written once, in place; named results, and CSV
    copies of stages, are written beside them. With `resume`, stage tables stay
    that were finished from the same sheets, files (by path, length and modification
    time), format and settings.
    """
    in_place = table_format == "parquet"
    raw = load_raw(spark, sheets, sheet_format, multi_line=multi_line)
    source = json.dumps([sheets, landing_identity(spark, sheets), sheet_format, multi_line], sort_keys=True)
    tables = Workspace(raw, settings, out if in_place else None, resume, source)
    for name in only or STAGES:
        df = tables.stage(name) if name in STAGES else RESULTS[name](tables)
        if name not in STAGES or not in_place:
            write_table(df, f"{out}/{name}", table_format)
    if only is None:
        write_bundle({role: tables.dashboard(role) for role in BUNDLE}, f"{out}/dashboard")
    return tables


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument(
        "--sheet", action="append", required=True, metavar="NAME=PATH", help="landing path of one yearly sheet"
    )
    parser.add_argument("--out", required=True, help="folder for the tables")
    parser.add_argument("--sheet-format", default="csv", choices=["csv", "parquet"])
    parser.add_argument("--multi-line", action="store_true", help="CSV values may hold line breaks; a file is one task")
    parser.add_argument("--table-format", default="parquet", choices=["csv", "parquet"])
    parser.add_argument("--only", nargs="+", choices=sorted({*STAGES, *RESULTS}), metavar="NAME")
    parser.add_argument("--resume", action="store_true", help="keep finished stage tables of the same sheets and settings")
    options = parser.parse_args()
    spark = SparkSession.builder.appName("ledgerlark").getOrCreate()
    sheets = dict(item.split("=", 1) for item in options.sheet)
    run_pipeline(
        spark, sheets, options.out, options.sheet_format, options.table_format, options.only,
        resume=options.resume, multi_line=options.multi_line,
    )
    spark.stop()


if __name__ == "__main__":
    main()
