"""The whole extraction as one Spark job: counts, reports, join preview, rankings, extract, audit.

    python -m shopfloor --parquet <folder> --out <folder>
"""

import argparse
import datetime
import sys

from pyspark.sql import DataFrame, SparkSession

from shopfloor.audit import AuditedRunner
from shopfloor.catalog import run_named
from shopfloor.plans import extract, profile
from shopfloor.sinks.files import EmptyExtract, save_extract
from shopfloor.sources.samples import from_samples
from shopfloor.sources.tables import Tables, from_catalog, from_jdbc, from_parquet
from shopfloor.storage import publish, remove_made, staging_path

STEPS = {
    "Tables": ["table_row_counts"],
    "Business aggregations": ["defect_rate_top10", "efficiency_by_shift", "pass_rate_by_category_short"],
    "Join preview": ["join_preview_10"],
    "Summary and rankings": ["plant_efficiency_short", "efficiency_rank_top20"],
}


PROFILES = {
    "extract_profile": profile.extract_profile,
    "null_report": profile.null_report,
    "quality_flags": profile.quality_flags,
}


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="shopfloor", description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--parquet", help="folder with one parquet file or folder per table")
    source.add_argument("--schema", help="catalog schema holding the five tables")
    source.add_argument("--jdbc", help="database url; schema 'manufacturing'")
    source.add_argument("--samples", help="folder with the order/supplier/event sample files")
    parser.add_argument("--out", required=True, help="folder for extract, reports and audit; extract and reports are replaced")
    parser.add_argument("--jdbc-partitions", type=int, default=64, help="ranges in which a large database table is read")
    parser.add_argument("--as-of", type=datetime.date.fromisoformat, help="date for maintenance ages, default today")
    return parser.parse_args(argv)


def _tables(spark: SparkSession, arguments: argparse.Namespace) -> Tables:
    if arguments.parquet:
        return from_parquet(spark, arguments.parquet)
    if arguments.schema:
        return from_catalog(spark, arguments.schema)
    if arguments.jdbc:
        return from_jdbc(spark, arguments.jdbc, partitions=arguments.jdbc_partitions)
    return from_samples(spark, arguments.samples)


def _report(name: str, df: DataFrame | None, out: str) -> None:
    """The whole result as parquet under ``out/reports``, its first rows on the screen."""
    print(f"\n{name}")
    if df is not None:
        path = f"{out}/reports/{name}"
        folder = staging_path(path)
        df.write.parquet(folder)
        publish(df.sparkSession, folder, path)
        df.show(truncate=False)
        print(f"all rows: {path}")


def main(argv: list[str] | None = None) -> int:
    arguments = _arguments(argv)
    spark = SparkSession.builder.appName("shopfloor").getOrCreate()
    tables = _tables(spark, arguments)
    runner = AuditedRunner(spark, raise_errors=False)

    for step, names in STEPS.items():
        print(f"\n== {step}")
        for name in names:
            _report(name, runner.run(name, lambda name=name: run_named(name, tables)), arguments.out)

    print("\n== Extract")
    # Written once, in no order; sorted once, for the output.
    staged = runner.run("run_extract", lambda: extract.keyed_extract(tables, arguments.as_of), ordered=False)
    empty = False
    if staged is not None:
        try:
            save_extract(staged, f"{arguments.out}/extract", staged=True)
        except EmptyExtract as error:
            print(error, file=sys.stderr)
            empty = True
        else:
            for name, query in PROFILES.items():
                _report(name, runner.run(name, lambda query=query: query(staged)), arguments.out)
    runner.history().show(truncate=False)
    runner.append_to(f"{arguments.out}/audit")
    remove_made(spark)
    return int(empty or runner.failed)


if __name__ == "__main__":
    sys.exit(main())
