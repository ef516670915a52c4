"""Command line: python -m groundplan collect|analyse|export ..."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from groundplan.plans import flows
from groundplan.sources import tables


def main() -> None:
    parser = argparse.ArgumentParser(prog="groundplan")
    commands = parser.add_subparsers(dest="command", required=True)
    collect = commands.add_parser("collect", help="union, deduplicate and enrich listings")
    collect.add_argument("archive")
    collect.add_argument("out")
    collect.add_argument("--interim")
    collect.add_argument("--zones", nargs="*", default=[])
    analyse = commands.add_parser("analyse", help="match, clean and report")
    analyse.add_argument("listings")
    analyse.add_argument("registry")
    analyse.add_argument("out")
    analyse.add_argument("--zones", nargs="*", default=[])
    export = commands.add_parser("export", help="registry records as one wide table")
    export.add_argument("records")
    export.add_argument("out")
    export.add_argument("--district")
    a = parser.parse_args()
    spark = SparkSession.builder.getOrCreate()
    zones = tables.load_zones(spark, a.zones, missing_ok=True) if getattr(a, "zones", None) else None
    if a.command == "collect":
        final, by_source = flows.build_final(tables.load_archive(spark, a.archive), tables.load_interim(spark, a.interim) if a.interim else None, zones)
        tables.save_csv(final, a.out)
        by_source.show(100, False)
    elif a.command == "analyse":
        done = flows.run_etl(tables.load_listings(spark, a.listings), tables.load_registry(spark, a.registry), zones)
        sale, rental = tables.split_by_deal(done.cleaned)
        for name, df in (("cleaned", done.cleaned), ("features", done.features), ("sale", sale), ("rental", rental)):
            tables.save_csv(df, f"{a.out}/{name}")
        tables.write_report(done.sheets, f"{a.out}/report", done.overview)
        done.match_report.show(truncate=False)
    else:
        tables.save_csv(tables.flatten_records(tables.load_records(spark, a.records), a.district), a.out)


if __name__ == "__main__":
    main()
