"""Command line: build, dashboard, classify, candidates."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import candidates, documents, intervals
from .plans.shipping import ship
from .sources import readers, sinks

DIMENSIONS, LISTED = ["trigger_event_type", "counterparty_type", "role", "status"], ["tax_asset_types"]


def build(spark: SparkSession, a: argparse.Namespace) -> None:
    """Agreements, events and active stock of a corpus of summaries."""
    table, events, rejects = documents.agreements_and_events(readers.whole_texts(spark, f"{a.corpus}/*/*_summary.qmd"))
    sinks.parquet(table, f"{a.output_dir}/tras.parquet", 1)
    sinks.parquet(events, f"{a.output_dir}/events.parquet", 1)
    sinks.parquet(rejects, f"{a.output_dir}/rejects.parquet", 1)
    own = spark.read.parquet(f"{a.output_dir}/tras.parquet")
    sinks.parquet(intervals.stock_by_date(own, F.to_date(F.lit(a.as_of)), DIMENSIONS, LISTED), f"{a.output_dir}/stock_by_date.parquet", 1)


def dashboard(spark: SparkSession, a: argparse.Namespace) -> None:
    read = lambda name: spark.read.parquet(f"{a.dir}/{name}.parquet")
    print(sinks.dashboard(a.dir, read("tras"), read("events"), read("stock_by_date")), "characters")


def classify(spark: SparkSession, a: argparse.Namespace) -> None:
    found = documents.classified(readers.text_documents(readers.binary_files(spark, a.source)))
    sinks.csv(found.where("decision = 'keep'"), a.output)
    if a.drop_csv:
        sinks.csv(found.where("decision = 'drop'"), a.drop_csv)
    documents.classification_report(found).show(100, False)


def union(spark: SparkSession, a: argparse.Namespace) -> None:
    """Candidates of exhibit type from files of hits, one a phrase variant, as variant=path."""
    variants = dict(x.split("=", 1) for x in a.hits)
    kept, dropped = candidates.of_type(candidates.candidate_union({v: readers.hits(spark.read.text(p)) for v, p in variants.items()}))
    if a.start or a.end:
        kept = kept.where(F.col("file_date").between(a.start or "0000", a.end or "9999"))
    sinks.parquet(kept, a.output)
    dropped.show(100, False)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tessera", description=__doc__)
    commands = parser.add_subparsers(required=True)
    for run, options in (
        (build, {"--corpus": {"required": True}, "--output-dir": {"required": True}, "--as-of": {"required": True}}),
        (dashboard, {"--dir": {"required": True}}),
        (classify, {"source": {}, "-o": {"dest": "output", "required": True}, "--drop-csv": {}}),
        (union, {"hits": {"nargs": "+"}, "-o": {"dest": "output", "required": True}, "--start": {}, "--end": {}}),
    ):
        p = commands.add_parser("candidates" if run is union else run.__name__, help=run.__doc__)
        for name, how in options.items():
            p.add_argument(name, **how)
        p.set_defaults(run=run)
    a = parser.parse_args(argv)
    spark = SparkSession.builder.appName("tessera").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ship(spark)
    a.run(spark, a)


if __name__ == "__main__":
    main()
