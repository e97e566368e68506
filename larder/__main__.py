"""Command line of the recipe job: ``spark-submit run_recipes.py --input ...``."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from larder.operators.rows import preview
from larder.plans.recipes import RecipeJob, run_recipes
from larder.sources.history_table import HistoryTable


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="larder", description="Ingest recipes and report on them.")
    parser.add_argument("--input", required=True, help="folder of line-delimited JSON")
    parser.add_argument("--lake", required=True, help="partitioned parquet table")
    parser.add_argument("--report", required=True, help="folder of the difficulty report")
    parser.add_argument("--history", required=True, help="run history table")
    parser.add_argument("--etl-name", default="recipe-data")
    parser.add_argument("--term", default="beef")
    parser.add_argument("--mentions", help="folder for all names mentioning the term")
    parser.add_argument("--lookback-days", type=int, default=0)
    parser.add_argument("--strict-durations", action="store_true", help="fail on unreadable durations")
    parser.add_argument("--new-files-only", action="store_true", help="files never change once they are there")
    parser.add_argument("--ledger", help="where loaded files are written down, so that a delta reads just the others")
    parser.add_argument("--snapshots", action="store_true", help="readers see a load whole or not at all")
    parser.add_argument("--merge-key", action="append", default=[], help="rows with the same key replace one another")
    parser.add_argument("--state", help="where the report's state is kept, so that only changed months are read")
    parser.add_argument("--reconcile", action="store_true", help="replace the months that differ between input and table")
    parser.add_argument("--sort-by", action="append", default=[], help="column by which the rows of a file are ordered")
    parser.add_argument("--claims", help="where attempts at a run are marked, so that two at a time do not both load")
    parser.add_argument("--profiles", help="where numbers and sketches of each run's rows are kept")
    parser.add_argument("--stage-by-run", action="store_true", help="make repeated attempts safe")
    parser.add_argument("--clustered", action="store_true", help="input already arrives by month")
    parser.add_argument(
        "--reader-option",
        action="append",
        default=[],
        metavar="NAME=VALUE",
        help="option of Spark's JSON reader, such as modifiedAfter=2024-01-31T00:00:00",
    )
    parser.add_argument("--seed", action="store_true", help="add a first run if there is none")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    options = parse(arguments)
    own = SparkSession.getActiveSession() is None
    spark = SparkSession.builder.appName("larder").getOrCreate()
    if options.seed:
        HistoryTable(spark, options.history).seed(options.etl_name)
    job = RecipeJob(
        input_path=options.input,
        lake_path=options.lake,
        report_path=options.report,
        history_path=options.history,
        etl_name=options.etl_name,
        term=options.term,
        mentions_path=options.mentions,
        lookback_days=options.lookback_days,
        stage_by_run=options.stage_by_run,
        clustered=options.clustered,
        strict_durations=options.strict_durations,
        new_files_only=options.new_files_only,
        ledger_path=options.ledger,
        snapshots=options.snapshots,
        state_path=options.state,
        reconcile=options.reconcile,
        sort_by=tuple(options.sort_by),
        claims_path=options.claims,
        profiles_path=options.profiles,
        merge_keys=tuple(options.merge_key),
        reader_options=dict(option.split("=", 1) for option in options.reader_option),
    )
    ingested, names = run_recipes(spark, job)
    logging.getLogger("larder").info("%s", ingested)
    preview(names).show(60, truncate=False)
    if own:
        spark.stop()


if __name__ == "__main__":
    main()
