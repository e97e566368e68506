"""The recipe job: ingest recipe files, then report on the stored recipes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators import recipes
from larder.plans.ingest import Ingested, Merge, ingest
from larder.schemas import CLEANSED_RECIPE, RAW_RECIPE, REPORT_STATE
from larder.sources.claims import RunClaims
from larder.sources.csv_report import read_csv_report, write_csv_report
from larder.sources.history_table import HistoryTable
from larder.sources.json_lines import read_json_lines
from larder.sources.files import exists
from larder.sources.lake import in_partitions, read_lake, write_lake
from larder.sources.ledger import FileLedger
from larder.sources.profiles import RunProfiles
from larder.sources.quarantine import write_apart
from larder.sources.snapshots import read_current


@dataclass(frozen=True)
class RecipeJob:
    """Where a job reads and writes, and what it looks for. Path prefixes pick file systems.

    ``reader_options`` go to Spark's JSON reader. ``new_files_only`` is for folders whose files never
    change once they are there: a delta then leaves files unread that are older than the start of the run
    before it; otherwise it reads all input again to find the new rows. With ``ledger_path`` the files of each run are
    written down there, and a delta reads just the others, whole. ``strict_durations`` fails the job
    on a duration that cannot be read. ``snapshots`` makes ``lake_path`` a folder of snapshots, whose loads readers see whole
    or not at all. With ``merge_keys`` rows replace those of the same key, the latest by ``merge_order`` staying; files that
    changed after they were loaded are then loaded again, where otherwise they fail the job. ``state_path`` keeps what the
    report needs of each month, so that after a delta only the months it wrote are read for the next report. ``reconcile`` lets a
    delta replace just the months whose rows differ between input and table. ``sort_by`` orders the rows of each file, which lets
    readers pass over parts of a month. With ``claims_path`` of two attempts at a run the second one ends in ``skip``.
    ``profiles_path`` keeps numbers and sketches of what each run wrote.
    """

    input_path: str
    lake_path: str
    report_path: str
    history_path: str
    etl_name: str = "recipe-data"
    term: str = "beef"
    mentions_path: str | None = None
    lookback_days: int = 0
    stage_by_run: bool = False
    clustered: bool = False
    reader_options: Mapping[str, str] = field(default_factory=dict)
    new_files_only: bool = False
    strict_durations: bool = False
    ledger_path: str | None = None
    snapshots: bool = False
    merge_keys: tuple[str, ...] = ()
    merge_order: tuple[str, ...] = ("datePublished",)
    state_path: str | None = None
    reconcile: bool = False
    sort_by: tuple[str, ...] = ()
    claims_path: str | None = None
    profiles_path: str | None = None


def load_recipes(
    spark: SparkSession,
    path: str | list[str],
    watermark: str | None = None,
    lookback_days: int = 0,
    strict_durations: bool = False,
    **reader_options: str,
) -> DataFrame:
    """Recipe files read and cleansed; none if the list of them is empty."""
    if isinstance(path, list) and not path:
        return recipes.cleanse(spark.createDataFrame([], RAW_RECIPE), watermark, lookback_days, strict_durations)
    raw = read_json_lines(spark, path, RAW_RECIPE, **reader_options)
    return recipes.cleanse(raw, watermark, lookback_days, strict_durations)


def ingest_recipes(spark: SparkSession, job: RecipeJob) -> Ingested:
    """Loads the recipe table as its run history asks."""
    if (job.lookback_days or job.reconcile) and "modifiedAfter" in job.reader_options:
        raise ValueError("a lookback or a comparison replaces months, for which it needs all input files")

    def load(mark: str | None, **more: str) -> DataFrame:
        options = {**job.reader_options, **more}
        return load_recipes(spark, job.input_path, mark, strict_durations=job.strict_durations, **options)

    def load_new(mark: str, since: datetime) -> DataFrame:
        # Run dates come back in the zone of this process; a second less, as files are dated coarsely.
        after = since.astimezone(timezone.utc) - timedelta(seconds=1)
        return load(mark, modifiedAfter=after.strftime("%Y-%m-%dT%H:%M:%S"), timeZone="UTC")

    def load_files(paths: list[str]) -> DataFrame:
        return load_recipes(spark, paths, strict_durations=job.strict_durations, **job.reader_options)

    ledger = None
    if job.ledger_path:
        on_change = "load" if job.merge_keys else "fail"
        ledger = FileLedger(spark, job.ledger_path, job.input_path, on_change)
    return ingest(
        HistoryTable(spark, job.history_path),
        job.etl_name,
        load,
        job.lake_path,
        stage_by_run=job.stage_by_run,
        clustered=job.clustered,
        lookback_days=job.lookback_days,
        load_new=load_new if job.new_files_only else None,
        ledger=ledger,
        load_files=load_files,
        snapshots=job.snapshots,
        merge=Merge(job.merge_keys, job.merge_order) if job.merge_keys else None,
        reconcile=job.reconcile,
        sort_by=job.sort_by,
        claims=RunClaims(spark, job.claims_path) if job.claims_path else None,
        profiles=recipe_profiles(spark, job) if job.profiles_path else None,
    )


def recipe_profiles(spark: SparkSession, job: RecipeJob) -> RunProfiles:
    return RunProfiles(spark, job.profiles_path, ("recipeName", "datePublished"), ("cookTimeMinutes", "prepTimeMinutes"))


def stored_recipes(spark: SparkSession, job: RecipeJob) -> DataFrame:
    """The recipes that finished runs have loaded."""
    if job.snapshots:
        return read_current(HistoryTable(spark, job.history_path), job.etl_name, job.lake_path, CLEANSED_RECIPE)
    return read_lake(spark, job.lake_path, CLEANSED_RECIPE)


def refresh_state(spark: SparkSession, job: RecipeJob, done: Ingested | None = None) -> DataFrame:
    """The report's state, brought up to the run ``done``.

    After a delta the months that it wrote are summed up anew and take the place of their old state; the others are
    not read. Everything is summed up after a full load or a merge, and whenever the state is not that of the run
    before, as after a job that died in between.
    """
    covered = f"{job.state_path.rstrip('/')}-runs"
    kept = spark.read.schema("run_id bigint").parquet(covered).agg(F.max("run_id")).first()[0] if exists(spark, covered) else None
    if kept is not None and done is not None and (done.mode == "skip" or done.run_id == kept):
        return read_lake(spark, job.state_path, REPORT_STATE)
    rows = stored_recipes(spark, job)
    follows = kept is not None and done is not None and done.mode == "delta" and done.run_id == kept + 1
    if not follows or done.months is None:
        write_lake(recipes.report_state(rows), job.state_path, "overwrite")
    elif done.months:
        months = [{"year": year, "month": month} for year, month in done.months]
        changed = rows.where(in_partitions(months, ("year", "month")))
        write_lake(recipes.report_state(changed), job.state_path, "replace")
    if done is not None and done.run_id is not None:
        spark.range(done.run_id, done.run_id + 1).select(F.col("id").alias("run_id")).write.mode("append").parquet(covered)
    return read_lake(spark, job.state_path, REPORT_STATE)


def load_apart(spark: SparkSession, input_path: str | list[str], path: str, mode: str = "overwrite", **reader_options: str) -> None:
    """Recipe files written in one pass: good recipes, and the lines that cannot be used with their reason.

    The good half is at ``good_path(path)``; ``read_quarantined`` gives the other one. Together they are all lines.
    """
    raw = read_json_lines(spark, input_path, RAW_RECIPE, keep_corrupt=True, **reader_options)
    write_apart(recipes.with_reasons(raw), path, mode)


def report_recipes(spark: SparkSession, job: RecipeJob, done: Ingested | None = None) -> DataFrame:
    """Writes the average time per difficulty as one CSV file; returns the names mentioning the term.

    With ``state_path`` the averages come from the state of each month, which ``done`` brings up to date.

    The names are left for the caller to show, or written to ``mentions_path`` in full and returned from there.
    """
    stored = stored_recipes(spark, job)
    names = recipes.mentioning(stored, job.term)
    if job.mentions_path:
        write_csv_report(names, job.mentions_path)
        names = read_csv_report(spark, job.mentions_path, names.schema)
    if job.state_path:
        report = recipes.report_of_state(refresh_state(spark, job, done))
    else:
        report = recipes.difficulty_report(recipes.aggregation_input(stored, job.term))
    write_csv_report(report, job.report_path, single_file=True)
    return names


def run_recipes(spark: SparkSession, job: RecipeJob) -> tuple[Ingested, DataFrame]:
    """The whole job: the report follows whatever the ingestion did, a skipped run included."""
    done = ingest_recipes(spark, job)
    return done, report_recipes(spark, job, done)
