"""Cleansing, reports and whole jobs over a few recipes of our own."""

import datetime
import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from larder.__main__ import main
from larder.operators import history as runs
from larder.operators import recipes
from larder.plans.recipes import RecipeJob, ingest_recipes, load_recipes, report_recipes, run_recipes
from larder.schemas import CLEANSED_RECIPE, RAW_RECIPE
from larder.sources.history_table import HistoryTable
from larder.sources.json_lines import line_counts, read_json_lines
from larder.sources.lake import read_lake


def recipe(name, date="2013-03-01", cook="PT10M", prep="PT5M", ingredients="salt", **more):
    return dict(
        name=name, datePublished=date, cookTime=cook, prepTime=prep, ingredients=ingredients, **more
    )


FIXTURE = [
    recipe(" Beef Stew ", "2013-03-28", "PT1H20M", "PT10M", "1 lb Ground BEEF\nsalt"),
    recipe("Short", "2013-03-02", "PT29M", "PT"),
    recipe("Half", "2013-03-03", "PT30M", ""),
    recipe("Hour", "2013-03-04", "PT1H", "PT"),
    recipe("Over", "2013-03-05", "PT1H", "PT1M"),
    recipe("Uncooked", "2013-03-06", None, "PT1M"),
    recipe("Decimal", "2013-03-07", "PT1.5H", "PT1M"),
    recipe(None),
    recipe("   ", "2013-03-08"),
    recipe("Undated", "not-a-date"),
    recipe("Empty", "2013-03-09", ingredients=None),
    recipe("Trailing", "2013-03-10", ingredients="a\n"),
    recipe("Extra", "2013-03-11", recipeYield=4, keywords="x"),
]


def write_lines(folder, name, rows, extra=()):
    folder.mkdir(exist_ok=True)
    kept = [json.dumps({k: v for k, v in row.items() if v is not None}) for row in rows]
    (folder / name).write_text("\n".join([*kept, *extra]) + "\n")
    return str(folder)


@pytest.fixture
def source(tmp_path):
    return write_lines(tmp_path / "input", "recipes-000.json", FIXTURE, ["{bad"])


def by_name(df):
    return {row.recipeName: row for row in df.collect()}


def test_cleanse(spark, source):
    cleansed = load_recipes(spark, source)
    assert cleansed.schema.simpleString() == CLEANSED_RECIPE.simpleString()
    rows = by_name(cleansed)
    assert cleansed.count() == 12 and "" in rows and None not in rows
    stew = rows["Beef Stew"]
    assert (stew.cookTimeMinutes, stew.prepTimeMinutes) == (80, 10)
    assert stew.datePublished == datetime.date(2013, 3, 28)
    assert (stew.year, stew.month) == (2013, 3)
    assert stew.ingredients_arr == ["1 lb Ground BEEF", "salt"]
    assert rows["Half"].prepTimeMinutes == 0
    assert rows["Uncooked"].cookTimeMinutes is None
    assert rows["Decimal"].cookTimeMinutes is None
    undated = rows["Undated"]
    assert undated.datePublished is None and undated.year is None and undated.month is None
    assert rows["Empty"].ingredients_arr is None
    assert rows["Trailing"].ingredients_arr == ["a", ""]
    assert rows["Extra"].recipeYield == "4"


def test_cleanse_delta_is_strict(spark, source):
    assert set(by_name(load_recipes(spark, source, "2013-03-10"))) == {"Beef Stew", "Extra"}
    assert set(by_name(load_recipes(spark, source, "2013-03-10", lookback_days=1))) == {
        "Beef Stew",
        "Extra",
        "Trailing",
    }


def test_malformed_lines_are_counted(spark, source):
    read = read_json_lines(spark, source, RAW_RECIPE, keep_corrupt=True)
    assert line_counts(read, "name").first() == (14, 1, 1)


def test_several_folders(spark, tmp_path):
    first = write_lines(tmp_path / "a", "x.json", FIXTURE[:2])
    second = write_lines(tmp_path / "b", "x.json", FIXTURE[2:4])
    assert load_recipes(spark, [first, second]).count() == 4


def test_aggregation_input(spark, source):
    rows = by_name(recipes.aggregation_input(load_recipes(spark, source)))
    assert rows["Beef Stew"][1:] == (1, 90, "hard")
    assert rows["Short"][1:] == (0, 29, "easy")
    assert rows["Half"][1:] == (0, 30, "medium")
    assert rows["Hour"][1:] == (0, 60, "medium")
    assert rows["Over"][1:] == (0, 61, "hard")
    assert rows["Uncooked"][1:] == (0, None, "hard")
    assert rows["Empty"][1:] == (0, 15, "easy")


def test_reports(spark, source):
    prepared = recipes.aggregation_input(load_recipes(spark, source))
    # easy: 29 and six times 15; hard: 90 and 61, the unknown times do not count.
    assert dict(recipes.difficulty_report(prepared).collect()) == {
        "easy": 17.0,
        "medium": 45.0,
        "hard": 76.0,
    }
    only = recipes.difficulty_report(prepared, only=F.col("is_beef_recipe") == 1)
    assert dict(only.collect()) == {"hard": 90.0}


def job_at(folder, source, **changes):
    paths = {name: str(folder / name) for name in ("lake", "report", "history", "mentions")}
    return RecipeJob(
        source,
        paths["lake"],
        paths["report"],
        paths["history"],
        mentions_path=paths["mentions"],
        **changes,
    )


def history_rows(spark, job):
    rows = HistoryTable(spark, job.history_path).read().orderBy("id").collect()
    return [(r.id, r.full_load, r.filter_col1_value) for r in rows]


def stored_names(spark, job):
    rows = read_lake(spark, job.lake_path, CLEANSED_RECIPE).select("recipeName").collect()
    return sorted(row.recipeName for row in rows)


@pytest.mark.parametrize("stage_by_run", [False, True])
@pytest.mark.parametrize("clustered", [False, True])
def test_full_delta_empty_delta(spark, tmp_path, source, stage_by_run, clustered):
    job = job_at(tmp_path, source, stage_by_run=stage_by_run, clustered=clustered)
    HistoryTable(spark, job.history_path).seed(job.etl_name)
    HistoryTable(spark, job.history_path).seed(job.etl_name)
    done = ingest_recipes(spark, job)
    assert (done.mode, done.run_id, done.watermark) == ("full", 1, "2013-03-28")
    assert len(stored_names(spark, job)) == 12

    write_lines(
        tmp_path / "input",
        "recipes-001.json",
        [recipe("Same day", "2013-03-28"), recipe("New", "2013-04-01"), recipe("Lost", "oops")],
    )
    done = ingest_recipes(spark, job)
    assert (done.mode, done.run_id, done.watermark) == ("delta", 2, "2013-04-01")
    assert len(stored_names(spark, job)) == 13

    for run_id in (3, 4):
        done = ingest_recipes(spark, job)
        assert (done.mode, done.run_id, done.watermark) == ("delta", run_id, "2013-04-01")
    write_lines(tmp_path / "input", "recipes-002.json", [recipe("Newest", "2014-01-01")])
    assert ingest_recipes(spark, job).watermark == "2014-01-01"
    assert len(stored_names(spark, job)) == 14
    assert history_rows(spark, job) == [
        (1, "Y", None),
        (2, "N", "2013-03-28"),
        (3, "N", "2013-04-01"),
        (4, "N", "2013-04-01"),
        (5, "N", "2013-04-01"),
        (6, "N", "2014-01-01"),
    ]


def control_row(spark, job, **values):
    """A row put into the history by hand."""
    row = runs.seed(spark, job.etl_name, run_id=values.pop("id"))
    row = row.withColumns({name: F.lit(value).cast("string") for name, value in values.items()})
    HistoryTable(spark, job.history_path).append(row)


def test_skipped_run_still_reports(spark, tmp_path, source):
    job = job_at(tmp_path, source)
    HistoryTable(spark, job.history_path).seed(job.etl_name)
    ingest_recipes(spark, job)
    control_row(spark, job, id=9, skip_execution="Y", full_load="N", filter_col1_value="2013-03-28")
    before = history_rows(spark, job)
    done, names = run_recipes(spark, job)
    assert done.mode == "skip" and done.run_id == 9
    assert history_rows(spark, job) == before
    assert [row[0] for row in names.collect()] == ["Beef Stew"]
    report = spark.read.option("header", True).csv(job.report_path)
    assert sorted(map(tuple, report.collect())) == [("easy", "17.0"), ("hard", "76.0"), ("medium", "45.0")]
    assert spark.read.option("header", True).csv(job.mentions_path).collect() == names.collect()


def test_no_active_run(spark, tmp_path, source, caplog):
    job = job_at(tmp_path, source)
    HistoryTable(spark, job.history_path).seed("another pipeline")
    assert ingest_recipes(spark, job).mode == "skip"
    control_row(spark, job, id=2, is_active="N")
    assert ingest_recipes(spark, job).mode == "skip"
    assert "no active run" in caplog.text
    assert not (tmp_path / "lake").exists()


@pytest.mark.parametrize("mark", [None, "null", "None"])
def test_delta_without_watermark(spark, tmp_path, source, mark):
    job = job_at(tmp_path, source)
    control_row(spark, job, id=1, full_load="N", filter_col1_value=mark)
    with pytest.raises(ValueError, match="stores no watermark"):
        ingest_recipes(spark, job)
    assert not (tmp_path / "lake").exists()
    assert len(history_rows(spark, job)) == 1


def test_full_load_without_dates_stays_full(spark, tmp_path):
    job = job_at(tmp_path, write_lines(tmp_path / "input", "x.json", [recipe("A", "oops")]))
    HistoryTable(spark, job.history_path).seed(job.etl_name)
    assert ingest_recipes(spark, job).watermark is None
    assert ingest_recipes(spark, job).mode == "full"
    assert stored_names(spark, job) == ["A"]


def test_full_load_replaces_all(spark, tmp_path, source):
    job = job_at(tmp_path, source)
    HistoryTable(spark, job.history_path).seed(job.etl_name)
    ingest_recipes(spark, job)
    control_row(spark, job, id=7, full_load="Y", filter_col1_value="2013-03-28")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_lines(tmp_path / "input", "recipes-000.json", [recipe("Only", "2015-05-05")])
        assert ingest_recipes(spark, job).mode == "full"
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert stored_names(spark, job) == ["Only"]


def test_attempt_that_fails_before_the_history(spark, tmp_path, source, monkeypatch):
    """Staged by run, a second attempt replaces the rows of the first."""
    job = job_at(tmp_path, source, stage_by_run=True)
    HistoryTable(spark, job.history_path).seed(job.etl_name)
    ingest_recipes(spark, job)
    write_lines(tmp_path / "input", "recipes-001.json", [recipe("New", "2013-04-01")])
    with monkeypatch.context() as patch:
        patch.setattr(HistoryTable, "append", lambda self, rows: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest_recipes(spark, job)
    assert ingest_recipes(spark, job).run_id == 2
    assert stored_names(spark, job).count("New") == 1
    assert len(stored_names(spark, job)) == 13


def test_report_reads_only_what_it_needs(spark, tmp_path, source):
    job = job_at(tmp_path, source)
    HistoryTable(spark, job.history_path).seed(job.etl_name)
    ingest_recipes(spark, job)
    stored = read_lake(spark, job.lake_path, CLEANSED_RECIPE)
    names = recipes.mentioning(stored)
    report = recipes.difficulty_report(recipes.aggregation_input(stored))
    plan = report._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "ReadSchema: struct<cookTimeMinutes:int,prepTimeMinutes:int>" in plan
    plan = names._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "ReadSchema: struct<recipeName:string,ingredients_arr:array<string>>" in plan
    assert "Exchange" not in plan and "Python" not in plan


def test_old_files_left_unread(spark, tmp_path, source, monkeypatch):
    """A delta leaves files older than the run before it unread; one that lands during a load is loaded next."""
    job = replace(job_at(tmp_path, source), new_files_only=True)
    HistoryTable(spark, job.history_path).seed(job.etl_name)
    os.utime(tmp_path / "input" / "recipes-000.json", (0, 0))
    ingest_recipes(spark, job)
    began = HistoryTable(spark, job.history_path).read().orderBy(F.desc("id")).first().run_date.timestamp()
    before = len(stored_names(spark, job))
    write_lines(tmp_path / "input", "recipes-001.json", [recipe("Landed", "2014-03-25")])
    os.utime(tmp_path / "input" / "recipes-001.json", (began, began))
    scanned = []

    def load_recipes_seen(*args, **options):
        rows = load_recipes(*args, **options)
        scanned.extend(rows.inputFiles())
        return rows

    monkeypatch.setattr("larder.plans.recipes.load_recipes", load_recipes_seen)
    done = ingest_recipes(spark, job)
    assert [os.path.basename(name) for name in scanned] == ["recipes-001.json"]
    assert (done.mode, done.watermark) == ("delta", "2014-03-25")
    assert len(stored_names(spark, job)) == before + 1


def test_lookback_takes_late_rows_once(spark, tmp_path, source):
    """Rows of months before the window stay, undated ones as well, and the watermark does not move back."""
    job = replace(job_at(tmp_path, source), lookback_days=7)
    HistoryTable(spark, job.history_path).seed(job.etl_name)
    ingest_recipes(spark, job)
    before = stored_names(spark, job)
    write_lines(tmp_path / "input", "recipes-001.json", [recipe("Late", "2013-03-25")])
    for _ in range(2):
        done = ingest_recipes(spark, job)
    assert (done.mode, done.watermark) == ("delta", "2013-03-28")
    assert sorted(map(str, stored_names(spark, job))) == sorted(map(str, [*before, "Late"]))


@pytest.mark.parametrize(
    "changes",
    [{"stage_by_run": True}, {"new_files_only": True}, {"reader_options": {"modifiedAfter": "2001-01-01T00:00:00"}}],
)
def test_lookback_that_cannot_be_exact(spark, tmp_path, source, changes):
    job = replace(job_at(tmp_path, source), lookback_days=7, **changes)
    HistoryTable(spark, job.history_path).seed(job.etl_name)
    with pytest.raises(ValueError, match="lookback"):
        ingest_recipes(spark, job)
    assert not os.path.exists(job.lake_path)


@pytest.mark.parametrize("first", [True, False])
def test_layout_cannot_change(spark, tmp_path, source, first):
    job = replace(job_at(tmp_path, source), stage_by_run=first)
    HistoryTable(spark, job.history_path).seed(job.etl_name)
    ingest_recipes(spark, job)
    files, rows = sorted(os.walk(job.lake_path)), history_rows(spark, job)
    write_lines(tmp_path / "input", "recipes-001.json", [recipe("New", "2014-03-25")])
    with pytest.raises(ValueError, match="run_id"):
        ingest_recipes(spark, replace(job, stage_by_run=not first))
    assert (sorted(os.walk(job.lake_path)), history_rows(spark, job)) == (files, rows)


def test_history_of_another_column(spark, tmp_path, source):
    job = job_at(tmp_path, source)
    HistoryTable(spark, job.history_path).seed(job.etl_name, "updated")
    with pytest.raises(ValueError, match="updated"):
        ingest_recipes(spark, job)
    assert not os.path.exists(job.lake_path)


def test_strict_durations_fail_the_job(spark, tmp_path):
    write_lines(tmp_path / "input", "recipes-000.json", [recipe("A", "2013-03-25") | {"cookTime": "PT1.5H"}])
    job = replace(job_at(tmp_path, str(tmp_path / "input")), strict_durations=True)
    HistoryTable(spark, job.history_path).seed(job.etl_name)
    with pytest.raises(Exception, match="cannot read as a duration"):
        ingest_recipes(spark, job)


def test_command_line(spark, tmp_path, source, capfd):
    main(
        ["--input", source, "--reader-option", "modifiedAfter=2001-01-01T00:00:00", "--lake", str(tmp_path / "lake"), "--report", str(tmp_path / "report")]
        + ["--history", str(tmp_path / "history"), "--seed", "--mentions", str(tmp_path / "names")]
    )
    assert len(list((tmp_path / "report").glob("part-*.csv"))) == 1
