"""Loads by ledger, snapshots, merging by key and of files: what fails, what changed, what must not be touched."""

import glob
import json
import os
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from larder.operators import recipes
from larder.operators.merge import latest_per_key
from larder.plans.recipes import RecipeJob, ingest_recipes, load_apart, load_recipes, run_recipes, stored_recipes
from larder.schemas import CLEANSED_RECIPE, DIFFICULTY_REPORT
from larder.sources import latest
from larder.sources.csv_report import read_csv_report
from larder.sources.history_table import HistoryTable
from larder.sources.lake import compact_lake, merge_lake, read_lake, write_lake
from larder.sources.latest import latest_rows
from larder.sources.ledger import FileLedger
from larder.sources.quarantine import good_path, read_quarantined
from larder.sources.snapshots import expire_snapshots


def put(folder, name, *rows):
    """Writes recipes ``(name, date, cook)`` as a file."""
    folder.mkdir(exist_ok=True, parents=True)
    lines = [json.dumps({"name": n, "datePublished": d, "cookTime": c, "prepTime": "PT1M", "image": n}) for n, d, c in rows]
    (folder / name).write_text("\n".join(lines) + "\n")


def job_in(spark, tmp_path, **changes):
    job = RecipeJob(
        str(tmp_path / "in"), str(tmp_path / "lake"), str(tmp_path / "report"), str(tmp_path / "history"),
        **{"ledger_path": str(tmp_path / "ledger"), **changes},
    )
    HistoryTable(spark, job.history_path).seed(job.etl_name)
    return job


def names(df):
    return sorted(r.recipeName for r in df.collect())


def files_of(job, spark, run_id):
    found = FileLedger(spark, job.ledger_path, job.input_path).loaded(job.etl_name, run_id + 1)
    return sorted(os.path.basename(r.path) for r in found.where(F.col("run_id") == run_id).collect())


# ---------------------------------------------------------------- ledger


def test_delta_reads_the_unseen_files(spark, tmp_path):
    job = job_in(spark, tmp_path)
    put(tmp_path / "in", "a.json", ("a", "2013-03-28", "PT1M"))
    assert ingest_recipes(spark, job).mode == "full"
    put(tmp_path / "in", "b.json", ("late", "2012-01-01", "PT1M"), ("undated", "?", "PT1M"))
    put(tmp_path / "in" / "deep", "c [1].json", ("c", "2013-04-01", "PT1M"))
    os.utime(tmp_path / "in" / "b.json", (1, 1))  # older than the run before, by its clock
    done = ingest_recipes(spark, job)
    assert (done.mode, done.watermark) == ("delta", "2013-04-01")
    assert names(stored_recipes(spark, job)) == ["a", "c", "late", "undated"]
    assert files_of(job, spark, 1) == ["a.json"] and files_of(job, spark, 2) == ["b.json", "c [1].json"]
    assert ingest_recipes(spark, job).watermark == "2013-04-01" and files_of(job, spark, 3) == []
    assert names(stored_recipes(spark, job)) == ["a", "c", "late", "undated"]


def test_changed_file_fails_or_is_merged(spark, tmp_path):
    job = job_in(spark, tmp_path)
    put(tmp_path / "in", "a.json", ("a", "2013-03-28", "PT1M"))
    ingest_recipes(spark, job)
    put(tmp_path / "in", "a.json", ("a", "2013-03-28", "PT9M"), ("b", "2013-03-29", "PT1M"))
    with pytest.raises(ValueError, match="a.json"):
        ingest_recipes(spark, job)
    assert names(stored_recipes(spark, job)) == ["a"]
    ingest_recipes(spark, replace(job, merge_keys=("image",)))
    assert {r.recipeName: r.cookTimeMinutes for r in stored_recipes(spark, job).collect()} == {"a": 9, "b": 1}
    # The same length, another time.
    os.utime(tmp_path / "in" / "a.json", (time.time() + 50,) * 2)
    with pytest.raises(ValueError):
        ingest_recipes(spark, job)


def test_files_of_a_failed_attempt_do_not_count(spark, tmp_path):
    job = job_in(spark, tmp_path, strict_durations=True, stage_by_run=True)
    put(tmp_path / "in", "a.json", ("a", "2013-03-28", "PT1M"))
    ingest_recipes(spark, job)
    put(tmp_path / "in", "b.json", ("b", "2013-03-28", "PT1M"))
    put(tmp_path / "in", "c.json", ("c", "2013-03-29", "PTxM"))
    with pytest.raises(Exception, match="(?i)duration|PTxM|USER_RAISED"):
        ingest_recipes(spark, job)
    put(tmp_path / "in", "c.json", ("c", "2013-03-29", "PT2M"))
    ingest_recipes(spark, job)
    assert names(stored_recipes(spark, job)) == ["a", "b", "c"] and files_of(job, spark, 2) == ["b.json", "c.json"]


def test_full_load_starts_the_ledger_anew(spark, tmp_path):
    job = job_in(spark, tmp_path)
    put(tmp_path / "in", "a.json", ("a", "2013-03-28", "PT1M"))
    ingest_recipes(spark, job)
    kept = (tmp_path / "in" / "a.json").rename(tmp_path / "a.json")
    history = HistoryTable(spark, job.history_path)
    from larder.operators import history as runs

    history.append(runs.seed(spark, job.etl_name, run_id=3))
    put(tmp_path / "in", "b.json", ("b", "2013-03-29", "PT1M"))
    assert ingest_recipes(spark, job).mode == "full" and names(stored_recipes(spark, job)) == ["b"]
    kept.rename(tmp_path / "in" / "a.json")  # as it was; loaded by a run whose rows are gone
    ingest_recipes(spark, job)
    assert names(stored_recipes(spark, job)) == ["a", "b"]


def test_ledger_without_files(spark, tmp_path):
    job = job_in(spark, tmp_path)
    (tmp_path / "in").mkdir()
    assert ingest_recipes(spark, job).watermark is None
    put(tmp_path / "in", "a.json", ("a", "2013-03-28", "PT1M"))
    assert ingest_recipes(spark, job).mode == "full"  # no mark yet
    assert names(stored_recipes(spark, job)) == ["a"]


def test_options_that_exclude_each_other(spark, tmp_path):
    job = job_in(spark, tmp_path)
    put(tmp_path / "in", "a.json", ("a", "2013-03-28", "PT1M"))
    for changes in ({"lookback_days": 3}, {"new_files_only": True}):
        with pytest.raises(ValueError):
            ingest_recipes(spark, replace(job, **changes))
    for changes in ({"stage_by_run": True}, {"merge_keys": ("image",)}):
        with pytest.raises(ValueError):
            ingest_recipes(spark, replace(job, snapshots=True, **changes))
    assert not (tmp_path / "lake").exists()


# ---------------------------------------------------------------- snapshots


def test_full_load_that_fails_midway(spark, tmp_path):
    job = job_in(spark, tmp_path, ledger_path=None, snapshots=True, strict_durations=True)
    put(tmp_path / "in", "a.json", ("a", "2013-03-28", "PT1M"))
    ingest_recipes(spark, job)
    from larder.operators import history as runs

    history = HistoryTable(spark, job.history_path)
    history.append(runs.seed(spark, job.etl_name, run_id=3).withColumn("filter_col2_name", F.lit("snapshot")).withColumn("filter_col2_value", F.lit("1")))
    put(tmp_path / "in", "b.json", *((f"b{i}", "2013-03-29", "PT2M") for i in range(500)))
    put(tmp_path / "in", "c.json", ("c", "2013-03-29", "PTxM"))
    with pytest.raises(Exception):
        ingest_recipes(spark, job)
    assert names(stored_recipes(spark, job)) == ["a"]
    put(tmp_path / "in", "c.json", ("c", "2013-03-29", "PT2M"))
    ingest_recipes(spark, job)
    assert len(names(stored_recipes(spark, job))) == 502
    assert expire_snapshots(history, job.etl_name, job.lake_path) == [1]
    assert expire_snapshots(history, job.etl_name, job.lake_path) == []
    assert len(names(stored_recipes(spark, job))) == 502


def test_delta_counts_with_its_history_row(spark, tmp_path, monkeypatch):
    job = job_in(spark, tmp_path, snapshots=True)
    with pytest.raises(ValueError, match="no snapshot"):
        stored_recipes(spark, job)
    put(tmp_path / "in", "a.json", ("a", "2013-03-28", "PT1M"))
    ingest_recipes(spark, job)
    put(tmp_path / "in", "b.json", ("b", "2013-03-29", "PT1M"))

    def dies(self, rows):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(HistoryTable, "append", dies)
        with pytest.raises(RuntimeError):
            ingest_recipes(spark, job)
    assert names(stored_recipes(spark, job)) == ["a"]  # written, but not a run yet
    put(tmp_path / "in", "c.json", ("c", "2013-03-30", "PT1M"))
    ingest_recipes(spark, job)
    assert names(stored_recipes(spark, job)) == ["a", "b", "c"]


def test_delta_of_a_table_without_snapshots(spark, tmp_path):
    job = job_in(spark, tmp_path)
    put(tmp_path / "in", "a.json", ("a", "2013-03-28", "PT1M"))
    ingest_recipes(spark, job)
    with pytest.raises(ValueError, match="no snapshot"):
        ingest_recipes(spark, replace(job, snapshots=True))


# ---------------------------------------------------------------- merging by key


ROWS = "k string, at int, v string, year int, month int"


def lake_files(path):
    return {p: os.path.getmtime(p) for p in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def merged(spark, path, rows):
    df = spark.createDataFrame(rows, ROWS)
    merge_lake(df, path, df.schema, ["k"], ["at"])
    return sorted(map(tuple, read_lake(spark, path, df.schema).collect()), key=str)


def test_merge_rewrites_touched_months_only(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [("a", 1, "a1", 2020, 1), ("b", 1, "b1", 2020, 2), ("c", 1, "c1", 2020, 3), ("d", 1, "d1", None, None), (None, 1, "n", 2020, 1)]
    df = spark.createDataFrame(first, ROWS)
    write_lake(df, path, "overwrite")
    before = lake_files(path)
    # b moves to another month and leaves its own empty, d gets a date, an older a and an equal c come late.
    new = [("b", 2, "b2", 2020, 4), ("d", 2, "d2", 2020, 4), ("a", 0, "a0", 2020, 1), (None, 1, "n", 2020, 1), ("b", 2, "b2", 2020, 4)]
    found = merged(spark, path, new)
    expected = [("a", 1, "a1", 2020, 1), ("b", 2, "b2", 2020, 4), ("c", 1, "c1", 2020, 3), ("d", 2, "d2", 2020, 4)]
    assert found == sorted([*expected, *[(None, 1, "n", 2020, 1)] * 2], key=str)
    after = lake_files(path)
    same = {p for p in before if after.get(p) == before[p]}
    assert {p.split("/")[-2] for p in same} == {"month=3"}
    assert not os.path.exists(f"{path}/year=2020/month=2")
    assert not glob.glob(f"{path}/year=__HIVE*/month=*/*.parquet")
    assert merged(spark, path, [r for r in new if r[0]]) == found  # again, without effect


def test_new_row_wins_among_equals(spark, tmp_path):
    path = str(tmp_path / "t")
    write_lake(spark.createDataFrame([("a", 1, "old", 2020, 1)], ROWS), path, "overwrite")
    assert merged(spark, path, [("a", 1, "new", 2020, 1)]) == [("a", 1, "new", 2020, 1)]
    assert merged(spark, path, []) == [("a", 1, "new", 2020, 1)]


def test_hot_key_leaves_each_task_as_one_row(spark):
    df = spark.range(0, 40_000, 1, 16).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("at")
    )
    latest = latest_per_key(df, ["k"], ["at"])
    assert latest.count() == 13_335 and latest.where("k = 'hot'").first().at == 39_998
    partial = latest._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in partial and "Window" not in partial


def test_latest_per_key_ties_and_nulls(spark):
    rows = [("a", None, "x"), ("a", None, "y"), ("b", 1, "z"), ("b", None, "w"), (None, 5, "p"), (None, 5, "p")]
    df = spark.createDataFrame(rows, "k string, at int, v string")
    runs = [sorted(map(tuple, latest_per_key(df.repartition(n), ["k"], ["at"]).collect()), key=str) for n in (1, 3, 6)]
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) == 4
    assert ("b", 1, "z") in runs[0] and runs[0].count((None, 5, "p")) == 2


# ---------------------------------------------------------------- merging of files


def test_compaction(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = spark.createDataFrame([], ROWS).schema
    for i in range(5):
        rows = [(f"{i}-{j}", j, "v" * 50, 2020, 1) for j in range(2000)] + ([("x", 1, "x", 2020, 2)] if i == 0 else [])
        rows += [(f"u{i}", 1, "u", None, None)]
        write_lake(spark.createDataFrame(rows, ROWS), path, "append" if i else "overwrite")
    before, rows = lake_files(path), sorted(map(str, read_lake(spark, path, schema).collect()))
    size = sum(os.path.getsize(p) for p in before if "month=1" in p)
    assert compact_lake(spark, path, schema, file_bytes=size // 2) == 2
    after = lake_files(path)
    assert sorted(map(str, read_lake(spark, path, schema).collect())) == rows
    assert len([p for p in after if "month=1" in p]) <= 3 < len([p for p in before if "month=1" in p])
    assert len([p for p in after if "month=__HIVE" in p]) == 1
    assert [p for p in after if "month=2" in p] == [p for p in before if "month=2" in p]
    assert compact_lake(spark, path, schema, file_bytes=1 << 30) == 1  # the two files of month 1
    assert compact_lake(spark, path, schema, file_bytes=1 << 30) == 0


def test_compaction_keeps_runs_apart(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = spark.createDataFrame([], ROWS).schema
    for run in (1, 2):
        df = spark.createDataFrame([(f"{run}-{j}", j, "v", 2020, 1) for j in range(100)], ROWS)
        df.withColumn("run_id", F.lit(run).cast("bigint")).repartition(4).write.mode("append").partitionBy("run_id", "year", "month").parquet(path)
    assert compact_lake(spark, path, schema) == 2
    assert len(lake_files(path)) == 2 and read_lake(spark, path, schema).count() == 200
    assert len(glob.glob(f"{path}/run_id=1/year=2020/month=1/*.parquet")) == 1


def test_load_of_no_files(spark):
    assert load_recipes(spark, []).collect() == []


# ---------------------------------------------------------------- incremental report


def report_of(spark, job):
    return dict(map(tuple, read_csv_report(spark, job.report_path, DIFFICULTY_REPORT).collect()))


def full_report(spark, job):
    return dict(map(tuple, recipes.difficulty_report(recipes.aggregation_input(stored_recipes(spark, job))).collect()))


def test_report_of_changed_months(spark, tmp_path):
    job = job_in(spark, tmp_path, state_path=str(tmp_path / "state"))
    put(tmp_path / "in", "a.json", ("a", "2013-01-05", "PT9M"), ("b", "2013-02-05", "PT40M"), ("c", "2013-02-06", None))
    run_recipes(spark, job)
    assert report_of(spark, job) == full_report(spark, job) == {"easy": 10.0, "medium": 41.0, "hard": None}
    before = lake_files(job.state_path)
    put(tmp_path / "in", "b.json", ("d", "2013-02-07", "PT50M"), ("e", "2013-03-01", "PT2H"), ("u", "?", "PT19M"))
    done, _ = run_recipes(spark, job)
    assert set(done.months) == {(2013, 2), (2013, 3), (None, None)}
    assert report_of(spark, job) == full_report(spark, job) == {"easy": 15.0, "medium": 46.0, "hard": 121.0}
    after = lake_files(job.state_path)
    assert {p.split("/")[-2] for p in before if after.get(p) == before[p]} == {"month=1"}
    assert run_recipes(spark, job)[0].months == ()
    assert lake_files(job.state_path) == after and report_of(spark, job) == full_report(spark, job)


def test_state_that_missed_a_run(spark, tmp_path):
    """A job that died between its load and its report: the next report sums up everything."""
    job = job_in(spark, tmp_path, state_path=str(tmp_path / "state"))
    put(tmp_path / "in", "a.json", ("a", "2013-01-05", "PT9M"))
    run_recipes(spark, job)
    put(tmp_path / "in", "b.json", ("b", "2013-02-05", "PT19M"))
    ingest_recipes(spark, job)
    put(tmp_path / "in", "c.json", ("c", "2013-03-05", "PT29M"))
    run_recipes(spark, job)
    assert report_of(spark, job) == full_report(spark, job) == {"easy": 15.0, "medium": 30.0}


def test_state_with_merged_rows(spark, tmp_path):
    job = job_in(spark, tmp_path, state_path=str(tmp_path / "state"), merge_keys=("image",))
    put(tmp_path / "in", "a.json", ("a", "2013-01-05", "PT9M"), ("b", "2013-01-06", "PT19M"))
    run_recipes(spark, job)
    put(tmp_path / "in", "b.json", ("b", "2013-02-06", "PT1H"))
    run_recipes(spark, job)
    assert report_of(spark, job) == full_report(spark, job) == {"easy": 10.0, "hard": 61.0}


# ---------------------------------------------------------------- quarantine


def test_lines_put_aside(spark, tmp_path):
    rows = [("ok", "2013-01-05", "PT9M"), (None, "2013-01-05", "PT9M"), ("undated", None, None), ("date", "soon", "PT9M"), ("time", "2013-01-05", "PTxM")]
    put(tmp_path / "in", "a.json", *rows)
    with (tmp_path / "in" / "a.json").open("a") as file:
        file.write('{bad\n{"name": "cut", "datePub\n')
    path = str(tmp_path / "t")
    load_apart(spark, job_in(spark, tmp_path).input_path, path)
    good = read_lake(spark, good_path(path), CLEANSED_RECIPE)
    aside = {r.line: r.reason for r in read_quarantined(spark, path, CLEANSED_RECIPE).collect()}
    assert names(good) == ["ok", "undated"] and good.columns == CLEANSED_RECIPE.fieldNames()
    assert sorted(aside.values()) == ["date", "duration", "line", "line", "name"]
    assert aside["{bad"] == "line" and aside['{"name": "cut", "datePub'] == "line"
    assert [json.loads(line)["name"] for line, reason in aside.items() if reason == "date"] == ["date"]
    load_apart(spark, [str(tmp_path / "in")], path, "append")
    assert len(names(read_lake(spark, good_path(path), CLEANSED_RECIPE))) == 4


def wide_rows(spark, ids, at):
    """Rows of 20 KB that do not compress, four of five with a key of their own, in two months."""
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(320)), lambda i: F.sha2(F.concat_ws("-", "id", i, F.lit(at)), 256)), "")
    key = F.when(F.col("id") % 5 > 0, F.concat(F.lit("k"), "id"))
    month = (1 + F.col("id") % 2).cast("int").alias("month")
    return ids.select(key.alias("k"), F.lit(at).alias("at"), text.alias("v"), F.lit(2020).alias("year"), month)


def test_latest_of_wide_rows_moves_no_rows(spark):
    ids = spark.range(0, 400, 1, 4)
    both = wide_rows(spark, ids, 1).unionByName(wide_rows(spark, ids.where("id % 3 = 0"), 2)).unionByName(wide_rows(spark, ids.where("id < 50"), 1))
    expected = sorted(map(tuple, latest_per_key(both, ["k"], ["at"]).select("k", "at", F.xxhash64("v"), "year", "month").collect()), key=str)
    with latest_rows(both, ["k"], ["at"]) as kept:
        rows = sorted(map(tuple, kept.select("k", "at", F.xxhash64("v"), "year", "month").collect()), key=str)
        plan = kept._jdf.queryExecution().executedPlan().toString()
    assert rows == expected and len(rows) == 320 + 80 + 27 + 10
    assert "Sort" not in plan and "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_latest_of_rows_by_shuffled_places(spark, monkeypatch):
    """The same rows where the places that stay are too many to broadcast, over files of more rows than one bitmap holds."""
    df = spark.range(0, 200_000, 1, 2).select(
        (F.col("id") % 70_000).cast("string").alias("k"), (F.col("id") % 7).cast("int").alias("at"), F.col("id").alias("v")
    )
    expected = latest_per_key(df, ["k"], ["at"]).agg(F.count("*"), F.sum("v")).first()
    for most in (16_384, 0):
        monkeypatch.setattr(latest, "BITMAPS_BROADCAST", most)
        with latest_rows(df, ["k"], ["at"]) as kept:
            assert kept.groupBy("k").count().where("count > 1").isEmpty()
            assert kept.count() == expected[0] == 70_000
            best = df.groupBy("k").agg(F.max("at").alias("at"))
            assert kept.join(best, ["k", "at"]).count() == 70_000


def test_merge_of_known_rows_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [(f"k{i}", 1, f"v{i}", 2020, 1 + i % 3) for i in range(30)] + [(None, 1, "n", 2020, 3), ("u", 1, None, None, None)]
    write_lake(spark.createDataFrame(first, ROWS), path, "overwrite")
    before = lake_files(path)
    found = merged(spark, path, [row for row in first if row[0]])
    assert found == sorted(first, key=str) and lake_files(path) == before
    # One row of one month differs, in NULL against text only.
    found = merged(spark, path, [("k0", 1, None, 2020, 1), *first[1:30]])
    assert ("k0", 1, None, 2020, 1) in found and len(found) == len(first)
    after = lake_files(path)
    assert {p.split("/")[-2] for p in before if p not in after} == {"month=1"}


def test_merge_of_structs(spark, tmp_path):
    """Columns without a digest are merged as well."""
    path = str(tmp_path / "t")
    schema = "k string, at int, v struct<a:int,b:string>, year int, month int"
    df = spark.createDataFrame([("a", 1, (1, "x"), 2020, 1), ("b", 1, None, 2020, 2)], schema)
    write_lake(df, path, "overwrite")
    new = spark.createDataFrame([("a", 2, (2, None), 2020, 3)], schema)
    merge_lake(new, path, df.schema, ["k"], ["at"])
    assert sorted((r.k, r.at, r.v, r.month) for r in read_lake(spark, path, df.schema).collect()) == [("a", 2, (2, None), 3), ("b", 1, None, 2)]
