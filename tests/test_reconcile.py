"""Months compared by digests, claims on runs, and order inside a month."""

import os
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from larder.operators.digests import differing_groups, group_digests
from larder.operators.rows import dated_between, with_year_month
from larder.plans.recipes import RecipeJob, ingest_recipes, load_recipes, run_recipes, stored_recipes
from larder.schemas import CLEANSED_RECIPE
from larder.sources.claims import RunClaims
from larder.sources.files import create_if_absent, remove_file
from larder.sources.history_table import HistoryTable
from larder.sources.lake import compact_lake, merge_lake, read_lake, write_lake
from tests.test_loads import full_report, lake_files, names, put, report_of

ROWS = "k string, v array<string>, d double, g int"


def job_in(spark, tmp_path, **changes):
    paths = (str(tmp_path / name) for name in ("in", "lake", "report", "history"))
    job = RecipeJob(*paths, **changes)
    HistoryTable(spark, job.history_path).seed(job.etl_name)
    return job


# ---------------------------------------------------------------- digests


def test_digests_by_brute_force(spark):
    """Two groups have one digest just if they hold the same rows, each as often."""
    rows = [
        ("a", ["x", None], 1.0), ("a", [None, "x"], 1.0), ("a", ["x"], 1.0), ("a", None, 1.0), ("a", [], 1.0), (None, ["a"], 1.0),
        (None, ["a"], None), ("", ["a"], None), (None, ["", "a"], None), (None, ["a", ""], None), (None, None, None), ("1.0", None, None),
        ("", None, None), ("x" * 100_000, [], 0.0), ("x" * 99_999, ["x"], 0.0), ("a", ["x", "y"], 2.0), ("a", ["xy"], 2.0),
    ]
    groups = [[row] for row in rows] + [[row, row] for row in rows[:4]] + [rows[:3], rows[2::-1], [*rows[:3], rows[0]], rows[:3] * 2]
    data = [(*row, g) for g, group in enumerate(groups) for row in group]
    df = spark.createDataFrame(data, ROWS).repartition(5)
    own = df.select("k", "v", "d", F.lit(0).alias("same"), "g")
    digests = {r.g: (r["rows"], r.sum1, r.sum2) for r in group_digests(own.drop("g").withColumn("g", F.lit(0)), ["g"]).collect()}
    assert digests[0][0] == len(data)
    found = {}
    for g in range(len(groups)):
        one = df.where(F.col("g") == g).drop("g").withColumn("g", F.lit(0))
        found[g] = tuple(group_digests(one, ["g"]).first())
    for i, first in enumerate(groups):
        for j, second in enumerate(groups):
            assert (found[i] == found[j]) == (sorted(map(str, first)) == sorted(map(str, second))), (first, second)


def test_differing_groups(spark):
    new = spark.createDataFrame([("a", None, 1.0, 1), ("b", None, 1.0, 2), ("c", None, 1.0, None), ("d", None, 1.0, 4)], ROWS)
    old = spark.createDataFrame([("a", None, 1.0, 1), ("b", [], 1.0, 2), ("d", None, 1.0, 5)], ROWS)

    def groups(left, right):
        return sorted(map(tuple, differing_groups(left, right, ["g"]).collect()), key=str)

    assert groups(new, old) == sorted([(2, 1, 1), (None, 1, 0), (4, 1, 0)], key=str)
    assert groups(new, new.union(new)) == sorted([(g, 1, 2) for g in (1, 2, None, 4)], key=str)
    assert groups(new, new.repartition(3)) == []
    empty = new.where("false")
    assert groups(empty, new) == [] and len(groups(new, empty)) == 4
    # Columns in another order are told apart by name, and more of them in the older table do not count.
    assert groups(new, new.select("g", "d", "v", "k", F.lit(1).alias("more"))) == []


def test_digests_of_nested_columns(spark):
    with pytest.raises(ValueError, match="nested"):
        group_digests(spark.range(1).select("id", F.struct("id").alias("nested")), ["id"])


def test_hot_group_leaves_each_task_as_one_row(spark):
    df = spark.range(0, 30_000, 1, 16).select("id", F.when(F.col("id") % 3 > 0, -1).otherwise(F.col("id")).alias("g"))
    digests = group_digests(df, ["g"])
    assert digests.where("g = -1").first()["rows"] == 20_000
    plan = digests._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Window" not in plan


# ---------------------------------------------------------------- reconciled loads


def test_late_rows_of_any_month(spark, tmp_path):
    job = job_in(spark, tmp_path, reconcile=True)
    put(tmp_path / "in", "a.json", ("a", "2013-03-28", "PT1M"), ("b", "2010-05-01", "PT1M"), ("c", "2011-01-01", None))
    assert ingest_recipes(spark, job).mode == "full"
    before = lake_files(job.lake_path)
    put(tmp_path / "in", "b.json", ("late", "2010-05-02", "PT1M"), ("undated", "?", "PT1M"), ("older", "2009-01-01", "PT1M"))
    done = ingest_recipes(spark, job)
    assert (done.mode, done.watermark) == ("delta", "2013-03-28")
    assert set(done.months) == {(2010, 5), (2009, 1), (None, None)}
    assert names(stored_recipes(spark, job)) == ["a", "b", "c", "late", "older", "undated"]
    after = lake_files(job.lake_path)
    kept = {tuple(p.split("/")[-3:-1]) for p in before if after.get(p) == before[p]}
    assert kept == {("year=2013", "month=3"), ("year=2011", "month=1")}
    # Nothing new, then a correction that keeps the number of rows.
    assert ingest_recipes(spark, job).months == () and lake_files(job.lake_path) == after
    put(tmp_path / "in", "a.json", ("a", "2013-03-28", "PT7M"), ("b", "2010-05-01", "PT1M"), ("c", "2011-01-01", None))
    assert ingest_recipes(spark, job).months == ((2013, 3),)
    assert {r.recipeName: r.cookTimeMinutes for r in stored_recipes(spark, job).collect()}["a"] == 7


def test_months_that_left_the_input(spark, tmp_path):
    job = job_in(spark, tmp_path, reconcile=True)
    put(tmp_path / "in", "a.json", ("a", "2013-03-28", "PT1M"), ("a2", "2013-03-29", "PT1M"))
    put(tmp_path / "in", "b.json", ("b", "2010-05-01", "PT1M"))
    ingest_recipes(spark, job)
    put(tmp_path / "in", "b.json", ("c", "2013-04-01", "PT1M"))
    ingest_recipes(spark, job)
    assert names(stored_recipes(spark, job)) == ["a", "a2", "b", "c"]
    put(tmp_path / "in", "a.json", ("a", "2013-03-28", "PT1M"))
    put(tmp_path / "in", "c.json", ("d", "2013-05-01", "PT1M"))
    with pytest.raises(ValueError, match="2013-3"):
        ingest_recipes(spark, job)
    assert names(stored_recipes(spark, job)) == ["a", "a2", "b", "c"]


def test_report_of_reconciled_months(spark, tmp_path):
    job = job_in(spark, tmp_path, reconcile=True, state_path=str(tmp_path / "state"))
    put(tmp_path / "in", "a.json", ("a", "2013-01-05", "PT9M"), ("b", "2013-02-05", "PT40M"))
    run_recipes(spark, job)
    put(tmp_path / "in", "b.json", ("c", "2013-01-07", "PT19M"), ("d", "?", "PT3H"))
    run_recipes(spark, job)
    assert report_of(spark, job) == full_report(spark, job) == {"easy": 15.0, "medium": 41.0, "hard": 181.0}


def test_reconcile_excludes_other_deltas(spark, tmp_path):
    job = job_in(spark, tmp_path, reconcile=True)
    put(tmp_path / "in", "a.json", ("a", "2013-03-28", "PT1M"))
    changes = [{"stage_by_run": True}, {"lookback_days": 3}, {"new_files_only": True}, {"snapshots": True}, {"merge_keys": ("image",)}]
    for change in [*changes, {"ledger_path": str(tmp_path / "ledger")}, {"reader_options": {"modifiedAfter": "2020-01-01T00:00:00"}}]:
        with pytest.raises(ValueError):
            ingest_recipes(spark, replace(job, **change))
    assert not (tmp_path / "lake").exists()


# ---------------------------------------------------------------- claims


def claimed_job(spark, tmp_path):
    job = job_in(spark, tmp_path, ledger_path=str(tmp_path / "ledger"), claims_path=str(tmp_path / "claims"))
    put(tmp_path / "in", "a.json", ("a", "2013-03-28", "PT1M"))
    return job, RunClaims(spark, job.claims_path)


def test_attempts_at_the_same_time(spark, tmp_path):
    job, _ = claimed_job(spark, tmp_path)
    for name in ("a", "b", "c"):
        put(tmp_path / "in", f"{name}.json", (name, "2013-03-28", "PT1M"))
        with ThreadPoolExecutor(4) as pool:
            done = list(pool.map(lambda _: ingest_recipes(spark, job), range(4)))
        loaded = [d.run_id for d in done if d.mode != "skip"]
        assert loaded and len(loaded) == len(set(loaded))
    assert names(stored_recipes(spark, job)) == ["a", "b", "c"]
    ids = [r.id for r in HistoryTable(spark, job.history_path).read().collect()]
    assert len(ids) == len(set(ids))


def test_only_one_creates_a_file(spark, tmp_path):
    for i in range(20):
        with ThreadPoolExecutor(8) as pool:
            made = list(pool.map(lambda _: create_if_absent(spark, str(tmp_path / f"m{i}")), range(8)))
        assert made.count(True) == 1
    assert remove_file(spark, str(tmp_path / "m0")) and create_if_absent(spark, str(tmp_path / "m0"))


def test_file_systems_other_than_the_local_one(spark, tmp_path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.larder.link./claims", f"file://{tmp_path}")
    path = "viewfs://larder/claims/one/file"
    assert create_if_absent(spark, path) and not create_if_absent(spark, path)
    assert os.path.getsize(tmp_path / "one" / "file") == 0


def test_a_held_run_is_skipped(spark, tmp_path):
    job, claims = claimed_job(spark, tmp_path)
    held = claims.claim(job.etl_name, 1)
    done = ingest_recipes(spark, job)
    assert (done.mode, done.run_id) == ("skip", 1) and not (tmp_path / "lake").exists()
    assert claims.claim("another", 1) is not None
    held.release()
    assert ingest_recipes(spark, job).mode == "full"


def test_a_failed_attempt_gives_its_run_back(spark, tmp_path, monkeypatch):
    job, claims = claimed_job(spark, tmp_path)

    def dies(self, rows):
        raise RuntimeError("no space")

    with monkeypatch.context() as patched:
        patched.setattr(HistoryTable, "append", dies)
        with pytest.raises(RuntimeError, match="no space"):
            ingest_recipes(spark, job)
    assert claims.attempts(job.etl_name) == {}
    assert ingest_recipes(spark, job).mode == "full" and names(stored_recipes(spark, job)) == ["a"]
    ingest_recipes(spark, job)
    assert list(claims.attempts(job.etl_name)) == [2]  # that of the first run is gone


def test_a_dead_attempt_is_taken_over(spark, tmp_path):
    job, claims = claimed_job(spark, tmp_path)
    dead = claims.claim(job.etl_name, 1)
    assert claims.claim(job.etl_name, 1) is None
    for file in (tmp_path / "claims").rglob("run-1-attempt-1"):
        os.utime(file, (time.time() - 90_000,) * 2)
    assert RunClaims(spark, job.claims_path, timedelta(hours=30)).claim(job.etl_name, 1) is None
    later = claims.claim(job.etl_name, 1)
    assert later.attempt == 2 and later.held() and not dead.held()
    assert claims.claim(job.etl_name, 1) is None


def test_an_attempt_that_lost_its_run_records_nothing(spark, tmp_path, monkeypatch):
    job, claims = claimed_job(spark, tmp_path)
    from larder.plans import ingest as plan

    def slow(*args, **named):
        create_if_absent(spark, f"{claims._folder(job.etl_name)}/run-1-attempt-2")
        return write_lake(*args, **named)

    monkeypatch.setattr(plan, "write_lake", slow)
    with pytest.raises(RuntimeError, match="taken over"):
        ingest_recipes(spark, job)
    assert HistoryTable(spark, job.history_path).read().count() == 1
    assert claims.attempts(job.etl_name)[1].keys() == {2}


def test_a_claim_on_a_finished_run_is_dropped(spark, tmp_path, monkeypatch):
    """An attempt that read the history before the run was over, and claims it after its file is gone."""
    job, claims = claimed_job(spark, tmp_path)
    seen = HistoryTable(spark, job.history_path).read()
    ingest_recipes(spark, job)
    ingest_recipes(spark, job)
    later = HistoryTable.read
    answers = [lambda self: seen, later]
    monkeypatch.setattr(HistoryTable, "read", lambda self: answers.pop(0)(self) if answers else later(self))
    assert ingest_recipes(spark, job).mode == "skip"
    assert names(stored_recipes(spark, job)) == ["a"] and 1 not in claims.attempts(job.etl_name)


# ---------------------------------------------------------------- order inside a month


def days(spark, rows):
    date = F.date_add(F.lit("2020-01-01").cast("date"), (F.xxhash64("id") % 31 + 31).cast("int") % 31)
    df = spark.range(0, rows, 1, 4).select("id", date.alias("d"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    return with_year_month(df, "d")


def rows_scanned(df):
    """Rows that the scan of ``df`` gives to its filter."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaf = plan.collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_sorted_files_let_row_groups_be_passed_over(spark, tmp_path):
    df, small = days(spark, 60_000), {"parquet.block.size": str(256 << 10), "parquet.page.size": str(32 << 10)}
    found = {}
    for name, order in (("plain", ()), ("sorted", ("d",))):
        path = str(tmp_path / name)
        write_lake(df, path, "overwrite", sort_by=order, **small)
        some = dated_between(read_lake(spark, path, df.schema), "d", "2020-01-10", "2020-01-11")
        assert "PushedFilters: [IsNotNull(d), GreaterThanOrEqual(d,2020-01-10), LessThanOrEqual(d,2020-01-11)]" in (
            some._jdf.queryExecution().executedPlan().toString()
        )
        found[name] = (rows_scanned(some), sorted(map(tuple, some.collect())))
    assert found["plain"][1] == found["sorted"][1] and len(found["plain"][1]) > 3000
    assert found["plain"][0] == 60_000 and found["sorted"][0] < 20_000


def test_order_survives_merging(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    df, path = days(spark, 5_000), str(tmp_path / "t")
    write_lake(df.where("id % 2 = 0"), path, "overwrite", sort_by=["d"])
    write_lake(df.where("id % 2 = 1"), path, "append", sort_by=["d"], run_id=None)

    def in_order():
        files = glob.glob(f"{path}/**/*.parquet", recursive=True)
        columns = [pq.ParquetFile(file).read(["d"])["d"].to_pylist() for file in files]
        assert sum(map(len, columns)) == 5_000
        return all(column == sorted(column) for column in columns)

    assert in_order()
    assert compact_lake(spark, path, df.schema, sort_by=["d"]) == 1 and in_order()
    merge_lake(df.where("id < 1000"), path, df.schema, ["id"], ["d"], sort_by=["d"])
    assert in_order()


def test_sorted_load_has_one_sort(spark, tmp_path):
    job = job_in(spark, tmp_path, sort_by=("datePublished",))
    put(tmp_path / "in", "a.json", *((f"r{i}", f"2013-03-{i % 28 + 1:02d}", "PT1M") for i in range(200)))
    ingest_recipes(spark, job)
    stored = read_lake(spark, job.lake_path, CLEANSED_RECIPE)
    dates = [r.datePublished for r in stored.collect()]
    assert len(dates) == 200 and dates == sorted(dates)
    assert load_recipes(spark, job.input_path).count() == 200
