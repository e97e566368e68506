"""Writing tables whose rows are unevenly spread, and other properties of the files."""

import datetime
import pathlib

import pytest
from pyspark.sql import functions as F

from larder.operators.rows import dated_between, newer_than, preview, watermark, with_year_month
from larder.sources.csv_report import write_csv_report
from larder.sources.lake import arrange, read_lake, write_lake


@pytest.fixture
def conf(spark):
    """Sets session options for one test."""
    changed = []

    def change(**options):
        for name, value in options.items():
            name = "spark.sql." + name.replace("__", ".")
            changed.append((name, spark.conf.get(name)))
            spark.conf.set(name, value)

    yield change
    for name, value in changed:
        spark.conf.set(name, value)


def skewed(spark, copies=False):
    """41 months; the first holds a third of the rows, all of them equal if wanted."""
    rows = spark.range(0, 90_000, numPartitions=24)
    month = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 60).cast("int")
    text = F.sha2(F.col("id").cast("string"), 256)
    if copies:
        text = F.when(F.col("id") % 3 == 0, F.lit("copy" * 16)).otherwise(text)
    dated = rows.select(F.add_months(F.lit("2010-01-01").cast("date"), month).alias("d"), text.alias("t"))
    return with_year_month(dated, "d")


def files_of(path, year, month):
    return len(list(pathlib.Path(path, f"year={year}", f"month={month}").glob("*.parquet")))


@pytest.mark.parametrize("copies", [False, True])
def test_hot_month_is_split(spark, tmp_path, conf, copies):
    # Copies shrink when compressed, and it is the compressed size that counts.
    size = "2k" if copies else "200k"
    conf(adaptive__advisoryPartitionSizeInBytes=size, shuffle__partitions="64")
    rows = skewed(spark, copies)
    path = str(tmp_path / "t")
    write_lake(rows, path, "overwrite")
    assert files_of(path, 2010, 1) > 1
    if not copies:
        unarranged = 24 * 41
        assert sum(1 for _ in pathlib.Path(path).rglob("*.parquet")) < unarranged / 8
    stored = read_lake(spark, path, rows.schema)
    assert stored.exceptAll(rows).isEmpty() and stored.count() == 90_000


def test_hot_month_is_split_without_adaptive_execution(spark, tmp_path, conf):
    conf(adaptive__enabled="false", shuffle__partitions="8")
    rows = skewed(spark, copies=True)
    sizes = arrange(rows, ["year", "month"]).groupBy(F.spark_partition_id()).count()
    assert max(row["count"] for row in sizes.collect()) < 30_000
    path = str(tmp_path / "t")
    write_lake(rows, path, "overwrite")
    assert files_of(path, 2010, 1) > 1
    assert read_lake(spark, path, rows.schema).count() == 90_000


def test_small_months_share_tasks(spark, tmp_path):
    """Input split over many tasks ends up in one file per month."""
    rows = skewed(spark)
    path = str(tmp_path / "t")
    write_lake(rows, path, "overwrite")
    assert sum(1 for _ in pathlib.Path(path).rglob("*.parquet")) == 41


@pytest.mark.parametrize("clustered", [False, True])
@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_observed_value(spark, tmp_path, conf, clustered, adaptive):
    conf(adaptive__enabled=adaptive)
    rows = skewed(spark)
    latest = F.max("d")
    seen = write_lake(rows, str(tmp_path / "a"), "overwrite", clustered=clustered, observe=latest)
    assert seen == "2014-12-01"
    none = newer_than(rows, "d", "2020-01-01")
    seen = write_lake(none, str(tmp_path / "b"), "overwrite", clustered=clustered, observe=latest)
    assert seen is None
    assert read_lake(spark, str(tmp_path / "b"), rows.schema).count() == 0


def test_rerun_replaces_only_its_own_rows(spark, tmp_path):
    rows = skewed(spark)
    path = str(tmp_path / "t")
    write_lake(rows, path, "overwrite", run_id=1)
    late = rows.where("year = 2014")
    for _ in range(2):
        write_lake(late, path, "append", run_id=2)
    assert read_lake(spark, path, rows.schema).count() == 90_000 + late.count()
    # Nothing stays of an attempt that wrote other months, or of all runs after a full load.
    write_lake(late.where("month = 3"), path, "append", run_id=2)
    assert read_lake(spark, path, rows.schema).count() == 90_000 + late.where("month = 3").count()
    write_lake(late, path, "overwrite", run_id=3)
    assert read_lake(spark, path, rows.schema).count() == late.count()


def test_dated_between_prunes_months(spark, tmp_path):
    rows = skewed(spark)
    path = str(tmp_path / "t")
    write_lake(rows, path, "overwrite")
    stored = read_lake(spark, path, rows.schema)
    for first, last in ((None, "2010-03-01"), ("2014-11-15", None), ("2010-12-01", "2011-02-01")):
        got = dated_between(stored, "d", first, last)
        low, high = first or "0001-01-01", last or "9999-12-31"
        assert got.count() == rows.where(F.col("d").between(low, high)).count() > 0
        scan = got._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: []" not in scan and "year" in scan.split("PartitionFilters")[1]


def test_watermark(spark):
    dates = spark.createDataFrame([(datetime.date(2013, 3, 1),), (None,)], "d date")
    assert watermark(dates, "d").first()[0] == datetime.date(2013, 3, 1)
    assert watermark(dates.where("d is null"), "d").first()[0] is None
    assert watermark(dates.limit(0), "d").first()[0] is None


def test_preview(spark):
    assert preview(spark.range(1000), 60).count() == 60
    assert [row.id for row in preview(spark.range(1000).orderBy(F.desc("id")), 3, "id").collect()] == [0, 1, 2]


def test_single_file_report(spark, tmp_path):
    report = spark.range(0, 3, numPartitions=3)
    for single, files in ((True, 1), (False, 3)):
        path = tmp_path / str(single)
        write_csv_report(report, str(path), single_file=single)
        assert len(list(path.glob("*.csv"))) == files
        assert next(path.glob("*.csv")).read_text().startswith("id\n")
