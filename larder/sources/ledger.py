"""A ledger of input files, so that a delta reads exactly those that no run has loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.schemas import INPUT_FILE
from larder.sources.files import exists, listed_files, literal_path


class FileLedger:
    """Which files each run of a pipeline has loaded: path, length and time of change.

    A run's files are a folder of their own, written before its rows. They count once the run is over, that is
    when the pipeline's current run is a later one; an attempt that failed leaves files that do not count, and
    the next attempt replaces them. A full load starts anew: files of runs before it no longer count.

    ``on_change`` says what to do with a file that was loaded and has another length or time now: ``fail``, or ``load`` it
    again, whole, which is for tables that merge rows by key. Clocks are not compared with each other, only with what was seen.
    """

    def __init__(self, spark: SparkSession, path: str, input_path: str | list[str], on_change: str = "fail", **options: str):
        if on_change not in ("fail", "load"):
            raise ValueError("on_change is 'fail' or 'load'")
        self.spark = spark
        self.path = path.rstrip("/")
        self.input_path = input_path
        self.on_change = on_change
        self.options = options

    def _folder(self, etl_name: str) -> str:
        return f"{self.path}/etl={etl_name.encode().hex()}"

    def loaded(self, etl_name: str, before_run: int) -> DataFrame:
        """The files of the runs before ``before_run``, from the last full load on; a file per run that loaded it."""
        folder = self._folder(etl_name)
        if not exists(self.spark, folder):
            return self.spark.createDataFrame([], INPUT_FILE)
        rows = self.spark.read.schema(INPUT_FILE).parquet(folder).where(F.col("run_id") < before_run)
        since = rows.where("full_load = 'Y'").agg(F.max("run_id")).first()[0]
        return rows if since is None else rows.where(F.col("run_id") >= since)

    def unseen(self, etl_name: str, run_id: int) -> DataFrame:
        """``path, length, modified`` of the listed files that no finished run loaded as they are now."""
        loaded = self.loaded(etl_name, run_id).select("path", "length", "modified")
        return listed_files(self.spark, self.input_path, **self.options).join(loaded, ["path", "length", "modified"], "left_anti")

    def claim(self, etl_name: str, run_id: int, full: bool) -> list[str]:
        """Writes down the files that a run loads, all listed ones or the unseen ones, and gives their paths.

        The folder is listed once, so that rows are read from just the files written down.
        """
        own = f"{self._folder(etl_name)}/run_id={run_id}"
        files = listed_files(self.spark, self.input_path, **self.options) if full else self.unseen(etl_name, run_id)
        marked = files.withColumn("full_load", F.lit("Y" if full else "N"))
        marked.write.mode("overwrite").parquet(own)
        claimed = self.spark.read.schema(marked.schema).parquet(own)
        if not full and self.on_change == "fail":
            before = self.loaded(etl_name, run_id).select("path")
            changed = [row.path for row in claimed.join(before, "path", "left_semi").limit(5).collect()]
            if changed:
                raise ValueError(f"files changed after they were loaded, such as {', '.join(sorted(changed))}")
        return [literal_path(row.path) for row in claimed.select("path").orderBy("path").collect()]
