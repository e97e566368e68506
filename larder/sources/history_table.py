"""The run history as an append-only parquet table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators import history as runs
from larder.schemas import RUN_HISTORY


class HistoryTable:
    """Rows are only ever added, so one write per run records it and none can be half done."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def read(self) -> DataFrame:
        return self.spark.read.schema(RUN_HISTORY).parquet(self.path)

    def append(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.path)

    def seed(self, etl_name: str, watermark_column: str = "datePublished") -> None:
        """Adds a first row for a pipeline that has no active one, and the table if it is new."""
        first = runs.seed(self.spark, etl_name, watermark_column)
        first.write.mode("ignore").parquet(self.path)
        history = self.read()
        if runs.active_runs(history, etl_name).isEmpty():
            own = history.where(F.col("etl_name") == etl_name)
            next_id = own.agg(F.coalesce(F.max("id"), F.lit(0)) + 1).first()[0]
            self.append(runs.seed(self.spark, etl_name, watermark_column, next_id))
