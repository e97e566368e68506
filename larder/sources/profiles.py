"""What each run wrote, in a few numbers and sketches that are taken while its rows are written."""

from __future__ import annotations

import base64
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.schemas import RUN_PROFILE
from larder.sources.files import exists

# Sizes of the sketches. Three standard errors of a distinct count are 5 % of it, and a quantile's rank is off by less than
# 0.01 with a probability far above 0.99; either sketch stays below some 20 kB whatever it has seen.
DISTINCT_LOG2 = 12
QUANTILE_K = 1024
QUANTILES = (0.25, 0.5, 0.75)


class RunProfiles:
    """Rows, NULLs, distinct values of ``distinct`` columns and quantiles of whole numbers in ``quantiles``, of every run.

    They are observed in the pass that writes the rows, after the shuffle, and kept in a folder per run that is written before the
    history row: as in a file ledger they count once the run is over, and a repeated attempt replaces them. Sketches
    add up over runs. Numbers are of the rows a run wrote, so they are those of the table where runs only add rows.
    """

    def __init__(self, spark: SparkSession, path: str, distinct: Sequence[str] = (), quantiles: Sequence[str] = ()):
        self.spark = spark
        self.path = path.rstrip("/")
        self.distinct = tuple(distinct)
        self.quantiles = tuple(quantiles)

    def _folder(self, etl_name: str) -> str:
        return f"{self.path}/etl={etl_name.encode().hex()}"

    def observed(self) -> Column:
        """The aggregate to observe: a struct, sketches being text."""
        columns = []
        for name in dict.fromkeys([*self.distinct, *self.quantiles]):
            column = F.col(f"`{name}`")
            sketches = [F.count(column).alias("filled")]
            if name in self.distinct:
                sketches.append(F.base64(F.hll_sketch_agg(column.cast("string"), DISTINCT_LOG2)).alias("different"))
            if name in self.quantiles:
                numbers = F.base64(F.kll_sketch_agg_bigint(column.cast("bigint"), QUANTILE_K))
                sketches.append(F.when(F.count(column) > 0, numbers).alias("numbers"))
            columns.append(F.struct(F.lit(name).alias("column"), *sketches))
        kind = "array<struct<column:string,filled:bigint,different:string,numbers:string>>"
        parts = [F.from_json(F.to_json(column), kind[6:-1]) for column in columns]
        return F.struct(F.count(F.lit(1)).alias("rows"), F.array(*parts).cast(kind).alias("columns"))

    def store(self, etl_name: str, run_id: int, full: bool, values: Mapping) -> None:
        rows = []
        for found in values.get("columns", ()):
            different, numbers = (base64.b64decode(found[name]) if found.get(name) else None for name in ("different", "numbers"))
            nulls = values["rows"] - found["filled"]
            rows.append((found["column"], values["rows"], nulls, different, numbers, "Y" if full else "N", run_id))
        stored = self.spark.createDataFrame(rows, RUN_PROFILE).drop("run_id").coalesce(1)
        stored.write.mode("overwrite").parquet(f"{self._folder(etl_name)}/run_id={run_id}")

    def stored(self, etl_name: str, before_run: int) -> DataFrame:
        """A row per column and run before ``before_run``, from the last full load on."""
        folder = self._folder(etl_name)
        if not exists(self.spark, folder):
            return self.spark.createDataFrame([], RUN_PROFILE)
        rows = self.spark.read.schema(RUN_PROFILE).parquet(folder).where(F.col("run_id") < before_run)
        since = rows.where("full_load = 'Y'").agg(F.max("run_id")).first()[0]
        return rows if since is None else rows.where(F.col("run_id") >= since)


def merged_profiles(profiles: DataFrame) -> DataFrame:
    """``column, runs, rows, nulls, different, quantiles`` over the runs in ``profiles``.

    ``different`` is an estimate, NULL for columns without it; ``quantiles`` are values at ranks 0.25, 0.5 and 0.75, NULL also for
    columns without a value.
    """
    merged = profiles.groupBy("column").agg(
        F.countDistinct("run_id").alias("runs"),
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.count("different").alias("counted"),
        F.hll_union_agg("different").alias("different"),
        F.count("numbers").alias("numbered"),
        F.kll_merge_agg_bigint("numbers").alias("numbers"),
    )
    ranks = F.array(*(F.lit(float(rank)) for rank in QUANTILES))
    return merged.select(
        "column",
        "runs",
        "rows",
        "nulls",
        F.when(F.col("counted") > 0, F.hll_sketch_estimate("different")).alias("different"),
        F.when(F.col("numbered") > 0, F.kll_sketch_get_quantile_bigint("numbers", ranks)).alias("quantiles"),
    )
