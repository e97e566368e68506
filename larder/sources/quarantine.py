"""Good rows and those that cannot be used, written in one pass and kept apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.sources.lake import read_lake, write_lake

# The folders of the two kinds of rows.
GOOD, QUARANTINED = "good", "quarantined"


def write_apart(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ("year", "month")) -> None:
    """Writes rows without a ``reason`` to one half of a table and the others, with their ``reason`` and ``line``, to another.

    One write of one table whose first partition column tells the halves apart, so the input is read once and both
    halves appear together. ``mode`` is ``overwrite`` or ``append``.
    """
    status = F.when(F.col("reason").isNull(), GOOD).otherwise(QUARANTINED)
    write_lake(df.withColumn("status", status), path, mode, ["status", *partition_by])


def good_path(path: str) -> str:
    """The good half, a table of its own that is partitioned like any other."""
    return f"{path.rstrip('/')}/status={GOOD}"


def read_quarantined(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The other half: what could be read of each line under ``schema``, its ``reason``, and the ``line`` itself."""
    fields = [T.StructField("reason", T.StringType()), T.StructField("line", T.StringType()), T.StructField("status", T.StringType())]
    whole = read_lake(spark, path, T.StructType([*schema, *fields]))
    return whole.where(F.col("status") == QUARANTINED).drop("status")
