"""Line-delimited JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_json_lines(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    keep_corrupt: bool = False,
    **options: str,
) -> DataFrame:
    """Rows of one or more JSON files or folders under a fixed schema, so nothing is inferred.

    The path's prefix picks the file system. A line that is not a JSON object becomes a row of
    NULLs; ``keep_corrupt`` adds its text as ``_corrupt_record``. Other ``options`` go to Spark's
    reader, such as ``modifiedAfter`` to leave out old files.
    """
    if keep_corrupt:
        schema = T.StructType([*schema, T.StructField(CORRUPT, T.StringType(), True)])
    return spark.read.options(**options).schema(schema).json(path)


def line_counts(df: DataFrame, key: str) -> DataFrame:
    """One row: lines, unreadable lines, and readable ones without ``key``.

    ``df`` is read with ``keep_corrupt``. Counting reads the key column too, as Spark refuses a
    scan of the corrupt column alone.
    """
    unreadable = F.col(CORRUPT).isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(unreadable).alias("unreadable"),
        F.count_if(~unreadable & F.col(key).isNull()).alias("without_key"),
    )
