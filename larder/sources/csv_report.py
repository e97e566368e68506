"""CSV reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Quotes are doubled, blanks stay, and no value stands for another one.
WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "emptyValue": "",
}
READ_OPTIONS = {name: WRITE_OPTIONS[name] for name in WRITE_OPTIONS if name != "emptyValue"}
NULL_TEXT = r"\N"


def _text_columns(schema: T.StructType) -> list[str]:
    return [field.name for field in schema if isinstance(field.dataType, T.StringType)]


def _written(text: Column) -> Column:
    """NULL as ``\\N``; a text that starts with a backslash gets another one."""
    marked = F.when(text.startswith("\\"), F.concat(F.lit("\\"), text)).otherwise(text)
    return F.coalesce(marked, F.lit(NULL_TEXT))


def _read(text: Column) -> Column:
    # The reader cannot tell an empty value from none, and no value is ever left out.
    filled = F.coalesce(text, F.lit(""))
    plain = F.when(filled.startswith("\\\\"), F.substring(filled, 2, 2**31 - 1)).otherwise(filled)
    return F.when(filled != NULL_TEXT, plain)


def write_csv_report(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Replaces the CSV files at ``path``, with a header.

    Every text comes back from ``read_csv_report`` as it was: blanks, line breaks, quotes and
    backslashes included, and empty text apart from NULL. ``single_file`` is for reports whose size does
    not grow with the data, such as one row per difficulty: all rows go through one task.
    """
    names = _text_columns(df.schema)
    text = df.withColumns({name: _written(F.col(f"`{name}`")) for name in names})
    rows = text.repartition(1) if single_file else text
    rows.write.options(**WRITE_OPTIONS, quoteAll=bool(names)).mode("overwrite").csv(path)


def read_csv_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    rows = spark.read.options(**READ_OPTIONS, multiLine="true").schema(schema).csv(path)
    return rows.withColumns({name: _read(F.col(f"`{name}`")) for name in _text_columns(schema)})
