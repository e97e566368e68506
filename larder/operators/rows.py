"""Filters, previews and high-water marks over any table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def drop_missing(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which none of ``columns`` is NULL. Empty text is not NULL and stays."""
    return df.na.drop(subset=list(columns))


def newer_than(
    df: DataFrame, column: str, watermark: Column | str | None, lookback_days: int = 0
) -> DataFrame:
    """Rows dated strictly after ``watermark``; all rows when there is none.

    A timestamp column is compared with the whole mark, any other with the mark's date. Rows without a
    date are never newer than a watermark. ``lookback_days`` moves the mark back so that late rows are seen
    again; the caller then has to cope with rows it already loaded (``ingest`` replaces them).
    """
    if watermark is None:
        return df
    kind = df.schema[column].dataType
    timed = isinstance(kind, (T.TimestampType, T.TimestampNTZType))
    mark = F.lit(watermark) if isinstance(watermark, str) else watermark
    mark = mark.cast(kind if timed else T.DateType())
    if lookback_days:
        mark = mark - F.expr(f"INTERVAL {int(lookback_days)} DAYS")
    return df.where(F.col(column) > mark)


def watermark(df: DataFrame, column: str) -> DataFrame:
    """One row holding the largest date of ``column``; NULL when there is none."""
    return df.agg(F.max(column).alias("watermark"))


def with_year_month(df: DataFrame, column: str) -> DataFrame:
    """Adds the ``year`` and ``month`` partition columns of a date column."""
    return df.withColumns({"year": F.year(column), "month": F.month(column)})


def dated_between(
    df: DataFrame, column: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Rows dated from ``first`` to ``last``, both included, reading only the months needed.

    For tables partitioned by ``year`` and ``month`` of ``column``: the bounds are repeated on the
    partition columns, because Spark cannot derive them from the date.
    """
    month_number = F.col("year") * 12 + F.col("month")
    for text, after in ((first, True), (last, False)):
        if text is None:
            continue
        bound = F.lit(text).cast("date")
        bound_month = F.year(bound) * 12 + F.month(bound)
        if after:
            df = df.where((F.col(column) >= bound) & (month_number >= bound_month))
        else:
            df = df.where((F.col(column) <= bound) & (month_number <= bound_month))
    return df


def preview(df: DataFrame, rows: int = 60, order_by: str | None = None) -> DataFrame:
    """At most ``rows`` rows for showing; with ``order_by`` the same ones every time."""
    return (df.orderBy(order_by) if order_by else df).limit(rows)
