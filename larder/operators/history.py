"""Run history: which load comes next for each pipeline, and what is recorded after it.

Every operator works on all pipelines of a history table at once. A pipeline's current run is its
active row with the highest id, so recording a run only needs new rows; marking the old row
inactive as well (``retire``) is for tables that other readers query. A row's key is ``(etl_name, id)``:
ids are counted within a pipeline, so pipelines that run at the same time cannot meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import parse_date
from larder.schemas import RUN_HISTORY
from larder.sources.shared import broadcast_if_small, computed_once


# How Spark writes dates and timestamps.
MARK_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
MARK_MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?\z"


def seed(
    spark: SparkSession, etl_name: str, watermark_column: str = "datePublished", run_id: int = 1
) -> DataFrame:
    """The first history row of a pipeline: it asks for a full load."""
    first = spark.range(run_id, run_id + 1)
    values = {
        "etl_name": F.lit(etl_name),
        "skip_execution": F.lit("N"),
        "is_active": F.lit("Y"),
        "full_load": F.lit("Y"),
        "run_date": F.current_timestamp(),
        "filter_col1_name": F.lit(watermark_column),
    }
    return first.select(
        *[
            values.get(field.name, F.col("id") if field.name == "id" else F.lit(None))
            .cast(field.dataType)
            .alias(field.name)
            for field in RUN_HISTORY
        ]
    )


def active_runs(history: DataFrame, etl_name: str | None = None) -> DataFrame:
    """Active rows, of one pipeline if named."""
    active = history.where(F.col("is_active") == "Y")
    return active if etl_name is None else active.where(F.col("etl_name") == etl_name)


def current_runs(history: DataFrame, etl_name: str | None = None) -> DataFrame:
    """The active row with the highest id of every pipeline.

    The highest ids are aggregated map-side first, without sorting, and then joined back.
    """
    active = active_runs(history, etl_name)
    highest = active.groupBy(F.col("etl_name").alias("name")).agg(F.max("id").alias("highest"))
    current = F.col("etl_name").eqNullSafe(F.col("name")) & (F.col("id") == F.col("highest"))
    return active.join(highest, current).select(*history.columns)


def stored_watermark() -> Column:
    """The mark a history row stores, as text: a date, or a timestamp that is written out to the second at least.

    ``'null'``, ``'None'`` and other text count as no mark. Marks of one column sort as text.
    """
    text = F.col("filter_col1_value")
    date = F.when(text.rlike(MARK_DATE), parse_date(text).cast("string"))
    moment = F.when(text.rlike(MARK_MOMENT) & text.try_cast("timestamp_ntz").isNotNull(), text)
    return F.coalesce(date, moment)


def load_mode() -> Column:
    """What a history row asks for: ``skip``, ``full``, ``delta``, or ``error`` if that is unclear."""
    return (
        F.when(~F.col("skip_execution").eqNullSafe("N"), "skip")
        .when(F.col("full_load") == "Y", "full")
        .when((F.col("full_load") == "N") & stored_watermark().isNotNull(), "delta")
        .otherwise("error")
    )


def retire(history: DataFrame, finished: DataFrame, stored: bool = False) -> DataFrame:
    """The history with the runs in ``finished`` (one row per ``etl_name`` and ``id``) set inactive.

    ``finished`` is counted first: while it is small the history is not shuffled for the join.
    ``stored`` says that it was computed once already.
    """
    if not stored:
        finished = computed_once(finished)
    keys = finished.select(F.col("etl_name").alias("done_name"), F.col("id").alias("done_id"))
    done = broadcast_if_small(keys, stored=True)
    same = (F.col("id") == F.col("done_id")) & F.col("etl_name").eqNullSafe(F.col("done_name"))
    active = F.when(F.col("done_id").isNotNull(), "N").otherwise(F.col("is_active"))
    return (
        history.join(done, same, "left")
        .withColumn("is_active", active)
        .select(*history.columns)
    )


def follow_up(
    history: DataFrame, finished: DataFrame, run_date: Column | None = None
) -> DataFrame:
    """The next history row of every run in ``finished``.

    ``finished`` holds history rows plus ``new_watermark``, the largest date the run loaded. A
    delta never moves the watermark back and keeps it when it loaded nothing; without any
    watermark the next load is a full one again. A ``new_snapshot`` column, if there is one, is stored as the second
    filter, under the name ``snapshot``.

    The new id is one above the pipeline's highest; only pipelines in ``finished`` are looked up, and
    ``finished`` holds one run of each.
    """
    highest = history.groupBy(F.col("etl_name").alias("name")).agg(F.max("id").alias("highest"))
    named = finished.join(highest, F.col("etl_name").eqNullSafe(F.col("name")))
    # greatest() leaves NULLs out.
    mark = F.greatest(
        F.col("new_watermark").cast("string"),
        F.when(F.col("full_load") == "N", stored_watermark()),
    )
    values = {
        "id": F.col("highest") + 1,
        "skip_execution": F.lit("N"),
        "is_active": F.lit("Y"),
        "full_load": F.when(mark.isNull(), "Y").otherwise("N"),
        "run_date": F.current_timestamp() if run_date is None else run_date,
        "filter_col1_value": mark,
        "filter_col2_name": F.lit(None),
        "filter_col2_value": F.lit(None),
    }
    if "new_snapshot" in finished.columns:
        values["filter_col2_name"] = F.when(F.col("new_snapshot").isNotNull(), "snapshot")
        values["filter_col2_value"] = F.col("new_snapshot")
    return named.select(
        *[
            values.get(field.name, F.col(field.name)).cast(field.dataType).alias(field.name)
            for field in history.schema
        ]
    )


def advance(history: DataFrame, finished: DataFrame, run_date: Column | None = None) -> DataFrame:
    """The whole history after the runs in ``finished``: old rows retired, next rows added."""
    finished = computed_once(finished)
    return retire(history, finished, stored=True).unionByName(follow_up(history, finished, run_date))
