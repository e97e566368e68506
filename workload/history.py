"""Run history operators over a history made from the events."""

from pyspark.sql import functions as F

from larder.operators import history as runs
from workload.registry import query, table

RUN_DATE = "2024-02-01 00:00:00"

# Every run is there for a pipeline and for its copy, so that pipelines share ids.
HISTORY_SQL = """history AS (SELECT event_id AS id, event_type || unnest(['', '-copy']) AS etl_name,
        CASE WHEN value < 5 THEN 'Y' ELSE 'N' END AS skip_execution,
        CASE WHEN value < 20 THEN 'N' ELSE 'Y' END AS is_active,
        CASE WHEN value >= 100 THEN 'Y' ELSE 'N' END AS full_load,
        ts AS run_date, 'datePublished' AS filter_col1_name,
        CASE WHEN value < 30 THEN 'null' WHEN value < 35 THEN 'None'
            WHEN value >= 40 THEN strftime(ts, '%Y-%m-%d') END AS filter_col1_value,
        CAST(NULL AS VARCHAR) AS filter_col2_name, CAST(NULL AS VARCHAR) AS filter_col2_value
    FROM events)"""
LATEST_SQL = """latest AS (SELECT etl_name, max(id) AS id FROM history WHERE is_active = 'Y' GROUP BY etl_name),
    done AS (SELECT * FROM latest WHERE etl_name NOT LIKE '%-copy'),
    highest AS (SELECT etl_name, max(id) AS top FROM history GROUP BY etl_name)"""
# The runs of clicks and views loaded something, the others did not.
FOLLOW_UP_SQL = """SELECT top + 1 AS id, etl_name,
        'N' AS skip_execution, 'Y' AS is_active, CASE WHEN mark IS NULL THEN 'Y' ELSE 'N' END AS full_load,
        TIMESTAMP '2024-02-01 00:00:00' AS run_date, filter_col1_name, CAST(mark AS VARCHAR) AS filter_col1_value,
        CAST(NULL AS VARCHAR) AS filter_col2_name, CAST(NULL AS VARCHAR) AS filter_col2_value
    FROM (SELECT h.*, CASE WHEN h.etl_name IN ('click', 'view') THEN CAST('2024-01-31' AS DATE)
            WHEN full_load = 'N' THEN try_cast(filter_col1_value AS DATE) END AS mark
        FROM history h JOIN done USING (etl_name, id)) JOIN highest USING (etl_name)"""


def history(spark, sf_dir):
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.explode(F.array("event_type", F.concat("event_type", F.lit("-copy")))).alias("etl_name"),
        F.when(value < 5, "Y").otherwise("N").alias("skip_execution"),
        F.when(value < 20, "N").otherwise("Y").alias("is_active"),
        F.when(value >= 100, "Y").otherwise("N").alias("full_load"),
        F.col("ts").alias("run_date"),
        F.lit("datePublished").alias("filter_col1_name"),
        F.when(value < 30, "null")
        .when(value < 35, "None")
        .when(value >= 40, F.to_date("ts").cast("string"))
        .alias("filter_col1_value"),
        F.lit(None).cast("string").alias("filter_col2_name"),
        F.lit(None).cast("string").alias("filter_col2_value"),
    )


def finished(table):
    """The current runs of all pipelines but the copies, with what they loaded."""
    loaded = F.when(F.col("etl_name").isin("click", "view"), "2024-01-31")
    own = ~F.col("etl_name").endswith("-copy")
    return runs.current_runs(table).where(own).withColumn("new_watermark", loaded)


def run_date():
    return F.lit(RUN_DATE).cast("timestamp_ntz")


@query(f"WITH {HISTORY_SQL} SELECT * FROM history WHERE is_active = 'Y'")
def history_active(spark, sf_dir):
    return runs.active_runs(history(spark, sf_dir))


@query(f"WITH {HISTORY_SQL}, {LATEST_SQL} SELECT h.* FROM history h JOIN latest USING (etl_name, id)")
def history_latest_active(spark, sf_dir):
    return runs.current_runs(history(spark, sf_dir))


@query(f"""WITH {HISTORY_SQL} SELECT id, etl_name, CASE WHEN skip_execution <> 'N' THEN 'skip' WHEN full_load = 'Y' THEN 'full'
        WHEN try_cast(filter_col1_value AS DATE) IS NOT NULL THEN 'delta' ELSE 'error' END AS load_mode
    FROM history""")
def history_load_mode(spark, sf_dir):
    return history(spark, sf_dir).select("id", "etl_name", runs.load_mode().alias("load_mode"))


@query(f"""WITH {HISTORY_SQL}, {LATEST_SQL} SELECT * REPLACE (CASE WHEN (etl_name, id) IN (SELECT (etl_name, id) FROM done) THEN 'N'
        ELSE is_active END AS is_active) FROM history""")
def history_retire(spark, sf_dir):
    table = history(spark, sf_dir)
    return runs.retire(table, finished(table))


@query(f"WITH {HISTORY_SQL}, {LATEST_SQL} {FOLLOW_UP_SQL}")
def history_follow_up(spark, sf_dir):
    table = history(spark, sf_dir)
    return runs.follow_up(table, finished(table), run_date())


@query(f"""WITH {HISTORY_SQL}, {LATEST_SQL} SELECT * REPLACE (CASE WHEN (etl_name, id) IN (SELECT (etl_name, id) FROM done) THEN 'N'
        ELSE is_active END AS is_active) FROM history UNION ALL {FOLLOW_UP_SQL}""")
def history_advance(spark, sf_dir):
    table = history(spark, sf_dir)
    return runs.advance(table, finished(table), run_date())
