"""Reading and writing: JSON lines, partitioned parquet, CSV reports."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.recipes import average_per, difficulty
from larder.operators.rows import dated_between, newer_than, with_year_month
from larder.plans.ingest import ingest
from larder.schemas import DIFFICULTY_REPORT
from larder.sources.csv_report import read_csv_report, write_csv_report
from larder.sources.history_table import HistoryTable
from larder.sources.json_lines import line_counts, read_json_lines
from larder.sources.lake import compact_lake, merge_lake, read_lake, write_lake
from larder.sources.shared import scratch_path
from workload.registry import query, table

PART_TEXT = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("p_partkey", "p_name", "p_size", "tags", "colour")]
)


@query("""SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CAST(p_size AS VARCHAR) AS p_size,
        '["' || p_brand || '","' || p_type || '"]' AS tags, CAST(NULL AS VARCHAR) AS colour FROM part""")
def json_explicit_schema(spark, sf_dir):
    """Numbers and arrays come back as their text, a missing field as NULL, an extra one not at all."""
    path = scratch_path(spark, "part-json")
    table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_size", F.array("p_brand", "p_type").alias("tags"), "p_retailprice"
    ).write.json(path)
    return read_json_lines(spark, path, PART_TEXT)


@query("""SELECT count(*) AS lines, count(*) FILTER (WHERE p_type = 'PROMO') AS unreadable,
        count(*) FILTER (WHERE p_type = 'LARGE') AS without_key FROM part""")
def json_malformed_lines(spark, sf_dir):
    """Lines cut off in the middle are counted, as are lines that lack the key."""
    path = scratch_path(spark, "part-lines")
    whole = F.to_json(F.struct(F.when(F.col("p_type") != "LARGE", F.col("p_name")).alias("p_name"), "p_size"))
    line = F.when(F.col("p_type") == "PROMO", F.concat(F.lit('{"p_name":"'), "p_name")).otherwise(whole)
    table(spark, sf_dir, "part").select(line.alias("value")).write.text(path)
    read = read_json_lines(spark, path, PART_TEXT, keep_corrupt=True)
    return line_counts(read, "p_name")


@query("SELECT CAST(p_size AS VARCHAR) AS p_size, p_name FROM part WHERE p_type <> 'PROMO'")
def json_malformed_dropped(spark, sf_dir):
    """A malformed line reads as NULLs, so dropping rows without a key removes it."""
    path = scratch_path(spark, "part-lines")
    line = F.when(F.col("p_type") == "PROMO", F.concat(F.lit('{"p_name":"'), "p_name")).otherwise(
        F.to_json(F.struct("p_name", "p_size"))
    )
    table(spark, sf_dir, "part").select(line.alias("value")).write.text(path)
    return read_json_lines(spark, path, PART_TEXT).na.drop(subset=["p_name"]).select("p_size", "p_name")


def orders_by_month(spark, sf_dir):
    dated = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("order_date")
    )
    return with_year_month(dated, "order_date")


MONTHLY_SQL = """SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS order_date,
        CAST(year(o_orderdate) AS INTEGER) AS "year", CAST(month(o_orderdate) AS INTEGER) AS "month"
    FROM orders"""


@query(MONTHLY_SQL)
def parquet_partitioned_roundtrip(spark, sf_dir):
    orders = orders_by_month(spark, sf_dir)
    path = scratch_path(spark, "orders")
    write_lake(orders, path, "overwrite")
    return read_lake(spark, path, orders.schema)


@query(MONTHLY_SQL)
def parquet_overwrite(spark, sf_dir):
    """A second full write replaces the first."""
    orders = orders_by_month(spark, sf_dir)
    path = scratch_path(spark, "orders")
    write_lake(orders.withColumn("o_orderkey", -F.col("o_orderkey")), path, "overwrite", clustered=True)
    write_lake(orders, path, "overwrite")
    return read_lake(spark, path, orders.schema)


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS order_date,
        CAST(CASE WHEN o_orderpriority <> '5-LOW' THEN year(o_orderdate) END AS INTEGER) AS "year",
        CAST(CASE WHEN o_orderpriority <> '5-LOW' THEN month(o_orderdate) END AS INTEGER) AS "month"
    FROM orders""")
def parquet_undated_partition(spark, sf_dir):
    """Rows without a date have a partition of their own and come back without one."""
    date = F.when(F.col("o_orderpriority") != "5-LOW", F.to_date("o_orderdate"))
    dated = table(spark, sf_dir, "orders").select("o_orderkey", date.alias("order_date"))
    orders = with_year_month(dated, "order_date")
    path = scratch_path(spark, "orders")
    write_lake(orders, path, "overwrite")
    return read_lake(spark, path, orders.schema)


@query(MONTHLY_SQL)
def parquet_append(spark, sf_dir):
    """The orders up to a date, then the others added."""
    orders = orders_by_month(spark, sf_dir)
    path = scratch_path(spark, "orders")
    early = F.col("order_date") <= F.lit("1999-12-15").cast("date")
    write_lake(orders.where(early), path, "overwrite")
    write_lake(orders.where(~early), path, "append")
    return read_lake(spark, path, orders.schema)


@query(MONTHLY_SQL)
def parquet_rerun_replaces(spark, sf_dir):
    """The second load is tried twice under one run id and leaves its rows once."""
    orders = orders_by_month(spark, sf_dir)
    path = scratch_path(spark, "orders")
    early = F.col("order_date") <= F.lit("1999-12-15").cast("date")
    write_lake(orders.where(early), path, "overwrite", run_id=1)
    write_lake(orders.where(~early), path, "append", run_id=2)
    write_lake(orders.where(~early), path, "append", run_id=2)
    return read_lake(spark, path, orders.schema)


@query(MONTHLY_SQL + " WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-11-20' AND DATE '1997-02-03'")
def parquet_date_range(spark, sf_dir):
    """Only the months in question are read."""
    orders = orders_by_month(spark, sf_dir)
    path = scratch_path(spark, "orders")
    write_lake(orders, path, "overwrite")
    stored = read_lake(spark, path, orders.schema)
    return dated_between(stored, "order_date", "1996-11-20", "1997-02-03")


@query(MONTHLY_SQL + " WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-11-20' AND DATE '1996-11-23'")
def parquet_date_range_sorted(spark, sf_dir):
    """A few days: of their month only the row groups are read that hold them."""
    orders = orders_by_month(spark, sf_dir)
    path = scratch_path(spark, "orders")
    write_lake(orders, path, "overwrite", sort_by=["order_date"], **{"parquet.block.size": str(1 << 20)})
    stored = read_lake(spark, path, orders.schema)
    return dated_between(stored, "order_date", "1996-11-20", "1996-11-23")


@query("SELECT CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS watermark, count(*) AS n FROM orders")
def watermark_observed(spark, sf_dir):
    """The largest date, taken in the pass that writes the rows."""
    orders = orders_by_month(spark, sf_dir)
    path = scratch_path(spark, "orders")
    mark = write_lake(orders, path, "overwrite", observe=F.max("order_date"))
    stored = read_lake(spark, path, orders.schema)
    return stored.agg(F.lit(mark).alias("watermark"), F.count(F.lit(1)).alias("n"))


@query("""SELECT p_type AS difficulty, CAST(round(avg(p_size)) AS DOUBLE) AS avg_total_cooking_time
    FROM part GROUP BY p_type""")
def csv_report_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "report")
    report = average_per(table(spark, sf_dir, "part"), "p_type", "p_size", "avg_total_cooking_time")
    write_csv_report(report, path)
    return read_csv_report(spark, path, DIFFICULTY_REPORT)


@query("""SELECT CASE WHEN p_size * 2 < 30 THEN 'easy' WHEN p_size * 2 <= 60 THEN 'medium' ELSE 'hard' END
        AS difficulty, CAST(round(avg(p_size * 2)) AS DOUBLE) AS avg_total_cooking_time
    FROM part GROUP BY 1""")
def csv_report_single_file(spark, sf_dir):
    path = scratch_path(spark, "report")
    timed = table(spark, sf_dir, "part").select((F.col("p_size") * 2).alias("minutes"))
    labelled = timed.withColumn("difficulty", difficulty("minutes"))
    report = average_per(labelled, "difficulty", "minutes", "avg_total_cooking_time")
    write_csv_report(report, path, single_file=True)
    return read_csv_report(spark, path, DIFFICULTY_REPORT)


@query(MONTHLY_SQL)
def ingest_other_table(spark, sf_dir):
    """The ingestion of any table: orders up to a date in full, the others as a delta."""
    orders = orders_by_month(spark, sf_dir)
    folder = scratch_path(spark, "orders")
    history = HistoryTable(spark, f"{folder}/history")
    history.seed("orders", "order_date")
    early = orders.where(F.col("order_date") <= F.lit("1999-12-15").cast("date"))
    for arrived in (early, orders):
        ingest(
            history,
            "orders",
            lambda mark: newer_than(arrived, "order_date", mark),
            f"{folder}/lake",
            watermark_column="order_date",
        )
    return read_lake(spark, f"{folder}/lake", orders.schema)


@query("""SELECT event_id, ts, CAST(year(ts) AS INTEGER) AS "year", CAST(month(ts) AS INTEGER) AS "month" FROM events""")
def ingest_by_timestamp(spark, sf_dir):
    """A mark in the middle of a day: three runs leave every event once."""
    events = with_year_month(table(spark, sf_dir, "events").select("event_id", "ts"), "ts")
    folder = scratch_path(spark, "events")
    history = HistoryTable(spark, f"{folder}/history")
    history.seed("events", "ts")
    early = events.where(F.col("ts") <= F.lit("2024-01-10 11:30:00").cast("timestamp_ntz"))
    for arrived in (early, events, events):
        ingest(
            history,
            "events",
            lambda mark: newer_than(arrived, "ts", mark),
            f"{folder}/lake",
            watermark_column="ts",
        )
    return read_lake(spark, f"{folder}/lake", events.schema)


def as_uri(path):
    return path if ":" in path else f"file:{path}"


@query("SELECT CAST(p_size AS VARCHAR) AS p_size, p_name FROM part")
def json_uris(spark, sf_dir):
    """Two folders named by URI, written and read together."""
    part = table(spark, sf_dir, "part")
    paths = [as_uri(scratch_path(spark, "part-json")) for _ in range(2)]
    for i, path in enumerate(paths):
        part.where(F.col("p_partkey") % 2 == i).select("p_size", "p_name").write.json(path)
    return read_json_lines(spark, paths, PART_TEXT).select("p_size", "p_name")


@query(MONTHLY_SQL)
def parquet_uri(spark, sf_dir):
    orders = orders_by_month(spark, sf_dir)
    path = as_uri(scratch_path(spark, "orders"))
    write_lake(orders, path, "overwrite")
    return read_lake(spark, path, orders.schema)


TEXTS_SQL = r"""SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN '  ' || text || ' ' WHEN 1 THEN chr(9) || text || chr(9)
        WHEN 2 THEN '"' || text || '", "' WHEN 3 THEN chr(92) || text WHEN 4 THEN '' WHEN 5 THEN NULL
        WHEN 6 THEN chr(13) || chr(10) || text || chr(10) ELSE chr(92) || 'N' END AS text, source FROM documents"""


@query(TEXTS_SQL)
def csv_text_roundtrip(spark, sf_dir):
    """Blanks, tabs, quotes, backslashes and line breaks at both ends, empty text and NULL."""
    text, kind = F.col("text"), F.col("doc_id") % 8
    odd = (
        F.when(kind == 0, F.concat(F.lit("  "), text, F.lit(" ")))
        .when(kind == 1, F.concat(F.lit("\t"), text, F.lit("\t")))
        .when(kind == 2, F.concat(F.lit('"'), text, F.lit('", "')))
        .when(kind == 3, F.concat(F.lit("\\"), text))
        .when(kind == 4, "")
        .when(kind == 5, F.lit(None).cast("string"))
        .when(kind == 6, F.concat(F.lit("\r\n"), text, F.lit("\n")))
        .otherwise("\\N")
    )
    rows = table(spark, sf_dir, "documents").select("doc_id", odd.alias("text"), "source")
    path = scratch_path(spark, "texts")
    write_csv_report(rows, path)
    return read_csv_report(spark, path, rows.schema)


def in_pieces(spark, sf_dir, pieces):
    """Orders by month, appended in pieces that each hold some of every month."""
    orders = orders_by_month(spark, sf_dir)
    path = scratch_path(spark, "orders")
    for piece in range(pieces):
        rows = orders.where(F.col("o_orderkey") % pieces == piece)
        write_lake(rows, path, "append" if piece else "overwrite")
    return orders.schema, path


@query(MONTHLY_SQL)
def parquet_compacted(spark, sf_dir):
    """Small files of each month merged; the rows stay."""
    schema, path = in_pieces(spark, sf_dir, 4)
    compact_lake(spark, path, schema)
    return read_lake(spark, path, schema)


@query(f"""SELECT * FROM ({MONTHLY_SQL}) WHERE o_orderkey % 7 <> 0 UNION ALL
    SELECT * REPLACE (concat('was ', o_orderpriority) AS o_orderpriority,
        CAST(year(order_date) AS INTEGER) AS "year", CAST(month(order_date) AS INTEGER) AS "month")
    FROM (SELECT * REPLACE (order_date + 31 AS order_date) FROM ({MONTHLY_SQL}) WHERE o_orderkey % 7 = 0)""")
def parquet_merged(spark, sf_dir):
    """Orders of two versions: the later one stays, a month further on, and comes twice without effect."""
    orders = orders_by_month(spark, sf_dir)
    path = scratch_path(spark, "orders")
    write_lake(orders, path, "overwrite")
    moved = orders.where("o_orderkey % 7 = 0").withColumn("order_date", F.date_add("order_date", 31))
    moved = moved.withColumn("o_orderpriority", F.concat(F.lit("was "), "o_orderpriority"))
    moved = with_year_month(moved, "order_date")
    for _ in range(2):
        merge_lake(moved.union(moved), path, orders.schema, ["o_orderkey"], ["order_date"])
    return read_lake(spark, path, orders.schema)
