"""Scalar functions, filters and aggregates."""

from pyspark.sql import functions as F

from larder import functions as fn
from larder.functions import lines, mentions
from larder.operators.recipes import average_per, difficulty
from larder.operators.rows import drop_missing, newer_than, preview, watermark, with_year_month
from workload.registry import query, table

TERM = "license"


def line_durations(lineitem):
    """Duration texts of all four shapes from the line number and the quantity, and one of minutes."""
    number = F.col("l_linenumber").cast("string")
    quantity = F.col("l_quantity").cast("int").cast("string")
    text = (
        F.when(F.col("l_linenumber") == 7, "PT")
        .when(F.col("l_linenumber").isin(3, 6), F.concat(F.lit("PT"), number, F.lit("H")))
        .when(F.col("l_linenumber") == 1, F.concat(F.lit("PT"), quantity, F.lit("M")))
        .otherwise(F.concat(F.lit("PT"), number, F.lit("H"), quantity, F.lit("M")))
    )
    prep = F.concat(F.lit("PT"), F.col("l_linenumber") * 5, F.lit("M"))
    return lineitem.withColumns({"duration": text, "prep_duration": prep})


LINE_MINUTES = """CASE WHEN l_linenumber = 7 THEN 0
        WHEN l_linenumber IN (3, 6) THEN l_linenumber * 60
        WHEN l_linenumber = 1 THEN CAST(l_quantity AS INTEGER)
        ELSE l_linenumber * 60 + CAST(l_quantity AS INTEGER) END"""
DIFFICULTY = "CASE WHEN {0} < 30 THEN 'easy' WHEN {0} BETWEEN 30 AND 60 THEN 'medium' ELSE 'hard' END"


@query(f"""SELECT l_orderkey, l_linenumber, CAST({LINE_MINUTES} AS INTEGER) AS mins FROM lineitem""")
def duration_minutes(spark, sf_dir):
    lineitem = line_durations(table(spark, sf_dir, "lineitem"))
    return lineitem.select("l_orderkey", "l_linenumber", fn.duration_minutes("duration").alias("mins"))


@query("""SELECT o_orderkey, CAST(CASE o_orderpriority
        WHEN '3-MEDIUM' THEN o_custkey * 60 + 20
        WHEN '4-NOT SPECIFIED' THEN CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN o_custkey
            ELSE -o_custkey END
        END AS INTEGER) AS mins FROM orders""")
def duration_unreadable(spark, sf_dir):
    """Malformed, missing, overflowing and oddly written durations."""
    customer = F.col("o_custkey").cast("string")
    urgent = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("PT9999999999"), customer, F.lit("M")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("PT40000000"), customer, F.lit("H1M")))
        .otherwise(F.concat(F.lit("PT"), customer, F.lit(".5H")))
    )
    high = (
        F.when(F.col("o_orderstatus") == "F", "P1DT2H")
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("PT"), customer, F.lit("M1H")))
        .otherwise(F.concat(F.lit("HPT"), customer, F.lit("M")))
    )
    unspecified = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("pt"), customer, F.lit("m")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit(" xxPT "), customer, F.lit("MIN ")))
        .otherwise(F.concat(F.lit("PT-"), customer, F.lit("M")))
    )
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", urgent)
        .when(F.col("o_orderpriority") == "2-HIGH", high)
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit("PT"), customer, F.lit("H 20M30S")))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", unspecified)
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", fn.duration_minutes(text).alias("mins"))


@query("""SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_returnflag <> 'R'
        AND 2147483000 + l_partkey <= 2147483647 THEN 2147483000 + l_partkey END AS INTEGER) AS total
    FROM lineitem""")
def total_minutes(spark, sf_dir):
    """A sum that is NULL if either side is, or if it leaves the int range."""
    cook = F.when(F.col("l_returnflag") != "R", F.lit(2147483000))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        fn.total_minutes(cook, F.col("l_partkey").cast("int")).alias("total"),
    )


@query(f"""SELECT {DIFFICULTY.format("t")} AS difficulty,
        CAST(round(avg(t)) AS DOUBLE) AS avg_total_cooking_time
    FROM (SELECT {LINE_MINUTES} + l_linenumber * 5 AS t FROM lineitem) GROUP BY 1""")
def difficulty_avg(spark, sf_dir):
    """Flagship: two duration texts, their total, its difficulty, the average per difficulty."""
    read = line_durations(table(spark, sf_dir, "lineitem")).select(
        fn.duration_minutes("duration").alias("cook"),
        fn.duration_minutes("prep_duration").alias("prep"),
    )
    timed = read.select(fn.total_minutes("cook", "prep").alias("total_time"))
    labelled = timed.withColumn("difficulty", difficulty("total_time"))
    return average_per(labelled, "difficulty", "total_time", "avg_total_cooking_time")


@query(f"""SELECT {DIFFICULTY.format("t")} AS difficulty, count(*) AS n, count(t) AS n_timed,
        CAST(round(avg(t)) AS DOUBLE) AS avg_total_cooking_time
    FROM (SELECT CASE WHEN l_linenumber <> 2 THEN {LINE_MINUTES} + l_linenumber * 5 END AS t
        FROM lineitem) GROUP BY 1""")
def difficulty_null_is_hard(spark, sf_dir):
    known = F.when(F.col("l_linenumber") != 2, F.col("duration"))
    texts = line_durations(table(spark, sf_dir, "lineitem")).withColumn("duration", known)
    read = texts.select(
        fn.duration_minutes("duration").alias("cook"),
        fn.duration_minutes("prep_duration").alias("prep"),
    )
    timed = read.select(fn.total_minutes("cook", "prep").alias("total_time"))
    return (
        timed.groupBy(difficulty("total_time").alias("difficulty"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("total_time").alias("n_timed"),
            F.round(F.avg("total_time")).alias("avg_total_cooking_time"),
        )
    )


@query(f"""SELECT p_partkey, p_size * 2 AS minutes_needed, {DIFFICULTY.format("p_size * 2")} AS difficulty
    FROM part""")
def difficulty_labels(spark, sf_dir):
    """Every size once more as minutes, so that both limits are met exactly."""
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        (F.col("p_size") * 2).alias("minutes_needed"),
        difficulty(F.col("p_size") * 2).alias("difficulty"),
    )


@query("""SELECT p_type, CAST(round(avg(p_size)) AS DOUBLE) AS avg_size FROM part GROUP BY p_type""")
def avg_rounded(spark, sf_dir):
    return average_per(table(spark, sf_dir, "part"), "p_type", "p_size", "avg_size")


@query("""SELECT l_linenumber, sign * (l_linenumber + 0.5) AS middle,
        CAST(sign * (l_linenumber + 1) AS DOUBLE) AS rounded
    FROM (SELECT DISTINCT l_linenumber, CASE WHEN l_linenumber > 3 THEN -1.0 ELSE 1.0 END::DOUBLE AS sign
        FROM lineitem)""")
def avg_rounds_half_up(spark, sf_dir):
    """Averages that end in .5 go away from zero."""
    sign = F.when(F.col("l_linenumber") > 3, -1.0).otherwise(1.0)
    halves = table(spark, sf_dir, "lineitem").select(
        "l_linenumber", (sign * (F.col("l_linenumber") + 0.5)).alias("middle")
    )
    rounded = halves.groupBy("l_linenumber").agg(
        F.avg("middle").alias("middle"), F.round(F.avg("middle")).alias("rounded")
    )
    return rounded


LINE_MATCH = f"len(list_filter(string_split(text, chr(10)), lambda x: contains(lower(x), '{TERM}'))) > 0"


@query(f"SELECT doc_id, CAST({LINE_MATCH} AS INTEGER) AS mentioned FROM documents")
def list_mentions_term(spark, sf_dir):
    """Upper-case term on purpose: both sides are compared in lower case."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", mentions(lines("text"), TERM.upper()).alias("mentioned")
    )


@query(f"""SELECT doc_id, CAST(lang <> 'de' AND {LINE_MATCH} AS INTEGER) AS mentioned FROM documents""")
def list_mentions_nulls(spark, sf_dir):
    """NULL arrays and NULL elements do not match."""
    text = F.when(F.col("lang") != "de", F.col("text"))
    items = F.transform(lines(text), lambda line: F.nullif(line, F.lit("")))
    return table(spark, sf_dir, "documents").select(
        "doc_id", mentions(items, TERM).alias("mentioned")
    )


@query(f"SELECT doc_id FROM documents WHERE {LINE_MATCH}")
def rows_mentioning_term(spark, sf_dir):
    flagged = table(spark, sf_dir, "documents").select(
        "doc_id", mentions(lines("text"), TERM).alias("flag")
    )
    return flagged.where(F.col("flag") == 1).select("doc_id")


@query("SELECT doc_id, source FROM documents WHERE contains(lower(text), 'en') ORDER BY doc_id LIMIT 60")
def preview_rows(spark, sf_dir):
    """Most documents match, so the limit acts at every size."""
    documents = table(spark, sf_dir, "documents")
    matching = documents.where(mentions(lines("text"), "en") == 1).select("doc_id", "source")
    return preview(matching, 60, order_by="doc_id")


@query("""SELECT doc_id, CAST(len(string_split(text, chr(10))) AS INTEGER) AS n_lines,
        string_split(text || chr(10), chr(10))[-1] AS last_line FROM documents""")
def split_count(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.size(lines("text")).alias("n_lines"),
        F.element_at(lines(F.concat("text", F.lit("\n"))), -1).alias("last_line"),
    )


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
        CAST(year(o_orderdate) AS INTEGER) AS "year", CAST(month(o_orderdate) AS INTEGER) AS "month"
    FROM orders""")
def date_parts(spark, sf_dir):
    dated = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("order_date")
    )
    return with_year_month(dated, "order_date")


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS parsed FROM orders")
def parse_date(spark, sf_dir):
    text = F.to_date("o_orderdate").cast("string")
    return table(spark, sf_dir, "orders").select("o_orderkey", fn.parse_date(text).alias("parsed"))


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority IN ('5-LOW', '2-HIGH') THEN CAST(o_orderdate AS DATE) END AS parsed,
        CAST(CASE WHEN o_orderpriority IN ('5-LOW', '2-HIGH') THEN year(o_orderdate) END AS INTEGER) AS "year"
    FROM orders""")
def parse_date_unreadable(spark, sf_dir):
    """Other orders, impossible days, extra digits and plain words give NULL; short months and trailing text are read."""
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format("o_orderdate", "yyyy-M-d'T'HH:mm"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format("o_orderdate", "yyyy-MM-'45'"))
        .when(
            F.col("o_orderpriority") == "4-NOT SPECIFIED",
            F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).otherwise(
                F.concat(F.to_date("o_orderdate").cast("string"), F.lit("1"))
            ),
        )
        .otherwise(F.to_date("o_orderdate").cast("string"))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", fn.parse_date(text).alias("parsed"), F.year(fn.parse_date(text)).alias("year")
    )


@query("""SELECT p_partkey, p_name || chr(9) AS trimmed FROM part""")
def trim_name(spark, sf_dir):
    """Blanks go, a tab stays."""
    padded = F.concat(F.lit("  "), F.col("p_name"), F.lit("\t "))
    return table(spark, sf_dir, "part").select("p_partkey", F.trim(padded).alias("trimmed"))


@query("""SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN '' ELSE p_name END AS name
    FROM part WHERE p_type <> 'PROMO'""")
def drop_null_subset(spark, sf_dir):
    """NULL names go; blank ones become empty and stay."""
    name = F.when(F.col("p_type") == "ECONOMY", "   ").when(
        F.col("p_type") != "PROMO", F.col("p_name")
    )
    named = table(spark, sf_dir, "part").select("p_partkey", F.trim(name).alias("name"))
    return drop_missing(named, "name")


def order_dates(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("order_date")
    )


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders
    WHERE CAST(o_orderdate AS DATE) > DATE '2000-06-30'""")
def delta_filter(spark, sf_dir):
    dated = order_dates(spark, sf_dir).select("o_orderkey", "order_date")
    return newer_than(dated, "order_date", "2000-06-30")


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders
    WHERE o_orderstatus <> 'P' AND CAST(o_orderdate AS DATE) > DATE '2000-06-30'""")
def delta_filter_undated(spark, sf_dir):
    """Rows without a date are not newer than any watermark."""
    date = F.when(F.col("o_orderstatus") != "P", F.col("order_date"))
    dated = order_dates(spark, sf_dir).select("o_orderkey", date.alias("order_date"))
    return newer_than(dated, "order_date", "2000-06-30")


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders
    WHERE CAST(o_orderdate AS DATE) > DATE '2000-06-23'""")
def delta_filter_lookback(spark, sf_dir):
    dated = order_dates(spark, sf_dir).select("o_orderkey", "order_date")
    return newer_than(dated, "order_date", "2000-06-30", lookback_days=7)


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders")
def delta_filter_none(spark, sf_dir):
    dated = order_dates(spark, sf_dir).select("o_orderkey", "order_date")
    return newer_than(dated, "order_date", None)


@query("SELECT max(CAST(o_orderdate AS DATE)) AS watermark FROM orders")
def watermark_max(spark, sf_dir):
    return watermark(order_dates(spark, sf_dir), "order_date")


@query("SELECT max(try_cast(o_orderstatus AS DATE)) AS watermark FROM orders")
def watermark_undated(spark, sf_dir):
    """A table without any date has the watermark NULL, not a text such as 'None'."""
    undated = order_dates(spark, sf_dir).select(fn.parse_date("o_orderstatus").alias("order_date"))
    return watermark(undated, "order_date")


@query("SELECT count(*) AS n FROM lineitem")
def row_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT doc_id, CAST(5 AS INTEGER) AS before, CAST(60 * (doc_id % 9) + 5 AS INTEGER) AS after FROM documents""")
def duration_in_texts(spark, sf_dir):
    """Whole texts of many words and character widths around a duration, without further markers."""
    text = F.translate("text", "HMPT", "hmpt")
    after = F.concat(text, F.lit("PT"), F.col("doc_id") % 9, F.lit("H5M"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        fn.duration_minutes(F.concat(F.lit("PT5M"), text)).alias("before"),
        fn.duration_minutes(after).alias("after"),
    )
