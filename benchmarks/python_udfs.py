"""The recipe job against the same job written with row-at-a-time Python functions.

    python -m benchmarks.python_udfs [copies]

Recipes are made from ``lineitem`` at ``$BENCH_SF_DIR``, each line ``copies`` times. The other job
is how it would be done without Spark's own expressions: two Python UDFs, all rows of a year in
one task, the input read a second time for the watermark. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bench import session
from larder.functions import duration_minutes, lines, mentions, parse_date
from larder.operators import recipes
from larder.operators.rows import drop_missing, watermark, with_year_month
from larder.plans.recipes import RecipeJob, run_recipes
from larder.schemas import CLEANSED_RECIPE, RAW_RECIPE
from larder.sources.csv_report import write_csv_report
from larder.sources.history_table import HistoryTable
from larder.sources.json_lines import read_json_lines
from larder.sources.lake import read_lake
from larder.sources.shared import scratch_path
from workload.registry import table

SHAPE = re.compile(r"PT(?:(\d+)H)?(?:(\d+)M)?")


@F.udf(T.IntegerType())
def minutes_udf(text):
    found = SHAPE.search(text or "")
    return int(found[1] or 0) * 60 + int(found[2] or 0) if found else 0


@F.udf(T.IntegerType())
def mentions_udf(items, term):
    return int(any(term in item.lower() for item in items or ()))


def write_recipes(spark, sf_dir, copies, path):
    lineitem = table(spark, sf_dir, "lineitem")
    hours, minutes = F.col("l_linenumber") - 1, F.col("l_quantity").cast("int")
    item = F.concat(F.lit(" g of item "), F.col("l_partkey"), F.lit("\nsalt\npepper\n"))
    recipe = lineitem.select(
        F.concat(F.lit(" Recipe "), F.col("l_orderkey"), F.lit(" ")).alias("name"),
        F.concat(
            minutes, item, F.when(F.col("l_returnflag") == "R", "1 lb Ground BEEF").otherwise("water")
        ).alias("ingredients"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("datePublished"),
        F.concat(F.lit("PT"), hours, F.lit("H"), minutes, F.lit("M")).alias("cookTime"),
        F.concat(F.lit("PT"), F.col("l_linenumber") * 5, F.lit("M")).alias("prepTime"),
        F.repeat(F.lit("A dish. "), 8).alias("description"),
        F.concat(F.lit("https://img.example.com/"), F.col("l_orderkey")).alias("image"),
        F.col("l_linenumber").alias("recipeYield"),
        F.concat(F.lit("https://example.com/"), F.col("l_orderkey")).alias("url"),
    )
    copied = recipe.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy")
    copied.repartition(32).write.json(path)


def udf_job(spark, source, folder):
    """The library's own steps, but for what is compared: the two functions, one task per year, a second read."""
    raw = read_json_lines(spark, source, RAW_RECIPE)
    read = raw.withColumns({"cook": minutes_udf("cookTime"), "prep": minutes_udf("prepTime")})
    named = drop_missing(read.withColumn("recipeName", F.trim("name")), "recipeName")
    dated = with_year_month(named.withColumn("published", parse_date("datePublished")), "published")
    cleansed = dated.select("recipeName", "published", "cook", "prep", lines("ingredients").alias("items"), "year", "month")
    writer = cleansed.repartition("year").write.mode("overwrite").partitionBy("year", "month")
    writer.parquet(f"{folder}/lake")
    watermark(cleansed, "published").first()
    stored = read_lake(spark, f"{folder}/lake", cleansed.schema)
    timed_ = stored.withColumn("minutes", F.col("cook") + F.col("prep"))
    labelled = timed_.withColumn("difficulty", recipes.difficulty("minutes"))
    report = recipes.average_per(labelled, "difficulty", "minutes", "avg_total_cooking_time")
    write_csv_report(report, f"{folder}/report", single_file=True)
    stored.where(mentions_udf("items", F.lit("beef")) == 1).select("recipeName").write.format("noop").mode("overwrite").save()


def native_job(spark, source, folder):
    job = RecipeJob(source, f"{folder}/lake", f"{folder}/report", f"{folder}/history")
    HistoryTable(spark, job.history_path).seed(job.etl_name)
    _, names = run_recipes(spark, job)
    names.write.format("noop").mode("overwrite").save()


def run(df):
    df.write.format("noop").mode("overwrite").save()


def timed(action):
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 2)


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 1
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    source = scratch_path(spark, "recipes")
    write_recipes(spark, sf_dir, copies, source)
    raw = read_json_lines(spark, source, RAW_RECIPE)
    count = raw.count()

    folders = {name: scratch_path(spark, name) for name in ("native", "udf")}
    result = {"recipes": count}
    # Each side runs once at a small size first, so that neither pays for starting the JVM's work.
    small = scratch_path(spark, "recipes")
    write_recipes(spark, sf_dir.replace("sf0.1", "sf0.01"), 1, small)
    for name, job in (("native", native_job), ("udf", udf_job)):
        job(spark, small, scratch_path(spark, "warm"))
        result[f"job_{name}"] = timed(lambda: job(spark, source, folders[name]))

    stored = read_lake(spark, f"{folders['native']}/lake", CLEANSED_RECIPE)
    texts = scratch_path(spark, "texts")
    raw.select("cookTime", "datePublished").write.parquet(texts)
    durations = spark.read.parquet(texts)
    for name, df in {
        "duration_native": durations.select(duration_minutes("cookTime")),
        "duration_udf": durations.select(minutes_udf("cookTime")),
        "mentions_native": stored.select(mentions("ingredients_arr", "beef")),
        "mentions_udf": stored.select(mentions_udf("ingredients_arr", F.lit("beef"))),
        "date_native": durations.select(parse_date("datePublished")),
        "split_native": raw.select(F.size(lines("ingredients"))),
    }.items():
        result[name] = min(timed(lambda: run(df)) for _ in range(3))
    reports = [
        sorted(map(tuple, spark.read.option("header", True).csv(f"{folder}/report").collect()))
        for folder in folders.values()
    ]
    result["same_report"] = reports[0] == reports[1]
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
