"""Recipe cleansing and the recipe reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import (
    duration_minutes,
    first_match,
    lines,
    mentions,
    parse_date,
    total_minutes,
)
from larder.operators.rows import drop_missing, newer_than, with_year_month
from larder.sources.json_lines import CORRUPT

# The difficulty labels and their limits in minutes.
DIFFICULTY_RULES = (
    ("easy", lambda minutes: minutes < 30),
    ("medium", lambda minutes: minutes.between(30, 60)),
)
DIFFICULTY_OTHERWISE = "hard"


def difficulty(minutes: Column | str) -> Column:
    """``easy`` under 30 minutes, ``medium`` up to 60, else ``hard``, which includes NULL."""
    return first_match(minutes, DIFFICULTY_RULES, DIFFICULTY_OTHERWISE)


def cleanse(
    raw: DataFrame,
    watermark: str | None = None,
    lookback_days: int = 0,
    strict_durations: bool = False,
) -> DataFrame:
    """Raw recipe rows in their typed form, only those newer than ``watermark`` if one is given.

    Only narrow expressions: one pass over the input, no shuffle. Recipes without a name are
    dropped. Recipes without a readable date stay, unless a watermark is given.
    """
    typed = raw.select(
        F.trim("name").alias("recipeName"),
        parse_date("datePublished").alias("datePublished"),
        duration_minutes("cookTime", strict_durations).alias("cookTimeMinutes"),
        duration_minutes("prepTime", strict_durations).alias("prepTimeMinutes"),
        "description",
        "image",
        "recipeYield",
        "url",
        lines("ingredients").alias("ingredients_arr"),
    )
    named = with_year_month(drop_missing(typed, "recipeName"), "datePublished")
    return newer_than(named, "datePublished", watermark, lookback_days)


def aggregation_input(
    recipes: DataFrame, term: str = "beef", flag: str = "is_beef_recipe"
) -> DataFrame:
    """Name, term flag, total time and difficulty of every recipe."""
    return recipes.select(
        "recipeName",
        mentions("ingredients_arr", term).alias(flag),
        total_minutes("cookTimeMinutes", "prepTimeMinutes").alias("total_time"),
    ).withColumn("difficulty", difficulty("total_time"))


def mentioning(recipes: DataFrame, term: str = "beef") -> DataFrame:
    """Names of the recipes whose ingredients mention ``term``."""
    return recipes.where(mentions("ingredients_arr", term) == 1).select("recipeName")


def difficulty_report(prepared: DataFrame, only: Column | None = None) -> DataFrame:
    """Rounded average total time per difficulty, over all recipes or those where ``only`` holds.

    Map-side partial averages leave at most three rows per task to shuffle, so a difficulty that
    holds most recipes costs no more than a rare one.
    """
    if only is not None:
        prepared = prepared.where(only)
    return average_per(prepared, "difficulty", "total_time", "avg_total_cooking_time")


def report_state(recipes: DataFrame) -> DataFrame:
    """What the difficulty report needs of each month: minutes, timed recipes and all recipes per difficulty.

    Sums of whole numbers, so states of different rows add up to that of all of them. One row per month and difficulty.
    """
    prepared = recipes.select("year", "month", total_minutes("cookTimeMinutes", "prepTimeMinutes").alias("total_time"))
    return (
        prepared.groupBy("year", "month", difficulty("total_time").alias("difficulty"))
        .agg(F.sum("total_time").alias("minutes"), F.count("total_time").alias("timed"), F.count("*").alias("recipes"))
        .select("difficulty", "minutes", "timed", "recipes", "year", "month")
    )


def report_of_state(state: DataFrame) -> DataFrame:
    """The difficulty report of the recipes that ``state`` sums up."""
    average = F.try_divide(F.sum("minutes").cast("double"), F.sum("timed").cast("double"))
    return state.groupBy("difficulty").agg(F.round(average).alias("avg_total_cooking_time"))


def with_reasons(raw: DataFrame, corrupt: str = CORRUPT) -> DataFrame:
    """The cleansed form of every line read, with a ``reason`` and the ``line`` where it cannot be used.

    ``raw`` is read with ``keep_corrupt``. Reasons are, in this order: ``line`` (no JSON object), ``name`` (there is none), ``date`` and
    ``duration`` (there is a text that is none); NULL for good rows, whose ``line`` is NULL as well. No row is lost. A
    missing date or duration is no reason.
    """
    date, cook, prep = parse_date("datePublished"), duration_minutes("cookTime"), duration_minutes("prepTime")
    unread = [F.col(given).isNotNull() & read.isNull() for given, read in (("cookTime", cook), ("prepTime", prep))]
    reason = (
        F.when(F.col(corrupt).isNotNull(), "line")
        .when(F.col("name").isNull(), "name")
        .when(F.col("datePublished").isNotNull() & date.isNull(), "date")
        .when(unread[0] | unread[1], "duration")
    )
    written = F.to_json(F.struct(*(name for name in raw.columns if name != corrupt)))
    line = F.when(reason.isNotNull(), F.coalesce(F.col(corrupt), written))
    typed = raw.select(
        F.trim("name").alias("recipeName"),
        date.alias("datePublished"),
        cook.alias("cookTimeMinutes"),
        prep.alias("prepTimeMinutes"),
        "description",
        "image",
        "recipeYield",
        "url",
        lines("ingredients").alias("ingredients_arr"),
        reason.alias("reason"),
        line.alias("line"),
    )
    return with_year_month(typed, "datePublished")


def average_per(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Average of ``value`` per ``key``, rounded half up to a whole number. NULLs do not count."""
    return df.groupBy(key).agg(F.round(F.avg(value)).alias(name))
