import random

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from larder.functions import (
    duration_minutes,
    first_match,
    lines,
    mentions,
    parse_date,
    total_minutes,
)
from larder.operators.recipes import difficulty

DURATIONS = {
    "": 0,
    "   ": 0,
    "PT": 0,
    "PT30S": 0,
    "P1D": 0,
    "pt10m": 0,
    "PT1H20M": 80,
    "PT1H": 60,
    "PT10M": 10,
    "PT90M": 90,
    "PT0H05M": 5,
    "PT1H30M15S": 90,
    "PT2H5S": 120,
    "PT1H20MIN": 80,
    "xxPT5M": 5,
    "PT-5M": -5,
    "PT+5M": 5,
    "PT1H 20M": 80,
    " PT5M ": 5,
    "PT35791394H7M": 2147483647,
    "PT35791395H-100M": 2147483600,
    None: None,
    "PT1.5H": None,
    "P1DT2H": None,
    "P2M": None,
    "PTM": None,
    "PT5M1H": None,
    "PT H5M": None,
    "HPT5M": None,
    "5M": None,
    "PT35791394H8M": None,
    "PT9999999999M": None,
    "PT99999999999999999999H": None,
}


def evaluate(spark, texts, expression):
    frame = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "i int, text string")
    return [row[0] for row in frame.orderBy("i").select(expression).collect()]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_duration_table(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        found = evaluate(spark, DURATIONS, duration_minutes("text"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert dict(zip(DURATIONS, found)) == DURATIONS


def expected_minutes(text):
    """The rule once more, over Python strings."""
    hour, minute, prefix = (text.find(mark) for mark in ("H", "M", "PT"))
    if hour < 0 and minute < 0:
        return 0
    if prefix < 0:
        return None
    try:
        hours = int(text[prefix + 2 : hour]) if hour >= 0 else 0
        begin = hour + 1 if hour >= 0 else prefix + 2
        minutes = int(text[begin:minute]) if minute >= 0 else 0
    except ValueError:
        return None
    total = hours * 60 + minutes
    return total if -(2**31) <= total < 2**31 else None


def test_duration_random_texts(spark):
    pick = random.Random(7)
    texts = ["".join(pick.choices("PTHM019 -+.S", k=pick.randint(0, 9))) for _ in range(4000)]
    texts += [f"PT{pick.choice(['', '1', '12H', ' 3H', '0H'])}{body}" for body in texts]
    assert evaluate(spark, texts, duration_minutes("text")) == [expected_minutes(t) for t in texts]


def test_duration_strict(spark):
    fine = [text for text, minutes in DURATIONS.items() if minutes is not None]
    strict = duration_minutes("text", strict=True)
    assert evaluate(spark, fine, strict) == [DURATIONS[text] for text in fine]
    for text in (None, "PT1.5H", "P2M"):
        with pytest.raises(SparkRuntimeException, match="cannot read as a duration"):
            evaluate(spark, [text], strict)


def test_duration_is_one_codegen_span(spark):
    frame = spark.range(10).select(duration_minutes(F.concat(F.lit("PT"), "id", F.lit("M"))))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert all(line.lstrip(" +-:").startswith("*(1)") for line in plan.strip().splitlines())


def test_total_minutes(spark):
    pairs = [(1, 2, 3), (None, 2, None), (1, None, None), (2**31 - 1, 0, 2**31 - 1)]
    pairs += [(2**31 - 1, 1, None), (-(2**31), -1, None), (-(2**31), 0, -(2**31))]
    frame = spark.createDataFrame(pairs, "a int, b int, expected int")
    assert [r[0] for r in frame.select(total_minutes("a", "b")).collect()] == [p[2] for p in pairs]


def test_mentions(spark):
    lists = [["A Beef x", None], [None, "pork"], [None], [], None, ["BEEFY"], ["be", "ef"], [None, "beef"]]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, a array<string>")
    for term in ("beef", "BEEF"):
        found = [row[0] for row in frame.orderBy("i").select(mentions("a", term)).collect()]
        assert found == [1, 0, 0, 0, 0, 1, 0, 1]


def test_lines(spark):
    assert evaluate(spark, ["a\n", "", None, "a\nb", "\n\n"], lines("text")) == [
        ["a", ""],
        [""],
        None,
        ["a", "b"],
        ["", "", ""],
    ]


def test_parse_date(spark):
    wrong = ["oops", "2013-02-30", "", None, " 2013-03-28", "2013-03-281", "2013-3-123", "28/03/2013"]
    wrong += ["+2013-03-28", "12013-03-28", "2013", "20130328", "2013-13-01", "2013-03"]
    right = {"2013-03-28": "2013-03-28", "2012-02-29": "2012-02-29", "2013-3-8": "2013-03-08"}
    right |= {"2013-03-28x": "2013-03-28", "2013-03-28T10:00:00": "2013-03-28", "2013-03-8 ": "2013-03-08"}
    right |= {"2013-03-28\n": "2013-03-28"}
    found = evaluate(spark, [*right, *wrong], parse_date("text").cast("string"))
    assert found == [*right.values()] + [None] * len(wrong)


def test_duration_in_a_very_long_text(spark):
    text = "a😀" * 200_000
    assert evaluate(spark, [f"{text}PT5M"], duration_minutes("text")) == [5]


def test_difficulty_limits(spark):
    minutes = ["-5", "0", "29", "30", "60", "61", None]
    found = evaluate(spark, minutes, difficulty(F.col("text").cast("int")))
    assert found == ["easy", "easy", "easy", "medium", "medium", "hard", "hard"]


def test_first_match_takes_the_first(spark):
    rules = [("low", lambda v: v < 10), ("lower", lambda v: v < 5), ("some", lambda v: v < 20)]
    column = first_match(F.col("text").cast("int"), rules, "rest")
    assert evaluate(spark, ["1", "15", "25"], column) == ["low", "some", "rest"]
