"""Work in proportion to the length of a text, and results that its length does not change."""

import random
import time
import tracemalloc

import pytest
from pyspark.sql import functions as F

from larder.llm import decontaminate, language

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def frames(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return docs, spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")


def seconds(spark, text, items):
    docs, bench = frames(spark, [text], items)
    start = time.perf_counter()
    (row,) = decontaminate.contamination(docs, bench).collect()
    return time.perf_counter() - start, row


@pytest.mark.parametrize("hit", [False, True])
def test_decontamination_takes_time_in_proportion(spark, hit):
    """Four megabytes in one text, without a hit and made of a benchmark passage: quadratic work would take many minutes."""
    pick = random.Random(1)
    passage = ["".join(pick.choices(LETTERS, k=5)) for _ in range(400)]
    items = [" ".join(passage)]
    other = ["".join(pick.choices(LETTERS, k=5)) for _ in range(5000)]
    short = " ".join((passage * 100 if hit else pick.choices(other, k=40_000))[:40_000])
    seconds(spark, "warm up", items)
    once, _ = seconds(spark, short, items)
    long, row = seconds(spark, " ".join([short] * 17), items)
    assert row.n_words == 680_000 and row.n_hit == (680_000 if hit else 0) and row.contaminated == hit
    assert long < 60 and long < 20 * max(once, 1.5)


def test_many_spans_in_one_text(spark):
    """Spans are counted and cut right however many there are."""
    pick = random.Random(2)
    item = ["".join(pick.choices(LETTERS, k=4)) for _ in range(13)]
    text, hits = [], 0
    for i in range(3000):
        text += [f"w{chr(97 + i % 26)}{'x' * (i % 7 + 1)}"] * (1 + i % 3)
        if i % 2:
            text += item
            hits += 13
    docs, bench = frames(spark, [" ".join(text), " ".join(item * 3), None], [" ".join(item)])
    found = {r.id: r for r in decontaminate.contamination(docs, bench).collect()}
    assert (found[0].n_words, found[0].n_hit) == (len(text), hits) and found[1].n_hit == 39 and found[2].n_hit == 0
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, bench, remove="spans").collect()}
    assert cut[0].split() == [w for w in text if w not in item] and cut[1] == "" and cut[2] is None


def test_starts_joined_by_a_shuffle(spark, monkeypatch):
    """Beyond the bytes that are broadcast the same rows come out."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    expected = sorted(map(tuple, decontaminate.contamination(docs, bench).collect()))
    plain = decontaminate.broadcast_if_light
    monkeypatch.setattr(decontaminate, "broadcast_if_light", lambda df: plain(df, most_bytes=0))
    assert sorted(map(tuple, decontaminate.contamination(docs, bench, broadcast_grams=0).collect())) == expected
    assert any(r[2] for r in expected)


def test_no_python_worker(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    windows = decontaminate.benchmark_windows(bench)
    for df in (decontaminate.window_hits(docs, windows), decontaminate.contamination(docs, bench)):
        plan = df.select(F.struct("*").alias("r"))._jdf.queryExecution().executedPlan().toString()
        assert not [word for word in ("Python", "Arrow", "Pandas") if word in plan]


# ---------------------------------------------------------------- language


@pytest.fixture(scope="module")
def field(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return language.train(docs, F.lit(True))


def test_language_of_a_text_in_runs(spark, field):
    """Messages pass from run to run: the same means as all words at a time."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    texts = [rows[i].text + " " + rows[i + 1].text for i in range(0, 30, 2)]
    texts += ["a" * 900 + " und der die das " + "ß" * 2000, "中文" * 1500, " \n" * 3000 + "the cat", "1 2 3 " * 500 + "x", "7 " * 900]
    whole = language.predict(field, texts, size=10**9)
    for size in (37, 200, 1000):
        found = language.predict(field, texts, size=size)
        assert [label for label, _ in found] == [label for label, _ in whole]
        assert [score for _, score in found] == pytest.approx([score for _, score in whole], abs=1e-5)


def test_runs_hold_all_words(field):
    pick = random.Random(6)
    for _ in range(200):
        text = "".join(pick.choice(["a", "bc", " ", "\n", "x" * 30, " "]) for _ in range(pick.randint(0, 60)))
        cut = list(language.runs(text, 11))
        assert [w for a, b, _ in cut for w in text[a:b].split()] == text.split()
        assert all(len(text[a:b].split()) == 1 for a, b, one in cut if one)


@pytest.mark.parametrize("text", ["wort und ein anderes " * 400_000, "wort" * 2_000_000])
def test_language_memory_of_a_long_text(field, text):
    """Eight megabytes in one text, of many words and of one: far less than a hundred bytes for each."""
    tracemalloc.start()
    found = language.predict(field, [text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found[0][0] != "und" and peak < 100 << 20


def test_sample_is_bounded_in_bytes(spark):
    rows = [(i, f"ein langer text {i} " * 50, "de") for i in range(20)] + [(i, "the text " * 5000, "en") for i in range(20, 23)]
    rows += [(30, "un texte", "fr")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    assert language.train(docs, F.lit(True), most_bytes=3000).labels == ("de", "fr")
