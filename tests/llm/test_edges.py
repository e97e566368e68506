"""Every operator on NULLs, empty and very long texts, ties, repeated rows, clashing columns and no rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from larder.llm import (
    decontaminate,
    language,
    packing,
    quality_model,
    quality_rules,
    secrets,
    simhash,
    suffixes,
    token_counts,
    wavelet,
)

LONG = "lorem ipsum dolor sit amet consetetur " * 5000
TEXTS = [None, "", " \n ", "one", "a b c d e f", "a b c d e f", LONG, LONG + " end", "Ünï çødé   x  y\n\n z "]
# Columns with the names that operators use themselves, and a repeated row.
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, key string, `fingerprint` int, ids string, row int, measures int, d int"
ROWS = [(i, text, "en" if i % 2 else None, None, None, "x", "y", 1, "z", 2, 3, 4) for i, text in enumerate(TEXTS)]
ROWS += [ROWS[4], (None, "no id here", None, None, 5, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def operators(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(9)] + [(1, 1), (None, 0), (2, None)], "doc_id bigint, quality int")
    bench = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, None), (3, ""), (None, "d e f")], "item_id bigint, text string")
    words = quality_model.word_vectors(docs)
    network = quality_model.train(docs, labels, F.lit(True), words)
    field = language.train(docs, F.lit(True))
    return {
        "simhash": simhash.near_duplicates(docs),
        "quality_model": quality_model.score(docs, words, network),
        "language": language.identify(docs, field),
        "contamination": decontaminate.contamination(docs, bench),
        "tokens": wavelet.tokenized(docs),
        "token_counts": token_counts.token_counts(docs),
        "quality_rules": quality_rules.judge(docs),
        "secrets": secrets.scan(docs),
    }


def test_one_row_for_each_row(spark, odd):
    ids = sorted((row.doc_id is None, row.doc_id or 0) for row in odd.collect())
    for name, found in operators(spark, odd).items():
        got = sorted((row.id is None, row.id or 0) for row in found.collect())
        assert got == ids, name


def test_no_rows(spark, none):
    for name, found in operators(spark, none).items():
        assert found.collect() == [], name
    assert packing.packed(none).collect() == []
    assert suffixes.repeated_passages(none).collect() == []
    assert packing.sequences(packing.packed(none)).collect() == []


def test_values_of_odd_texts(spark, odd):
    found = operators(spark, odd)
    rows = {name: {r.id: r for r in df.collect()} for name, df in found.items()}
    for i in (0, 1):
        assert rows["simhash"][i].fingerprint == 0 and rows["simhash"][i].component_id == 0
        assert (rows["language"][i].lang_pred, rows["language"][i].score) == ("und", 0.0)
        assert (rows["contamination"][i].n_words, rows["contamination"][i].contaminated) == (0, False)
        assert rows["tokens"][i].n_tokens == 1
        assert rows["token_counts"][i].n_tokens == 0
        assert rows["quality_rules"][i].base_failed and not rows["quality_rules"][i].kept
        assert rows["secrets"][i].spans == ""
    assert rows["simhash"][5].component_id == 4
    assert rows["contamination"][4].n_hit == 6 and rows["contamination"][4].n_items == 1
    assert all(0 <= r.score <= 1 for r in rows["quality_model"].values())
    assert rows["token_counts"][6].n_chars == len(LONG)


def test_repeated_passages_of_odd_texts(spark, odd):
    found = {r.id: (r.n_words, r.n_repeated) for r in suffixes.repeated_passages(odd).collect()}
    assert found == {6: (30000, 30000), 7: (30001, 30000)}


def test_packing_of_odd_texts(spark, odd):
    pieces = packing.packed(odd)
    rows = pieces.collect()
    assert sum(r.length for r in rows) == sum({(r.id, r.doc_tokens, r.start): r.length for r in rows}.values()) + 7
    full = packing.sequences(pieces).collect()
    assert all(len(r.ids) == 4096 or (r.n_tokens & (r.n_tokens - 1)) == 0 for r in full)


def test_filters_keep_columns(spark, odd, none):
    for docs in (odd, none):
        bench = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
        for kept in (
            simhash.deduplicate(docs),
            quality_rules.keep_good(docs),
            decontaminate.decontaminate(docs, bench),
            decontaminate.decontaminate(docs, bench, remove="spans"),
            secrets.without_secrets(docs),
        ):
            assert kept.columns == docs.columns
            assert [f.dataType for f in kept.schema] == [f.dataType for f in docs.schema]
            kept.collect()


def test_deduplicate_keeps_one_of_repeated_rows(spark, odd):
    kept = sorted(r.doc_id for r in simhash.deduplicate(odd).collect() if r.doc_id is not None)
    assert kept.count(4) == 1 and 5 not in kept and 0 in kept and 1 not in kept


def test_pipeline_stages_take_no_rows(spark, none, tmp_path):
    docs = none.select("doc_id", "text", "lang", "source", "n_chars")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.collect() == []
