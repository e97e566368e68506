"""Encoding by pieces against the tokenizer, and lookups over written token files against plain lists."""

import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer, pre_tokenizers

from larder.llm import tokens, wavelet

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def exact():
    it = Tokenizer.from_file(tokens.default_tokenizer())
    it.encode_special_tokens = True
    return it


def expected(exact, texts):
    return [np.array(exact.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_borders_of_odd_characters(exact):
    pick = random.Random(5)
    pieces = ["a", "B", "é", "ß", "1", " ", " ", "\n", "\n\n", ".", ",", "'s", "'", "\t", " ", "—", "中", "🙂", "\x01", "ﬁ", "ɏ", "ʰ"]
    pieces += ["×", "÷", "ª", "_", "[", "~", "\x7f", "́", "\r\n", "᠎", "​", "\x85", "\x1c", "x.", "\n.", "<|endoftext|>"]
    texts = ["".join(pick.choice(pieces) for _ in range(pick.randint(0, 30))) for _ in range(8000)] + [None, "", "a\n", "\na", "a\nb\nc"]
    assert tokens.TextEncoder(tokens.default_tokenizer()).encode(texts) == expected(exact, texts)


def test_memory_forgets_and_makes_again():
    memory, made = tokens.Memory(8), []

    def make(words):
        made.extend(words.to_pylist())
        return np.array([ord(w) for w in words.to_pylist()], "<u4"), np.ones(len(words), np.int64)

    for word in "abcabcdefghaijkalmnaopqra":
        ids, sizes = memory.look_up(pa.array([word]), make)
        assert ids.tolist() == [ord(word)] and sizes.tolist() == [1]
    assert len(memory.met) <= 9 and made.count("a") < 3 and made.count("b") == 1


def test_tokenizer_with_other_borders(exact, tmp_path):
    """Settings under which the borders are not certain: texts are encoded whole."""
    other = Tokenizer.from_file(tokens.default_tokenizer())
    other.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True, use_regex=False)
    other.save(str(tmp_path / "other.json"))
    texts = ["one two, three", "", None, "a.b c"]
    assert tokens.TextEncoder(str(tmp_path / "other.json")).encode(texts) == expected(other, texts)


@pytest.fixture(scope="module")
def written(spark, exact, tmp_path_factory):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    path = str(tmp_path_factory.mktemp("tokens") / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    wavelet.write_tokens(docs, path, block_tokens=900)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = [i for d in sorted(texts) for i in exact.encode(texts[d], add_special_tokens=False).ids + [2]]
    table = spark.read.parquet(path)
    assert table.select("shard").distinct().count() > 1 and table.count() > 50
    return path, ids


def test_counts_over_files(spark, written):
    path, ids = written
    asked = [2, 13, ids[0], ids[-1], 49999, 60000]
    found = {r.symbol: r.n for r in wavelet.token_counts(spark, path, asked).collect()}
    assert found == {symbol: ids.count(symbol) for symbol in asked}


def test_access_over_files(spark, written):
    path, ids = written
    asked = [0, 1, len(ids) - 1, len(ids), len(ids) + 5, *range(7, len(ids), 997)]
    found = {r.offset: r.symbol for r in wavelet.tokens_at(spark, path, asked).collect()}
    assert found == {at: ids[at] for at in asked if at < len(ids)}


def test_occurrences_over_files(spark, written):
    path, ids = written
    for symbol in (2, ids[100], 60000):
        where = [at for at, i in enumerate(ids) if i == symbol]
        asked = [0, 1, len(where) // 2, len(where) - 1, len(where), 10**9]
        found = {r.k: r.offset for r in wavelet.occurrences(spark, path, symbol, asked).collect()}
        assert found == {k: where[k] for k in asked if 0 <= k < len(where)}


def test_lookups_over_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    wavelet.write_tokens(spark.createDataFrame([], "doc_id bigint, text string"), path)
    assert [tuple(r) for r in wavelet.token_counts(spark, path, [5]).collect()] == [(5, 0)]
    assert wavelet.tokens_at(spark, path, [0]).collect() == []
    assert wavelet.occurrences(spark, path, 5, [0]).collect() == []


def test_damaged_plane():
    matrix = wavelet.WaveletMatrix.of(np.arange(500, dtype="<u4"))
    matrix.zeros[3] += 1
    with pytest.raises(ValueError):
        wavelet.WaveletMatrix.from_bytes(matrix.to_bytes()).ids()
