"""Repeated passages by sparse suffix arrays over words."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.texts import let_workers_import, stored, text_function

# Odd bases of two polynomial hashes modulo 2^64; both together tell runs of words apart.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
# Words whose hashes a task remembers.
REMEMBERED_WORDS = 500_000
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def anchor_words(passage: int) -> int:
    """Words of an anchor: of the ``passage - anchor + 1`` anchors in a passage the least one marks it."""
    return max(1, passage // 2)


def word_hashes(text: str | None, known: dict[bytes, int]) -> np.ndarray:
    words = text.encode().split() if text else []
    for word in set(words).difference(known):
        if len(known) >= REMEMBERED_WORDS:
            known.clear()
            return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
        known[word] = xxhash.xxh64_intdigest(word)
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    return np.cumprod(np.full(n, base, np.uint64)), np.cumprod(np.full(n, inverse, np.uint64))


def run_hashes(words: np.ndarray, size: int, base: int) -> np.ndarray:
    """A hash of each run of ``size`` words, from running sums: equal runs have equal hashes anywhere."""
    n = len(words)
    if n < size:
        return np.zeros(0, np.uint64)
    power, back = (x[:n] for x in _powers(base, 1 << max(10, n.bit_length())))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * power)))
    runs = (sums[size:] - sums[:-size]) * back[: n - size + 1]
    runs ^= runs >> np.uint64(29)
    runs *= np.uint64(0xBF58476D1CE4E5B9)
    return runs ^ runs >> np.uint64(32)


def anchors(words: np.ndarray, passage: int) -> tuple[np.ndarray, np.ndarray]:
    """``marks, hashes``: where the least anchor of each passage begins, for all its possible starts; and
    the hash of the anchor at every word. Equal passages have the same mark at the same distance."""
    size = anchor_words(passage)
    hashes = run_hashes(words, size, BASES[0])
    if len(words) < passage:
        return np.zeros(0, np.int64), hashes
    span = passage - size + 1
    views = np.lib.stride_tricks.sliding_window_view(hashes, span)
    return np.concatenate([v.argmin(axis=1) for v in np.array_split(views, -(-len(views) // 65536))]) + np.arange(
        len(views)
    ), hashes


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64), pa.int64())


def _keys(text: str) -> list[Column]:
    """128 bits that tell texts apart."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2")]


def _different(inside: bool = False) -> Column:
    texts = (F.min("k1") < F.max("k1")) | (F.min("k2") < F.max("k2"))
    return texts | (F.min("at") < F.max("at")) if inside else texts


def sparse_suffixes(texts: DataFrame, passage: int) -> DataFrame:
    """``anchor, k1, k2, at``: the retained suffixes, those that begin at a mark, by the hash of their first words."""

    def retain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            for row, text in enumerate(batch.column(2).to_pylist()):
                marks, hashes = anchors(word_hashes(text, known), passage)
                if not len(marks):
                    continue
                at = np.unique(marks)
                k1, k2 = (pa.array(np.full(len(at), batch.column(i)[row].as_py(), np.int64)) for i in (0, 1))
                columns = [_signed(hashes[at]), k1, k2, pa.array(at.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["anchor", "k1", "k2", "at"])

    return texts.select(*_keys("text"), "text").mapInArrow(retain, "anchor bigint, k1 bigint, k2 bigint, at int")


def extended(texts: DataFrame, passage: int) -> DataFrame:
    """``h1, h2, k1, k2, at``: every run of ``passage`` words around one of a text's ``marks``, by its hashes."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                k1, k2, text, shared = (column[row].as_py() for column in batch.columns)
                words = word_hashes(text, known)
                marks, _ = anchors(words, passage)
                at = np.flatnonzero(np.isin(marks, shared))
                columns = [_signed(run_hashes(words, passage, base)[at]) for base in BASES]
                columns += [pa.array(np.full(len(at), k, np.int64)) for k in (k1, k2)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(at.astype(np.int32))], names=["h1", "h2", "k1", "k2", "at"]
                )

    return texts.select("k1", "k2", "text", "marks").mapInArrow(
        extend, "h1 bigint, h2 bigint, k1 bigint, k2 bigint, at int"
    )


def _copies(rows: DataFrame) -> DataFrame:
    """``k1, k2, least, copies``: every text with its least id."""
    keyed = rows.where("text IS NOT NULL").select("id", *_keys("text"))
    return stored(keyed.groupBy("k1", "k2").agg(F.min("id").alias("least"), F.count("*").alias("copies")), "copies")


def repeated_runs(rows: DataFrame, copies: DataFrame, passage: int, inside: bool = False) -> tuple[DataFrame, DataFrame]:
    """``h1, h2, k1, k2, at`` of runs, and ``h1, h2`` of those found in different texts or, if ``inside``, places."""
    suffixes = stored(sparse_suffixes(rows.where("text IS NOT NULL"), passage), "suffixes")
    # Stored, so that the joins begin with plain shuffles of both sides, which Spark can split where skewed.
    shared = suffixes.groupBy("anchor").agg(_different(inside).alias("different")).where("different").select("anchor")
    shared = stored(shared, "shared")
    marks = suffixes.join(shared, "anchor", "left_semi").groupBy("k1", "k2").agg(F.collect_set("at").alias("marks"))

    # One row of each text is enough, and rows with other ids need not go where it goes.
    one = marks.join(copies, ["k1", "k2"]).select("k1", "k2", "least", "marks")
    sources = rows.select(F.col("id"), *_keys("text"), "text").alias("d")
    same = (F.col("d.k1") == F.col("o.k1")) & (F.col("d.k2") == F.col("o.k2"))
    chosen = sources.join(one.alias("o"), same & F.col("d.id").eqNullSafe(F.col("o.least"))).select(
        "d.k1", "d.k2", "d.text", "o.marks"
    )
    runs = stored(extended(chosen, passage), "runs")
    again = runs.groupBy("h1", "h2").agg(_different(inside).alias("different")).where("different").select("h1", "h2")
    return runs, stored(again, "again")


def without_words(text: str, spans: list[dict]) -> str:
    """``text`` without the words of ``spans`` (in order, by start) and the white space after them, or at the end before."""
    words = [match.span() for match in WORD.finditer(text)]
    parts, at, done = [], 0, 0
    for span in spans:
        start, end = max(span["start"], done), span["end"]
        if start >= end:
            continue
        parts.append(text[at : words[start][0]])
        at, done = words[end][0] if end < len(words) else len(text), end
    if done and done == len(words):
        return "".join(parts).rstrip(" \t\n\x0b\x0c\r")
    return "".join([*parts, text[at:]])


def without_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", passage: int = 50
) -> DataFrame:
    """``docs`` with each run of ``passage`` words only where it comes first; rows and other columns stay.

    First is the occurrence in the row with the least id (NULL first; of repeated rows, one), and there at the least
    position. Every later occurrence, in other rows or the same one, is cut, but not where it overlaps the first occurrence.
    So every cut word has an equal one that stays, in an earlier copy. Of rows with equal texts of ``passage`` words or more the first
    stays and the others become empty. Words left next to each other by a cut are not compared again.
    """
    let_workers_import(docs.sparkSession)
    whole = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("d")
    numbered = stored(docs.select(whole, F.monotonically_increasing_id().alias("row")), "numbered")
    text = F.col(f"d.`{text_column}`")
    rows = numbered.select(F.struct(F.col(f"d.`{id_column}`").alias("id"), "row").alias("id"), text.alias("text"))
    copies = _copies(rows)
    runs, again = repeated_runs(rows, copies, passage, inside=True)

    found = runs.join(again, ["h1", "h2"], "left_semi").join(copies.select("k1", "k2", "least"), ["k1", "k2"])
    found = stored(found, "found")
    first = found.groupBy("h1", "h2").agg(F.min(F.struct("least", "k1", "k2", "at")).alias("first"))
    first = stored(first, "first")
    here = (F.col("k1") == F.col("first.k1")) & (F.col("k2") == F.col("first.k2"))
    start = F.when(here, F.greatest("at", F.col("first.at") + passage)).otherwise(F.col("at"))
    later = found.join(first, ["h1", "h2"]).where(~(here & (F.col("at") == F.col("first.at"))))
    span = F.struct(start.alias("start"), (F.col("at") + passage).alias("end"))
    spans = stored(later.groupBy("k1", "k2").agg(F.array_sort(F.collect_set(span)).alias("spans")), "spans")

    n_words = F.coalesce(F.regexp_count(text, F.lit(WORD.pattern)), F.lit(0))
    of_text = stored(copies.join(spans, ["k1", "k2"], "left").where("copies > 1 OR spans IS NOT NULL"), "of-text")
    joined = numbered.select("d", "row", *_keys(text)).join(of_text, ["k1", "k2"], "left")
    everything = F.array(F.struct(F.lit(0).alias("start"), n_words.alias("end")))
    cut = F.when(text.isNull() | (n_words < passage), None).when(F.col("least.row") != F.col("row"), everything)
    cut = cut.otherwise(F.col("spans"))

    def make():
        def work(pairs):
            return pa.array([without_words(p["text"], p["cut"]) if p["cut"] else p["text"] for p in pairs], pa.string())

        return work

    cleaned = text_function(docs.sparkSession, make, "string")(F.struct(text.alias("text"), cut.alias("cut")))
    return joined.select(
        *(cleaned.alias(name) if name == text_column else F.col(f"d.`{name}`").alias(name) for name in docs.columns)
    )


def repeated_passages(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", passage: int = 50
) -> DataFrame:
    """``id, n_words, n_repeated, spans`` of the rows that hold a run of ``passage`` words found in another row.

    Words lie between ASCII white space and count as they are written. ``spans`` are the repeated words as ``start:end``
    (counted from 0, end exclusive), overlapping and touching runs joined, in order and separated by commas;
    ``n_repeated`` is how many words they hold. A run that only comes twice in one row is not listed; ``without_repeats`` cuts it. In a row whose
    text another row has as well, all words are, if there are ``passage`` of them. NULL, empty and shorter texts give no row;
    repeated rows give one each; other columns are not looked at; an empty table gives an empty result.

    Suffixes are retained where a passage has its least anchor (a run of half as many words), so equal
    passages retain suffixes at the same place. Retained suffixes are brought together by their first words, and those whose
    group holds one text only are dropped. Around the others, each run of ``passage`` words that reaches left and right
    over the suffix' start is compared in the same way. Groups are only ever aggregated and joined, so a
    passage in very many documents is pre-aggregated and its join partition can be split; no pairs are made.
    """
    let_workers_import(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    copies = _copies(rows)
    runs, again = repeated_runs(rows, copies, passage)
    starts = runs.join(again, ["h1", "h2"], "left_semi").groupBy("k1", "k2").agg(F.collect_set("at").alias("starts"))

    of_text = copies.join(starts, ["k1", "k2"], "left").where("copies > 1 OR starts IS NOT NULL")
    found = stored(of_text.select("k1", "k2", "copies", F.array_sort("starts").alias("starts")), "starts")
    n_words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")
    counted = rows.where("text IS NOT NULL").select("id", *_keys("text"), n_words.alias("n_words"))
    joined = counted.join(found, ["k1", "k2"]).where(F.col("n_words") >= passage)
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    merged = F.aggregate(
        "starts",
        none,
        lambda done, at: F.when(
            (F.size(done) > 0) & (at <= F.element_at(done, -1)["end"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), (at + passage).cast("bigint").alias("end"))),
            ),
        ).otherwise(
            F.concat(done, F.array(F.struct(at.cast("bigint").alias("start"), (at + passage).cast("bigint").alias("end"))))
        ),
    )
    all_ = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_words").alias("end")))
    spans = joined.select("id", "n_words", F.when(F.col("copies") > 1, all_).otherwise(merged).alias("s"))
    return spans.select(
        "id",
        "n_words",
        F.aggregate("s", F.lit(0).cast("bigint"), lambda total, span: total + span["end"] - span["start"]).alias("n_repeated"),
        F.array_join(F.transform("s", lambda span: F.concat_ws(":", span["start"].cast("string"), span["end"].cast("string"))), ",").alias("spans"),
    )
