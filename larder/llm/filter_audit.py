"""Filter interaction audit: what each of some filters removes, in every order they could run in."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.texts import let_workers_import, stored, text_function
from larder.sources.shared import broadcast_if_small

# The filters in the order of their bits: too few words, too few different ones, capitals, symbols, repeats of a text.
FILTERS = "ABCDE"
REPEATS = "E"
# The characters and limits of the filters' contract.
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
SYMBOLS = b"#$%&*|"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LEAST_WORDS, LEAST_DIFFERENT, MOST_CAPITALS = 50, 65, 5
LONG_TEXT = 1 << 20

# Counters of the sketch: one per text under each of three hashes, at most this many under each, in blocks.
HASHES = 3
LEAST_CELLS, MOST_CELLS = 1 << 18, 1 << 26
BLOCK = 1 << 18


def failures(raw: bytes, length: int) -> int:
    """A bit for each of the first four filters that a text of ``length`` code points fails."""
    if len(raw) > LONG_TEXT:  # the words of a long text are not held together
        n, different = 0, set()
        for match in WORD.finditer(raw):
            n += 1
            different.add(match[0])
    else:
        words = raw.split()
        n, different = len(words), set(words)
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    failed = (n < LEAST_WORDS, 100 * len(different) < LEAST_DIFFERENT * n, 100 * capitals > MOST_CAPITALS * length, symbols > 0)
    return sum(1 << bit for bit, fails in enumerate(failed) if fails)


def text_flags(docs: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    """``id, source, mask, digest``: the first four filters' bits, and the SHA-256 digest of the whole text."""
    fields = [pa.field("mask", pa.int32()), pa.field("digest", pa.binary())]

    def work(texts):
        masks, digests = [], []
        for text in texts:
            raw = (text or "").encode()
            masks.append(failures(raw, len(text or "")))
            digests.append(hashlib.sha256(raw).digest())
        return pa.StructArray.from_arrays([pa.array(masks, pa.int32()), pa.array(digests, pa.binary())], fields=fields)

    flags = text_function(docs.sparkSession, lambda: work, "struct<mask:int,digest:binary>")(text_column)
    return docs.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.col(source_column).cast("string"), F.lit("")).alias("source"),
        flags.alias("f"),
    ).select("id", "source", "f.*")


def cells(digests: list[bytes], size: int) -> np.ndarray:
    """The counters of each text: one in each of ``HASHES`` ranges of ``size``."""
    words = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 4)[:, :HASHES]
    return (words & np.uint64(size - 1)).astype(np.int64) + np.arange(HASHES) * size


class Sketch:
    """Counting Bloom filter whose counters say none, once, or more: a bit for ``once`` and a bit for ``more``."""

    def __init__(self, size: int):
        self.once, self.more = np.zeros(size // 8, np.uint8), np.zeros(size // 8, np.uint8)

    def add(self, at: np.ndarray) -> None:
        at, n = np.unique(at, return_counts=True)
        bit = np.left_shift(1, at & 7).astype(np.uint8)
        again = (n > 1) | (self.once[at >> 3] & bit > 0)
        np.bitwise_or.at(self.more, at[again] >> 3, bit[again])
        np.bitwise_or.at(self.once, at >> 3, bit)


def _sketch_blocks(size: int):
    """For ``mapInArrow``: the filled blocks of the sketch of a task's texts."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, any_rows = Sketch(HASHES * size), False
        for batch in batches:
            if batch.num_rows:
                any_rows = True
                sketch.add(cells(batch.column(0).to_pylist(), size).ravel())
        step = BLOCK // 8
        for block in range(HASHES * size // BLOCK if any_rows else 0):
            once = sketch.once[block * step : (block + 1) * step]
            if once.any():
                more = sketch.more[block * step : (block + 1) * step]
                yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "once": [once.tobytes()], "more": [more.tobytes()]})

    return blocks


def _merged_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For rows in order of ``block``: each block's counters added up, two blocks in memory."""
    open_block, once, more = None, None, None

    def close() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"block": pa.array([open_block], pa.int32()), "more": [more.tobytes()]})

    for batch in batches:
        for row in range(batch.num_rows):
            block = batch.column(0)[row].as_py()
            one, two = (np.frombuffer(batch.column(c)[row].as_py(), np.uint8) for c in (1, 2))
            if block != open_block:
                if open_block is not None:
                    yield close()
                open_block, once, more = block, one.copy(), two.copy()
                continue
            more |= two | (once & one)
            once |= one
    if open_block is not None:
        yield close()


def possible_repeats(flags: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """``flags`` with ``again``: false only where no other row has the same digest.

    Every task makes a sketch of its digests, block after block of which are merged; a text that has a counter to
    itself is unique. There are four to eight counters a row under each hash, up to ``most_cells`` (25 MB for all bits
    that are broadcast); beyond that fewer texts are cleared and more go through the exact step.
    """
    spark = flags.sparkSession
    let_workers_import(spark)
    size = max(LEAST_CELLS, min(most_cells, 1 << (4 * flags.count()).bit_length()))
    blocks = flags.select("digest").mapInArrow(_sketch_blocks(size), "block int, once binary, more binary")
    merged = blocks.repartition("block").sortWithinPartitions("block").mapInArrow(_merged_blocks, "block int, more binary")
    plane = np.zeros(HASHES * size // 8, np.uint8)
    for row in merged.collect():
        plane[row.block * BLOCK // 8 : (row.block + 1) * BLOCK // 8] = np.frombuffer(row.more, np.uint8)
    known = spark.sparkContext.broadcast(plane)

    def make():
        def work(digests):
            if not digests:
                return pa.array([], pa.bool_())
            at = cells(digests, size)
            return pa.array((known.value[at >> 3] >> (at & 7) & 1).all(axis=1), pa.bool_())

        return work

    return flags.select("*", text_function(spark, make, "boolean")("digest").alias("again"))


def full_masks(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """``id, source, mask``: a bit for each filter of ``FILTERS`` that a row fails.

    A row repeats if another row with a smaller id has the same text, NULL being an empty one; of rows that share text and
    smallest id none does. Rows without an id neither repeat nor make others do. Texts that the sketch clears are not
    shuffled. Of the others digests meet in an aggregate that gives each text's least id; ids and digests that are least
    are joined back, on a key that is as good as unique, so that a text with very many copies loads no task.
    """
    flags = stored(possible_repeats(stored(text_flags(docs, id_column, text_column, source_column), "flags")), "marked")
    suspects = flags.where("again AND id IS NOT NULL")
    least = suspects.groupBy(F.col("digest").alias("of")).agg(F.min("id").alias("least"))
    met = suspects.join(least, (F.col("id") == F.col("least")) & (F.col("digest") == F.col("of")), "left")
    repeated = F.when(F.col("least").isNull(), 1 << FILTERS.index(REPEATS)).otherwise(0)
    return met.select("id", "source", (F.col("mask") + repeated).alias("mask")).unionByName(
        flags.where("NOT again OR id IS NULL").select("id", "source", "mask")
    )


def mask_counts(masks: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``source, mask, n, good, toxic``: additive counts of rows, and of those with labels quality 1 and toxic 1.

    Of labels that repeat an id any counts; labels without an id, and NULL labels, count for nothing.
    """
    marks = labels.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("label_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"),
    )
    known = broadcast_if_small(marks)
    joined = masks.join(known, F.col("id") == F.col("label_id"), "left")
    zero = F.lit(0).cast("bigint")
    return joined.groupBy("source", "mask").agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum("good"), zero).alias("good"),
        F.coalesce(F.sum("toxic"), zero).alias("toxic"),
    )


def order_steps(spark: SparkSession, filters: str = FILTERS) -> DataFrame:
    """What becomes of a row with each mask at each step of each order; for five filters 19,200 rows."""
    rows = []
    for order in permutations(filters):
        for mask in range(1 << len(filters)):
            failed = {f for bit, f in enumerate(filters) if mask >> bit & 1}
            for step, here in enumerate(order, 1):
                before = not failed.isdisjoint(order[: step - 1])
                rows.append(
                    (
                        "".join(order),
                        step,
                        mask,
                        int(not before and here not in failed),
                        int(not before and here in failed),
                        int(before and here in failed),
                        int(failed == {here}),
                        factorial(len(filters)) // len(failed) if here in failed else 0,
                    )
                )
    return spark.createDataFrame(
        rows, "filter_order string, step int, at_mask int, kept int, removed int, redundant int, alone int, orders int"
    )


def interactions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """The audit from the counts by mask: a row per source, order of the filters and step.

    ``shapley`` is what a filter removes, summed over all orders: of the filters that a row fails, each comes first in an
    equal share of them. The orders are a table of fixed size, so at most 32 counts of a source meet 600 steps.
    """
    steps = F.broadcast(order_steps(counts.sparkSession, filters))
    joined = counts.join(steps, counts["mask"] == steps["at_mask"])

    def total(of: str, when: str):
        return F.sum(F.col(of) * F.col(when))

    return joined.groupBy(F.col("source").alias("part"), "filter_order", "step").agg(
        total("n", "kept").alias("kept"),
        total("n", "removed").alias("removed"),
        total("n", "redundant").alias("redundant"),
        total("n", "alone").alias("unique_fails"),
        total("good", "removed").alias("good_lost"),
        total("toxic", "removed").alias("toxic_lost"),
        total("n", "orders").alias("shapley"),
    )


def audit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``.

    All steps of all orders for every source, zeros included; NULL sources are ``''`` and NULL texts empty. Empty and
    wordless texts fail A alone, unless they repeat. Repeated rows are counted each; without labels nothing good or toxic
    is lost; an empty table gives no rows. Other columns are not looked at.
    """
    return interactions(mask_counts(full_masks(docs, id_column, text_column, source_column), labels, id_column))
