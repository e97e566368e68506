"""SimHash near-duplicates: fingerprints, links between close ones, groups, and deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.components import connected_components
from larder.llm.texts import folded_words, fresh, stored, text_function, text_key

BITS = 64
SEED = 42
# Hashes whose bits are counted at once; bounds memory for very long texts, changes no result.
AT_ONCE = 1 << 16


def fingerprint_of(text: str | None, shingle_words: int = 4) -> int:
    """A bit is 1 if it is set in over half of the shingle hashes. No words: 0."""
    words = folded_words(text)
    if not words:
        return 0
    last = max(1, len(words) - shingle_words + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for start in range(0, last, AT_ONCE):
        part = words[start : min(start + AT_ONCE, last) + shingle_words - 1]
        shingles = (
            [b" ".join(part)]
            if len(part) < shingle_words
            else map(b" ".join, zip(*(part[i:] for i in range(shingle_words)), strict=False))
        )
        hashes = np.array([digest(shingle, SEED) for shingle in shingles], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > last, bitorder="little")
    return int(majority.view("<i8")[0])


def signatures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle_words: int = 4):
    """``id, fingerprint`` (a signed bigint) of every row; NULL and wordless texts have fingerprint 0."""

    def make():
        return lambda texts: pa.array([fingerprint_of(text, shingle_words) for text in texts], pa.int64())

    fingerprint = text_function(docs.sparkSession, make, "bigint")
    return docs.select(F.col(id_column).alias("id"), fingerprint(text_column).alias("fingerprint"))


def block_masks(blocks: int) -> list[int]:
    """Masks that cut the fingerprint into ``blocks`` parts of nearly equal width."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    return [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:], strict=False)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def close_pairs(distinct: DataFrame, max_bits: int = 4, blocks: int = 7) -> DataFrame:
    """``a, b`` (a < b): pairs of distinct fingerprints that differ in at most ``max_bits`` bits.

    Pigeonhole: of ``blocks`` parts at least ``blocks - max_bits`` agree, so a pair meets under the
    key of some choice of that many parts; it is kept under its first agreeing parts only, so it
    comes out once. More blocks give longer keys, hence fewer chance meetings, and more rows to
    shuffle; any number above ``max_bits`` gives the same pairs. Meetings under one key are compared
    inside the join and only verified pairs leave it; Spark can split the partition of a frequent key.
    """
    agreeing = blocks - max_bits
    if agreeing < 1:
        raise ValueError("more blocks than differing bits are needed")
    masks = block_masks(blocks)
    choices = []
    for chosen in combinations(range(blocks), agreeing):
        mask = _signed(sum(masks[i] for i in chosen))
        part = F.col("fingerprint").bitwiseAND(F.lit(mask).cast("bigint"))
        choices.append(F.struct(F.lit(sum(1 << i for i in chosen)).alias("choice"), part.alias("part")))
    # Dealt out again first, as few and narrow rows come in few partitions and each becomes one row for every choice.
    partitions = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = distinct.repartition(partitions, "fingerprint").select("fingerprint", F.inline(F.array(*choices)))
    # Spark takes the rows of all choices for no more than the fingerprints; it must not broadcast them.
    left, right = keyed.alias("l"), keyed.hint("merge").alias("r")
    a, b = F.col("l.fingerprint"), F.col("r.fingerprint")
    difference = a.bitwiseXOR(b)
    return left.join(
        right,
        (F.col("l.choice") == F.col("r.choice"))
        & (F.col("l.part") == F.col("r.part"))
        & (a < b)
        & (F.bit_count(difference) <= max_bits)
        & (F.col("l.choice") == _first_agreeing(difference, masks, agreeing)),
    ).select(a.alias("a"), b.alias("b"))


def _first_agreeing(difference: Column, masks: Sequence[int], count: int) -> Column:
    """The lowest ``count`` blocks in which nothing differs, as a bit set."""
    agree = F.lit(0)
    for i, mask in enumerate(masks):
        same = difference.bitwiseAND(F.lit(_signed(mask)).cast("bigint")) == 0
        agree = agree + F.when(same, 1 << i).otherwise(0)
    rest = agree
    for _ in range(count):
        rest = rest.bitwiseAND(rest - 1)
    return agree - rest


def fingerprint_groups(distinct: DataFrame, max_bits: int = 4, blocks: int = 7) -> DataFrame:
    """``fingerprint, root`` for fingerprints linked to another one; others are groups of their own."""
    groups = connected_components(close_pairs(distinct, max_bits, blocks))
    alone = groups.select(F.col("root").alias("fingerprint"), "root").distinct()
    return groups.select(F.col("node").alias("fingerprint"), "root").union(alone)


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", max_bits: int = 4, blocks: int = 7
) -> DataFrame:
    """``id, fingerprint, component_id`` of every row of ``docs``.

    Rows with equal fingerprints form one class before any comparison, so copies cost nothing
    more, however many there are. ``component_id`` is the least non-NULL id that can be reached by
    links of at most ``max_bits`` differing bits; NULL only if no id of the component is known. NULL and
    empty texts have fingerprint 0 and are linked like others. Repeated rows stay as they are;
    other columns are not looked at. An empty table gives an empty result.
    """
    signed = stored(signatures(docs, id_column, text_column), "signatures")
    classes = signed.groupBy("fingerprint").agg(F.min("id").alias("least"))
    groups = fingerprint_groups(classes.select("fingerprint"), max_bits, blocks)
    rooted = classes.join(groups, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    least = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    of_class = rooted.join(least, "root").select("fingerprint", "component_id")
    return signed.join(of_class, "fingerprint").select("id", "fingerprint", "component_id")


def deduplicate(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", max_bits: int = 4, blocks: int = 7
) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the least id; of rows that share it, one.

    NULL ids come last. Which of several rows with the same id stays is decided by the key of
    the text; between rows equal in both, any one stays. Columns come back as they are.
    """
    id_, key, print_ = fresh(docs, "id", "key", "fingerprint")
    signed = signatures(
        docs.select(F.struct(F.col(id_column).alias("id"), text_key(text_column).alias("key")).alias(id_), text_column),
        id_, text_column,
    )
    signed = stored(signed.select("id.id", "id.key", "fingerprint"), "signatures")
    order = F.struct(F.col("id").isNull().alias("missing"), "id", "key")
    classes = signed.groupBy("fingerprint").agg(F.min(order).alias("first"))
    groups = fingerprint_groups(classes.select("fingerprint"), max_bits, blocks)
    rooted = classes.join(groups, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    first = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.id", "first.key")
    seen = signed.groupBy("id", "key").agg(F.count("*").alias("rows"))
    keep = first.alias("f").join(
        seen.alias("s"), F.col("f.id").eqNullSafe(F.col("s.id")) & (F.col("f.key") == F.col("s.key"))
    )
    keep = stored(keep.select(F.col("f.id").alias(id_), F.col("f.key").alias(key), F.col("rows").alias(print_)), "keep")
    kept = docs.alias("d").join(
        keep.alias("k"),
        F.col(f"d.{id_column}").eqNullSafe(F.col(f"k.{id_}")) & (text_key(f"d.{text_column}") == F.col(f"k.{key}")),
    )
    columns = [F.col(f"d.`{name}`") for name in docs.columns]
    # Only rows repeated in id and text need bringing together, and most tables have none.
    if keep.where(F.col(print_) > 1).isEmpty():
        return kept.select(*columns)
    once = kept.where(F.col(f"k.{print_}") == 1).select(*columns)
    repeated = kept.where(F.col(f"k.{print_}") > 1).select(*columns, F.col(f"k.{key}").alias(key))
    return once.union(repeated.dropDuplicates([id_column, key]).select(*docs.columns))
