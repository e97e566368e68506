"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.texts import fresh, stored
from larder.sources.shared import broadcast_if_small

WORD = r"[^\x20\x09-\x0D]+"
# Partition and place within it, as ``monotonically_increasing_id`` packs them.
PLACE_BITS = 33


def _whole(number: int | Column) -> Column:
    return (F.lit(number) if isinstance(number, int) else number).cast("decimal(38,0)")


def _div(top: Column, bottom: Column) -> Column:
    return F.call_function("div", top, bottom)


def placed(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` in global order, stored, with ``part`` and ``at``: its range partition and the place in it, from 0."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    number = F.monotonically_increasing_id()
    numbered = rows.withColumn("_n", number)
    return stored(
        numbered.select(
            *df.columns,
            F.shiftright("_n", PLACE_BITS).cast("int").alias("part"),
            F.col("_n").bitwiseAND((1 << PLACE_BITS) - 1).alias("at"),
        ),
        name,
    )


def source_targets(sizes: DataFrame, weights: Sequence[int], share: Fraction, most: int) -> DataFrame:
    """``no_source, source, total, place, top, bottom, target`` of every source of ``sizes``.

    The sources in code-point order, NULL last, take the weights in turn and share ``share`` of all sizes by them; a target
    stops at ``most`` times its source and what is over goes to the others by their weights, until no target is above.
    ``top / bottom`` is how often a row of the source is expected. Only sums over all sources come to the driver: a
    round adds up the sources that stop, and the rounds end once no more do.
    """
    totals = sizes.groupBy("no_source", "source").agg(F.sum("size").alias("total"))
    rows = placed(totals, [F.col("no_source"), F.col("source")], "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    bases = rows.groupBy("part").agg(F.count("*").alias("rows")).select(
        F.col("part").alias("of_part"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base")
    )
    place = F.col("base") + F.col("at")
    turn = F.array(*(F.lit(w) for w in weights))
    weighed = rows.join(F.broadcast(bases), F.col("part") == F.col("of_part")).select(
        "no_source", "source", "total", place.alias("place"),
        F.element_at(turn, (place % len(weights) + 1).cast("int")).alias("weight"),
    )
    weighed = stored(weighed, "weights")

    def stops(num: int, den: int) -> Column:
        """Whether the target ``weight * num / (share's denominator * den)`` is at or above the most."""
        return _whole(F.col("weight")) * _whole(num) >= _whole(most * share.denominator) * F.col("total") * _whole(den)

    stopped, num, den = -1, 0, 1
    while True:
        full = F.lit(False) if stopped < 0 else stops(num, den)
        row = weighed.agg(
            F.count_if(full), F.sum("total"), F.sum(F.when(full, F.col("total"))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        n, everything, over, weight = row[0], row[1] or 0, row[2] or 0, row[3] or 0
        if n == stopped or not weight:
            break
        stopped = n
        num, den = share.numerator * everything - most * share.denominator * over, weight
    full = F.lit(True) if not weight else stops(num, den)
    empty = F.col("total") == 0
    top = F.when(empty, 0).when(full, _whole(most)).otherwise(_whole(F.col("weight")) * _whole(num))
    bottom = F.when(empty | full, 1).otherwise(_whole(share.denominator * den) * F.col("total"))
    own = F.col("weight").cast("double") * F.lit(float(num)) / F.lit(float(share.denominator * den))
    return weighed.select(
        "no_source", "source", "total",
        top.cast("decimal(38,0)").alias("top"),
        bottom.cast("decimal(38,0)").alias("bottom"),
        F.when(full, (F.col("total") * most).cast("double")).otherwise(own).alias("target"),
    )


def copies(
    rows: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: Fraction = Fraction(3, 2),
    most: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """``row, id, size, source_size, target, copies`` for stored rows ``row, id, source, size``.

    Within a source, rows are ordered by size, then id. Each row's expected copies are added to those of
    the rows before it and to one offset of the source, taken from the hash of ``seed`` and its name, and the row comes
    once for each whole number that the sum passes; all in whole numbers of up to 38 digits. In order of size the words
    taken stay within about the largest row of the target, where sizes at random places would not.

    A range sort puts a source's rows into as many tasks as it needs; what comes before each partition of it is added
    up over one row per partition.
    """
    sizes = rows.select(
        "row", "id", "size", F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("source")
    )
    targets = source_targets(sizes, weights, share, most)
    order = [F.col("no_source"), F.col("source"), F.desc("size"), F.col("id"), F.col("row")]
    numbered = placed(sizes, order, "in-order")
    before = Window.partitionBy("no_source", "source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        numbered.groupBy("no_source", "source", "part")
        .agg(F.count("*").alias("n"), F.min("at").alias("first"))
        .select("*", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("base"))
        .join(targets, ["no_source", "source"])
    )
    # 16 hex digits of a hash as a share of the source's whole turn.
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("no_source").cast("int").cast("string"), "source")), 1, 8), 16, 10)
    offset = _div(_whole(drawn) * F.col("bottom"), _whole(1 << 32))
    starts = starts.select(
        F.struct("no_source", "source", "part").alias("key"), "base", "total", "target", "top", "bottom", _whole(offset).alias("offset")
    )
    known = broadcast_if_small(starts)
    place = _whole(F.col("base") + F.col("at"))
    joined = numbered.join(known, F.struct("no_source", "source", "part") == F.col("key"))

    def passed(n: Column) -> Column:
        return _div(n * F.col("top") + F.col("offset"), F.col("bottom"))

    return joined.select(
        "row", "id", "size", F.col("total").alias("source_size"), "target",
        (passed(place + 1) - passed(place)).alias("copies"),
    )


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def mixture(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[int] = (3, 1, 2),
    share: Fraction = Fraction(3, 2),
    most: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """``id, size, source_size, target, copies, taken`` of every row: how often the mix takes it.

    ``size`` counts words between ASCII white space, 0 for NULL. A NULL source is a source of its own, after all
    others, and another one than ``''``. Texts without words, NULL ids and repeated rows are rows like any other; sources
    without words have target 0 and no copies. The same rows give the same result again. An empty table gives
    no rows; other columns are not looked at.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).alias("id"),
        F.col(source_column).cast("string").alias("source"),
        word_count(text_column).alias("size"),
    )
    found = copies(stored(rows, "sizes"), weights, share, most, seed)
    return found.select("id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[int] = (3, 1, 2),
    share: Fraction = Fraction(3, 2),
    most: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """The mix itself: the rows of ``docs``, all columns, each as often as ``mixture`` takes it (maybe not at all)."""
    row, n = fresh(docs, "row", "copies")
    whole = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    rows = whole.select(
        F.col(row).alias("row"), F.col(id_column).alias("id"), F.col(source_column).cast("string").alias("source"),
        word_count(text_column).alias("size"),
    )
    taken = copies(rows, weights, share, most, seed).where("copies > 0").select(F.col("row").alias(row), F.col("copies").alias(n))
    often = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(n)))
    return whole.join(taken, row).select(*(F.col(f"`{c}`") for c in docs.columns), often.alias(n)).drop(n)
