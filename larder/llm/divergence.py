"""Source divergence audit: how far the words of each source are from those of the others of its language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.texts import let_workers_import, stored
from larder.sources.shared import broadcast_if_small

# What lies between terms once A-Z are lower-cased, and the scale of the shares.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000

# Bytes of text that are split at a time (a longer text goes alone), and counted rows a task holds before it passes them on.
TEXT_BYTES = 8 << 20
HELD_ROWS = 1_000_000
# Counts in a shard of a language (or the square of its sources, if that is more: what a shard gives out), sources
# compared with all others in one task, and cells of a block of shares.
SHARD_ROWS = 20_000
TILE_SOURCES = 256
BLOCK_CELLS = 1 << 20

COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def _batch_counts(langs: pa.Array, sources: pa.Array, texts: pa.Array) -> pa.Table:
    """Counts of one batch, and a row with an empty term for each group that gives its documents."""
    numbers: dict[tuple[str, str], int] = {}
    pairs = zip(langs.to_pylist(), sources.to_pylist(), strict=True)
    group_of = pa.array([numbers.setdefault(pair, len(numbers)) for pair in pairs], pa.int32())
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=BETWEEN)
    terms, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
    real = pc.not_equal(terms, "")
    coded = terms.filter(real).dictionary_encode()
    rows = pa.table({"doc": doc.filter(real), "term": coded.indices})
    by_doc = rows.group_by(["doc", "term"], use_threads=False).aggregate([([], "count_all")])
    by_group = pa.table(
        {"group": group_of.take(by_doc["doc"].combine_chunks()), "term": by_doc["term"], "n": by_doc["count_all"]}
    )
    counted = by_group.group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
    docs = pa.table({"group": group_of}).group_by("group", use_threads=False).aggregate([([], "count_all")])
    group = np.concatenate((counted["group"].to_numpy(), docs["group"].to_numpy()))
    names = list(numbers)
    return pa.table(
        {
            "lang": pa.array([lang for lang, _ in names], pa.string()).take(pa.array(group)),
            "source": pa.array([source for _, source in names], pa.string()).take(pa.array(group)),
            "term": pa.concat_arrays(
                [
                    coded.dictionary.cast(pa.string()).take(counted["term"].combine_chunks()),
                    pa.array([""] * docs.num_rows, pa.string()),
                ]
            ),
            "n": np.concatenate((counted["n_sum"].to_numpy(), np.zeros(docs.num_rows, np.int64))),
            "docs": np.concatenate((counted["count_all"].to_numpy(), docs["count_all"].to_numpy())),
        }
    )


def _merged(tables: list[pa.Table]) -> pa.Table:
    grouped = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False)
    summed = grouped.aggregate([("n", "sum"), ("docs", "sum")])
    return summed.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(["lang", "source", "term", "n", "docs"])


def _runs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Where runs of about ``TEXT_BYTES`` bytes begin and how many texts they hold."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    start = held = 0
    for at, size in enumerate(sizes.tolist()):
        if at > start and held + size > TEXT_BYTES:
            yield start, at - start
            start, held = at, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes) - start


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        for start, n in _runs(batch.column(2)):
            piece = batch.slice(start, n)
            held.append(_batch_counts(*piece.columns))
            rows += held[-1].num_rows
            if rows > HELD_ROWS:
                merged = _merged(held)
                held, rows = [merged], merged.num_rows
                if 2 * rows > HELD_ROWS:
                    yield from merged.to_batches(max_chunksize=10_000)
                    held, rows = [], 0
    if held:
        yield from _merged(held).to_batches(max_chunksize=10_000)


def term_counts(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", source_column: str = "source"
) -> DataFrame:
    """``lang, source, term, n, docs``: how often a group holds a term, and in how many of its rows.

    Each group also has a row with an empty term whose ``docs`` are all its rows. Each task splits, encodes and
    counts its texts with Arrow's functions and passes on its counts, at most a few hundred thousand at a time; those are
    added up by key, so that a hot source or a frequent term is one row per task. NULL text, lang or source is ``''``.
    """
    let_workers_import(docs.sparkSession)
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_column, "lang"), (source_column, "source"), (text_column, "text"))]
    partial = docs.select(*columns).mapInArrow(_partial_counts, COUNTS)
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, total: Column, kept: Column) -> Column:
    """The smoothed share of a term in billionths, rounded down, plus one."""
    top = (n.cast("decimal(38,0)") + 2) * F.lit(SCALE).cast("decimal(38,0)")
    bottom = (total + 2 * kept).cast("decimal(38,0)")
    return F.lit(1).cast("bigint") + F.call_function("div", top, bottom)


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def shares(n: np.ndarray, bottom: np.ndarray) -> np.ndarray:
    """``_share`` of counts: long division by three digits at a time, exact for texts of up to 9e15 terms."""
    rest, out = n + 2, np.zeros(np.broadcast_shapes(n.shape, bottom.shape), np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // bottom
        rest = rest % bottom
    return out + 1


def _pair_sums(key, terms: pa.Table, groups: pa.Table) -> pa.Table:
    """Sums over one shard of terms of the distances between the sources of one tile and all others."""
    order = np.argsort(groups["place"].to_numpy())
    names = groups["source"].combine_chunks().take(pa.array(order))
    n_sources = len(names)
    first = int(key[2].as_py()) * TILE_SOURCES
    tile = np.arange(first, min(first + TILE_SOURCES, n_sources))
    sums = np.zeros((len(tile), n_sources), np.int64)
    if terms.num_rows:
        bottom = groups["total"].to_numpy()[order] + 2 * groups["kept"].to_numpy()[order]
        none = shares(np.zeros(n_sources, np.int64), bottom)
        coded = terms["term"].combine_chunks().dictionary_encode()
        term = coded.indices.to_numpy()
        place = terms["place"].to_numpy()
        share = shares(terms["n"].to_numpy(), bottom[place])
        by_term = np.argsort(term, kind="stable")
        term, place, share = term[by_term], place[by_term], share[by_term]
        step = max(1, BLOCK_CELLS // n_sources)
        for start in range(0, len(coded.dictionary), step):
            n_terms = min(step, len(coded.dictionary) - start)
            a, b = np.searchsorted(term, (start, start + n_terms))
            block = np.tile(none, (n_terms, 1))
            block[term[a:b] - start, place[a:b]] = share[a:b]
            for row, source in enumerate(tile.tolist()):
                own = block[:, source : source + 1]
                sums[row] += ((block - own) ** 2 // (block + own)).sum(axis=0)
    row, column = np.nonzero(tile[:, None] != np.arange(n_sources)[None, :])
    return pa.table(
        {
            "lang": pa.array([key[0].as_py()] * len(row), pa.string()),
            "source": names.take(pa.array(tile[row])).cast(pa.string()),
            "item": names.take(pa.array(column)).cast(pa.string()),
            "value": pa.array(sums[row, column], pa.int64()),
        }
    )


def divergences(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
    least_docs: int = 10,
    top_terms: int = 10,
) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every group of rows with one lang and source.

    Terms are runs of ASCII letters and of all characters beyond ASCII, with A-Z lower-cased. A language keeps the terms
    that at least ``least_docs`` of its rows hold. With p and q the smoothed shares of a term in billionths
    (``1 + floor(1e9 * (n + 2) / (N + 2 V))``), a term's distance is ``floor((p - q)**2 / (p + q))``. ``part`` is ``pair``
    (``item`` is another source of the language, ``value`` the sum over all kept terms) or ``term`` (``item`` is a term that the
    group holds more often than its language, ``value`` its distance from the language; the first ``top_terms``).

    NULL texts, langs and sources are ``''``; repeated rows count as documents of their own; a group without terms,
    of empty texts say, still has its pairs, with value 0 if the language keeps no term; a source alone in its language has
    none. An empty table gives no rows. Other columns are not looked at.

    The counts of a language are cut into shards by term and its sources into tiles, so that no task holds more than
    a shard of counts, one row per source and a block of shares, however many terms or sources there are.
    """
    counts = stored(term_counts(docs, text_column, lang_column, source_column), "term-counts")
    real = counts.where("term <> ''")
    kept = real.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    terms = stored(real.select("lang", "source", "term", "n").join(kept.select("lang", "term", "all_n"), ["lang", "term"]), "kept-terms")

    per_group = terms.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("held"))
    # A language's rows here are one for each of its sources.
    of_lang = Window.partitionBy("lang")
    in_lang = terms.groupBy("lang", "term").agg(F.first("all_n").alias("all_n"))
    in_lang = in_lang.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all_n").alias("lang_total"))
    none = F.lit(0).cast("bigint")
    groups = (
        counts.where("term = ''")
        .select("lang", "source")
        .join(per_group, ["lang", "source"], "left")
        .join(in_lang, "lang", "left")
        .select(
            "lang",
            "source",
            *(F.coalesce(name, none).alias(name) for name in ("total", "held", "kept", "lang_total")),
        )
        .select(
            "*",
            (F.row_number().over(of_lang.orderBy("source")) - 1).alias("place"),
            F.count("*").over(of_lang).alias("sources"),
            F.sum("held").over(of_lang).alias("lang_held"),
        )
        .select(
            "*",
            (1 + F.expr(f"lang_held div greatest({SHARD_ROWS}, sources * sources)")).alias("shards"),
            (1 + F.expr(f"(sources - 1) div {TILE_SOURCES}")).alias("tiles"),
        )
    )
    groups = stored(groups, "groups")
    known = broadcast_if_small(groups, stored=True)
    joined = terms.join(known, ["lang", "source"])

    p, q = _share(F.col("n"), F.col("total"), F.col("kept")), _share(F.col("all_n"), F.col("lang_total"), F.col("kept"))
    apart = joined.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    apart = apart.select("lang", "source", F.lit("term").alias("part"), "item", _distance(F.col("p"), F.col("q")).alias("value"))

    tiles = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1))
    shard = F.pmod(F.xxhash64("term"), F.col("shards"))
    of_terms = joined.select("lang", shard.alias("shard"), tiles.alias("tile"), "term", "n", "place")
    names = ("lang", "source", "place", "total", "kept", "shards")
    of_groups = groups.select(*(F.col(name).alias(name) for name in names), tiles.alias("tile")).select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1)).alias("shard")
    )
    keys = ("lang", "shard", "tile")
    sums = (
        of_terms.groupBy(*keys)
        .cogroup(of_groups.groupBy(*keys))
        .applyInArrow(_pair_sums, "lang string, source string, item string, value bigint")
    )
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(best).alias("rank")
    return pairs.select("*", rank).unionByName(apart.select("*", rank).where(F.col("rank") <= top_terms))
