"""Benchmark decontamination with Spark's own functions: no Python runs on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.texts import broadcast_if_light, stored, text_key
from larder.sources.shared import broadcast_if_small

# What lies between words, and what words are made of. Non-ASCII characters all count.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Distinct probe hashes, two short columns each, up to which they are broadcast.
BROADCAST_GRAMS = 2_000_000


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def any_case(text: Column) -> Column:
    """``text`` with the case of all letters folded, each letter without regard to those around it.

    ``lower`` turns a capital sigma into one of two letters, by what follows it, also beyond the word.
    """
    return F.replace(F.lower(text), F.lit("\u03c2"), F.lit("\u03c3"))


def words(text: Column | str) -> Column:
    """The words of a text as an array, in their own case; of NULL an empty one."""
    column = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.filter(F.split(column, BETWEEN), lambda word: word != "")


def word_count(text: Column | str) -> Column:
    return F.size(words(text)).cast("bigint")


def gram_shape(window: int) -> tuple[int, int]:
    """``(size, step)`` such that every run of ``window`` words holds exactly one gram of ``size``
    words that starts at a multiple of ``step``."""
    size = window // 2 + 1
    return size, window - size + 1


def benchmark_windows(
    benchmark: DataFrame, item_column: str = "item_id", text_column: str = "text", window: int = 13
) -> DataFrame:
    """``n, words, item``: each run of ``window`` words of an item, or all words of a shorter one.

    ``words`` is the run in A-Z lower case, joined by blanks, and ``n`` its length. NULL texts and texts
    without words give no row, NULL items with words an item without a name; repeated rows give one.
    """
    split = benchmark.select(
        F.col(item_column).cast("string").alias("item"), words(ascii_lower(F.col(text_column))).alias("all")
    ).where(F.size("all") > 0)
    n = F.least(F.size("all"), F.lit(window))
    runs = F.transform(
        F.sequence(F.lit(1), F.size("all") - n + 1), lambda at: F.array_join(F.slice("all", at, n), " ")
    )
    return split.select(n.alias("n"), "item", F.explode(runs).alias("words")).distinct()


def window_hits(
    docs: DataFrame,
    windows: DataFrame,
    text_column: str = "text",
    broadcast_grams: int = BROADCAST_GRAMS,
) -> DataFrame:
    """``key, n, at, words``: every run of words of a text that is a benchmark window.

    ``key`` is the key of the text, so rows with equal texts share their hits; ``at`` counts words from 1.

    Scanning: the texts are probed only at each ``step``-th word with the hash of the next ``size`` words
    (``gram_shape``); any occurrence of a window holds one such gram. The distinct hashes of all grams of the benchmark are
    broadcast after counting them, or joined by a shuffle beyond ``broadcast_grams``. Here case is folded for
    all letters, which finds a superset. A probe carries the key of its text and not the text, so the work grows with the
    length of a text and no faster. Verifying: the starts that the hits of a text allow are gathered and joined
    back to the text; each gives a run of words, in A-Z lower case, and those have to equal a window as text.
    """
    lengths = sorted(row.n for row in windows.select("n").distinct().collect())  # at most `window` of them
    if not lengths:
        return docs.sparkSession.createDataFrame([], "key binary, n int, at int, words string")

    def hashed(array: Column | str, at: Column, size: int, n: int) -> Column:
        gram = F.xxhash64(F.slice(array, at, size))
        return F.struct(F.lit(n).alias("n"), at.alias("at"), gram.alias("gram"), F.size(array).alias("n_all"))

    def grams(array: str, n: int, step: int) -> Column:
        size, _ = gram_shape(n)
        last = F.size(array) - size + 1
        starts = F.when(last >= 1, F.sequence(F.lit(1), last, F.lit(step))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda at: hashed(array, at, size, n))

    split = windows.select("n", F.split(any_case(F.col("words")), " ").alias("all"))
    of_windows = [
        split.where(F.col("n") == n).select(F.inline(grams("all", n, 1))).select("n", "gram") for n in lengths
    ]
    known = of_windows[0]
    for more in of_windows[1:]:
        known = known.union(more)
    known = broadcast_if_small(known.distinct(), broadcast_grams)

    texts = docs.select(text_key(text_column).alias("key"), F.col(text_column).alias("text"))
    folded = texts.select("key", words(any_case(F.col("text"))).alias("all"))
    # Each probe says how many words its text has, so that the words themselves do not go along with it.
    probes = folded.select("key", F.inline(F.concat(*(grams("all", n, gram_shape(n)[1]) for n in lengths))))
    step = F.lit(None).cast("int")
    for n in lengths:
        step = F.when(F.col("n") == n, F.lit(gram_shape(n)[1])).otherwise(step)
    first = F.greatest(F.col("at") - step + 1, F.lit(1))
    last = F.least(F.col("at"), F.col("n_all") - F.col("n") + 1)
    found = probes.join(known, ["n", "gram"], "left_semi").select("key", "n", first.alias("first"), last.alias("last"))
    starts = found.where("first <= last").groupBy("key").agg(F.collect_set(F.struct("n", "first", "last")).alias("starts"))
    # Each text with a hit is split once, in its own case, which leaves the words in the same places.
    asked = broadcast_if_light(starts)
    raw = texts.join(asked, "key").select("key", "starts", words("text").alias("all"))
    runs = F.transform(
        "starts",
        lambda start: F.transform(
            F.sequence(start["first"], start["last"]),
            lambda at: F.struct(
                start["n"].alias("n"), at.alias("at"), ascii_lower(F.array_join(F.slice("all", at, start["n"]), " ")).alias("words")
            ),
        ),
    )
    opened = raw.select("key", F.inline(F.flatten(runs)))
    real = windows.select("n", "words").distinct()
    return opened.join(real, ["n", "words"], "left_semi").select("key", "n", "at", "words").distinct()


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    window: int = 13,
    least_share: int = 20,
    broadcast_grams: int = BROADCAST_GRAMS,
) -> DataFrame:
    """``id, n_words, n_hit, n_items, items_sha256, contaminated`` of every row of ``docs``.

    A word inside any occurrence of a benchmark window is hit; a row is contaminated if any word is hit
    and hit words times ``least_share`` are at least all words. ``items_sha256`` is over the item ids
    with occurring windows, sorted as text and joined by commas (NULL ids left out). NULL and wordless texts
    have no hits, as has everything beside an empty benchmark. Equal texts get equal results, repeated rows stay,
    other columns are not looked at.
    """
    findings = _findings(docs, benchmark, text_column, item_column, window, broadcast_grams)
    counted = docs.select(
        F.col(id_column).alias("id"), word_count(text_column).alias("n_words"), text_key(text_column).alias("key")
    )
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return counted.join(findings, "key", "left").select(
        "id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * least_share >= F.col("n_words"))).alias("contaminated"),
    )


def _findings(docs, benchmark, text_column, item_column, window, broadcast_grams) -> DataFrame:
    """``key, n_hit, n_items, items_sha256, spans`` of every text with a hit."""
    windows = stored(benchmark_windows(benchmark, item_column, text_column, window), "windows")
    hits = stored(window_hits(docs, windows, text_column, broadcast_grams), "hits")
    # Runs of words that overlap or touch, joined: a run after the end of all before it begins a span. A text's runs are no
    # more than its words.
    in_text = Window.partitionBy("key").orderBy("at", "end").rowsBetween(Window.unboundedPreceding, -1)
    runs = hits.select("key", "at", (F.col("at") + F.col("n")).alias("end"))
    begins = runs.select("*", (F.col("at") <= F.max("end").over(in_text)).alias("goes_on"))
    begins = begins.select("key", "at", "end", F.when(F.col("goes_on"), 0).otherwise(1).alias("begins"))
    up_to_here = Window.partitionBy("key").orderBy("at", "end").rowsBetween(Window.unboundedPreceding, 0)
    numbered = begins.select("key", "at", "end", F.sum("begins").over(up_to_here).alias("span"))
    joined = numbered.groupBy("key", "span").agg(F.min("at").alias("at"), F.max("end").alias("end"))
    spans = joined.groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("at", "end"))).alias("spans"),
        F.sum((F.col("end") - F.col("at")).cast("bigint")).alias("n_hit"),
    )
    items = hits.join(windows, ["n", "words"]).select("key", "item").distinct().where("item IS NOT NULL")
    named = items.groupBy("key").agg(
        F.count("*").alias("n_items"), F.sha2(F.array_join(F.array_sort(F.collect_list("item")), ","), 256).alias("items_sha256")
    )
    # Stored, so that the join with the documents has no aggregate beside it and a frequent key can be split.
    return stored(spans.join(named, "key", "left"), "findings")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    window: int = 13,
    least_share: int = 20,
    remove: str = "documents",
    broadcast_grams: int = BROADCAST_GRAMS,
) -> DataFrame:
    """``docs`` without contaminated rows, or with ``remove="spans"`` all rows without their hit words.

    Removing spans joins the words before and after by a blank and leaves the rest of the text as it is,
    from the end of one word to the next; texts without hits, NULL included, stay untouched.
    Columns come back as they are. Repeated rows stay or go together; an empty table gives an empty one, and an empty
    benchmark changes nothing.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    findings = _findings(docs, benchmark, text_column, item_column, window, broadcast_grams).select(
        F.struct("key", "n_hit", "spans").alias("f")
    )
    source = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("d"))
    joined = source.join(findings, text_key(F.col("d")[text_column]) == F.col("f.key"), "left")
    if remove == "documents":
        kept = F.col("f.n_hit").isNull() | (F.col("f.n_hit") * least_share < word_count(F.col("d")[text_column]))
        return joined.where(kept).select("d.*")
    text = F.col("d")[text_column]
    # Pieces of text, each a word with what follows it; the first holds only what comes before all words.
    pieces = F.split(text, rf"(?<=^|{BETWEEN[:-1]})(?=[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])")
    led = F.when(text.rlike(rf"^{WORD}"), F.concat(F.array(F.lit("")), pieces)).otherwise(pieces)
    # What lies between the spans, from the end of one to the start of the next.
    spans = F.col("f.spans")
    kept = F.transform(
        F.sequence(F.lit(0), F.size(spans)),
        lambda i: F.slice(
            F.col("led"),
            F.coalesce(F.get(spans, i - 1)["end"], F.lit(0)) + 1,
            F.coalesce(F.get(spans, i)["at"], F.size("led")) - F.coalesce(F.get(spans, i - 1)["end"], F.lit(0)),
        ),
    )
    cleaned = F.array_join(F.flatten(kept), "")
    changed = F.when(F.col("f.key").isNull(), text).otherwise(cleaned)
    split = joined.select("d", "f", F.when(F.col("f.key").isNotNull(), led).alias("led"))
    return split.withColumn("d", F.col("d").withField(f"`{text_column}`", changed)).select("d.*")
