"""The registered queries of the corpus operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import (
    decontaminate,
    divergence,
    filter_audit,
    language,
    mixing,
    packing,
    quality_model,
    quality_rules,
    secrets,
    simhash,
    suffixes,
    token_counts,
    wavelet,
)


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    """Registers a function under its own name."""

    def register(run):
        QUERIES[run.__name__] = Query(run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_simhash(spark, sf_dir):
    """Near-duplicate groups: 4-word shingles, links at 4 or fewer differing bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


WORDS_SQL = r"""list_filter(regexp_split_to_array(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"""


@query(f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL.format(text="text")} AS w FROM documents),
    b AS (SELECT item_id, {WORDS_SQL.format(text="text")} AS w FROM benchmark),
    windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS words FROM
        (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
    runs AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS words FROM
        (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows))),
    hits AS (SELECT r, n, i, item_id FROM runs JOIN windows USING (n, words)),
    hit_words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
    items AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM
        (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
        CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
        coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
    FROM d LEFT JOIN hit_words USING (r) LEFT JOIN items USING (r)""")
def op4_decontaminate(spark, sf_dir):
    """Words of every document that lie in a window of a benchmark item."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


@query()
def op6_token_files(spark, sf_dir):
    """Wavelet matrices of all token ids, written and read back."""
    return wavelet.tokenized(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query()
def op7_packing(spark, sf_dir):
    """The pieces of all documents in sequences of 1024 ids."""
    return piece_digests(packing.packed(table(spark, sf_dir, "documents")))


def piece_digests(pieces):
    return pieces.select(
        F.col("id").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query()
def op9_quality_rules(spark, sf_dir):
    """Base measures of every text and the verdict of the weak supervision."""
    return (
        quality_rules.judge(table(spark, sf_dir, "documents"))
        .withColumnRenamed("id", "doc_id")
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")
    )


@query()
def op10_secrets(spark, sf_dir):
    """All secrets: base patterns and values that are costly to guess."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "value_bits"
    )


def remainder(divisor: int):
    return F.crc32(F.col("doc_id").cast("string")) % divisor


@query()
def op3_language(spark, sf_dir):
    """The language of every text; a quarter of the documents is held out from learning."""
    docs = table(spark, sf_dir, "documents")
    field = language.train(docs, remainder(4) != 2)
    found = language.identify(docs, field).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score")


@query()
def op5_repeated_passages(spark, sf_dir):
    """Passages of 50 or more words that other documents hold as well."""
    return suffixes.repeated_passages(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query()
def op2_quality_model(spark, sf_dir):
    """Calibrated quality of every text; a fifth of the documents is held out from the labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    words = quality_model.word_vectors(docs)
    network = quality_model.train(docs, labels, remainder(5) != 0, words)
    scored = quality_model.score(docs, words, network).withColumnRenamed("id", "doc_id")
    return scored.select(
        "doc_id",
        (remainder(5) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


@query()
def op8_token_counts(spark, sf_dir):
    """Pieces of every text under a unigram vocabulary."""
    return token_counts.token_counts(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query(r"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    found AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    counts AS (SELECT lang, source, term, count(*) AS n FROM found GROUP BY ALL),
    kept AS (SELECT lang, term, count(*) AS n FROM found GROUP BY ALL HAVING count(DISTINCT r) >= 10),
    langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
    groups AS (SELECT DISTINCT lang, source FROM d),
    every AS (SELECT lang, source, term, k.n AS lang_n, coalesce(c.n, 0) AS n
        FROM groups JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
    shares AS (SELECT lang, source, term, n,
        CAST(1 + CAST(1000000000 AS HUGEINT) * (n + 2) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS HUGEINT) AS p,
        CAST(1 + CAST(1000000000 AS HUGEINT) * (lang_n + 2) // (total + 2 * v) AS HUGEINT) AS q FROM every JOIN langs USING (lang)),
    sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
    apart AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
        FROM shares WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
        CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM apart) QUALIFY part = 'pair' OR rank <= 10""")
def op11_divergence(spark, sf_dir):
    """How far the words of each source are from those of the others of its language."""
    return divergence.divergences(table(spark, sf_dir, "documents"))


@query(r"""WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
    marks AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS bad FROM labels GROUP BY doc_id),
    failed AS (SELECT part, good, bad, [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
        100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t), regexp_matches(t, '[#$%&*|]'),
        coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS f FROM w LEFT JOIN marks USING (doc_id)),
    counts AS (SELECT part, f, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE bad) AS bad
        FROM failed GROUP BY ALL),
    i AS (SELECT unnest(range(1, 6)) AS i),
    orders AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM i a, i b, i c, i d, i e
        WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
    steps AS (SELECT part, n, good, bad, f, o, s.i AS step, f[o[s.i]] AS fails,
        len(list_filter(o[1:s.i - 1], lambda x: f[x])) > 0 AS gone, len(list_filter(f, lambda x: x)) AS n_fails
        FROM counts, orders, i s)
    SELECT part, array_to_string(list_transform(o, lambda x: substr('ABCDE', CAST(x AS INTEGER), 1)), '') AS filter_order,
        CAST(step AS INTEGER) AS step,
        CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails), 0) AS BIGINT) AS kept,
        CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND fails), 0) AS BIGINT) AS removed,
        CAST(coalesce(sum(n) FILTER (WHERE gone AND fails), 0) AS BIGINT) AS redundant,
        CAST(coalesce(sum(n) FILTER (WHERE fails AND n_fails = 1), 0) AS BIGINT) AS unique_fails,
        CAST(coalesce(sum(good) FILTER (WHERE NOT gone AND fails), 0) AS BIGINT) AS good_lost,
        CAST(coalesce(sum(bad) FILTER (WHERE NOT gone AND fails), 0) AS BIGINT) AS toxic_lost,
        CAST(coalesce(sum(sum(n) FILTER (WHERE NOT gone AND fails)) OVER (PARTITION BY part, o[step]), 0) AS BIGINT) AS shapley
    FROM steps GROUP BY part, o, step""")
def op12_filter_audit(spark, sf_dir):
    """What each of five filters removes, in every order they could run in."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(r"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
    totals AS (SELECT source, CAST(sum(size) AS HUGEINT) AS total FROM d GROUP BY source),
    w AS (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
        sum(total) OVER () AS everything FROM totals),
    -- Sources stop in the order of their size for their weight. What the others get for each weight after some have stopped is
    -- num / (2 * den); the first source that this does not bring above its most is the first that does not stop.
    f AS (SELECT *, 3 * everything - 4 * coalesce(sum(total) OVER before, 0) AS num,
        sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS den FROM w
        WINDOW before AS (ORDER BY total / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    level AS (SELECT CAST(num AS HUGEINT) AS num, CAST(den AS HUGEINT) AS den FROM f
        WHERE weight * num <= 4 * total * den ORDER BY total / weight, source NULLS LAST LIMIT 1),
    targets AS (SELECT source, total, total = 0 OR weight * num >= 4 * total * den AS stops,
        CASE WHEN total = 0 THEN 0 WHEN stops THEN 2 ELSE weight * num END AS top,
        CASE WHEN stops THEN 1 ELSE 2 * den * total END AS bottom,
        CASE WHEN stops THEN CAST(2 * total AS DOUBLE)
            ELSE CAST(weight AS DOUBLE) * CAST(num AS DOUBLE) / CAST(2 * den AS DOUBLE) END AS target,
        CAST(concat('0x', substr(md5(concat('mix', CASE WHEN source IS NULL THEN '1' ELSE '0' END, coalesce(source, ''))), 1, 8)) AS HUGEINT)
            * bottom // 4294967296 AS turn FROM w LEFT JOIN level ON true),
    placed AS (SELECT d.*, t.* EXCLUDE (source), row_number() OVER (PARTITION BY d.source ORDER BY size DESC, doc_id NULLS FIRST) AS k
        FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(total AS BIGINT) AS source_size, target,
        CAST(size * ((k * top + turn) // bottom - ((k - 1) * top + turn) // bottom) AS BIGINT) AS taken FROM placed""")
def op13_mixing(spark, sf_dir):
    """How many words the mix of sources takes of each document."""
    found = mixing.mixture(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", "size", "source_size", "target", "taken")
