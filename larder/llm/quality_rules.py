"""Quality rules as weak supervision: votes, accuracies by expectation-maximisation, posteriors."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.texts import fresh, stored, text_function

# The white space between words, and the characters that count as symbols.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
BARE = re.compile(r"[\W_]+")

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct", "n_upper", "n_letters", "n_marked", "n_bare",
)
COUNTS = "struct<" + ",".join(f"{name}:bigint" for name in MEASURES) + ">"


def repeat_words(words: Sequence[str], window: int = 3) -> int:
    """Words inside windows of ``window`` words that occur more than once in the text."""
    if len(words) <= window:
        return 0
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(word, len(numbers)) for word in words), np.int64, len(words))
    keys = ids[: len(ids) - window + 1]
    for i in range(1, window):
        # Numbered anew each time, so that the keys never outgrow 64 bits.
        _, keys = np.unique(keys * len(numbers) + ids[i : len(ids) - window + 1 + i], return_inverse=True)
    twice = np.bincount(keys)[keys] > 1
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, np.flatnonzero(twice), 1)
    np.add.at(covered, np.flatnonzero(twice) + window, -1)
    return int(np.count_nonzero(np.cumsum(covered[:-1])))


def measure(text: str | None) -> tuple[int, ...]:
    """``MEASURES`` of one text; NULL is like a text without words.

    Lines are the text's parts between newlines that hold a word. ``n_marked`` counts words whose last
    two characters are neither letters nor digits, ``n_bare`` words without a letter or digit.
    """
    text = text or ""
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    distinct = Counter(words)
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    marked = bare = 0
    for word, times in distinct.items():
        tail = word[-2:]
        if len(tail) == 2 and tail.isascii() and not (tail[:1].isalnum() or tail[1:].isalnum()):
            marked += times
        if not word[:1].isalnum() and word.isascii() and not any(map(bytes.isalnum, (word[i : i + 1] for i in range(len(word))))):
            bare += times
    return (
        len(words),
        len(text) - sum(map(text.count, SPACE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(lines),
        len(distinct),
        upper,
        sum(map(str.isalpha, text)),
        marked,
        bare,
    )


@dataclass(frozen=True)
class Rule:
    """Votes bad from ``bad`` on, good below ``good``, and abstains between them."""

    name: str
    value: Column
    good: float
    bad: float

    def vote(self) -> Column:
        return F.when(self.value >= self.bad, 0).when(self.value < self.good, 1).otherwise(2)


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def rules() -> list[Rule]:
    return [
        Rule("symbols", _share("n_symbols", "word_chars"), 0.02, 0.08),
        Rule("symbols_per_word", _share("n_symbols", "n_words"), 0.1, 0.4),
        Rule("marked_words", _share("n_marked", "n_words"), 0.05, 0.25),
        Rule("bare_words", _share("n_bare", "n_words"), 0.05, 0.25),
        Rule("repeated_words", _share("n_repeat_words", "n_words"), 0.2, 0.5),
        Rule("repeated_lines", _share("n_dup_lines", "n_lines"), 0.1, 0.3),
        Rule("few_distinct", 1 - _share("n_distinct", "n_words"), 0.75, 0.9),
        Rule("upper_case", _share("n_upper", "n_letters"), 0.1, 0.3),
        Rule("short_words", -_share("word_chars", "n_words"), -3.0, -2.0),
        Rule("long_words", _share("word_chars", "n_words"), 12.0, 20.0),
    ]


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


@dataclass(frozen=True)
class VoteModel:
    """``votes[c, j, v]``: how often rule j votes v (bad, good, abstain) on texts of class c (bad, good)."""

    prior: np.ndarray
    votes: np.ndarray

    def log_odds(self, patterns: np.ndarray) -> np.ndarray:
        at = np.arange(patterns.shape[1])
        table = np.log(self.votes[1] / self.votes[0])
        return np.log(self.prior[1] / self.prior[0]) + table[at, patterns].sum(axis=1)


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, tolerance: float = 1e-9) -> VoteModel:
    """Expectation-maximisation over vote patterns with their numbers of texts.

    Starts from the rules' majority, one bad vote against the good ones weighing like ``n_rules / 3`` of them.
    A text counts 1 in every update whatever pattern it has, and each vote has a pseudo-count, so that no rule is ever
    certain. A rule that votes bad is never taken as a sign of a good text (nor the reverse): its
    likelihood ratio is kept on its own side of 1.
    """
    n_rules = patterns.shape[1]
    bad, good = (patterns == 0).sum(axis=1), (patterns == 1).sum(axis=1)
    posterior = 1 / (1 + np.exp(-(good - bad * n_rules / 3)))
    one_hot = (patterns[:, :, None] == np.arange(3)).astype(float)
    pseudo = np.array([[[0.5, 0.1, 0.1]], [[0.05, 1.0, 0.1]]])
    model, before = None, -np.inf
    for _ in range(rounds):
        weight = np.stack([(1 - posterior) * counts, posterior * counts])
        votes = np.einsum("cp,pjv->cjv", weight, one_hot) + pseudo
        votes /= votes.sum(axis=2, keepdims=True)
        prior = np.clip((weight.sum(axis=1) + 1) / (weight.sum() + 2), 0.02, 0.98)
        for vote, more, less in ((0, 0, 1), (1, 1, 0)):
            votes[less, :, vote] = np.minimum(votes[less, :, vote], votes[more, :, vote])
        votes /= votes.sum(axis=2, keepdims=True)
        model = VoteModel(prior, votes)
        odds = model.log_odds(patterns)
        posterior = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        if abs((seen := float(posterior @ counts)) - before) <= tolerance * max(1.0, counts.sum()):
            break
        before = seen
    return model


def measured(docs: DataFrame, text_column: str, name: str) -> DataFrame:
    """``docs`` with a struct of ``MEASURES`` under ``name``."""

    def make():
        kinds = [pa.field(m, pa.int64()) for m in MEASURES]

        def work(texts):
            rows = [measure(text) for text in texts]
            columns = list(zip(*rows, strict=True)) or [[] for _ in MEASURES]
            return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=kinds)

        return work

    return docs.withColumn(name, text_function(docs.sparkSession, make, COUNTS)(text_column))


def with_verdicts(measures: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``measures`` (with the columns ``MEASURES``) plus ``base_failed, quality, kept``.

    Votes are counted by pattern over all rows, at most ``3 ** rules`` counts, which the driver fits.
    Rows that fail the base rules are counted like others; failing them only decides ``kept``.
    ``quality`` is the posterior probability of a good text; ``kept`` is false where ``base_failed``, and
    otherwise says whether ``quality`` reaches ``threshold``.
    """
    all_rules = rules()
    code = F.lit(0).cast("int")
    for rule in all_rules:
        code = code * 3 + rule.vote()
    coded = measures.withColumn("pattern", code)
    counted = coded.groupBy("pattern").count().collect()
    if counted:
        codes = np.array([row["pattern"] for row in counted])
        patterns = np.stack([codes // 3**i % 3 for i in range(len(all_rules) - 1, -1, -1)], axis=1)
        model = fit_votes(patterns, np.array([row["count"] for row in counted], float))
    else:
        flat = np.full((2, len(all_rules), 3), 1 / 3)
        model = VoteModel(np.array([0.5, 0.5]), flat)
    odds = F.lit(float(np.log(model.prior[1] / model.prior[0])))
    table = np.log(model.votes[1] / model.votes[0])
    for j, rule in enumerate(all_rules):
        vote = rule.vote()
        odds = odds + F.when(vote == 0, float(table[j, 0])).when(vote == 1, float(table[j, 1])).otherwise(float(table[j, 2]))
    quality = 1 / (1 + F.exp(-odds))
    return (
        coded.drop("pattern")
        .withColumn("base_failed", base_failed())
        .withColumn("quality", quality)
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
    )


def judge(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.5) -> DataFrame:
    """``id``, all ``MEASURES``, ``base_failed, quality, kept`` of every row of ``docs``.

    NULL and empty texts have no words and so fail the base rules; repeated rows are judged alike and each
    counts; other columns are not looked at; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    found = measured(rows, "text", "m").select("id", "m.*")
    return with_verdicts(stored(found, "measures"), threshold)


def keep_good(docs: DataFrame, text_column: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns as they are.

    NULL and empty texts, and all others that fail the base rules, go; repeated rows stay or go together; an empty table
    gives an empty one. Texts are measured once and stored beside their measures.
    """
    row, measures = fresh(docs, "row", "measures")
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(row), F.col(text_column).alias("text"))
    found = measured(whole, "text", measures).select(row, f"{measures}.*")
    return with_verdicts(stored(found, "measured"), threshold).where("kept").select(f"{row}.*")
