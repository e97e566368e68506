"""What the fitted operators learn from: expectation-maximisation row by row, bounded samples."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import quality_model, quality_rules


def slow_fit(rows, rounds):
    """Expectation-maximisation with one row at a time; the rules' formulas in plain numbers."""
    n_rules = len(rows[0])
    posterior = [1 / (1 + math.exp(-(row.count(1) - row.count(0) * n_rules / 3))) for row in rows]
    for _ in range(rounds):
        votes = [[[0.5, 0.1, 0.1] for _ in range(n_rules)], [[0.05, 1.0, 0.1] for _ in range(n_rules)]]
        for row, good in zip(rows, posterior, strict=True):
            for j, vote in enumerate(row):
                votes[0][j][vote] += 1 - good
                votes[1][j][vote] += good
        votes = [[[v / sum(rule) for v in rule] for rule in side] for side in votes]
        prior = [min(0.98, max(0.02, (sum(1 - p if c == 0 else p for p in posterior) + 1) / (len(rows) + 2))) for c in (0, 1)]
        for j in range(n_rules):
            votes[1][j][0] = min(votes[1][j][0], votes[0][j][0])
            votes[0][j][1] = min(votes[0][j][1], votes[1][j][1])
        votes = [[[v / sum(rule) for v in rule] for rule in side] for side in votes]
        odds = [
            math.log(prior[1] / prior[0]) + sum(math.log(votes[1][j][v] / votes[0][j][v]) for j, v in enumerate(row)) for row in rows
        ]
        posterior = [1 / (1 + math.exp(-o)) for o in odds]
    return prior, votes, odds


@pytest.mark.parametrize("rounds", [1, 2, 25])
def test_votes_fitted_row_by_row(rounds):
    pick = random.Random(rounds)
    rows = [[pick.choices((0, 1, 2), weights=(1, 4, 2) if i % 4 else (4, 1, 1))[0] for _ in range(5)] for i in range(400)]
    prior, votes, odds = slow_fit(rows, rounds)
    patterns, counts = np.unique(np.array(rows), axis=0, return_counts=True)
    model = quality_rules.fit_votes(patterns, counts.astype(float), rounds=rounds, tolerance=-1.0)
    assert np.allclose(model.prior, prior) and np.allclose(model.votes, votes)
    assert np.allclose(model.log_odds(np.array(rows)), odds)


def test_rules_see_the_rows_that_fail_the_base(spark):
    """Half of the rows are one word over and over: they fail the base rules, and the model knows such votes."""
    rows = [(i, "spam " * 80) for i in range(60)] + [(100 + i, " ".join(f"word{(i * 7 + j) % 90}" for j in range(80))) for i in range(60)]
    rows += [(300, "short text"), (301, None)]
    found = {r.id: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert all(found[i].base_failed and not found[i].kept and found[i].quality < 0.5 for i in range(60))
    assert all(found[100 + i].kept for i in range(60)) and not found[300].kept and not found[301].kept


def test_repeated_ids_are_learned_once(spark):
    """An id that a third of the rows have brings one row to the sample."""
    docs = [(1, f"good words here {i}") for i in range(300)] + [(i, f"other bad {i} !!") for i in range(2, 40)]
    frame = spark.createDataFrame(docs, "doc_id int, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id int, quality int")
    seen = []
    words = quality_model.word_vectors(frame)
    plain = quality_model.fit

    def fit(x, y):
        seen.append(len(y))
        return plain(x, y)

    quality_model.fit = fit
    try:
        quality_model.train(frame, labels, F.lit(True), words)
    finally:
        quality_model.fit = plain
    assert seen == [39]
