"""Guess costs against all segmentations, and values costed by joins against an uncapped dictionary."""

import math
import random
import re
from itertools import combinations, permutations

import pytest

import corpus_pipeline
from larder.llm import secrets

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def piece_costs(value, start, end, ranks, each):
    """All that a segment of its own may cost, by the rules in words: not repeats, which look back."""
    piece, low = value[start:end], secrets.folded(value)
    joint = 1 if end > 1 else 0
    costs = [each * (end - start)]  # brute force goes on without a joint
    for written in {low[start:end], low.translate(secrets.SWAPS)[start:end]}:
        rank = ranks.get(low[start:end], ranks.get(written))
        lonely = not (low[start - 1 : start].isalpha() or low[end : end + 1].isalpha())
        if rank and (end - start >= 3 or lonely):
            swapped = 0 if low[start:end] in ranks else sum(a != b for a, b in zip(low[start:end], written, strict=True))
            capitals = 0 if piece == low[start:end] else 1 if piece.isupper() or piece[1:] == low[start + 1 : end] else len(piece)
            costs.append(math.log2(rank + 1) + swapped + capitals + joint)
    if re.fullmatch(r"(19|20)\d\d", piece):
        costs.append(math.log2(150) + joint)
    if end - start >= 3 and len(set(piece)) == 1:
        costs.append(each + math.log2(end - start) + joint)
    pairs = list(zip(low[start:end], low[start + 1 : end], strict=False))
    walk = all(any(a + b in row or b + a in row for row in secrets.KEYBOARD) for a, b in pairs)
    order = all(abs(ord(a) - ord(b)) == 1 and b.isalnum() for a, b in zip(piece, piece[1:], strict=False))
    if end - start >= 3 and (walk or order):
        costs.append(math.log2(94) + math.log2(end - start) + joint)
    return min(costs)


def slow_bits(value, ranks):
    each = math.log2(max(2, secrets._alphabet(value)))
    n, best = len(value), math.inf
    for k in range(n):
        for cuts in combinations(range(1, n), k):
            bounds = [0, *cuts, n]
            best = min(best, sum(piece_costs(value, a, b, ranks, each) for a, b in zip(bounds, bounds[1:], strict=False)))
    return best


def test_guess_bits_over_all_segmentations():
    """Values of up to nine characters in which no character comes again soon (that is a copy) and none lies between words."""
    pick = random.Random(4)
    ranks = {"cat": 3, "dog": 9, "at": 2, "a": 1, "house": 40, "sold": 70, "old": 5}
    parts = ["cat", "Dog", "HOUSE", "old", "s0ld", "at", "2019", "qwe", "zxc", "abc", "987", "a", "x", "K", "7", "%"]
    tried = 0
    while tried < 300:
        value = "".join(pick.choice(parts) for _ in range(pick.randint(1, 4)))
        if not 0 < len(value) <= 9 or any(value[i] == value[i + u] for u in (1, 2, 3, 4, 5, 6) for i in range(len(value) - u)):
            continue
        tried += 1
        assert secrets.guess_bits(value, ranks) == pytest.approx(slow_bits(value, ranks)), value


def corpus(spark):
    pick = random.Random(9)
    words = ["".join(pick.choices(LETTERS, k=pick.randint(1, 14))) for _ in range(300)] + ["x" * 60, "İstanbul"]
    texts = [" ".join(pick.choices(words, k=40)) for _ in range(200)]
    values = []
    for _ in range(60):
        chosen = pick.choices(words, k=pick.randint(1, 4))
        value = pick.choice(["", "-", "_", "1"]).join(w.title() if pick.random() < 0.2 else w for w in chosen)
        values.append(value.replace("s", "$") if pick.random() < 0.2 else value)
    values += ["".join(pick.choices(LETTERS + LETTERS.upper() + "0123456789", k=pick.randint(8, 14))) for _ in range(40)]
    texts += [f"see passphrase = {v} there" for v in values] + [f'password: "{v}"' for v in values[::3]]
    texts += ["pwd=" + values[0]] * 300 + [None, ""]  # one value in a third of the rows
    return spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), texts


def test_scan_equals_an_uncapped_dictionary(spark):
    docs, texts = corpus(spark)
    ranks = {r.word: r["rank"] for r in secrets.word_ranks(docs).collect()}
    assert len(ranks) > 300
    found = {r.id: r for r in secrets.scan(docs).collect()}
    kinds = set()
    for i, text in enumerate(texts):
        base = secrets.base_spans(text or "")
        spans = secrets.in_order([*base, *secrets.guess_spans(text or "", base, ranks=ranks)])
        assert found[i].spans == ",".join(map(str, spans)) and found[i].base == ",".join(map(str, base))
        bits = [(a, b, secrets.guess_bits(text[a:b], ranks)) for a, b in secrets.context_values(text or "")]
        got = [x.split(":") for x in found[i].value_bits.split(",") if x]
        assert [(int(a), int(b)) for a, b, _ in got] == [(a, b) for a, b, _ in bits]
        assert all(abs(float(x) - c) <= 0.01 for (_, _, x), (_, _, c) in zip(got, bits, strict=True))
        kinds.add((bool(bits), any(s.kind == "guess" for s in spans)))
    assert kinds == {(False, False), (True, False), (True, True)}


def test_redaction_follows_the_scan(spark):
    docs, texts = corpus(spark)
    ranks = {r.word: r["rank"] for r in secrets.word_ranks(docs).collect()}
    cleaned = {r.doc_id: r.text for r in secrets.without_secrets(docs).collect()}
    for i, text in enumerate(texts):
        base = secrets.base_spans(text or "")
        spans = secrets.in_order([*base, *secrets.guess_spans(text or "", base, ranks=ranks)])
        assert cleaned[i] == (secrets.redact(text, spans) if spans else text)


def test_words_of_the_corpus_are_found_inside_runs(spark):
    rows = [(i, "correct horse battery staple donaudampfschifffahrtsgesellschaft") for i in range(9)]
    rows += [(9, "passphrase: horsebattery pwd: donaudampfschifffahrtsgesellschaft credentials: kqzxvwpyjm")]
    found = secrets.scan(spark.createDataFrame(rows, "doc_id int, text string")).where("id = 9").first()
    assert (found.n_guess, [x.split(":")[0] for x in found.spans.split(",")]) == (1, ["guess"])
    bits = [float(x.split(":")[2]) for x in found.value_bits.split(",")]
    assert bits[0] < 10 and bits[1] < 5 and bits[2] > secrets.GUESS_BITS


def test_long_value_and_no_values(spark):
    pick = random.Random(3)
    long = "".join(pick.choices(LETTERS, k=30_000))
    rows = [(1, f'pwd: "{long}"'), (2, "no secrets here"), (3, f"token={'ab' * 40_000}")]
    found = {r.id: r for r in secrets.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert found[1].spans == f"guess:6:{6 + len(long)}" and found[2].spans == found[2].value_bits == ""
    assert found[3].n_assign == 1 and found[3].value_bits.startswith("6:80006:")


def test_pipeline_stage_redacts_guesses_by_corpus_words(spark):
    """Planted values: the stage tells them apart by the words of its own documents."""
    rows = [(i, f"umbrella garden quality river number{i}", "en", "s", 0) for i in range(20)]
    rows += [(20, "pwd: umbrellagarden", "en", "s", 1), (21, "pwd: xK9mQ2vTb7", "en", "s", 2), (22, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.secret_values(spark, docs, "").collect()}
    assert out[20] == ("pwd: umbrellagarden", 19) and out[21] == ("pwd: [secret]", 13) and out[22] == (None, None)


def test_scan_counts_each_kind_wherever_its_spans_stand(spark):
    """Spans of every kind in every order, several of one kind, and none."""
    one = {"assign": "token=abcdefgh", "access": "AKIA" + "Z9" * 8, "hex": "0a1b2c3d" * 3}
    orders = [[], *([kind] for kind in one), *permutations(one), ["hex"] * 3, ["assign"] * 4, ["access", "access", "hex", "assign", "hex"]]
    texts = [(i, " ; ".join(one[kind] for kind in order)) for i, order in enumerate(orders)]
    found = {r.id: r for r in secrets.scan(spark.createDataFrame([*texts, (-1, None)], "doc_id int, text string")).collect()}
    assert (found[-1].n_assign, found[-1].n_access, found[-1].n_hex) == (0, 0, 0)
    for i, order in enumerate(orders):
        assert [span.split(":")[0] for span in found[i].base.split(",") if span] == list(order)
        assert (found[i].n_assign, found[i].n_access, found[i].n_hex) == tuple(map(list(order).count, one))
