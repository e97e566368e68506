"""Language identification by a linear-chain conditional random field over words."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.texts import text_function

UNKNOWN = "und"
# Features are hashed into a table of so many bits; row 0 stands for no feature.
TABLE_BITS = 17
TABLE = (1 << TABLE_BITS) + 1
GRAMS = (2, 3, 4)
BLOCK = 64
# The largest training sample: so many documents of each language, whole, and so many bytes of them.
SAMPLE_PER_LANGUAGE = 200
SAMPLE_BYTES = 4 << 20
# Characters whose words are worked on together, at about 100 bytes of memory each; a longer text goes in runs of this length.
RUN = 200_000
SPACE = re.compile(r"\s")

BLANK = 32
# Odd multipliers, one for each gram length.
MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass(frozen=True)
class Words:
    """The words of many texts as features: ``grams`` (one row for each length) hold a table row for each byte, 0 for
    none; ``starts`` is where each word begins, ``whole`` its table row, ``lettered`` whether it has a letter, ``sizes`` its
    number of features, ``doc_ends`` the number of words up to the end of each text."""

    grams: np.ndarray
    starts: np.ndarray
    whole: np.ndarray
    lettered: np.ndarray
    sizes: np.ndarray
    doc_ends: np.ndarray


def features(texts: Sequence[str | None]) -> Words:
    """Affixes and n-grams: all runs of 2 to 4 bytes of a word between two blanks; lexicon: the word itself.

    Grams that hold a blank are the word's affixes. Case is folded.
    """
    parts = [(text or "").lower().split() for text in texts]
    doc_ends = np.cumsum([len(words) for words in parts])
    raw = np.frombuffer((" " + " ".join(word for words in parts for word in words) + " ").encode("utf-8", "replace"), np.uint8)
    n = len(raw)
    blanks = np.flatnonzero(raw == BLANK)
    starts, ends = blanks[:-1], blanks[1:]  # of a word with the blank before it; the blank after it
    if not len(doc_ends) or doc_ends[-1] == 0:
        starts = ends = np.zeros(0, np.int64)
    # For each byte, how many bytes of its word are left with the word's final blank.
    left = np.zeros(n, np.int32)
    if len(starts):
        left[: ends[-1]] = np.repeat(ends.astype(np.int32), ends - starts)
        left[: ends[-1]] -= np.arange(ends[-1], dtype=np.int32) - 1
    grams = np.zeros((len(GRAMS), n), np.int32)
    valid = np.zeros(n, np.int64)
    value = raw.astype(np.uint32)
    for size in range(2, max(GRAMS) + 1):
        value = value << np.uint32(8)
        value[: max(0, n - size + 1)] |= raw[size - 1 :]
        if size in GRAMS:
            fits = left >= size
            hashed = (value * MIX[size - 2] >> np.uint32(32 - TABLE_BITS)).astype(np.int32) + 1
            np.multiply(hashed, fits, out=grams[GRAMS.index(size)])
            valid += fits
    if len(starts):
        # A polynomial hash of each word from running sums, in whole numbers modulo 2^64.
        power = np.cumprod(np.full(n, 0x100000001B3, np.uint64))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw + np.uint64(1)) * power)))
        inverse = np.uint64(pow(0x100000001B3, -1, 1 << 64))
        back = np.cumprod(np.full(n, inverse, np.uint64))
        word = (sums[ends] - sums[starts]) * back[starts]
        whole = (word * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - TABLE_BITS)).astype(np.int64) + 1
        letters = (raw >= 97) & (raw <= 122) | (raw >= 128)
        counts = np.concatenate(([0], np.cumsum(letters)))
        lettered = counts[ends] > counts[starts]
        covered = np.concatenate(([0], np.cumsum(valid)))
        sizes = covered[ends] - covered[starts] + 1
    else:
        whole, lettered, sizes = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)
    return Words(grams, starts, whole, lettered, sizes, doc_ends)


@dataclass(frozen=True)
class Field:
    """Feature weights (row 0 is all zero), transition weights from one label to the next, and labels."""

    weights: np.ndarray
    moves: np.ndarray
    labels: tuple[str, ...]

    def scores(self, words: Words) -> np.ndarray:
        """The label scores of each word: its features' weights over the root of their number."""
        if not len(words.starts):
            return np.zeros((0, len(self.labels)), np.float32)
        total = self.weights[words.grams[0]]
        for row in words.grams[1:]:
            total += self.weights[row]
        sums = np.add.reduceat(total, words.starts, axis=0)
        return (sums + self.weights[words.whole]) / np.sqrt(words.sizes)[:, None].astype(np.float32)


def forward_backward(scores: np.ndarray, ends: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``run_forward_backward`` of whole chains: each word's posterior, and its probability given the words up to it."""
    return run_forward_backward(scores, ends, moves)[:2]


def run_forward_backward(
    scores: np.ndarray,
    ends: np.ndarray,
    moves: np.ndarray,
    before: np.ndarray | None = None,
    after: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior probability of each label at each word, exactly, for many chains at a time; the
    probability given only the words up to that one; and the first chain's message to what comes before it.

    ``before`` and ``after`` are messages into the chains from what comes before and after them, for runs of one text.
    ``ends`` is the number of words up to the end of each chain. Chains are cut into blocks: all blocks are
    multiplied out side by side, messages then pass from block to block, and all blocks are filled in side by side.
    """
    n, k = scores.shape
    lengths = np.diff(np.concatenate(([0], ends)))
    if not n:
        return np.zeros((0, k)), np.zeros((0, k)), np.full(k, 1 / k) if after is None else after
    blocks_of = -(-lengths // BLOCK)
    first_block = np.concatenate(([0], np.cumsum(blocks_of)))[:-1]
    total = int(blocks_of.sum())
    chain = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(n) - np.repeat(ends - lengths, lengths)
    block, at = first_block[chain] + place // BLOCK, place % BLOCK
    emit = np.ones((BLOCK, total, k))
    emit[at, block] = np.exp(scores - scores.max(axis=1, keepdims=True))
    used = np.zeros((BLOCK, total), bool)
    used[at, block] = True
    step = np.exp(moves - moves.max())

    product = np.broadcast_to(np.eye(k), (total, k, k)).copy()
    for t in range(BLOCK):
        on = used[t]
        if not on.any():
            break
        grown = product[on] @ step * emit[t, on][:, None, :]
        product[on] = grown / grown.sum(axis=(1, 2), keepdims=True)

    into, out = np.full((total, k), 1 / k), np.full((total, k), 1 / k)
    if before is not None:
        into[:] = before
    if after is not None:
        out[:] = after
    order = np.argsort(-blocks_of, kind="stable")
    many = blocks_of[order]
    for b in range(1, int(many[0])):
        here = first_block[order[: np.searchsorted(-many, -b, side="left")]] + b
        moved = np.einsum("bi,bij->bj", into[here - 1], product[here - 1])
        into[here] = moved / moved.sum(axis=1, keepdims=True)
    for b in range(int(many[0]) - 2, -1, -1):
        here = first_block[order[: np.searchsorted(-many, -(b + 1), side="left")]] + b
        moved = np.einsum("bij,bj->bi", product[here + 1], out[here + 1])
        out[here] = moved / moved.sum(axis=1, keepdims=True)

    ahead = np.empty((BLOCK, total, k))
    state = into
    for t in range(BLOCK):
        grown = state @ step * emit[t]
        grown /= grown.sum(axis=1, keepdims=True)
        state = np.where(used[t][:, None], grown, state)
        ahead[t] = state
    forward = ahead[at, block]
    state = out
    for t in range(BLOCK - 1, -1, -1):
        ahead[t] *= state
        grown = (state * emit[t]) @ step.T
        grown /= grown.sum(axis=1, keepdims=True)
        state = np.where(used[t][:, None], grown, state)
    posterior = ahead[at, block]
    first = product[0] @ out[0]
    return posterior / posterior.sum(axis=1, keepdims=True), forward, first / first.sum()


def fit(texts: Sequence[str], languages: Sequence[str], rounds: int = 30, rate: float = 0.3, seed: int = 7) -> Field:
    """Maximum conditional likelihood with a Gaussian prior, by Adam over all chains.

    The texts' words are cut into stretches of 8 to 40 words, which are put together at random into chains of
    ``BLOCK`` words, so that the transitions are learned from text that switches between languages.
    """
    labels = tuple(sorted(set(languages)))
    k = len(labels)
    if k < 2:
        return Field(np.zeros((TABLE, max(k, 1)), np.float32), np.zeros((max(k, 1), max(k, 1))), labels)
    words = features(texts)
    if not len(words.starts):
        return Field(np.zeros((TABLE, k), np.float32), np.zeros((k, k)), labels)
    gold = np.repeat([labels.index(x) for x in languages], np.diff(np.concatenate(([0], words.doc_ends))))
    random = np.random.default_rng(seed)
    at, n = 0, len(gold)
    stretches = []
    while at < n:
        size = int(random.integers(8, 41))
        stretches.append(np.arange(at, min(at + size, n)))
        at += size
    random.shuffle(stretches)
    order = np.concatenate(stretches)
    ends = np.append(np.arange(BLOCK, len(order), BLOCK), len(order))
    gold = gold[order]

    # Features of each byte with its word's number; a word's features weigh 1 / root of their number.
    word_of = np.repeat(np.arange(n), np.diff(np.append(words.starts, words.grams.shape[1] - 1)))
    weigh = (1 / np.sqrt(words.sizes)).astype(np.float32)
    weights, moves = np.zeros((TABLE, k), np.float32), np.zeros((k, k))
    state = [np.zeros_like(x) for x in (weights, weights, moves, moves)]
    seen = np.zeros((k, k))
    inside = np.ones(len(gold), bool)
    inside[ends[:-1]] = False
    inside[0] = False
    later = np.flatnonzero(inside)
    np.add.at(seen, (gold[later - 1], gold[later]), 1)
    for round_ in range(1, rounds + 1):
        field = Field(weights, moves, labels)
        scores = field.scores(words)[order]
        posterior, forward = forward_backward(scores, ends, moves)
        error = posterior.copy()
        error[np.arange(len(gold)), gold] -= 1
        of_word = np.zeros((n, k), np.float32)
        of_word[order] = error
        of_word *= weigh[:, None]
        gradient = np.zeros_like(weights)
        for label in range(k):
            values = of_word[:, label]
            spread = values[word_of]
            column = np.bincount(words.whole, values, TABLE)
            for row in words.grams:
                column += np.bincount(row[: len(word_of)], spread, TABLE)
            gradient[:, label] = column
        gradient = gradient / len(gold) + 1e-6 * weights
        gradient[0] = 0
        # Expected moves; what a word's later words say is its posterior over its forward probability.
        rest = np.exp(scores[later] - scores[later].max(axis=1, keepdims=True)) * (
            posterior[later] / np.maximum(forward[later], 1e-300)
        )
        pair = forward[later - 1][:, :, None] * np.exp(moves)[None] * rest[:, None, :]
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        of_moves = (pair.sum(axis=0) - seen) / len(gold) + 1e-4 * moves
        for value, grad, mean, square in (
            (weights, gradient, state[0], state[1]),
            (moves, of_moves, state[2], state[3]),
        ):
            mean += 0.1 * (grad - mean)
            square += 0.01 * (grad * grad - square)
            step = rate * (mean / (1 - 0.9**round_)) / (np.sqrt(square / (1 - 0.99**round_)) + 1e-8)
            value -= step.astype(value.dtype)
    return Field(weights, moves, labels)


def runs(text: str, size: int) -> Iterator[tuple[int, int, bool]]:
    """Where runs of about ``size`` characters of whole words begin and end; true for a run that is one word longer than that."""
    at = 0
    while at < len(text):
        end = at + size
        if end >= len(text):
            yield at, len(text), False
            return
        blank = SPACE.search(text, end)
        stop = blank.start() if blank else len(text)
        if stop - end <= size:
            yield at, stop, False
        else:
            head = text[at:end].rsplit(None, 1)
            start = end - len(head[-1]) if head and not text[end - 1].isspace() else end
            if start > at:
                yield at, start, False
            yield start, stop, True
        at = stop


def long_word_scores(field: Field, word: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``Field.scores`` and ``lettered`` of one word, from ``size`` bytes of it at a time."""
    raw = np.frombuffer(f" {word.lower().strip()} ".encode("utf-8", "replace"), np.uint8)
    total, grams, hashed, lettered = np.zeros(len(field.labels)), 0, 0, False
    prime, modulus = 0x100000001B3, 1 << 64
    power = 1
    for start in range(0, len(raw), size):
        part = raw[start : start + size + max(GRAMS) - 1]
        own = min(size, len(raw) - start)
        value = part.astype(np.uint32)
        for length in range(2, max(GRAMS) + 1):
            value = value << np.uint32(8)
            value[: max(0, len(part) - length + 1)] |= part[length - 1 :]
            n = min(own, len(part) - length + 1)
            if length in GRAMS and n > 0:
                rows = (value[:n] * MIX[length - 2] >> np.uint32(32 - TABLE_BITS)).astype(np.int64) + 1
                total += row_sum(field.weights, rows)
                grams += n
        letters = part[: min(own, len(raw) - 1 - start)]  # the blank behind is no part of the word's hash
        powers = np.cumprod(np.concatenate(([np.uint64(power)], np.full(max(0, len(letters) - 1), prime, np.uint64))))
        if len(letters):
            hashed = (hashed + int(((letters + np.uint64(1)) * powers).sum())) % modulus
            power = int(powers[-1]) * prime % modulus
            lettered |= bool(((letters >= 97) & (letters <= 122) | (letters >= 128)).any())
    whole = (hashed * 0x9E3779B97F4A7C15 % modulus >> (64 - TABLE_BITS)) + 1
    scores = (total + field.weights[whole]) / np.sqrt(grams + 1)
    return scores[None, :].astype(np.float32), np.array([lettered])


def row_sum(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The sum of some rows of ``weights``, by how often each is there."""
    return np.bincount(rows, minlength=len(weights)) @ weights


def _mean_of_runs(field: Field, text: str, size: int) -> np.ndarray:
    """The mean posterior over a long text's words that hold a letter: messages pass from run to run, first ahead, then back."""
    cut = list(runs(text, size))

    def scored(run: tuple[int, int, bool]) -> tuple[np.ndarray, np.ndarray]:
        if run[2]:
            return long_word_scores(field, text[run[0] : run[1]], size)
        words = features([text[run[0] : run[1]]])
        return field.scores(words), words.lettered

    before: list[np.ndarray | None] = [None]
    for run in cut[:-1]:
        scores, _ = scored(run)
        forward = run_forward_backward(scores, np.array([len(scores)]), field.moves, before[-1])[1]
        before.append(forward[-1] if len(forward) else before[-1])
    sums, n, all_sums, all_n, after = 0.0, 0, 0.0, 0, None
    for run, message in zip(reversed(cut), reversed(before), strict=True):
        scores, lettered = scored(run)
        posterior, _, after = run_forward_backward(scores, np.array([len(scores)]), field.moves, message, after)
        sums, n = sums + posterior[lettered].sum(axis=0), n + int(lettered.sum())
        all_sums, all_n = all_sums + posterior.sum(axis=0), all_n + len(posterior)
    return sums / n if n else all_sums / max(all_n, 1)


def predict(field: Field, texts: Sequence[str | None], size: int = RUN) -> list[tuple[str, float]]:
    """The label with the greatest mean posterior over a text's words that hold a letter, and that mean.

    ``und`` with score 0 if the text is NULL or has no letter, or if no label was learned. Texts are worked on together up to
    ``size`` characters; a longer text goes in runs of that length, with the same result.
    """
    out: list[tuple[str, float]] = []
    held: list[str | None] = []
    length = 0
    for text in texts:
        n = len(text or "")
        if held and length + n > size:
            out += _predict_together(field, held)
            held, length = [], 0
        if n > size:
            mean = _mean_of_runs(field, text, size) if field.labels and has_letter(text) else None
            best = 0 if mean is None else int(mean.argmax())
            out.append((UNKNOWN, 0.0) if mean is None else (field.labels[best], float(mean[best])))
            continue
        held.append(text)
        length += n
    return out + _predict_together(field, held) if held else out


def _predict_together(field: Field, texts: Sequence[str | None]) -> list[tuple[str, float]]:
    words = features(texts)
    posterior = forward_backward(field.scores(words), words.doc_ends, field.moves)[0] if field.labels else None
    out, begin = [], 0
    for text, end in zip(texts, words.doc_ends.tolist(), strict=True):
        if field.labels and has_letter(text):
            counted = words.lettered[begin:end]
            own = posterior[begin:end]
            mean = (own[counted] if counted.any() else own).mean(axis=0)
            best = int(mean.argmax())
            out.append((field.labels[best], float(mean[best])))
        else:
            out.append((UNKNOWN, 0.0))
        begin = end
    return out


def tag(field: Field, text: str | None) -> list[tuple[str, str, float]]:
    """``word, language, probability`` of each word of a code-switched text."""
    words = features([text])
    if not field.labels or not len(words.starts):
        return []
    posterior, _ = forward_backward(field.scores(words), words.doc_ends, field.moves)
    best = posterior.argmax(axis=1)
    return [(w, field.labels[b], float(p[b])) for w, b, p in zip(text.split(), best, posterior, strict=True)]


def train(
    docs: DataFrame,
    learn: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
    most_bytes: int = SAMPLE_BYTES,
) -> Field:
    """Fits a field on at most ``per_language`` whole documents, of ``most_bytes`` together, of each language where ``learn``
    holds. Longer documents than that teach nothing.

    The sample is that with the least hashes of the id, so it is the same every time and spread over the table.
    Rows with a NULL language or text, or a text without letters, teach nothing. Each task
    keeps only its own least rows of a language, so a frequent language costs no more.
    """
    row = docs.where(learn & F.col(language_column).isNotNull() & F.col(text_column).rlike(r"\p{L}"))
    row = row.where(F.octet_length(text_column) <= most_bytes).select(
        F.col(text_column).alias("text"),
        F.col(language_column).alias("lang"),
        F.xxhash64(F.col(id_column).cast("string")).alias("mark"),
    )
    least = Window.partitionBy("lang").orderBy("mark", F.xxhash64("text"))
    taken = row.withColumn("rank", F.row_number().over(least)).where(F.col("rank") <= per_language)
    so_far = least.rowsBetween(Window.unboundedPreceding, 0)
    taken = taken.withColumn("bytes", F.sum(F.octet_length("text")).over(so_far)).where(F.col("bytes") <= most_bytes)
    sample = sorted((r["lang"], r["mark"], r["text"]) for r in taken.select("lang", "mark", "text").collect())
    return fit([text for _, _, text in sample], [lang for lang, _, _ in sample])


def identify(docs: DataFrame, field: Field, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, lang_pred, score`` of every row of ``docs``.

    Whole texts; NULL, empty and letterless ones are ``und`` with score 0. Repeated rows stay; other columns are
    not looked at; an empty table gives an empty result. The field (a few megabytes, whatever the
    number of documents) goes to the workers once each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def make():
        def work(texts):
            rows = predict(shared.value, texts)
            return pa.StructArray.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64())],
                names=["lang_pred", "score"],
            )

        return work

    found = text_function(docs.sparkSession, make, "struct<lang_pred:string,score:double>")(text_column)
    return docs.select(F.col(id_column).alias("id"), found.alias("f")).select("id", "f.*")
