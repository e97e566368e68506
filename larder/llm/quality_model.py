"""A quality classifier: random-indexing word vectors, pooled, and a small calibrated network."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.texts import let_workers_import, text_function, text_key

# Rows of the word table: folded words and the shapes of words, each hashed. The last row is the
# border between texts.
WORD_ROWS, SHAPE_ROWS = 4096, 1024
ROWS = WORD_ROWS + SHAPE_ROWS
BORDER = ROWS
DIMENSIONS = 64
NONZERO = 2
# The stretches in which the table is added up.
SLICES = 16
REMEMBERED_WORDS = 400_000
# The largest training sample, in labelled documents.
SAMPLE = 8000
HIDDEN = 32
SHAPES = str.maketrans({c: "a" for c in "abcdefghijklmnopqrstuvwxyz"} | {c: "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"} | {c: "0" for c in "0123456789"})


def shape(word: str) -> str:
    """Letters, capitals and digits by class, other characters themselves, without direct repeats."""
    classes = word.translate(SHAPES)
    if not classes.isascii():
        classes = "".join(c if c.isascii() else "A" if c.isupper() else "a" if c.isalpha() else "~" for c in classes)
    return "".join(c for i, c in enumerate(classes) if not i or c != classes[i - 1])


class WordTable:
    """Table rows of words, remembered within limits: row of the word times 2^16, plus row of the shape."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def _rows(self, word: str) -> int:
        text = word.lower().encode("utf-8", "replace")
        return zlib.crc32(text) % WORD_ROWS << 16 | WORD_ROWS + zlib.crc32(shape(word).encode("utf-8", "replace")) % SHAPE_ROWS

    def rows(self, text: str | None) -> np.ndarray:
        words = text.split() if text else []
        new = set(words).difference(self.known)
        if len(self.known) + len(new) <= REMEMBERED_WORDS:
            self.known.update((word, self._rows(word)) for word in new)
            return np.fromiter(map(self.known.__getitem__, words), np.int32, len(words))
        own = {word: self._rows(word) for word in new}
        return np.fromiter((own[w] if w in own else self.known[w] for w in words), np.int32, len(words))


@lru_cache(maxsize=1)
def _remembered() -> WordTable:
    return WordTable()


@lru_cache(maxsize=1)
def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """The fixed sparse random vectors: ``NONZERO`` places of each row, half of them +1 and half -1."""
    random = np.random.default_rng(20240229)
    places = np.stack([random.permutation(DIMENSIONS)[:NONZERO] for _ in range(ROWS + 1)]).astype(np.int64)
    return places, np.where(np.arange(NONZERO) % 2, -1, 1)


def add_contexts(sums: np.ndarray, rows: np.ndarray, reach: int) -> None:
    """Adds to each row's vector the index vectors of its neighbours up to ``reach`` words away."""
    places, signs = index_vectors()
    flat = sums.reshape(-1)
    for step in range(1, reach + 1):
        for mine, other in ((rows[:-step], rows[step:]), (rows[step:], rows[:-step])):
            near = other != BORDER
            base, them = mine[near] * DIMENSIONS, other[near]
            for place, sign in enumerate(signs):
                flat += sign * np.bincount(base + places[them, place], minlength=len(flat))


@dataclass(frozen=True)
class WordVectors:
    """Unit vectors of all rows, and each row's weight in a pool (frequent words weigh less)."""

    vectors: np.ndarray
    weights: np.ndarray


def word_vectors(docs: DataFrame, text_column: str = "text") -> WordVectors:
    """Random indexing over every text: a row's vector is the sum of the index vectors around it.

    Each task adds up its texts in one table of fixed size and sends it in slices, which are summed slice by slice;
    the driver gets ``ROWS x (DIMENSIONS + 1)`` sums whatever the number of texts.
    """
    let_workers_import(docs.sparkSession)
    schema = "slice int, sums binary"
    width = DIMENSIONS + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((ROWS + 1, DIMENSIONS), np.int64)
        seen = np.zeros(ROWS + 1, np.int64)
        table = _remembered()
        border = np.full(2, BORDER, np.int64)

        def add(parts):
            rows = np.concatenate(parts).astype(np.int64)
            words, shapes = rows >> 16, np.where(rows == BORDER << 16 | BORDER, BORDER, rows & 0xFFFF)
            add_contexts(sums, words, 2)
            add_contexts(sums, shapes, 1)
            seen[:] += np.bincount(words, minlength=ROWS + 1) + np.bincount(shapes, minlength=ROWS + 1)

        for batch in batches:
            parts, size = [], 0
            for text in batch.column(0).to_pylist():
                rows = table.rows(text)
                parts += [rows.astype(np.int64), border << 16 | border]
                size += len(rows)
                if size > 1 << 20:
                    add(parts)
                    parts, size = [], 0
            if parts:
                add(parts)
        whole = np.column_stack((sums, seen))[:ROWS]
        if seen[:ROWS].any():
            body = [part.astype("<i8").tobytes() for part in np.array_split(whole, SLICES)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(SLICES), pa.int32()), pa.array(body, pa.binary())], names=["slice", "sums"]
            )

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for which, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                values = np.frombuffer(body, "<i8")
                sums[which] = sums[which] + values if which in sums else values
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                names=["slice", "sums"],
            )

    partial = docs.select(text_column).mapInArrow(count, schema)
    added = partial.repartition(SLICES, "slice").mapInArrow(total, schema).collect()
    whole = np.zeros((ROWS, width))
    parts = np.array_split(np.arange(ROWS), SLICES)
    for row in added:
        whole[parts[row["slice"]]] = np.frombuffer(row["sums"], "<i8").reshape(-1, width)
    vectors, seen = whole[:, :DIMENSIONS], whole[:, DIMENSIONS]
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    share = seen / max(1.0, seen[:WORD_ROWS].sum())
    weights = 1e-3 / (1e-3 + share)
    weights[WORD_ROWS:] = 1.0
    return WordVectors((vectors / np.maximum(norms, 1e-9)).astype(np.float32), weights.astype(np.float32))


def pooled(words: WordVectors, rows: np.ndarray) -> np.ndarray:
    """A text's features: the weighted means of its words' and of its shapes' vectors, the lengths of both
    means, and the logarithm of its number of words. All zero for a text without words."""
    if not len(rows):
        return np.zeros(2 * DIMENSIONS + 3, np.float32)
    own, shapes = rows >> 16, rows & 0xFFFF
    counts = np.bincount(own, minlength=WORD_ROWS)[:WORD_ROWS] * words.weights[:WORD_ROWS]
    forms = np.bincount(shapes - WORD_ROWS, minlength=SHAPE_ROWS) * words.weights[WORD_ROWS:]
    means = [c @ v / c.sum() for c, v in ((counts, words.vectors[:WORD_ROWS]), (forms, words.vectors[WORD_ROWS:]))]
    lengths = [np.linalg.norm(mean) for mean in means]
    return np.concatenate((*means, lengths, [np.log1p(len(rows))])).astype(np.float32)


@dataclass(frozen=True)
class Network:
    """Standardised features, a layer of ``tanh`` units, one logit, and the temperature it is divided by."""

    centre: np.ndarray
    spread: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    temperature: float = 1.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        units = np.tanh((features - self.centre) / self.spread @ self.hidden + self.hidden_bias)
        return units @ self.out + self.out_bias

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -60, 60)))


def fit(features: np.ndarray, labels: np.ndarray, rounds: int = 400, rate: float = 0.01, decay: float = 1e-3) -> Network:
    """Cross-entropy by Adam on four fifths of the rows; the temperature by the likelihood of the rest.

    One class only, or no rows: the network gives the smoothed share of label 1.
    """
    random = np.random.default_rng(11)
    n, width = features.shape
    share = float(np.log((labels.sum() + 1) / (n - labels.sum() + 1)))
    if n < 10 or labels.min(initial=1) == labels.max(initial=0):
        flat = np.zeros(width)
        return Network(flat, flat + 1, np.zeros((width, 1)), np.zeros(1), np.zeros(1), share)
    order = random.permutation(n)
    held, used = order[: n // 5], order[n // 5 :]
    x, y = features[used].astype(float), labels[used].astype(float)
    centre, spread = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = (x - centre) / spread
    values = [
        random.normal(0, width**-0.5, (width, HIDDEN)),
        np.zeros(HIDDEN),
        random.normal(0, HIDDEN**-0.5, HIDDEN),
        np.array(share),
    ]
    means, squares = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for round_ in range(1, rounds + 1):
        hidden, bias, out, out_bias = values
        units = np.tanh(x @ hidden + bias)
        error = (1 / (1 + np.exp(-np.clip(units @ out + out_bias, -60, 60))) - y) / len(y)
        back = error[:, None] * out * (1 - units**2)
        slopes = [x.T @ back + decay * hidden, back.sum(axis=0), units.T @ error + decay * out, error.sum()]
        for value, slope, mean, square in zip(values, slopes, means, squares, strict=True):
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope * slope - square)
            value -= rate * (mean / (1 - 0.9**round_)) / (np.sqrt(square / (1 - 0.99**round_)) + 1e-9)
    network = Network(centre, spread, values[0], values[1], values[2], float(values[3]))
    logits, truth = network.logits(features[held].astype(float)), labels[held]
    tried = np.exp(np.linspace(np.log(0.25), np.log(8), 101))
    loss = [np.logaddexp(0, -np.where(truth == 1, 1, -1) * logits / t).mean() for t in tried]
    return Network(centre, spread, values[0], values[1], values[2], float(values[3]), float(tried[int(np.argmin(loss))]))


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    words: WordVectors,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    sample: int = SAMPLE,
) -> Network:
    """Fits a network on at most ``sample`` labelled rows where ``learn`` holds: those with the least hashes of the id.

    Only pooled features travel. Labels other than 0 and 1 teach nothing; of several labels for an id the
    greatest counts.
    """
    known = labels.where(F.col(label_column).isin(0, 1)).groupBy(F.col(id_column).alias("id"))
    known = known.agg(F.max(label_column).alias("label"))
    rows = docs.where(learn).select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    chosen = known.join(rows.select("id").distinct(), "id", "left_semi")
    chosen = chosen.orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(sample)
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def make():
        def work(texts: Sequence[str | None]):
            table = _remembered()
            return pa.array([pooled(shared.value, table.rows(text)).tolist() for text in texts], pa.list_(pa.float32()))

        return work

    features = text_function(docs.sparkSession, make, "array<float>")
    # One row of an id, the one whose text has the least key, so that a repeated id is learned once.
    taken = rows.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min_by("text", text_key("text")).alias("text"))
    got = taken.select("id", "label", features("text").alias("features")).collect()
    got.sort(key=lambda row: (row["id"], row["features"]))
    x = np.array([row["features"] for row in got], np.float32).reshape(-1, 2 * DIMENSIONS + 3)
    return fit(x, np.array([row["label"] for row in got], int)) if got else fit(x, np.zeros(0, int))


def score(
    docs: DataFrame, words: WordVectors, network: Network, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id, score`` of every row of ``docs``: the calibrated probability of label 1.

    Whole texts; NULL and empty ones are scored like a text without words. Repeated rows stay; other columns are
    not looked at; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast((words, network))

    def make():
        def work(texts: Sequence[str | None]):
            vectors, net = shared.value
            table, scores = _remembered(), []
            for start in range(0, len(texts), 256):
                some = texts[start : start + 256]
                scores.append(net.probability(np.stack([pooled(vectors, table.rows(text)) for text in some])))
            return pa.array(np.concatenate(scores) if scores else [], pa.float64())

        return work

    probability = text_function(docs.sparkSession, make, "double")(text_column)
    return docs.select(F.col(id_column).alias("id"), probability.alias("score"))
