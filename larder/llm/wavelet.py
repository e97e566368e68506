"""Token files: a wavelet matrix per block of documents, written and read by Spark."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from larder.llm.texts import let_workers_import, stored
from larder.llm.tokens import IDS, default_tokenizer, encoder, in_runs, with_end
from larder.sources.shared import scratch_path

MAGIC = b"WVM2"
HEADER = struct.Struct("<4sBxxxQ")
PLANE = struct.Struct("<QQQ")
# Tokens after which a block of whole documents is closed.
BLOCK_TOKENS = 1 << 20
# 64-bit words between two stored counts of ones.
GROUP = 8


class WaveletMatrix:
    """A sequence of ids as bit-planes, highest bit first; each plane sorts the ids by its bit, keeping order.

    A plane keeps its bits in 64-bit words beside the number of ones before each group of ``GROUP`` words, so ``rank`` is
    a lookup and a few population counts. ``access``, ``count`` and ``select`` take one step per plane.
    As bytes: a header, then for each plane its number of zeros, its bits and its counts, both compressed by zstd. An opened
    matrix unpacks a plane when it is first asked for.
    """

    def __init__(self, n: int, zeros: list[int], packed: list[tuple[bytes, bytes]]):
        self.n = n
        self.zeros = zeros
        self.packed = packed
        self._opened: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @classmethod
    def of(cls, ids: np.ndarray, width: int | None = None) -> WaveletMatrix:
        if width is None:
            width = max(1, int(ids.max(initial=0)).bit_length())
        kind = np.dtype(np.uint16 if width <= 16 else np.uint32)
        n, rest, zeros, packed = len(ids), pa.array(ids.astype(kind)), [], []
        compress = zstandard.ZstdCompressor(level=1).compress
        for plane in range(width - 1, -1, -1):
            bits = (rest.to_numpy() >> kind.type(plane)).astype(np.uint8) & 1
            body = np.packbits(bits, bitorder="little").tobytes().ljust(-(-n // (64 * GROUP)) * 8 * GROUP, b"\0")
            ones = np.bitwise_count(np.frombuffer(body, "<u8")).reshape(-1, GROUP).sum(axis=1, dtype=np.int64)
            before = np.concatenate(([0], np.cumsum(ones))).astype("<u4")
            zeros.append(n - int(before[-1]))
            packed.append((compress(body), compress(before.tobytes())))
            is_one = pa.Array.from_buffers(pa.bool_(), n, [None, pa.py_buffer(body)])
            rest = pa.concat_arrays([rest.filter(pc.invert(is_one)), rest.filter(is_one)])
        return cls(n, zeros, packed)

    def to_bytes(self) -> bytes:
        parts = [HEADER.pack(MAGIC, len(self.packed), self.n)]
        for zero, (body, counts) in zip(self.zeros, self.packed, strict=True):
            parts += [PLANE.pack(zero, len(body), len(counts)), body, counts]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, raw: bytes) -> WaveletMatrix:
        magic, width, n = HEADER.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix")
        at, zeros, packed = HEADER.size, [], []
        for _ in range(width):
            zero, size, more = PLANE.unpack_from(raw, at)
            at += PLANE.size
            zeros.append(zero)
            packed.append((raw[at : at + size], raw[at + size : at + size + more]))
            at += size + more
        return cls(n, zeros, packed)

    def _bits(self, plane: int) -> np.ndarray:
        words = np.frombuffer(zstandard.ZstdDecompressor().decompress(self.packed[plane][0]), "<u8")
        if self.n - int(np.bitwise_count(words).sum()) != self.zeros[plane]:
            raise ValueError("damaged wavelet matrix")
        return words

    def _open(self, plane: int) -> tuple[np.ndarray, np.ndarray]:
        if plane not in self._opened:
            before = np.frombuffer(zstandard.ZstdDecompressor().decompress(self.packed[plane][1]), "<u4")
            self._opened[plane] = self._bits(plane), before
        return self._opened[plane]

    def _bit(self, plane: int, i: int) -> int:
        return int(self._open(plane)[0][i >> 6]) >> (i & 63) & 1

    def _ones(self, plane: int, i: int) -> int:
        """Ones among the first ``i`` bits."""
        words, before = self._open(plane)
        whole, part = divmod(i, 64)
        group = whole // GROUP
        ones = int(before[group]) + int(np.bitwise_count(words[group * GROUP : whole]).sum())
        return ones + (int(words[whole]) & ((1 << part) - 1)).bit_count() if part else ones

    def _step(self, plane: int, bit: int, i: int) -> int:
        ones = self._ones(plane, i)
        return self.zeros[plane] + ones if bit else i - ones

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for plane in range(len(self.packed)):
            bit = self._bit(plane, i)
            value = value << 1 | bit
            i = self._step(plane, bit, i)
        return value

    def count(self, symbol: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of ``symbol`` from ``start`` up to ``end``."""
        start, end = max(0, start), self.n if end is None else min(end, self.n)
        if symbol < 0 or symbol >> len(self.packed) or start >= end:
            return 0
        for plane in range(len(self.packed)):
            bit = symbol >> (len(self.packed) - 1 - plane) & 1
            start, end = self._step(plane, bit, start), self._step(plane, bit, end)
        return end - start

    def select(self, symbol: int, k: int) -> int:
        """Where the ``k``-th occurrence of ``symbol`` is, both counted from 0."""
        if not 0 <= k < self.count(symbol):
            raise IndexError(k)
        start = 0
        bits = [symbol >> (len(self.packed) - 1 - plane) & 1 for plane in range(len(self.packed))]
        for plane, bit in enumerate(bits):
            start = self._step(plane, bit, start)
        at = start + k
        for plane in range(len(self.packed) - 1, -1, -1):
            at = self._find(plane, bits[plane], at - self.zeros[plane] if bits[plane] else at)
        return at

    def _find(self, plane: int, bit: int, k: int) -> int:
        """Where the ``k``-th bit equal to ``bit`` is in a plane."""
        words, before = self._open(plane)
        before = before.astype(np.int64)
        if not bit:
            before = 64 * GROUP * np.arange(len(before)) - before
        group = int(np.searchsorted(before, k, side="right")) - 1
        left = k - int(before[group])
        for word in range(group * GROUP, (group + 1) * GROUP):
            value = int(words[word]) if bit else ~int(words[word]) & ((1 << 64) - 1)
            here = value.bit_count()
            if left >= here:
                left -= here
                continue
            for _ in range(left):
                value &= value - 1
            return 64 * word + (value & -value).bit_length() - 1
        raise AssertionError("rank and bits disagree")

    def occurrences(self, symbol: int) -> list[int]:
        return [self.select(symbol, k) for k in range(self.count(symbol))]

    def ids(self) -> np.ndarray:
        """All ids in order: the planes undone from the lowest to the highest."""
        kind = np.dtype(np.uint16 if len(self.packed) <= 16 else np.uint32)
        values = np.zeros(self.n, kind)
        for plane in range(len(self.packed) - 1, -1, -1):
            bits = np.unpackbits(self._bits(plane).view(np.uint8), count=self.n, bitorder="little").view(bool)
            zeros = self.zeros[plane]
            values[zeros:] |= kind.type(1 << (len(self.packed) - 1 - plane))
            merged = np.empty_like(values)
            merged[np.flatnonzero(bits)] = values[zeros:]
            merged[np.flatnonzero(~bits)] = values[:zeros]
            values = merged
        return values.astype(IDS)


def write_tokens(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str | None = None,
    end_id: int = 2,
    block_tokens: int = BLOCK_TOKENS,
) -> None:
    """Writes the ids of every text, each followed by ``end_id``, in ascending id order.

    Rows are range-partitioned and sorted by id (NULL first; rows that share an id by the key of their
    text). Each partition is a shard in a file of its own, a row for each block of about
    ``block_tokens`` ids: ``shard, block, start`` (ids before it in its shard), ``n_tokens, ids, lengths`` (of its
    documents) and ``matrix``, the wavelet matrix as bytes. NULL texts are like empty ones: the end id alone.
    A task holds one block and one Arrow batch of texts. No rows: no files but an empty table.
    """
    spark = docs.sparkSession
    let_workers_import(spark)
    vocabulary = tokenizer or default_tokenizer()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = rows.schema["id"].dataType
    ordered = rows.withColumn("key", F.xxhash64("text")).repartitionByRange("id", "key").sortWithinPartitions("id", "key")
    schema = T.StructType(
        [
            T.StructField("shard", T.IntegerType()),
            T.StructField("block", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.ArrayType(kind)),
            T.StructField("lengths", T.ArrayType(T.LongType())),
            T.StructField("matrix", T.BinaryType()),
        ]
    )
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).ids
        shard, block, start = TaskContext.get().partitionId(), 0, 0
        names, lengths, parts, total = [], [], [], 0

        def close() -> pa.RecordBatch:
            matrix = WaveletMatrix.of(np.concatenate(parts)).to_bytes()
            of_block = [pa.concat_arrays(names), pa.array(np.concatenate(lengths))]
            lists = [pa.ListArray.from_arrays([0, len(values)], values) for values in of_block]
            row = [shard, block, start, total, *lists, matrix]
            return pa.RecordBatch.from_arrays(
                [v.cast(f.type) if isinstance(v, pa.Array) else pa.array([v], f.type) for v, f in zip(row, arrow, strict=True)],
                schema=arrow,
            )

        for batch in batches:
            for first, n_texts in in_runs(batch.column(1)):
                some = batch.slice(first, n_texts)
                ids, n = with_end(*encode(some.column(1)), end_id)
                ends = np.cumsum(n)
                done = 0  # texts of this run that are in a block
                while done < n_texts:
                    before = int(ends[done - 1]) if done else 0
                    # Up to and with the text that fills the block.
                    last = min(int(np.searchsorted(ends, before + block_tokens - total)) + 1, n_texts)
                    names.append(some.column(0).slice(done, last - done))
                    lengths.append(n[done:last])
                    parts.append(ids[before : ends[last - 1]])
                    total += int(ends[last - 1]) - before
                    done = last
                    if total >= block_tokens:
                        yield close()
                        block, start = block + 1, start + total
                        names, lengths, parts, total = [], [], [], 0
        if names:
            yield close()

    ordered.select("id", "text").mapInArrow(blocks, schema).write.parquet(path)


def _bases(table: DataFrame) -> DataFrame:
    """``shard, base``: the tokens before each shard. Shards' totals, one row for each partition that was written,
    are added up on the driver; blocks and documents are not."""
    totals = sorted(table.groupBy("shard").agg(F.sum("n_tokens")).collect())
    bases, base = [], 0
    for shard, total in totals:
        bases.append((shard, base))
        base += total
    return F.broadcast(table.sparkSession.createDataFrame(bases, "shard int, base bigint"))


def _matrix_function(spark: SparkSession, ask: Callable[[WaveletMatrix, int], int]):
    """A column function of a block's matrix and a number: each matrix is opened, and only the planes that are asked for."""
    let_workers_import(spark)

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for matrices, numbers in batches:
            asked = zip(matrices, numbers.to_pylist(), strict=True)
            yield pa.array([ask(WaveletMatrix.from_bytes(matrix.as_py()), number) for matrix, number in asked], pa.int64())

    return F.arrow_udf(run, "bigint").asNondeterministic()


def token_counts(spark: SparkSession, path: str, symbols: Sequence[int]) -> DataFrame:
    """``symbol, n``: how often each of ``symbols`` (different ids) occurs in a token table, from its blocks' counts."""
    count = _matrix_function(spark, lambda matrix, symbol: matrix.count(symbol))
    asked = F.explode(F.lit(sorted(set(symbols))).cast("array<bigint>")).alias("symbol")
    blocks = spark.read.parquet(path).select("matrix", asked)
    found = blocks.select("symbol", count("matrix", "symbol").alias("n")).groupBy("symbol").agg(F.sum("n").alias("n"))
    every = spark.createDataFrame([(symbol,) for symbol in sorted(set(symbols))], "symbol bigint")
    return F.broadcast(every).join(found, "symbol", "left").select("symbol", F.coalesce("n", F.lit(0)).alias("n"))


def tokens_at(spark: SparkSession, path: str, offsets: Sequence[int]) -> DataFrame:
    """``offset, symbol``: the id at each of ``offsets`` (different numbers) among all ids of a token table; no row beyond it.

    Only the blocks that hold an offset are opened.
    """
    table = spark.read.parquet(path)
    begin = F.col("base") + F.col("start")
    inside = F.filter(
        F.lit(sorted(set(offsets))).cast("array<bigint>"), lambda at: (at >= begin) & (at < begin + F.col("n_tokens"))
    )
    asked = table.join(_bases(table), "shard").select("matrix", begin.alias("begin"), F.explode(inside).alias("offset"))
    access = _matrix_function(spark, lambda matrix, at: matrix.access(at))
    return asked.select("offset", access("matrix", F.col("offset") - F.col("begin")).alias("symbol"))


def occurrences(spark: SparkSession, path: str, symbol: int, which: Sequence[int]) -> DataFrame:
    """``k, offset``: where the ``k``-th occurrence of ``symbol`` is in a token table, both from 0, for each of ``which``.

    Counts of each block are added up within their shard and over the shards; only blocks that hold one of the
    occurrences are then opened to select it. No row for a ``k`` beyond the last one.
    """
    table = spark.read.parquet(path)
    count = _matrix_function(spark, lambda matrix, asked: matrix.count(asked))
    counted = stored(table.select("shard", "block", count("matrix", F.lit(symbol).cast("bigint")).alias("n_tokens")), "counts")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("base") + F.coalesce(F.sum("n_tokens").over(before), F.lit(0))
    inside = F.filter(
        F.lit(sorted(set(which))).cast("array<bigint>"), lambda k: (k >= F.col("first")) & (k < F.col("first") + F.col("n_tokens"))
    )
    holding = counted.join(_bases(counted), "shard").select("shard", "block", "n_tokens", first.alias("first"))
    holding = holding.select("shard", "block", "first", F.explode(inside).alias("k"))
    select = _matrix_function(spark, lambda matrix, k: matrix.select(symbol, k))
    blocks = table.join(_bases(table), "shard").join(F.broadcast(holding), ["shard", "block"])  # a row for each k at most
    return blocks.select(
        "k", (F.col("base") + F.col("start") + select("matrix", F.col("k") - F.col("first"))).alias("offset")
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` of every document of a token table, ``start`` over all shards.

    Decodes every block.
    """
    let_workers_import(spark)
    table = spark.read.parquet(path)
    kind = table.schema["ids"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("shard", T.IntegerType()),
            T.StructField("id", kind),
            T.StructField("at", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard, start, names, lengths, matrix = (column[row].as_py() for column in batch.columns)
                raw = WaveletMatrix.from_bytes(matrix).ids().tobytes()
                ends = np.cumsum(lengths)
                starts = ends - lengths
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                values = [[shard] * len(names), names, (start + starts).tolist(), lengths, crc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, f.type) for v, f in zip(values, arrow, strict=True)], schema=arrow
                )

    decoded = table.select("shard", "start", "ids", "lengths", "matrix").mapInArrow(documents, schema)
    return decoded.join(_bases(table), "shard").select(
        "id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def tokenized(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", tokenizer: str | None = None):
    """``write_tokens`` to a new place in the shared folder, and ``read_tokens`` from it."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, id_column, text_column, tokenizer)
    return read_tokens(docs.sparkSession, path)
