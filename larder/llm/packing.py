"""Packing by concatenation: documents one after the other, cut into windows of fixed length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from larder.llm.texts import let_workers_import
from larder.llm.tokens import IDS, default_tokenizer, encoder, in_runs, with_end
from larder.sources.shared import scratch_path

# Less than the encoder's own, as packing is the last of many stages in the same workers: words that are remembered, and
# bytes of text that are encoded at a time.
REMEMBERED_WORDS = 500_000
TEXT_BYTES = 4 << 20


def encoded(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", tokenizer: str | None = None, end_id: int = 0
) -> DataFrame:
    """First pass: ``part, at, id, n, ids``, stored. Texts stay in the partitions they are in.

    ``at`` is the number of ids before the document in its partition ``part``, and ``ids`` its ids with
    ``end_id`` as little-endian unsigned 32-bit integers. NULL texts are like empty ones.
    """
    spark = docs.sparkSession
    let_workers_import(spark)
    vocabulary = tokenizer or default_tokenizer()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("at", T.LongType()),
            T.StructField("id", rows.schema["id"].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts_to_ids = encoder(vocabulary, REMEMBERED_WORDS).ids
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start, n_texts in in_runs(batch.column(1), TEXT_BYTES):
                some = batch.slice(start, n_texts)
                ids, n = with_end(*texts_to_ids(some.column(1)), end_id)
                ends = at + np.cumsum(n)
                bounds = np.concatenate(([0], IDS.itemsize * np.cumsum(n))).astype(np.int32)
                raw = pa.Array.from_buffers(pa.binary(), n_texts, [None, pa.py_buffer(bounds), pa.py_buffer(ids)])
                values = [np.full(n_texts, part, np.int32), ends - n, some.column(0), n, raw]
                at = int(ends[-1])
                yield pa.RecordBatch.from_arrays(
                    [v.cast(f.type) if isinstance(v, pa.Array) else pa.array(v, f.type) for v, f in zip(values, arrow, strict=True)],
                    schema=arrow,
                )
                del some, ids, raw, values
                pa.default_memory_pool().release_unused()

    path = scratch_path(spark, "ids")
    rows.mapInArrow(encode, schema).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def pieces(first_pass: DataFrame, length: int = 1024) -> DataFrame:
    """Second pass: ``id, start, length, doc_tokens, sequence_id, offset, ids`` of every piece.

    The partitions' token totals, one row each, are added up on the driver; with them each document
    knows its place among all ids, and windows of ``length`` ids cut it into pieces. These are the
    boundary records of the sequences: only the last sequence can be shorter than ``length``.
    """
    spark = first_pass.sparkSession
    totals = sorted(first_pass.groupBy("part").agg(F.max(F.col("at") + F.col("n"))).collect())
    bases, base = [], 0
    for part, total in totals:
        bases.append((part, base))
        base += total
    known = spark.createDataFrame(bases, "part int, base bigint")
    placed = first_pass.join(F.broadcast(known), "part").select(
        "id", "n", "ids", (F.col("base") + F.col("at")).alias("first")
    )
    window = F.lit(length).cast("bigint")
    windows = F.sequence(F.expr(f"first div {length}"), F.expr(f"(first + n - 1) div {length}"))
    cut = placed.select("*", F.explode(windows).alias("sequence_id"))
    begin = F.greatest(F.col("first"), F.col("sequence_id") * window)
    end = F.least(F.col("first") + F.col("n"), (F.col("sequence_id") + 1) * window)
    start, size = begin - F.col("first"), end - begin
    return cut.select(
        "id",
        start.alias("start"),
        size.alias("length"),
        F.col("n").alias("doc_tokens"),
        "sequence_id",
        (begin % window).alias("offset"),
        F.substring("ids", (start * 4 + 1).cast("int"), (size * 4).cast("int")).alias("ids"),
    )


def packed(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str | None = None,
    end_id: int = 0,
    length: int = 1024,
) -> DataFrame:
    """Every piece of every document of ``docs``, in sequences of ``length`` ids.

    A NULL or empty text is its end id alone; repeated rows and NULL ids are documents like any other. An
    empty table gives no pieces. Other columns are not looked at.
    """
    return pieces(encoded(docs, id_column, text_column, tokenizer, end_id), length)


def sequences(cut: DataFrame, length: int = 1024, pad_id: int = 0) -> DataFrame:
    """``sequence_id, n_tokens, ids`` of every sequence: its pieces joined, at most ``length`` ids.

    The last one is padded to ``length`` with ``pad_id``, unless the number of its ids is a power of two.
    """
    pad = np.array([pad_id], IDS).tobytes()
    joined = cut.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("pieces")
    )
    body = F.aggregate("pieces", F.lit(b""), lambda all_, piece: F.concat(all_, piece["ids"]))
    missing = F.when(F.bit_count("n_tokens") == 1, 0).otherwise(F.lit(length) - F.col("n_tokens"))
    filler = F.unhex(F.repeat(F.lit(pad.hex()), missing.cast("int")))
    return joined.select("sequence_id", "n_tokens", F.concat(body, filler).alias("ids"))
