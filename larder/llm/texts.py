"""What the text operators share: word splitting, functions over whole texts, stored steps."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.sources.shared import scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# Bytes of rows, written out as JSON, up to which they are broadcast.
BROADCAST_BYTES = 64 << 20
# bytes.translate table that lower-cases A-Z and nothing else
ASCII_LOWER = bytes(ord(chr(b).lower()) if b < 128 else b for b in range(256))


def let_workers_import(spark: SparkSession) -> None:
    """Puts this library on the Python path of local workers; clusters get it by ``--py-files``."""
    context = spark.sparkContext
    if context.master.startswith("local"):
        context.environment.setdefault("PYTHONPATH", ROOT)


def text_function(
    spark: SparkSession, make: Callable[[], Callable[[Sequence[str | None]], pa.Array]], returns: str
):
    """A column function over texts: ``make()`` is called once per task, its result per Arrow batch.

    Batches hold whole texts and at most ``spark.sql.execution.arrow.maxBytesPerBatch`` of them.
    It counts as nondeterministic only so that the optimizer never evaluates it twice.
    """
    let_workers_import(spark)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = make()
        for batch in batches:
            yield work(batch.to_pylist())

    return F.arrow_udf(run, returns).asNondeterministic()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so that its lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_light(df: DataFrame, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` stored, with a broadcast hint only if its values, written out, take at most ``most_bytes``.

    For rows of any width. Larger frames come back without a hint, for Spark to shuffle.
    """
    kept = stored(df, "light")
    total = kept.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("bigint"))).first()[0] or 0
    return F.broadcast(kept) if total <= most_bytes else kept


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened until they clash with no column of ``df`` in any letter case."""
    taken = {column.lower() for column in df.columns}
    free = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        free.append(name)
    return free


def text_key(text: Column | str) -> Column:
    """32 bytes that tell texts apart; NULL counts as a text of its own."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.unhex(F.sha2(column, 256)), F.lit(b""))


def folded_words(text: str | None) -> list[bytes]:
    """The text's words between ASCII white space, A-Z lower-cased, as UTF-8."""
    return text.encode().translate(ASCII_LOWER).split() if text else []
