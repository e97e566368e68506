"""A training corpus from ``documents``: quality rules, near-duplicates, benchmark passages, secrets, packing.

Each stage works on all rows the one before it kept. All but the last return the columns of documents; extra columns stay as
they are. NULL and empty texts go with the first stage; a stage given them keeps them, as one group of near-duplicates. Repeated
rows are one document from the second stage on. An empty table gives an empty one, after any stage and in the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import decontaminate, packing, quality_rules, secrets, simhash
from larder.llm.queries import Query, piece_digests
from larder.llm.texts import stored

# No SQL: votes are fitted, fingerprints hashed and texts tokenized.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go, NULL and empty texts among them."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the least id.

    Groups are those of ``op1_simhash`` by its contract: 4-word shingles, links at 4 or fewer of 64 differing bits, and no
    other check of similarity. Near copies further apart stay.
    """
    return simhash.deduplicate(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go: those with a twentieth of their words in benchmark windows. Without a benchmark all stay."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark, and ``n_chars``, where there is one, follows."""
    clean = secrets.without_secrets(docs)
    if "n_chars" not in clean.columns:
        return clean
    kind = clean.schema["n_chars"].dataType
    length = F.when(F.col("n_chars").isNotNull(), F.char_length("text")).cast(kind)
    return clean.withColumn("n_chars", length)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 ids."""
    return piece_digests(packing.packed(docs))


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("decontamination", benchmark_passages),
    ("secret scans", secret_values),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read back by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERY = Query(run, ORACLE_SQL)
