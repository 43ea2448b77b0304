"""From raw documents to packed training sequences: five operators, each over what the one before kept."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright import ship
from framewright.llm import common, decontaminate, line_dedup, near_dedup, packing, toxicity


@contextmanager
def stage(spark: SparkSession) -> Iterator[None]:
    """Executors have the package; the result before has been written by now, so what its operator left in the shared folder goes."""
    ship(spark)
    common.free("stage")
    with common.owned("stage"):
        yield


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar doesn't reject. It is taught by the labels and the documents of sf_dir."""
    with stage(spark):
        grammar = toxicity.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
        return toxicity.without_toxic(docs, grammar)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of lines, alone or in runs; n_chars, if there, follows the text."""
    with stage(spark):
        left = line_dedup.dedup_lines(spark, docs)
    if "n_chars" not in docs.columns:
        return left
    return left.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by three fingerprints of the words that a text has."""
    with stage(spark):
        return near_dedup.one_of_each(spark, docs, features=near_dedup.WORD_SETS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in passages of test items."""
    with stage(spark):
        return decontaminate.without_contaminated(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of at most 1024 tokens."""
    with stage(spark):
        return packing.pack(spark, docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: Stages learn from labels, hash with XXH64 and encode with a tokenizer, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each stage's rows written to the shared folder and read again."""
    scratch = common.Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, f in STAGES[:-1]:
        docs = scratch.table(f(spark, docs, sf_dir), name)
    packed = STAGES[-1][1](spark, docs, sf_dir)
    common.hand_over("stage", "pipeline")
    return packed
