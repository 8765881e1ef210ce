"""A corpus cleaning job: each stage's rows are written, reread and handed to the next.

Toxic documents go, one document of each group of near copies stays, documents with
benchmark items go, secrets are masked, and what is left is encoded.

Every stage keeps null and empty texts as its operator does: they score like texts without a
chosen term, are copies of each other, contain no item and no secret, and have no ids. Rows
that repeat meet the same decision, near copies apart, of which one row stays. Columns
beside ``doc_id`` and ``text`` stay, whatever they are called; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fitloom.llm import decontaminate, secrets, sentencepiece, simhash, toxicity
from fitloom.llm.language import held_out
from fitloom.llm.queries import SENTENCEPIECE_MODEL
from fitloom.session import materialise

#: Encoded stretches that a worker keeps: it serves the other stages too, beside what it keeps.
KEPT = 30_000
#: Bytes of rows that go to a worker at once. Otherwise all texts of a task's slice may stand
#: several times, in the worker and in the buffers on both ways to it.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def small_batches(stage: Stage) -> Stage:
    """The stage with batches of about ``BATCH_BYTES``, unless the session has its own bound.

    The setting stays with the session, as the stage's rows are computed when they are asked for.
    """

    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(_BATCH, None) is None:
            spark.conf.set(_BATCH, str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return bounded


@small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go; labels of the held-out third are not learned from."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out("doc_id", 3, 1))
    return toxicity.without_toxic(docs, labels.select("doc_id", F.col("toxic").alias("y")))


@small_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, by shingles of five words."""
    return simhash.keep_one_of_each(docs)


@small_batches
def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@small_batches
def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts become their kind in angle brackets; every document stays."""
    return secrets.redacted(docs)


@small_batches
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return sentencepiece.encoded(docs, SENTENCEPIECE_MODEL, kept=KEPT)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("secrets", mask_secrets),
    ("sentencepiece", encode),
]

#: SQL can't express a learned score, near copies or an encoding; tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
