"""The training corpus, stage by stage, from the documents table to packed sequences.

Every stage takes the documents its predecessor kept and is written to the shared folder before the next one
reads it, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from torqline.llm.common import TEXT_BATCH, stored, table
from torqline.llm.decontamination import without_phrases
from torqline.llm.exact import without_copies
from torqline.llm.jaccard import without_near_duplicates
from torqline.llm.packing import pack_documents
from torqline.llm.quality import fit_quality, quality_scores
from torqline.llm.samples import fold

QUALITY = 0.7
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
HELD_OUT = (4, 2)  # documents whose crc32(doc_id as text) leaves this rest teach the classifier nothing


def _short_batches(spark: SparkSession) -> None:
    """Whole texts go to Python workers a thousand rows at a time from here on.

    A stage is written after its function has returned, so this stays set. Executors and workers keep the memory of the
    largest batch they met for the stages that follow.
    """
    spark.conf.set(_BATCH_ROWS, str(min(TEXT_BATCH, int(spark.conf.get(_BATCH_ROWS)))))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    _short_batches(spark)
    parts, rest = HELD_OUT
    model = fit_quality(docs, table(spark, sf_dir, "labels"), learn=fold(F.col("doc_id"), parts) != rest)
    names = docs.columns
    return quality_scores(docs, model).filter(F.col("score") >= QUALITY).select(*[F.col(f"`{c}`") for c in names])


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return without_copies(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays."""
    return without_near_duplicates(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts they occur in; every document stays."""
    _short_batches(spark)
    return without_phrases(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 4096 tokens."""
    _short_batches(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", cut_benchmark),
    ("best-fit packing", pack),
]

# A learnt score and a packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
