"""The corpus pipeline: documents in, binary token output out.

Each stage takes `(spark, docs, sf_dir)` and returns a DataFrame that is written as Parquet
and reread as the next stage's documents. All but the last return the columns of documents.

1. toxicity: documents that the classifier rejects go;
2. near duplicates: one document of each class stays;
3. decontamination: documents contaminated by the benchmark go;
4. mixing: documents stand as often as the mix of sources takes them;
5. tokens: binary token shards, and one row per document read back from them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dockwise.llm import decontam, mixing, near_dup, tokens, toxicity
from dockwise.llm.common import ship_package, stage
from dockwise.llm.queries import TOKENIZER

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scoring below the threshold, by a classifier fitted on the labelled ones."""
    ship_package(spark)
    return toxicity.clean_documents(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate class."""
    ship_package(spark)
    return near_dup.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words is benchmark text."""
    ship_package(spark)
    return decontam.clean_documents(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, repeated as often as the mix takes them."""
    ship_package(spark)
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards; `doc_id, start, n_tokens, ids_crc32` of every document in them."""
    ship_package(spark)
    # A small word cache, dropped at the end: executors of a pipeline serve other stages too.
    return tokens.round_trip(spark, docs, TOKENIZER, cache=tokens.CACHE // 4, forget=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("near_dup", drop_near_duplicates),
    ("decontam", decontaminate),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

# Training, signatures and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the folder's documents; the last stage's rows."""
    docs = _table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
