"""From documents to shuffled shards of a training mix.

Each stage is written as Parquet and read again as the next one's documents. All stages but
the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagloom.llm.decontamination import clean_documents
from tagloom.llm.mixing import mixed_documents
from tagloom.llm.ngram_join import one_of_each
from tagloom.llm.quality import good_documents
from tagloom.llm.queries import trusted_ids
from tagloom.llm.scratch import Scratch, let_workers_import, read
from tagloom.llm.sharding import sharded

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within their language's threshold."""
    let_workers_import(spark)
    return good_documents(docs, trusted_ids(spark, sf_dir))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the least id."""
    let_workers_import(spark)
    return one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    let_workers_import(spark)
    return clean_documents(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source comes near its target; documents are repeated or left out for it."""
    let_workers_import(spark)
    return mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """16 shuffled shards of equal rows: the documents with ``shard`` and ``slot``."""
    let_workers_import(spark)
    return sharded(docs, shards=16)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("similar", keep_one_of_each),
    ("benchmark", drop_benchmark),
    ("mix", mix_sources),
    ("shard", shard),
]

ORACLE_SQL: str | None = None  # perplexities, projections and seeds are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = read(spark, sf_dir, "documents"), Scratch(spark)
    for _, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return docs
