"""Corpus pipeline: five stages over ``documents``, each stored as Parquet before the next.

A stage takes all rows its predecessor kept. All but the last return the
columns of ``documents``, mix with the row's place as one column more:

* language_id drops the rows that language identification rejects;
* near_duplicates keeps one document of each group of near copies;
* decontaminate drops the documents that the contamination rule names; texts of the others are untouched;
* mix keeps every row and stores them in the order that interleaves the sources by their target weights,
  with their place in it as POSITION;
* shard gives each row its shard and its place in it: the slots of a shard follow the mixture.

Rows with null columns pass as each operator's docstring says.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from terracell.llm.common import materialize, scratch_path, small_batches, table
from terracell.llm.decontam import decontaminate
from terracell.llm.jaccard import keep_one
from terracell.llm.langid import identify
from terracell.llm.mixing import in_order, mix
from terracell.llm.sharding import shard

SHARDS = 16
POSITION = "mix_position"


def apart(docs: DataFrame, work) -> DataFrame:
    """The columns of ``docs`` in ``work`` of it, kept from being replaced by columns of the same name that ``work`` adds."""
    held = {c: f"_own_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "lang", "source")}
    out = work(docs.withColumnsRenamed(held))
    return out.select(*[F.col(held.get(c, c)).alias(c) for c in docs.columns])


def bounded(stage):
    """``stage`` with small batches for what it runs, so that stages of one session leave memory to each other."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with small_batches(spark):
            return stage(spark, docs, sf_dir)
    return run_stage


@bounded
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return apart(docs, lambda rows: identify(rows).where("accepted"))


@bounded
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


@bounded
def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    return apart(docs, lambda rows: decontaminate(rows, items).where("NOT contaminated"))


@bounded
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return in_order(docs, mix(docs), position=POSITION)


@bounded
def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard(docs, scratch_path(spark, "slot-map"), SHARDS, position=POSITION)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontaminate", clean_of_benchmark),
    ("mix", mixture),
    ("shard", shards),
]

# Character models, scheduling and balancing have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
