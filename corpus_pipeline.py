"""A training corpus from raw documents: clean, without near copies and benchmark items, mixed and sharded.

Every stage takes the session, the documents its predecessor kept and the folder of the tables, and returns
documents with their columns as they are; the last one adds the place in the shards. A stage's result is
written and read back before the next, so a lost executor costs one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import hilbert, ngram_join, queries, templates, toxicity
from siltstone.session import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Shingles and similarity of near copies.
NEAR_WORDS, NEAR_NUM, NEAR_DEN = 5, 80, 100


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, queries.toxicity_model(spark, docs, sf_dir), queries.TOXIC_FROM)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs, words=NEAR_WORDS, num=NEAR_NUM, den=NEAR_DEN)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return templates.keep_uncontaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Whole rows are kept aside, so that no column of theirs meets one that the operator adds.
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_document")
    return queries.mixed(queries.measured(docs.select("doc_id", "source", "lang", "text", row))).where("mix_kept").select("_document.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    carried = [c for c in docs.columns if c != "doc_id"]
    return hilbert.shard_documents(docs, queries.SHARDS, carry=carried)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_copies),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Fitted weights, template matching and raked probabilities are beyond SQL; tests hold the rows to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
