"""The corpus pipeline: languages, near copies, benchmark passages, source weights, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as
the next stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontaminate, jaccard, langid, mixing, sharding
from tidemark.llm.common import table, unveiled, veiled
from tidemark.session import materialize

SHARDS = 16


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language that the profiles know; letterless and alien texts go."""
    own, names = veiled(docs)
    profiles = langid.fit_profiles(own, names["text"], names["lang"])
    return unveiled(langid.identify(own, profiles, names["text"]).where(langid.accepted()), names)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies."""
    own, names = veiled(docs)
    return unveiled(jaccard.one_of_each(own, names["doc_id"], names["text"]), names)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    own, names = veiled(docs)
    found = decontaminate.find_items(own, table(spark, sf_dir, "benchmark"), names["text"])
    return unveiled(found.where(F.size("hits") == 0), names)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources near their target weights, of whole documents; a document taken twice has two rows."""
    own, names = veiled(docs)
    got = mixing.mix(own, F.array(names["source"]), mixing.word_count(F.col(names["text"])), names["doc_id"])
    return unveiled(mixing.take_whole(got), names)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its size, its shard and its slot there; columns of these names are replaced."""
    return sharding.shard(docs, SHARDS)


STAGES = [("language_id", language), ("ngram_jaccard_join", one_of_each), ("benchmark_decontamination", without_benchmark),
          ("source_mix", mixed), ("sharding", shards)]

#: SQL can state neither the language profiles nor the fingerprints; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
