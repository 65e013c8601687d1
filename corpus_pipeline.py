"""The corpus pipeline: language ID, near-dedup, benchmark decontamination, mixing, sharding.

Each stage works on all that its predecessor kept, and its decisions take effect: undetermined languages go, one document
of each near-duplicate class stays, documents that hold a benchmark item go, the mix repeats or leaves documents, and the
last stage names each document's shard and slot, beside all its columns but the text. All others return the columns of
`documents`, whatever columns it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larkspur.llm import common, decontamination, language_id, mixing, near_dedup, sharding


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs, language_id.references(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicate(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.assign(docs, keep=tuple(c for c in docs.columns if c not in ("doc_id", "text")))


STAGES = [
    ("op10_language_id", identify_language),
    ("op7_near_dedup", drop_near_duplicates),
    ("op1_decontamination", drop_benchmark_leaks),
    ("op2_mixing", mix_sources),
    ("op6_sharding", deal_shards),
]

#: SQL cannot express suffix automata, dart signatures and the cube method; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's result is written and read again, and goes once the next is written.

    The folder that the last stage reads stays, as the result is read from it.
    """
    docs, earlier = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = common.table(docs)
            if earlier is not None:
                common.forget(earlier)
            earlier = docs
    return docs
