"""Corpus pipeline: quality rules, exact dedup, near dedup, source mix, packing.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor
kept; all but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import exact_dedup, mixing, ngram_join, packing, quality
from ledgerlake.llm.common import read, shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_docs(docs, read(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_docs(docs)


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_copies), ("ngram_jaccard_join", near_copies),
          ("source_mixing", source_mix), ("best_fit_packing", pack)]

#: tokenized packing is beyond SQL; the operators are tested one by one, the rows the pipeline's stages keep are not compared yet
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
