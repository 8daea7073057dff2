"""From raw documents to packed training sequences: stages in order, each written before the next reads it.

quality draws as large a share as the labels call good, by importance weights; exact_dedup leaves the
smallest doc_id of equal texts, near_dedup one document of each group of near copies; mixing repeats or
leaves out documents by their rates; packing gives the pieces and their places in sequences.

Defined results: a null text is an empty one; null ids are kept and come last where ids decide; repeated
rows are one document after exact_dedup; without good labels all documents pass the first stage; without
languages all rates are 1; all columns pass through up to packing, whatever their names; an empty table
gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evidra.llm import exact_dedup, mixing, near_dedup, packing, resampling
from evidra.llm.common import Scratch, table
from evidra.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return resampling.keep(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, vocabulary())


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("packing", pack)]
#: Models, hashes and greedy packing are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs
