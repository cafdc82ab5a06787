"""A training corpus from documents: drop toxic texts, exact copies and near duplicates, mix sources, pack tokens.

Each stage takes the whole of what its predecessor kept, as a written table;
all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanweave.llm import exact_dedup, jaccard_join, mix_sources, packing, toxicity
from spanweave.llm.common import table
from spanweave.scratch import Scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(toxicity.training_sample(docs, table(spark, sf_dir, "labels")))
    return toxicity.score_toxicity(docs, model).filter("predicted = 0").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs).filter("kept").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five words a shingle and a similarity of 0.8; the smallest identifier of each group stays."""
    return jaccard_join.keep_one_of_each(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources.mix_sources(docs, mix_sources.WEIGHTS, mix_sources.REST).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_duplicates),
    ("mix_sources", mix),
    ("packing", pack),
]

#: SQL has no string-kernel machine and no tokenizer; tests hold single operators, not this chain, against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of documents; every stage's result is written and read again."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return docs
