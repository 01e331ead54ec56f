"""The corpus pipeline: documents through the training-data operators, stage by stage.

Each stage takes (spark, docs, sf_dir), works on every document that the stage before it kept and
returns a DataFrame; all but the last return the columns of documents. NULL and empty texts fail
the quality rules and go no further; an empty table passes through as an empty table. Rows that
repeat a document are near-duplicates of it, so one of them stays; texts of any length are read
whole; columns of other names, also the operators' own, stay until the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import session
from millrace.llm import bpe, langid, mixing, quality, simhash
from millrace.llm.queries import reach
from millrace.llm.text import id_remainder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules or are depleted go; boilerplate lines leave the others' texts."""
    return quality.clean(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents whose id has not remainder 1; documents of no learned language go.

    How many of its n-grams a document must share with its language comes from the other labelled ones.
    """
    held = id_remainder(F.col("doc_id"), 3) == 1
    model = langid.learn(docs.where(~held))
    return langid.keep_identified(docs, model, least=langid.least_share(docs.where(held), model))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's rate says."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and digests of the ids and of the text decoded from them."""
    return bpe.code(docs, bpe.read_description(), keep=["doc_id", "source", "lang"], with_ids=True)


STAGES = [
    ("quality", quality_rules),
    ("language", language_id),
    ("simhash", near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]

ORACLE_SQL = None  # learned languages, fingerprints and the tokenizer are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's result is written and read again."""
    reach(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = session.settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
