"""A training corpus from `documents`: languages, exact copies, near copies, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame; `run` writes what a stage returns
as Parquet in the shared work folder and hands it, read again, to the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storepulse.llm import exact_dedup, jaccard_join, language_id, packing, pii
from storepulse.llm.scratch import stage
from storepulse.llm.tables import fold, read
from storepulse.session import default_work_root

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document is rejected if it has no language, or if its mean probability is below this.
LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told. Those without a letter, and those on which the
    network cannot decide, go."""
    model = language_id.train(docs.filter(fold("doc_id", 3) != 1))
    told = language_id.identify(docs.select(*COLUMNS), model)
    return told.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is equal without white space."""
    return exact_dedup.drop_exact_duplicates(docs.select(*COLUMNS))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8. The one with the
    smallest doc_id stays; documents without words stay."""
    return jaccard_join.drop_near_duplicates(docs.select(*COLUMNS), width=5, percent=80)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by the names of their kinds; n_chars follows the text."""
    clean = pii.find_spans(docs.select(*COLUMNS), redact=True)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 2048 tokens: one row per piece of a document."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1, capacity=2048)


STAGES = [("language", language), ("exact", exact), ("near", near), ("private", private), ("packed", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    default_work_root(spark)
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: SQL can express neither the network nor the tokenizer; tests use brute force instead.
ORACLE_SQL = None
