"""A corpus made ready for training: rules, classifier, near-duplicates, secrets, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and read
again as the next one's docs. All but the last return the columns of `documents`. Rejected documents and
all but one of each group of near copies go, live secrets are cut out of the texts, and what is left is
packed into sequences of 2048 tokens.

Null texts go with the rules, and so do empty ones; an empty table gives empty results. Very long texts are
worked on whole in every stage. Ties: of alike documents the one of least doc_id stays. Repeated rows: one stays of
those of one doc_id, also where their texts differ, as the group is told by its doc_id; rows without doc_id can't be
told apart and stay. Other columns are kept as they are, whatever their names, up to the packing.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm import minhash, nbsvm, packing, quality, secret_scan
from gaugeworks.llm.shared import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that keep to the rules."""
    return quality.keep_good(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.3 or more. It learns from the labelled rows of the whole table: the rules have left few bad ones here."""
    corpus, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return nbsvm.keep_good(docs, nbsvm.train(corpus, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of least doc_id, of each group whose 5-word shingles are alike to 0.8."""
    return minhash.keep_one(docs, size=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking secrets replaced by a mark; n_chars counts the new text."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=2048)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("packing", pack),
]

#: The classifier, the near-duplicate graph and the tokenizer can't be said in SQL; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
