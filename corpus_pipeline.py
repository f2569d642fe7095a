"""Corpus preparation: five stages over ``documents``, each one operator of ``pulseline.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes it as Parquet to the shared folder and reads it back as the next
stage's ``docs``. All but the last return the columns of ``docs``. Models are
learned from the labelled rows of the given ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pulseline.llm import near_dedup, packing, quality_classifier, quality_rules, secrets
from pulseline.llm.common import staged, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned rules keep."""
    rules = quality_rules.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_rules.filter_documents(docs, rules)


def by_score(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression score predicts to be good."""
    model = quality_classifier.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_classifier.filter_documents(docs, model)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    return near_dedup.drop_copies(docs, near_dedup.Params(words=5))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked; ``n_chars`` follows where a text changed."""
    return secrets.mask_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their ids and place in the packed sequences."""
    with open(TOKENIZER, encoding="utf-8") as file:
        spec = file.read()
    return packing.pack_documents(docs, spec, public_tokenizers.PATTERN)


STAGES = [("quality rules", by_rules), ("quality classifier", by_score),
          ("near duplicates", without_copies), ("secrets", without_secrets), ("packing", packed)]

# learned models and near duplicates: tested against brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
