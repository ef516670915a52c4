"""A training corpus from documents: five stages, each of which works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from groundplan.llm import minhash, packing, pii, quality, rules
from groundplan.scratch import Scratch


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores 0.5 or more; it is fitted to the labels that aren't held out."""
    return quality.keep(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the production policy keeps."""
    return rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return minhash.keep_one(docs)


def pii_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal values replaced by the session's key; n_chars follows the new text."""
    done = pii.pseudonymise(docs, pii.session_key(spark))
    return done.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else done


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("pii_pseudonyms", pii_pseudonyms),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over documents; each result but the last is a written table."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.save(docs, name)
    return docs


#: Neither the classifier nor near-duplicates are expressible in SQL.
ORACLE_SQL = None
