"""Corpus pipeline: quality, exact and near duplicates, personal data, packing; each stage works on what the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.llm import exact_dedup, near_dedup, pii, quality
from civiclake.llm.common import discard, scratch, store
from civiclake.llm.packing import pack_documents


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are well written with a probability of one half at least; rejected ones go.

    The model is fitted on labelled documents that the stage was given. Null and empty texts are judged by the cuts
    alone, long ones in whole; repeated rows share their fate; an empty table stays empty; other columns ride along.
    """
    model = quality.train_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), quality.label_grade(), quality.GRADES)
    return quality.keep_quality(docs, model)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the smallest id's. Null texts count as empty, long ones are compared in whole; repeated rows, ties and rows
    without an id leave one each; other columns ride along, whatever their names; an empty table stays empty."""
    return exact_dedup.exact_unique(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the smallest id's. Null and empty texts, rows without an id and repeated rows of a kept id
    stay; long texts are compared in whole; other columns ride along, whatever their names; an empty table stays empty."""
    return near_dedup.near_unique(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, detected entities replaced; n_chars follows the new text. Null texts keep theirs; long ones are searched in whole;
    repeated rows and ties get the same text; other columns ride along, whatever their names; an empty table stays empty."""
    out = pii.replace_entities(docs, pii.session_key(spark))
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of at most 2048 tokens, one row a piece. Null and empty texts are their end id alone, long ones are cut into pieces;
    repeated rows are packed like any other; other columns are left; an empty table gives no pieces."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 1)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("pii", personal_data),
    ("packing", packing),
]

#: A trained model, keyed surrogates and a tokenizer can't be told in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder before the next stage reads it."""
    folder, before = scratch(spark), None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), folder, name)
        if before:
            discard(spark, folder, before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
