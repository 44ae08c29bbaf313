"""The registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, mixing, near_dedup, spelling, substring_dedup, topk
from .common import documents, scratch


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_topk(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0, 5)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality

    docs = documents(spark, sf_dir)
    model = quality.train_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), quality.label_grade(), quality.GRADES)
    return quality.score_quality(docs, model)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(documents(spark, sf_dir), _vocabulary("word_bpe_49k.json"), 1)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import digest_documents

    return digest_documents(documents(spark, sf_dir), _vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity

    docs = documents(spark, sf_dir)
    return toxicity.score_toxicity(docs, toxicity.train_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(documents(spark, sf_dir))


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_store import read_tokens, write_tokens

    return read_tokens(write_tokens(documents(spark, sf_dir), f"{scratch(spark)}/tokens", _vocabulary("word_bpe_49k.json"), 2))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import session_key, surrogate_documents

    return surrogate_documents(documents(spark, sf_dir), session_key(spark))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .alignment import align_tokenizers

    return align_tokenizers(documents(spark, sf_dir), _vocabulary("byte_bpe_50k.json"), _vocabulary("piece_bpe_32k.model"))


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_plan(documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_topk,
        op2_quality,
        op3_exact_dedup,
        op4_near_dedup,
        op5_packing,
        op6_byte_bpe,
        op7_toxicity,
        op8_substring_dedup,
        op9_token_store,
        op10_pii,
        op11_spelling_variants,
        op12_tokenizer_alignment,
        op13_source_mix,
    )
}
ORACLES = {
    "op1_exact_topk": topk.ORACLE,
    "op3_exact_dedup": exact_dedup.ORACLE,
    "op4_near_dedup": near_dedup.ORACLE,
    "op8_substring_dedup": substring_dedup.ORACLE,
    "op13_source_mix": mixing.ORACLE,
}
