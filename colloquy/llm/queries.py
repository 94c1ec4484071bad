"""One query for each operator of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sql


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Place of a public tokenizer file; every operator takes the place as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import round_trip

    return round_trip(_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality

    return quality(_table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_duplicates

    return exact_duplicates(_table(spark, sf_dir, "documents")).drop("bucket", "chain")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines

    out = dedup_lines(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import scan

    return scan(_table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents")).drop("spans")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .classifier import classify, graded

    return classify(_table(spark, sf_dir, "documents"), graded(_table(spark, sf_dir, "labels")))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import similar_components

    return similar_components(_table(spark, sf_dir, "documents"), size=4, percent=85)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import identify

    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    out = identify(docs, ~held_out & F.col("doc_id").isNotNull())
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_line_dedup": op2_line_dedup,
    "op3_secrets": op3_secrets,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_quality": op5_quality,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_ngram_join": op8_ngram_join,
    "op9_language_id": op9_language_id,
    "op10_packing": op10_packing,
}

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": sql.LINE_DEDUP,
    "op5_quality": sql.QUALITY,
    "op6_exact_dedup": sql.EXACT_DEDUP,
}
