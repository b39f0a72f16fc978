"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from patchloom.llm import line_dedup

    return line_dedup.line_report(_table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from patchloom.llm import quality

    return quality.predictions(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from patchloom.llm import license_scan

    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op4_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from patchloom.llm import gif

    return gif.media_digests(_table(spark, sf_dir, "documents"))


def op5_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from patchloom.llm import warc

    return warc.derivatives(warc.responses_from_pages(_table(spark, sf_dir, "pages")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from patchloom.llm import toxicity

    return toxicity.predictions(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from patchloom.llm import packing

    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from patchloom.llm import suffix_dedup

    return suffix_dedup.report(_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from patchloom.llm import decontamination

    return decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from patchloom.llm import ngram_join

    return ngram_join.components(_table(spark, sf_dir, "documents"))


def op11_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from patchloom.llm import lm_score

    return lm_score.score(_table(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from patchloom.llm import divergence

    return divergence.divergence(_table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from patchloom.llm import lexical

    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_quality": op2_quality,
        "op3_license_scan": op3_license_scan,
        "op4_gif_media": op4_gif_media,
        "op5_warc_derivatives": op5_warc_derivatives,
        "op6_toxicity": op6_toxicity,
        "op7_packing": op7_packing,
        "op8_suffix_dedup": op8_suffix_dedup,
        "op9_decontamination": op9_decontamination,
        "op10_ngram_join": op10_ngram_join,
        "op11_lm_score": op11_lm_score,
        "op12_divergence": op12_divergence,
        "op13_lexical_search": op13_lexical_search,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    from patchloom.llm import decontamination, divergence, lexical, license_scan, line_dedup, lm_score, ngram_join, suffix_dedup, warc

    return {
        "op1_line_dedup": line_dedup.ORACLE_SQL,
        "op3_license_scan": license_scan.oracle_sql(),
        "op5_warc_derivatives": warc.oracle_sql(),
        "op8_suffix_dedup": suffix_dedup.ORACLE_SQL,
        "op9_decontamination": decontamination.ORACLE_SQL,
        "op10_ngram_join": ngram_join.ORACLE_SQL,
        "op11_lm_score": lm_score.ORACLE_SQL,
        "op12_divergence": divergence.ORACLE_SQL,
        "op13_lexical_search": lexical.ORACLE_SQL,
    }
