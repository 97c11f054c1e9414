"""One query for each operator, over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roomtide.llm import bpe, curve_search, fill_middle, html_text, language_id, mixing, ngram_join, quality_classifier, quality_rules, secret_scan, suffix_tree, token_files, vector_codes
from roomtide.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(_table(spark, sf_dir, "documents"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    token_files.write(_table(spark, sf_dir, "documents"), folder, tokenizer_path(), end_id=END_ID)
    return token_files.read(spark, folder, ids=False)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(_table(spark, sf_dir, "documents"))


def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(_table(spark, sf_dir, "documents"))


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judge(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(_table(spark, sf_dir, "documents"))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_classifier.score(docs, quality_classifier.learn(docs, _table(spark, sf_dir, "labels")))


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_search.nearest(_table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


def round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path())


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(_table(spark, sf_dir, "embeddings"))


def cut_in_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(_table(spark, sf_dir, "documents"))


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.learn(docs))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixing": mix, "op2_token_files": tokens, "op3_html_text": pages, "op4_secrets": secrets, "op5_ngram_join": near_copies,
        "op6_quality_rules": rules, "op7_suffix_tree": language_model, "op8_quality_classifier": classified, "op9_curve_search": neighbours,
        "op10_bpe": round_trip, "op11_vector_codes": codes, "op12_fill_middle": cut_in_three, "op13_language_id": languages, "pipeline": pipeline,
    }
