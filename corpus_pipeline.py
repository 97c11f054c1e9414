"""Documents to token ids: good texts, one of each group of near copies, no secrets, mixed to target weights, encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet and reads again as the next stage's ``docs``. All but the
last return the columns of documents; rows with nulls, empty texts, repeated
rows and further columns pass as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roomtide.llm import bpe, mixing, ngram_join, quality_classifier, secret_scan
from roomtide.llm.queries import tokenizer_path
from roomtide.session import scratch_path


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = quality_classifier.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_classifier.keep_good(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of near copies (five words, 80 percent) stays."""
    return ngram_join.first_of_each(docs, width=5, percent=80)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets, also encoded ones, are masked; ``n_chars`` follows the text."""
    return secret_scan.mask_secrets(docs, n_chars="n_chars")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens have the target shares of sources, languages and topics."""
    return mixing.sample(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, and the hash of the text decoded from them."""
    path = scratch_path(spark, "encoded")
    # stored between, so that an executor has one Python worker for each running task, not two
    bpe.encode(docs.select("doc_id", "lang", "source", "text"), tokenizer_path()).write.parquet(path)
    return bpe.decode(spark.read.parquet(path), tokenizer_path()).selectExpr(
        "doc_id", "lang", "source", "n_tokens", "ids", "sha2(decoded, 256) as decoded_sha256", "decoded = coalesce(text, '') as same_text"
    )


STAGES = [
    ("quality classifier", good_texts),
    ("n-gram Jaccard join", one_of_each),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mixed),
    ("BPE encoding and decoding", token_ids),
]

#: The classifier and the encoder can't be expressed in SQL; tests/llm holds every stage and the whole against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
