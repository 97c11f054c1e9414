import pytest
from pyspark.sql import functions as F

ODD = [
    (1, "The same words stand here twice, more or less, in one short text."),
    (1, "The same words stand here twice, more or less, in one short text."),
    (2, None), (3, ""), (None, "a null id has a text all the same"), (4, " \n\t "), (5, "One"), (6, "x" * 5000), (7, "word " * 3000),
    (8, "é ñ 中文 😀 \x1c\x85"), (9, "password = hunter2secret and <|endoftext|>"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns named like outputs and inner columns."""
    df = spark.createDataFrame([(i, t, "en", None if i == 5 else "s", None if t is None else len(t)) for i, t in ODD], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name in ("score", "ids", "n_tokens", "component_id", "kept", "key", "weight", "topic", "value", "held_out"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
