import zlib

import pytest
from pyspark.sql import functions as F

from roomtide.llm import language_id as li


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = li.identify(docs, li.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    for lang in {r.lang for r in rows}:
        of = [r.lang_pred == lang for r in rows if r.held_out and r.lang == lang]
        assert len(of) > 10 and sum(of) >= 0.97 * len(of)


def test_close_languages_are_told_apart_inside_their_family(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = li.learn(docs)
    assert model.languages == {"germanic": ["de", "en"], "romance": ["es", "fr"]} and len(model.weights) == 2 + 1 + 1
    assert [model.predict(t)[0] for t in ("Nicht der schtz, und von keiten.", "The of and ertioning wh.", "Les eauxtion, ément.", "La ción, que los ñado.")] == ["de", "en", "fr", "es"]


def test_only_training_rows_are_read(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    shuffled = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit(None))
    a, b = li.learn(docs), li.learn(shuffled)
    assert a.languages == b.languages and (a.weights == b.weights).all() and "xx" not in sum(b.languages.values(), [])


def test_one_machine_agrees_with_its_definition():
    """Squared hinge loss: the dual value of the rows inside the margin bounds the loss from below."""
    import numpy as np

    rng = np.random.default_rng(1)
    rows, y = [], np.where(np.arange(60) % 3 == 0, 1, -1)
    for side in y:
        at = np.sort(rng.choice(40, 8, replace=False)) + (20 if side > 0 else 0)
        x = rng.random(8)
        rows.append((at, x / np.linalg.norm(x)))
    w = li.descend(rows, y, 4.0, 500)
    dense = np.zeros((60, li.FEATURES + 1))
    for i, (at, x) in enumerate(rows):
        dense[i, at], dense[i, -1] = x, 1
    cost = np.where(y > 0, 4.0 * 60 / (2 * 20), 4.0 * 60 / (2 * 40))
    slack = np.maximum(0, 1 - y * (dense @ w))
    inside = 2 * cost * slack
    most = 0.5 * (w @ w) + (cost * slack**2).sum()
    least = inside.sum() - 0.5 * (((inside * y) @ dense) ** 2).sum() - (inside**2 / (4 * cost)).sum()
    assert least <= most <= 1.02 * least


def test_families():
    assert li.family_of("pt-BR") == li.family_of("es") == "romance" and li.family_of("en_GB") == "germanic"
    assert li.family_of("tlh") == "=tlh" and li.family_of("a", {"x": "a b"}) == "x"
    assert all(len(codes.split()) == len(set(codes.split())) for codes in li.FAMILIES.values())


def test_long_texts_count_whole():
    a, b = "der und nicht " * 3000, "the of and " * 20000
    model = li.fit([li.features(t) for t in ("der und nicht", "the of and")] * 4, ["de", "en"] * 4)
    assert model.predict(a + b)[0] == "en" and model.predict(a * 8 + b)[0] == "de" and model.predict("x" * 10**6)[0] in ("de", "en")
    whole = li.features(a + b)
    assert whole[0].max() < li.FEATURES and abs((whole[1] ** 2).sum() - 1) < 1e-3


def test_odd_rows(spark, odd, empty):
    rows = li.identify(odd, li.learn(odd)).collect()
    assert len(rows) == odd.count() and {r.lang_pred for r in rows} == {"en", "und"}
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in rows}
    assert by_id[2] == by_id[3] == by_id[4] == ("und", 0.0) and by_id[5] == ("en", 1.0)
    unknown = li.learn(empty)
    assert li.identify(empty, unknown).count() == 0
    assert {(r.lang_pred, r.score) for r in li.identify(odd, unknown).collect()} == {("und", 0.0)}
    digits = spark.createDataFrame([(1, "12 345 !?"), (1, "é"), (None, "中")], "doc_id bigint, text string")
    assert sorted(r.lang_pred for r in li.identify(digits, li.learn(odd)).collect()) == ["en", "en", "und"]


@pytest.mark.parametrize("most", [8, 40])
def test_the_sample_is_bounded_and_the_same_for_any_partitioning(spark, most):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a, b = li.learn(docs, most_rows=most), li.learn(docs.repartition(7), most_rows=most)
    assert (a.weights == b.weights).all()
