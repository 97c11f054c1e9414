from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from roomtide.llm import bpe, ngram_join, quality_classifier, secret_scan, suffix_tree, text
from roomtide.llm.oracles import mixing_sql
from roomtide.llm.queries import llm_queries, tokenizer_path


def test_queries_are_registered():
    assert set(llm_queries()) <= set(queries()) and {"op1_mixing", "op5_ngram_join"} <= set(oracle_sql())
    assert len(corpus_pipeline.STAGES) == 5


def test_masking_and_encoding_stages(spark, odd):
    masked = corpus_pipeline.without_secrets(spark, odd, "")
    assert masked.columns == odd.columns and masked.count() == odd.count()
    rows = corpus_pipeline.token_ids(spark, masked, "").collect()
    assert len(rows) == odd.count() and all(r.same_text and len(r.ids) == r.n_tokens for r in rows)


def test_near_copies_equal_brute_force_at_five_words_and_80_percent(spark, documents):
    text = [f"w{k}" for k in range(200)]
    changed = [f"x{k}" if k % 50 == 25 else w for k, w in enumerate(text)]
    far = [f"y{k}" if k % 25 == 12 else w for k, w in enumerate(text)]
    copies = [text, text + [f"z{k}" for k in range(30)], changed, far]
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    least = max(i for i, _ in rows) + 1
    rows += [(least + k, " ".join(w)) for k, w in enumerate(copies)]
    sets = []
    for _, t in rows:
        w = ngram_join.words((t or "").encode())
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and group[a] != group[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                group = [group[a] if g == group[b] else g for g in group]
    first = {}
    for (i, _), g in zip(rows, group):
        first[g] = min(i, first.get(g, i))
    kept = corpus_pipeline.one_of_each(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(first.values())
    assert least in first.values() and not {least + 1, least + 2} & set(first.values()) and least + 3 in first.values()


def survivors(rows, width=5, percent=80):
    """Ids that stay of (id, text) rows: the smallest of each component, by comparing all sets with all sets."""
    sets = []
    for _, t in rows:
        w = ngram_join.words((t or "").encode())
        sets.append({tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and group[a] != group[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                group = [group[a] if g == group[b] else g for g in group]
    first = {}
    for (i, _), g in zip(rows, group):
        if i is not None:
            first[g] = min(i, first.get(g, i))
    return {first.get(g) for (_, t), g in zip(rows, group) if ngram_join.words((t or "").encode())}, {i for i, t in rows if not ngram_join.words((t or "").encode())}


@pytest.fixture(scope="module")
def small(spark, odd, tmp_path_factory):
    """A folder with documents, some of them odd, and labels; further columns have the names of outputs."""
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = odd.select(*docs.columns).where("doc_id is null or doc_id in (2, 3, 4, 9)").withColumn("doc_id", F.expr("if(doc_id is null, null, doc_id + 100000)"))
    every = docs.unionByName(extra).unionByName(docs.limit(3))
    for name in ("score", "ids", "kept", "component_id", "topic"):
        every = every.withColumn(name, F.lit("clash"))
    every.write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_good_texts_are_those_the_model_scores_so(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = quality_classifier.learn(docs, spark.read.parquet(f"{small}/labels.parquet"))
    kept = corpus_pipeline.good_texts(spark, docs, small)
    assert kept.columns == docs.columns
    scored = lambda t: 0.5 if model is None else float(model.scores(np.array([quality_classifier.shape((t or "").encode())]))[0])
    expected = [tuple(r) for r in docs.collect() if scored(r.text) >= 0.3]
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(expected, key=repr) and 0 < len(expected) < docs.count()


def test_mixed_equals_the_sql_of_raking(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = corpus_pipeline.mixed(spark, docs, small)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(mixed_by_sql([r.asDict() for r in docs.collect()]))


def mixed_by_sql(rows):
    con = duckdb.connect()
    table = pa.table({c: pa.array([r[c] for r in rows], k) for c, k in (("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()))})
    con.register("documents", table)
    # a row joins its cell once; equal rows stay equal in number
    return [str(i) for i, kept in con.execute(f"select doc_id, kept from ({mixing_sql(sweeps=40)})").fetchall() if kept]


def test_run_equals_the_stages_one_by_one(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = quality_classifier.learn(docs, spark.read.parquet(f"{small}/labels.parquet"))
    rows = [r.asDict() for r in docs.collect()]
    shapes = np.array([quality_classifier.shape((r["text"] or "").encode()) for r in rows])
    rows = [r for r, s in zip(rows, np.full(len(rows), 0.5) if model is None else model.scores(shapes)) if s >= 0.3]
    stay, empty = survivors([(r["doc_id"], r["text"]) for r in rows])
    rows = [r for r in rows if r["doc_id"] is None or r["doc_id"] in stay or r["doc_id"] in empty]
    for r in rows:
        r["text"] = r["text"] and secret_scan.masked(r["text"], secret_scan.scan(r["text"])[1])
    left = Counter(mixed_by_sql(rows))
    library = Tokenizer.from_file(tokenizer_path())
    expected = sorted((str(r["doc_id"]), library.encode(r["text"] or "", add_special_tokens=False).ids) for r in rows if left[str(r["doc_id"])])
    got = corpus_pipeline.run(spark, small).collect()
    assert all(r.same_text for r in got)
    assert sorted((str(r.doc_id), list(r.ids)) for r in got) == expected and expected


def test_run_on_empty_tables(spark, small, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{small}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_encoding_and_decoding_take_one_python_worker_of_a_task(spark, odd):
    """Two Python functions in one stage keep two workers for each running task, with the tables of both."""
    plan = corpus_pipeline.token_ids(spark, odd, "")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert not hasattr(bpe.decoder(tokenizer_path()), "merges")


def test_word_hashes_are_not_kept(spark):
    found = [b"one", b"two", b"one"]
    assert text.word_hashes(found).tolist() == [xxhash.xxh3_64_intdigest(w) for w in found] and len(text.word_hashes([])) == 0
    assert not any(isinstance(x, dict) and not k.startswith("__") for m in (ngram_join, suffix_tree, text) for k, x in vars(m).items())
