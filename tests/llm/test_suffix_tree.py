import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from roomtide.llm import suffix_tree as tree

LEAST, DIVERGENCE = 2, 3.0


def held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0


def brute_tree(texts, depth=tree.DEPTH, least=LEAST, divergence=DIVERGENCE):
    """Counts of next symbols by context, and the states, from the definition."""
    counts = {}
    for t in texts:
        symbols = bytes([tree.END]) * depth + t + bytes([tree.END])
        for i in range(depth, len(symbols)):
            for d in range(depth + 1):
                counts.setdefault(symbols[i - d:i], Counter())[symbols[i]] += 1
    states = set()
    for c, n in counts.items():
        total = sum(n.values())
        if c and total >= least:
            above = counts[c[1:]]
            up = sum(above.values())
            if sum(x * math.log(x / total / (above[s] / up)) for s, x in n.items()) >= divergence:
                states |= {c[k:] for k in range(len(c))}
    return counts, states


def chance(counts, states, c, s):
    """The symbol's probability in the state of the longest suffix of its context."""
    n = counts.get(b"", Counter())
    p = (n[s] + 0.1) / (sum(n.values()) + 25.6)
    for d in range(1, len(c) + 1):
        if c[-d:] in states:
            n = counts[c[-d:]]
            p = (n[s] + len(n) * p) / (sum(n.values()) + len(n))
    return p


def brute_score(counts, states, t, depth=tree.DEPTH):
    symbols = bytes([tree.END]) * depth + t + bytes([tree.END])
    return sum(math.log10(chance(counts, states, symbols[i - depth:i], symbols[i])) for i in range(depth, len(symbols)))


def low(t):
    return (t or "").encode().translate(tree.LOWER)


def check(df):
    rows = [(r.doc_id, low(r.text)) for r in df.select("doc_id", "text").collect()]
    trained = [t for i, t in rows if not held(i)]
    counts, states = brute_tree(trained)
    words = Counter(w for t in trained for w in [*t.split(), None])
    n, v = sum(words.values()), len(words)
    expected = []
    for i, t in rows:
        ws = [*t.split(), None]
        base = sum(math.log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        expected.append((str(i), held(i), len(ws), sum(words[w] > 0 for w in ws), n, round(base, 6), round(brute_score(counts, states, t), 6)))
    got = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in tree.score(df).collect()]
    assert sorted(got) == sorted(expected)
    return states


def test_scores_equal_brute_force(spark, documents, odd):
    texts = documents.where("length(text) < 1500").limit(60).unionByName(documents.where("lang = 'de' and length(text) < 3000").limit(5))
    assert {len(c) for c in check(texts)} == {1, 2, 3, 4, 5}
    check(odd)


def test_states_equal_brute_force_and_distributions_add_up(spark, documents):
    rows = documents.where("length(text) < 800").limit(40)
    asked = tree.ask(rows.selectExpr("doc_id", "text", "crc32(cast(doc_id as string)) % 10 = 0 as held_out"))
    found = tree.Tree(asked, LEAST, DIVERGENCE)
    counts, states = brute_tree([low(r.text) for r in rows.collect() if not held(r.doc_id)])
    for depth in range(1, tree.DEPTH + 1):
        got = {(r.context.to_bytes(depth, "big"), r.total, r.types) for r in found.states[depth].collect()}
        assert got == {(c, sum(counts[c].values()), len(counts[c])) for c in states if len(c) == depth}
    for c in [b"", next(iter(states)), b"zzzzz"]:
        assert sum(chance(counts, states, c, s) for s in range(256)) == pytest.approx(1)


def test_no_training_texts(spark, empty):
    assert tree.score(empty).count() == 0
    [row] = tree.score(spark.createDataFrame([(None, "a b")], "doc_id bigint, text string")).collect()
    assert (row.n_known, row.train_tokens, row.n_tokens) == (0, 0, 3) and row.score == pytest.approx(-4 * math.log10(256))


def test_blocks_of_one_text_and_of_many(spark, documents, monkeypatch):
    rows = documents.limit(50)
    key = lambda df: sorted((r.doc_id, round(r.score, 6), round(r.base_score, 6)) for r in df.collect())
    whole = key(tree.score(rows.repartition(1)))
    assert key(tree.score(rows.repartition(5))) == whole
    monkeypatch.setattr(tree, "BLOCK_ROWS", 1)
    monkeypatch.setattr(tree, "BLOCK_BYTES", 1)
    assert key(tree.score(rows)) == whole


def test_an_input_that_changes_ends_the_job(spark):
    df = spark.createDataFrame([(i, "x") for i in range(20)], "doc_id bigint, text string").selectExpr("doc_id", "concat('some text ', reflect('java.util.UUID', 'randomUUID')) as text")
    with pytest.raises(Exception, match="input changed between two reads"):
        tree.score(df).collect()


def test_the_tree_beats_the_words_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    row = tree.score(docs).where("held_out").selectExpr("sum(score) / sum(n_tokens) as s", "sum(base_score) / sum(n_tokens) as b").first()
    assert row.s > row.b


def test_states_grow_with_the_corpus(spark, documents):
    def states(df):
        asked = tree.ask(df.selectExpr("doc_id", "text", "false as held_out"))
        return sum(x.count() for x in tree.Tree(asked, LEAST, DIVERGENCE).states[1:])

    few, many = states(documents.limit(20)), states(documents)
    assert many > 2 * few


@settings(max_examples=50, deadline=None)
@given(st.lists(st.binary(max_size=12).map(lambda b: b.replace(b"\xff", b"")), max_size=6))
def test_grams(texts):
    codes, begins = tree.grams(texts)
    expected = []
    for t in texts:
        symbols = bytes([tree.END]) * tree.DEPTH + t + bytes([tree.END])
        expected.append([int.from_bytes(symbols[i - tree.DEPTH:i + 1], "big") for i in range(tree.DEPTH, len(symbols))])
    assert codes.tolist() == [c for e in expected for c in e]
    assert np.split(codes, begins[1:])[0].tolist() == (expected[0] if texts else []) if texts else len(begins) == 0
