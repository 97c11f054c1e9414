
import numpy as np
import pytest
from pyspark.sql import functions as F

from roomtide.llm import components, curve_search, mixing, ngram_join


def brute_components(rows, percent=90):
    sets = []
    for i, t in rows:
        w = ngram_join.words((t or "").encode())
        sets.append(frozenset(zip(w, w[1:], w[2:])) if len(w) > 2 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, len(s), (least.get(root(k)) if s else i)) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=repr)


def found(df):
    return sorted((tuple(r) for r in ngram_join.components(df, counters=1 << 14).select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def test_components_equal_brute_force(documents, odd, empty):
    for df in (documents, odd):
        assert found(df) == brute_components([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    assert found(empty) == []


def test_chains_of_near_copies(spark):
    rng = np.random.default_rng(4)
    rows, text = [], [f"w{k}" for k in range(80)]
    for i in range(120):
        rows.append((i, " ".join(text)))
        text = list(text)
        text[int(rng.integers(80))] = f"x{i}"
    rows += [(200 + i, "a b c d e f g h i j k l"[: 3 + 2 * i]) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(df) == brute_components(rows)


def test_one_row_of_each_component_stays(odd):
    kept = ngram_join.first_of_each(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count()  # equal rows share the smallest id


def test_smallest_nodes(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    roots = {r.node: r.root for r in components.smallest_nodes(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert roots == {**{i: 1 for i in range(2, 41)}, 101: 100, 102: 100}
    assert components.smallest_nodes(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_hilbert_curve_steps_to_neighbours():
    grid = np.array([[a, b, c] for a in range(8) for b in range(8) for c in range(8)])
    keys = curve_search.hilbert_keys(grid, 3)
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_recall_of_curve_search(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    answer = curve_search.nearest(rows, "vec_id % 20 = 0", block=64, span=2).collect()
    table = {r.vec_id: np.array(r.embedding, float) for r in rows.collect()}
    got, hits, all_ = {}, 0, 0
    for r in answer:
        assert abs(r.score - table[r.query_id] @ table[r.vec_id]) < 1e-12 and r.query_id != r.vec_id
        got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    for q in (i for i in table if i % 20 == 0):
        best = sorted((i for i in table if i != q), key=lambda i: (-(table[q] @ table[i]), i))[:20]
        assert sorted(got[q]) == list(range(1, 21))
        hits, all_ = hits + len(set(best) & set(got[q].values())), all_ + 20
    assert hits >= 0.9 * all_


def test_search_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (None, [1.0, 1.0]), (8, [1.0]), (9, [3.0, 3.0])]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id bigint, embedding array<double>, score string")
    answer = curve_search.nearest(df, "vec_id % 2 = 0").orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in answer] == [(0, 1, 9, 3.0), (0, 2, 1, 1.0), (0, 3, 2, 0.0), (2, 1, 9, 6.0), (2, 2, 0, 0.0), (2, 3, 1, 0.0)]
    copies = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(300)], "vec_id bigint, embedding array<double>")
    assert [r.vec_id for r in curve_search.nearest(copies, "vec_id = 3").orderBy("rank").collect()] == [0, 1, 2, *range(4, 21)]
    assert curve_search.nearest(df.where("false"), "true").count() == 0


def test_raking_meets_both_margins(spark):
    cells = spark.createDataFrame([("a", "x", 90), ("a", "y", 10), ("b", "x", 30), ("b", "y", 70), (None, "x", 20), (None, "y", 5)], "s string, l string, tokens bigint")
    wanted = {"s": {"a": 0.2, "b": 0.5, None: 0.3}, "l": {"x": 0.6, "y": 0.4}}
    targets = {k: spark.createDataFrame(list(v.items()), "value string, share double") for k, v in wanted.items()}
    raked = mixing.rake(cells, targets, sweeps=25)
    for d, shares in wanted.items():
        assert {r.value: round(r.share, 6) for r in mixing.margins(raked, d).collect()} == shares
    chances = [r["__chance"] for r in mixing.probabilities(raked, ["s", "l"]).collect()]
    assert max(chances) == 1 and min(chances) > 0


def test_raking_goes_on_until_the_margins_hold(spark):
    cells = spark.createDataFrame([("a", "x", 10**6), ("a", "y", 10), ("b", "x", 10), ("b", "y", 10**6), ("c", "x", 1), ("c", "y", 1)], "s string, l string, tokens bigint")
    wanted = {"s": {"a": 0.2, "b": 0.5, "c": 0.3}, "l": {"x": 0.6, "y": 0.4}}
    targets = {k: spark.createDataFrame(list(v.items()), "value string, share double") for k, v in wanted.items()}
    raked = mixing.rake(cells, targets)
    assert all(abs(r.share - wanted[d][r.value]) < 1e-11 for d in wanted for r in mixing.margins(raked, d).collect())


def test_raking_reports_targets_that_contradict(spark):
    cells = spark.createDataFrame([("a", "x", 5), ("b", "y", 5)], "s string, l string, tokens bigint")
    wanted = {"s": {"a": 0.2, "b": 0.8}, "l": {"x": 0.6, "y": 0.4}}
    targets = {k: spark.createDataFrame(list(v.items()), "value string, share double") for k, v in wanted.items()}
    with pytest.warns(UserWarning, match="0.4 off"):
        mixing.rake(cells, targets)


def test_mix_of_odd_rows(odd, empty, documents):
    rows = mixing.report(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r.chance <= 1 for r in rows)
    kept = mixing.sample(odd)
    assert kept.columns == odd.columns
    assert mixing.sample(empty).count() == 0
    assert mixing.report(documents).where(F.col("kept") != (mixing.draw(F.col("doc_id"), 17) < F.col("chance"))).count() == 0


def test_mixing_stays_native(documents, plan):
    text = plan(mixing.report(documents))
    for bad in ("Python", "Pandas", "MapInArrow", "CartesianProduct"):
        assert bad not in text
