"""Operators over empty tables, nulls, repeated keys and many classes."""

import itertools
import math
import random

import numpy as np
import pytest
from prosewell.operators import classify, cluster, quality
from prosewell.sources.store import cut


def test_duplicates_are_dropped_by_row(spark):
    """Every text keeps exactly one row, whatever the keys are; rows without a text all stay."""
    schema = "doc_id long, text string, `_row` string, `_digest` long, copies array<int>"
    rng = random.Random(3)
    texts = ["a b", "a  b ", "unique text", "", None, "third"]
    for trial in range(8):
        rows = [
            (rng.choice([None, 1, 2, 3]), rng.choice(texts), rng.choice(["x", "y"]), rng.choice([None, 5]), [1])
            for _ in range(rng.choice([1, 5, 40]))
        ]
        docs = spark.createDataFrame(rows, schema)
        kept = quality.drop_duplicates(docs).collect()
        fold = lambda t: None if t is None else " ".join(t.split())
        wanted = {}
        for r in rows:
            if r[1] is not None:
                wanted.setdefault(fold(r[1]), []).append(r[0])
        found = [r for r in kept if r.text is not None]
        assert len(found) == len(wanted)
        for r in found:
            ids = [i for i in wanted[fold(r.text)] if i is not None]
            assert r.doc_id == (min(ids) if ids else None) and tuple(r) in rows
        assert len(kept) - len(found) == sum(r[1] is None for r in rows)
    assert quality.drop_duplicates(docs.limit(0)).count() == 0


def test_the_three_rows_of_the_report(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a b"), (2, "unique text")], "doc_id long, text string")
    assert sorted(tuple(r) for r in quality.drop_duplicates(docs).collect()) == [(1, "a b"), (2, "unique text")]


def plain_naive_bayes(docs, smoothing=1.0):
    """Log prior and likelihoods by counting."""
    classes = sorted({c for _, c, _ in docs})
    vocabulary = {w for _, _, ws in docs for w in ws}
    model = {}
    for c in classes:
        mine = [ws for _, k, ws in docs if k == c]
        words = list(itertools.chain(*mine))
        size = len(words) + smoothing * len(vocabulary)
        model[c] = math.log(len(mine) / len(docs)), {w: math.log((words.count(w) + smoothing) / size) for w in vocabulary}
    return model


@pytest.mark.parametrize("classes", [3, 130])
def test_naive_bayes_of_few_and_many_classes(spark, classes):
    rng = random.Random(classes)
    words = [f"w{i}" for i in range(12)]
    docs = [(i, f"c{i % classes:03d}", [rng.choice(words[i % 5 :]) for _ in range(rng.randint(0, 9))]) for i in range(2 * classes)]
    table = spark.createDataFrame([(i, c) for i, c, _ in docs], "doc_id long, label string")
    tf = spark.createDataFrame([(i, c, w, 1) for i, c, ws in docs for w in ws], "doc_id long, label string, token string, tf long")
    tf = tf.groupBy("doc_id", "label", "token").sum("tf").withColumnRenamed("sum(tf)", "tf")
    unseen = spark.createDataFrame([(9_999, "never")], "doc_id long, token string").selectExpr("doc_id", "token", "2L AS tf")
    asked = tf.select("doc_id", "token", "tf").unionByName(unseen)
    everyone = table.select("doc_id").unionByName(spark.createDataFrame([(9_999,), (8_888,)], "doc_id long"))
    found = classify.nb_predict(*classify.nb_fit(tf, table), everyone, asked)
    model = plain_naive_bayes(docs)
    texts = {i: ws for i, _, ws in docs} | {9_999: [], 8_888: []}
    rows = found.collect()
    assert len(rows) == len(texts) and len(found.columns) == 3
    for r in rows:
        scores = {c: p + sum(l[w] for w in texts[r.doc_id]) for c, (p, l) in model.items()}
        assert r.score == pytest.approx(max(scores.values()))
        assert scores[r.prediction] == pytest.approx(r.score)
        assert r.prediction == min(c for c, s in scores.items() if s > r.score - 1e-9)


def test_naive_bayes_without_training_rows(spark):
    table = spark.createDataFrame([(1, None)], "doc_id long, label string")
    tf = spark.createDataFrame([(1, None, "a", 1)], "doc_id long, label string, token string, tf long")
    priors, likelihoods = classify.nb_fit(tf, table)
    assert priors.count() == likelihoods.count() == 0
    found = classify.nb_predict(priors, likelihoods, table, tf).collect()
    assert [(r.doc_id, r.prediction, r.score) for r in found] == [(1, None, None)]


VECTORS = "doc_id long, vector array<double>"


def test_clustering_of_empty_and_broken_vectors(spark):
    broken = [(1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (None, None), (5, [1.0]), (6, [])]
    good = [(10 + i, [1.0, 0.1 * i]) for i in range(5)] + [(20 + i, [0.1 * i, 1.0]) for i in range(5)]
    for rows in ([], broken[:2], broken, good + broken, good[:1]):
        df = spark.createDataFrame(rows, VECTORS)
        cf = cluster.cluster_features(df, 0.2)
        whole = [r for r in rows if r[1] and len(r[1]) == 2 and all(x is not None and x == x for x in r[1])]
        assert sum(r.n for r in cf.collect()) == len(whole)
        for centers in (cluster.spherical_kmeans_cf(cluster.condense(cf, 0.2), 2), cluster.spherical_kmeans(df, 2)):
            assert (centers.count() > 0) == any(any(r[1]) for r in whole)
            placed = cluster.assign(df, centers).collect()
            assert len(placed) == len(rows)
            known = sorted(r[0] for r in whole if any(r[1])) if centers.count() else []
            assert sorted(r.doc_id for r in placed if r.k is not None) == known
            assert all((r.k is None) == (r.sim is None) for r in placed)
    one = cluster.spherical_kmeans_cf(cluster.cluster_features(spark.createDataFrame(good, VECTORS), 0.2), 1).collect()
    total = [sum(v[i] for _, v in good) for i in (0, 1)]
    assert one[0].center == pytest.approx([t / math.hypot(*total) for t in total])


def random_units(rng, n, width, groups, spread):
    centers = rng.normal(size=(groups, width))
    x = centers[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, width))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("chunk", [1, 64])
def test_the_tree_keeps_its_invariants(chunk):
    """Sums are those of the points, every entry is within the threshold, inner entries are sums of their children, and all leaves are at one height."""
    rng = np.random.default_rng(chunk)
    x = random_units(rng, 3_000, 8, 30, 0.2)
    tree = cluster.CFTree(0.05, 200, 5)
    for start in range(0, len(x), chunk):
        tree.absorb(x[start : start + chunk])
    rows = tree.rows(3)
    assert rows["n"].sum() == len(x) and 1 < len(rows) <= 200 and len(rows) == tree.entries
    assert np.allclose(np.stack(rows["ls"]).sum(axis=0), x.sum(axis=0)) and np.isclose(rows["ss"].sum(), len(x))
    for n, ls, ss in zip(rows["n"], rows["ls"], rows["ss"], strict=True):
        assert n == 1 or ss / n - ls @ ls / n**2 <= tree.threshold**2 + 1e-9

    def walk(node):
        assert 1 <= node.size <= 5
        if node.children is None:
            return 1
        assert len(node.children) == node.size
        for i, child in enumerate(node.children):
            n, ls, ss = child.total()
            assert n == pytest.approx(node.n[i]) and np.allclose(ls, node.ls[i]) and ss == pytest.approx(node.ss[i])
        heights = {walk(c) for c in node.children}
        assert len(heights) == 1
        return heights.pop() + 1

    assert walk(tree.root) == tree.height() > 2


def test_an_insert_compares_with_a_path_only():
    """64 times the entries cost a few levels more, not 64 times the comparisons."""
    rng = np.random.default_rng(9)
    cost = {}
    for entries in (64, 4_096):
        tree = cluster.CFTree(0.0, entries, 8)
        for row in random_units(rng, entries, 16, entries, 1.0):
            tree.add(1.0, row, 1.0)
        assert tree.entries == entries
        tree.compared = 0
        for row in random_units(rng, 200, 16, 200, 1.0):
            tree._insert(tree.root, 1.0, row, 1.0)
        cost[entries] = tree.compared / 200
        assert cost[entries] <= 8 * (tree.height() + 1)
    assert cost[4_096] < 4 * cost[64] < 4_096 / 4


def test_equal_points_and_one_entry():
    tree = cluster.CFTree(0.0, 1)
    for row in np.array([[1.0, 0.0], [0.0, 1.0], [1.0, 0.0], [-1.0, 0.0]]):
        tree.absorb(row[None])
    assert tree.entries == 1 and tree.rows(0)["n"].tolist() == [4]
    same = cluster.CFTree(0.1, 9)
    same.absorb(np.tile([0.6, 0.8], (500, 1)))
    assert same.entries == 1 and same.rows(0)["n"].tolist() == [500]


def test_groups_follow_the_points(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(random_units(rng, 2_000, 4, 10, 0.05))]
    df = spark.createDataFrame(rows, VECTORS)
    few = cluster.cluster_features(df, 0.2).select("part").distinct().count()
    monkeypatch.setattr(cluster, "GROUP_POINTS", 20)
    cf = cluster.cluster_features(df, 0.2)
    many = cf.select("part").distinct().count()
    assert few <= cluster.GROUPS < 90 < many <= 100
    whole = cluster.condense(cf, 0.2, 64)
    assert whole.select("part").distinct().count() == 1 and whole.count() <= 64
    assert sum(r.n for r in whole.collect()) == 2_000
    for r in whole.collect():
        ls = np.array(r.ls)
        assert r.ss / r.n - ls @ ls / r.n**2 <= r.threshold**2 + 1e-9


@pytest.mark.parametrize("form", ["points", "summary"])
def test_centers_are_a_fixed_point(spark, form):
    """Once the solver has stopped, giving every point to its nearest center and taking the direction of each sum moves no center."""
    rng = np.random.default_rng(17)
    x = random_units(rng, 900, 6, 8, 0.15)
    df = cut(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], VECTORS))
    if form == "points":
        centers = cut(cluster.spherical_kmeans(df, 5, max_iter=200))
        weighted = df
    else:
        cf = cut(cluster.cluster_features(df, 0.1, 64))
        centers = cut(cluster.spherical_kmeans_cf(cf, 5, max_iter=200))
        weighted = cf.withColumnRenamed("ls", "vector")
    assert centers.count() == 5
    moved = cluster.recenter(cut(cluster.assign(weighted, centers)), centers)
    old, new = ({r.k: np.array(r.center) for r in c.collect()} for c in (centers, moved))
    assert all(old[k] @ new[k] > 1 - 1e-4 for k in old)


def test_cohesion_for_several_k_is_that_of_the_points(spark):
    """What `choose_k` reads off the summary is the mean similarity of the summary's own sums, by hand."""
    rng = np.random.default_rng(18)
    x = random_units(rng, 400, 5, 4, 0.2)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], VECTORS)
    cf = cut(cluster.cluster_features(df, 0.1, 32))
    sums = [(r.n, np.array(r.ls)) for r in cf.collect()]
    for row in cluster.choose_k(cf, [2, 5]).collect():
        centers = np.array([r.center for r in cluster.spherical_kmeans_cf(cf, row[0]).collect()])
        wanted = sum((centers @ ls).max() for _, ls in sums) / sum(n for n, _ in sums)
        assert row[1] == pytest.approx(wanted, abs=1e-9)
