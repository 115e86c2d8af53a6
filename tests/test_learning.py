"""The relational classifier against the library's, and the cluster invariants."""

import numpy as np
import pytest
from oracle import differences, duck
from prosewell.operators import classify, cluster, learn, terms
from prosewell.plans import clustering, learning
from prosewell.plans.registry import ORACLE, QUERIES
from prosewell.sources.store import cut
from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F


def test_naive_bayes_tables_agree_with_the_pipeline(spark, folder):
    data = learning.labelled(spark, folder).cache()
    train, test = data.filter("side = 'train'"), data.filter("side = 'test'")
    model = learn.train_nb(train, n=1 << 20, vectorizer="count")
    library = {r.doc_id: r.prediction for r in learn.score_table(model, test, ["doc_id"]).collect()}
    priors, likelihoods = classify.nb_fit(terms.term_counts(train, key=["doc_id", "label"]), train)
    mine = classify.nb_predict(priors, likelihoods, test, terms.term_counts(test)).collect()
    assert len(mine) == test.count() > 5
    # The library smooths the class priors as well, which can only matter at a near tie.
    assert np.mean([library[r.doc_id] == r.prediction for r in mine]) > 0.9


def test_split_keeps_threads_together_and_all_rows(spark, folder):
    turns = spark.read.parquet(f"{folder}/conversations.parquet")
    out = classify.split(turns, "conv_id")
    assert out.count() == turns.count()
    assert out.groupBy("conv_id").agg(F.count_distinct("side").alias("n")).filter("n > 1").count() == 0


def test_confusion_keeps_zero_cells(spark):
    rows = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")], "label string, prediction string")
    matrix = classify.confusion_matrix(rows)
    cells = {(r.label, r.prediction): r.n for r in matrix.collect()}
    assert len(cells) == 9 and cells["a", "b"] == 1 and cells["b", "c"] == 0 and sum(cells.values()) == 4
    metrics = {r.label: (r.precision, r.recall) for r in classify.class_metrics(matrix).collect()}
    assert metrics == {"a": (0.5, 0.5), "b": (0.5, 1.0), "c": (0.0, 0.0)}
    assert classify.overall_metrics(matrix).first().accuracy == 0.5


def test_saved_model_scores_the_same(spark, folder, tmp_path):
    data = learning.labelled(spark, folder)
    model = learn.train_nb(data, n=1 << 12)
    learn.save_model(model, str(tmp_path / "m"))
    again = learn.load_model(str(tmp_path / "m"))
    a = learn.score_table(model, data, ["doc_id"]).collect()
    b = learn.score_table(again, data, ["doc_id"]).collect()
    assert sorted(a) == sorted(b)


@pytest.fixture(scope="module")
def points(spark, folder):
    return clustering.points(spark, folder).cache()


@pytest.mark.parametrize("max_entries", [8, 64])
def test_cluster_features_keep_the_sums(points, max_entries):
    cf = cluster.cluster_features(points, 0.3, max_entries, "vec_id").cache()
    n, ss = cf.agg(F.sum("n"), F.sum("ss")).first()
    assert n == points.count()
    x = np.array([r.vector for r in points.collect()])
    assert ss == pytest.approx((x * x).sum())
    total = np.sum([r.ls for r in cf.select("ls").collect()], axis=0)
    assert np.allclose(total, x.sum(axis=0))
    assert cf.groupBy("part").count().agg(F.max("count")).first()[0] <= max_entries
    assert cluster.cf_stats(cf).filter("radius > threshold + 1e-6").count() == 0


def test_documents_without_known_words_get_the_prior(spark):
    train = spark.createDataFrame([(1, 0, "a b"), (2, 0, "a"), (3, 1, "c")], "doc_id int, label int, text string")
    test = spark.createDataFrame([(4, "zz"), (5, None), (6, "c c c"), (7, "")], "doc_id int, text string")
    priors, likelihoods = classify.nb_fit(terms.term_counts(train, key=["doc_id", "label"]), train)
    found = {r.doc_id: r.prediction for r in classify.nb_predict(priors, likelihoods, test, terms.term_counts(test)).collect()}
    assert found == {4: 0, 5: 0, 6: 1, 7: 0}


def test_long_form_equals_the_wide_one(spark, folder, monkeypatch):
    train = learning.labelled(spark, folder).filter("side = 'train'")
    tf = terms.term_counts(train, key=["doc_id", "label"])
    wide = {(r.token, r.label): r.log_likelihood for r in classify.nb_fit(tf, train)[1].collect()}
    monkeypatch.setattr(classify, "WIDE_CLASSES", 1)
    long = {(r.token, r.label): r.log_likelihood for r in classify.nb_fit(tf, train)[1].collect()}
    assert long == pytest.approx(wide)


def test_summaries_do_not_depend_on_the_partitions(points):
    rows = []
    for n in (2, 4, 8):
        first = cluster.cluster_features(points.repartition(n), 0.4, 16, "vec_id", groups=6)
        out = cluster.condense(first, 0.4, 16, 6, 3)
        rows.append(sorted((r.cf_id, r.n, r.ss, tuple(r.ls)) for r in out.collect()))
    assert rows[0] == rows[1] == rows[2]


def test_center_blocks(spark, points, monkeypatch):
    centers = cluster.spherical_kmeans(points, 7)
    whole = sorted(cluster.assign(points, centers).select("vec_id", "k").collect())
    monkeypatch.setattr(cluster, "CENTER_BLOCK", 2)
    assert sorted(cluster.assign(points, centers).select("vec_id", "k").collect()) == whole


def test_pivot_counts_other_labels(spark):
    rows = spark.createDataFrame([(0, 1), (0, 2), (0, None), (1, 9)], "k int, label int")
    found = {r.k: (r["1"], r.other) for r in cluster.contingency_pivot(rows, [1]).collect()}
    assert found == {0: (1, 2), 1: (0, 1)}


def test_condense_keeps_the_sums(spark, points):
    cf = cluster.cluster_features(points, 0.3, 16, "vec_id")
    out = cluster.condense(cf, 0.3, 16, 8, 2)
    assert out.count() <= 16 and out.agg(F.sum("n")).first()[0] == points.count()


def test_summary_clusters_nearly_as_well_as_all_points(points):
    assigned, _, _ = cluster.birch(points, 10, 0.4, 64, key="vec_id")
    full = cluster.assign(points, cluster.spherical_kmeans(points, 10))
    mean = [a.agg(F.avg("sim")).first()[0] for a in (assigned, full)]
    assert mean[0] > 0.9 * mean[1]


def test_cohesion_never_falls(spark, folder, points):
    centers = clustering.start_centers(spark, folder)
    last = -1.0
    for _ in range(3):
        found = cluster.assign(points, centers)
        now = found.agg(F.avg("sim")).first()[0]
        assert now >= last - 1e-12
        last, centers = now, cluster.recenter(found, centers)


def test_zero_vectors(spark):
    rows = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0])], "doc_id int, vector array<double>")
    good, rejects = cluster.unit_vectors(rows, "doc_id")
    assert [r.vector for r in good.collect()] == [[0.6, 0.8]]
    assert [r.doc_id for r in rejects.collect()] == [2]
    centers = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "k int, center array<double>")
    got = {r.doc_id: (r.k, r.sim) for r in cluster.assign(rows, centers).collect()}
    assert got == {1: (1, 0.8), 2: (None, None)}


def test_quality_of_a_perfect_clustering(spark):
    cells = spark.createDataFrame([(0, "a", 5), (1, "b", 7)], "k int, label string, n long")
    assert [round(v, 9) for v in cluster.cluster_quality(cells).first()] == [1.0, 1.0, 1.0]


def test_projection_keeps_what_is_alike(spark):
    texts = ["red green blue", "red green blue", "one two three", "", None, "red green three"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    v = {r.doc_id: np.array(r.vector) for r in learn.project_text(docs, 256, ["doc_id"]).collect()}
    assert len(v) == 6 and not v[3].any() and not v[4].any()
    assert np.array_equal(v[0], v[1])
    cos = lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    assert abs(cos(v[0], v[2])) < 0.35 < cos(v[0], v[5])


def test_no_vocabulary_caps_the_queries(spark, folder, monkeypatch):
    monkeypatch.setattr(learning, "VOCABULARY", 3, raising=False)
    con = duck(folder)
    for name in ("F4_weight", "F8_naive_bayes_multinomial", "F15_save_model_score_table"):
        assert differences(spark, con, QUERIES[name], ORACLE[name], folder) == []


def test_a_full_vocabulary_is_refused(spark):
    rows = spark.createDataFrame([(0, "a b c"), (1, "c d")], "label int, text string")
    with pytest.raises(ValueError):
        learn.train_nb(rows, n=3, vectorizer="count")
    assert len(learn.train_nb(rows, n=5, vectorizer="count").stages[1].vocabulary) == 4


@pytest.fixture(scope="module")
def small(spark):
    """Labelled texts of few words, so that solvers can run to their optimum."""
    rng = np.random.default_rng(12)
    words = ["red", "green", "blue", "one", "two", "three", "four"]
    rows = []
    for i in range(90):
        label = i % 3
        weights = np.ones(len(words)) + 3 * (np.arange(len(words)) % 3 == label)
        rows.append((i, label, " ".join(rng.choice(words, 8, p=weights / weights.sum())), i % 3))
    return cut(spark.createDataFrame(rows, "doc_id long, label int, text string, fold int"))


@pytest.mark.parametrize("kind", ["multinomial", "complement", "bernoulli"])
def test_naive_bayes_tables_equal_the_library(small, kind):
    """The kinds as tables against the solver's, over the same words."""
    model = learn.train(learn.naive_bayes(kind, 100, "count"), small.select("text", "label"))
    wanted = {r.doc_id: r.prediction for r in learn.score_table(model, small, ["doc_id"]).collect()}
    tf = terms.term_counts(small, key=["doc_id", "label"])
    fit = {
        "multinomial": lambda: classify.nb_fit(tf, small, prior_smoothing=1.0),
        "complement": lambda: classify.nb_fit_complement(tf, small),
        "bernoulli": lambda: classify.nb_fit_bernoulli(tf, small, prior_smoothing=1.0),
    }[kind]()
    seen = classify.presence(tf) if kind == "bernoulli" else tf
    found = {r.doc_id: r.prediction for r in classify.nb_predict(*fit, small, seen).collect()}
    assert found == wanted


def design(model, docs):
    """Features as a matrix, and labels."""
    rows = model.transform(docs.withColumn("label", F.col("label").cast("double"))).orderBy("doc_id").collect()
    return np.array([r.features.toArray() for r in rows]), np.array([int(r.label) for r in rows]), rows


def is_least(loss, at, rng):
    """No step of any size in 200 random directions makes the loss smaller."""
    least = loss(at)
    for scale in (1.0, 0.1, 0.01):
        for _ in range(70):
            if loss(at + scale * rng.normal(size=at.shape)) < least - 1e-7:
                return False
    return True


def test_logistic_regression_is_at_its_optimum(small):
    reg = 0.01
    model = learn.train(learn.logistic(64, 500, reg), small.select("text", "label"))
    x, y, rows = design(model, small)
    spread = x.std(axis=0, ddof=1)
    stage = model.stages[-1]
    at = np.c_[stage.coefficientMatrix.toArray(), stage.interceptVector.toArray()]

    def loss(theta):
        scores = x @ theta[:, :-1].T + theta[:, -1]
        top = scores.max(axis=1)
        norm = top + np.log(np.exp(scores - top[:, None]).sum(axis=1))
        return (norm - scores[np.arange(len(y)), y]).mean() + reg / 2 * ((theta[:, :-1] * spread) ** 2).sum()

    assert is_least(loss, at, np.random.default_rng(1))
    assert [int(r.prediction) for r in rows] == (x @ at[:, :-1].T + at[:, -1]).argmax(axis=1).tolist()


def test_svm_is_at_its_optimum_for_each_class(small):
    reg = 0.01
    model = learn.train(learn.svm(64, 150, reg), small.select("text", "label"))
    x, y, rows = design(model, small)
    spread = x.std(axis=0, ddof=1)
    margins = []
    for c, one in enumerate(model.stages[-1].models):
        sign = np.where(y == c, 1, -1)
        at = np.append(one.coefficients.toArray(), one.intercept)

        def loss(theta, sign=sign):
            hinge = np.maximum(0, 1 - sign * (x @ theta[:-1] + theta[-1])).mean()
            return hinge + reg / 2 * ((theta[:-1] * spread) ** 2).sum()

        # The hinge has corners: the solver stops near the least loss, not on it.
        rng = np.random.default_rng(c)
        best = min(loss(at + s * rng.normal(size=at.shape)) for s in (0.3, 0.1, 0.03, 0.01) for _ in range(60))
        assert loss(at) <= best + 2e-3 and loss(at) < 0.9 * loss(np.zeros_like(at))
        margins.append(x @ at[:-1] + at[-1])
    assert [int(r.prediction) for r in rows] == np.argmax(margins, axis=0).tolist()


def test_cross_validation_is_the_mean_over_folds(small):
    nb = NaiveBayes(featuresCol="counts", labelCol="label")
    pipeline = Pipeline(stages=[*learn.vectorize(1 << 10), nb])
    grid = ParamGridBuilder().addGrid(nb.smoothing, [0.1, 5.0]).build()
    found = learn.cross_validate(pipeline, grid, small, "fold", 3, "accuracy")
    for params, metric in zip(grid, found.avgMetrics, strict=True):
        right = []
        for k in range(3):
            one = pipeline.copy(params)
            model = learn.train(one, small.filter(f"fold <> {k}"))
            rows = learn.score_table(model, small.filter(f"fold = {k}"), ["label"]).collect()
            right.append(np.mean([r.label == r.prediction for r in rows]))
        assert metric == pytest.approx(np.mean(right))


def test_weights_of_pipeline_and_tables_agree(small):
    """IDF and unit length by `pyspark.ml` over counted words, against the tables."""
    model = Pipeline(stages=[*learn.vectorize(50, "count"), *learn.weight()]).fit(small)
    names = model.stages[1].vocabulary
    wanted = {
        (r.doc_id, names[i]): v
        for r in model.transform(small).collect()
        for i, v in zip(r.features.indices.tolist(), r.features.values.tolist(), strict=True)
    }
    tf = terms.term_counts(small)
    found = terms.unit_weights(terms.tf_idf(tf, cut(terms.doc_freq(tf)), small.count())).collect()
    got = {(r.doc_id, r.token): r.weight for r in found if r.weight}
    assert got == pytest.approx({k: v for k, v in wanted.items() if v})


def test_weights_and_scores_beyond_the_broadcast_bound(spark, monkeypatch):
    """Weights and Naive Bayes scores are the same where only the frequent words are broadcast; weights move no pair of document and word that is together already."""
    from prosewell.operators import joins

    docs = spark.createDataFrame([(i, i % 2, "the word " * (i % 5) + f"rare{chr(97 + i % 26)} common of") for i in range(120)], "doc_id int, label int, text string")

    def run():
        tf = cut(terms.term_counts(docs))
        weights = terms.unit_weights(terms.tf_idf(tf, cut(terms.doc_freq(tf)), docs.count()))
        fitted = classify.nb_fit(terms.term_counts(docs, key=["doc_id", "label"]), docs)
        scores = classify.nb_predict(*fitted, docs, tf)
        return weights, {(r.doc_id, r.token): r.weight for r in weights.collect()}, {r.doc_id: (r.prediction, round(r.score, 9)) for r in scores.collect()}

    _, weights, scores = run()
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 5)
    frame, few_weights, few_scores = run()
    assert "LeftAnti" in frame._jdf.queryExecution().optimizedPlan().toString()
    assert few_weights == pytest.approx(weights) and few_scores == scores
    monkeypatch.undo()
    together = docs.repartition(5, "doc_id")
    tf = terms.term_counts(together)
    moved = terms.unit_weights(terms.tf_idf(tf, cut(terms.doc_freq(tf)), 120))._jdf.queryExecution().executedPlan().toString()
    assert moved.count("Exchange hashpartitioning") == 1


def test_projection_holds_few_vectors_at_once(spark, monkeypatch):
    """Texts are projected in slices of a batch, and points meet centers in slices: the same vectors and centers whatever the slice, empty and missing texts too."""
    texts = [" ".join(f"{chr(97 + (i * j) % 26)}{chr(97 + j % 26)}" for j in range(i % 9)) for i in range(50)] + [None]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id int, text string")

    def run():
        vectors = cut(learn.project_text(docs, 16, ["doc_id"]))
        centers = spark.createDataFrame([(k, [float(i % 3 == k) for i in range(16)]) for k in range(3)], "k int, center array<double>")
        return {r.doc_id: (r.vector, r.k, r.sim) for r in cluster.assign(vectors, centers).collect()}

    whole = run()
    assert len(whole) == 51 and whole[50] == ([0.0] * 16, None, None)
    monkeypatch.setattr(learn, "PROJECTED_ROWS", 3)
    monkeypatch.setattr(cluster, "ASSIGNED", 4)
    apart = run()
    assert {k: (v[0], v[1]) for k, v in apart.items()} == {k: (v[0], v[1]) for k, v in whole.items()}
    assert all(apart[k][2] == pytest.approx(v[2]) for k, v in whole.items() if v[2] is not None)
