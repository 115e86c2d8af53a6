"""Registered queries: classification."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosewell.functions import text as T
from prosewell.operators import classify, learn, opinion, terms
from prosewell.plans import fixtures as fx
from prosewell.plans.registry import query
from prosewell.plans.text import CHI_SQL, association_ctes, documents
from prosewell.sources.store import cut, fresh_path
from prosewell.sources.tables import deal, documents_as_corpus, read_table


@query(
    "F1_index_labels",
    """WITH c AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS i FROM (SELECT DISTINCT lang AS label FROM documents))
    SELECT doc_id, lang, i::BIGINT AS label_index FROM documents JOIN c ON lang = label""",
)
def f1(spark, folder):
    docs = documents(spark, folder).select("doc_id", F.col("lang").alias("label"))
    return classify.index_labels(docs).select(
        "doc_id", F.col("label").alias("lang"), F.col("label_index").cast("bigint")
    )


def _fold_sql(key: str, n: int) -> str:
    return f"(('0x' || substr(md5({key}::VARCHAR), 1, 8))::BIGINT % {n})"


@query(
    "F2_split",
    f"""SELECT conv_id, turn, {_fold_sql('conv_id', 5)}::BIGINT AS fold,
    CASE WHEN {_fold_sql('conv_id', 5)} = 0 THEN 'test' ELSE 'train' END AS side FROM conversations""",
)
def f2(spark, folder):
    turns = read_table(spark, folder, "conversations").select("conv_id", "turn")
    out = classify.split(classify.fold(turns, 5, "conv_id"), "conv_id")
    return out.withColumn("fold", F.col("fold").cast("bigint"))


def labelled(spark: SparkSession, folder: str, label: str = "toxic") -> DataFrame:
    """(doc_id, label, text, side) of the labelled documents, split by document."""
    docs = documents_as_corpus(spark, folder, label).filter("label is not null")
    return classify.split(docs, "doc_id")


LABELLED_SQL = f"""lab AS (SELECT l.doc_id, l.toxic AS label, d.text, {_fold_sql('l.doc_id', 5)} = 0 AS test
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id WHERE l.toxic IS NOT NULL),
toks AS (SELECT doc_id, label, test, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM lab),
tf AS (SELECT doc_id, label, test, token, count(*) AS tf FROM toks GROUP BY ALL),
vocab AS (SELECT DISTINCT token FROM tf WHERE NOT test),
counts AS (SELECT token, label, sum(tf) AS c FROM tf WHERE NOT test GROUP BY ALL),
totals AS (SELECT label, sum(c) AS t FROM counts GROUP BY label),
classes AS (SELECT label, count(*) AS docs, ln(count(*) / (SELECT count(*) FROM lab WHERE NOT test)) AS log_prior
  FROM lab WHERE NOT test GROUP BY label),
model AS (SELECT v.token, k.label, ln((coalesce(c.c, 0) + 1) / (t.t + (SELECT count(*) FROM vocab))) AS ll
  FROM vocab v CROSS JOIN classes k JOIN totals t ON t.label = k.label
  LEFT JOIN counts c ON c.token = v.token AND c.label = k.label)
"""
PREDICTED_SQL = (
    LABELLED_SQL
    + """, s AS (SELECT lab.doc_id, lab.label AS actual, k.label, any_value(k.log_prior) + coalesce(sum(tf.tf * m.ll), 0) AS score
  FROM lab CROSS JOIN classes k LEFT JOIN tf ON tf.doc_id = lab.doc_id LEFT JOIN model m ON tf.token = m.token AND k.label = m.label
  WHERE lab.test GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS rn FROM s),
pred AS (SELECT doc_id, actual AS label, label AS prediction, score FROM r WHERE rn = 1)
"""
)
CONFUSION_SQL = (
    PREDICTED_SQL
    + """, both_ AS (SELECT label FROM pred UNION SELECT prediction FROM pred),
confusion AS (SELECT a.label, b.label AS prediction, (SELECT count(*) FROM pred p WHERE p.label = a.label AND p.prediction = b.label) AS n
  FROM both_ a CROSS JOIN both_ b)
"""
)


def _fit(spark, folder):
    data = labelled(spark, folder)
    train = data.filter("side = 'train'")
    priors, likelihoods = classify.nb_fit(terms.term_counts(train, key=["doc_id", "label"]), train)
    return data, priors, likelihoods


@query(
    "F6_nb_fit",
    f"WITH {LABELLED_SQL} SELECT token, label::BIGINT AS label, round(ll, 6) AS log_likelihood FROM model",
)
def f6(spark, folder):
    _, _, likelihoods = _fit(spark, folder)
    return likelihoods.select(
        "token", F.col("label").cast("bigint"), F.round("log_likelihood", 6).alias("log_likelihood")
    )


@query(
    "F6_nb_priors",
    f"WITH {LABELLED_SQL} SELECT label::BIGINT AS label, docs, round(log_prior, 6) AS log_prior FROM classes",
)
def f6b(spark, folder):
    out = classify.nb_priors(labelled(spark, folder).filter("side = 'train'"))
    return out.select(F.col("label").cast("bigint"), "docs", F.round("log_prior", 6).alias("log_prior"))


def nb_predictions(spark: SparkSession, folder: str) -> DataFrame:
    data, priors, likelihoods = _fit(spark, folder)
    test = data.filter("side = 'test'")
    tf = terms.term_counts(test, key=["doc_id", "label"])
    return classify.nb_predict(priors, likelihoods, test, tf, ["doc_id", "label"])


@query(
    "F7_nb_predict",
    f"""WITH {PREDICTED_SQL} SELECT doc_id, label::BIGINT AS label, prediction::BIGINT AS prediction,
    round(score, 4) AS score FROM pred""",
)
def f7(spark, folder):
    out = nb_predictions(spark, folder)
    return out.select(
        "doc_id",
        F.col("label").cast("bigint"),
        F.col("prediction").cast("bigint"),
        F.round("score", 4).alias("score"),
    )


@query(
    "F5_select_features",
    f"""WITH {association_ctes('toxic')}, s AS (SELECT token, max(round({CHI_SQL}, 9)) AS score FROM cells GROUP BY token)
    SELECT token, round(score, 6) AS score FROM s ORDER BY s.score DESC, token LIMIT 100""",
)
def f5(spark, folder):
    chosen = terms.select_features(terms.term_association(documents_as_corpus(spark, folder)), 100)
    return chosen.withColumn("score", F.round("score", 6))


@query(
    "F11_majority_baseline",
    f"""WITH {LABELLED_SQL} SELECT doc_id, label::BIGINT AS label,
    (SELECT label FROM classes ORDER BY docs DESC, label LIMIT 1)::BIGINT AS prediction FROM lab WHERE test""",
)
def f11(spark, folder):
    data = labelled(spark, folder).select("doc_id", "label", "side")
    out = classify.majority_baseline(data.filter("side = 'train'"), data.filter("side = 'test'"))
    return out.select("doc_id", F.col("label").cast("bigint"), F.col("prediction").cast("bigint"))


@query(
    "F12_confusion_matrix",
    f"WITH {CONFUSION_SQL} SELECT label::BIGINT AS label, prediction::BIGINT AS prediction, n FROM confusion",
)
def f12(spark, folder):
    out = classify.confusion_matrix(nb_predictions(spark, folder))
    return out.select(F.col("label").cast("bigint"), F.col("prediction").cast("bigint"), "n")


METRIC_SQL = (
    CONFUSION_SQL
    + """, m AS (SELECT k.label,
  (SELECT sum(n) FROM confusion c WHERE c.label = k.label) AS support,
  (SELECT sum(n) FROM confusion c WHERE c.prediction = k.label) AS predicted,
  (SELECT sum(n) FROM confusion c WHERE c.prediction = k.label AND c.label = k.label) AS hit FROM both_ k),
metrics AS (SELECT label, support::BIGINT AS support, coalesce(hit / nullif(predicted, 0), 0) AS precision,
  coalesce(hit / nullif(support, 0), 0) AS recall, coalesce(2 * hit / nullif(predicted + support, 0), 0) AS f1 FROM m)
"""
)


@query(
    "F13_class_metrics",
    f"""WITH {METRIC_SQL} SELECT label::BIGINT AS label, support, round(precision, 6) AS precision,
    round(recall, 6) AS recall, round(f1, 6) AS f1 FROM metrics""",
)
def f13(spark, folder):
    out = classify.class_metrics(classify.confusion_matrix(nb_predictions(spark, folder)))
    return out.select(
        F.col("label").cast("bigint"),
        "support",
        *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")],
    )


@query(
    "F13_overall_metrics",
    f"""WITH {METRIC_SQL} SELECT sum(support)::BIGINT AS n,
    round((SELECT sum(n) FROM confusion WHERE label = prediction) / (SELECT sum(n) FROM confusion), 6) AS accuracy,
    round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1
    FROM metrics""",
)
def f13b(spark, folder):
    out = classify.overall_metrics(classify.confusion_matrix(nb_predictions(spark, folder)))
    return out.select(
        "n",
        *[F.round(c, 6).alias(c) for c in ("accuracy", "macro_precision", "macro_recall", "macro_f1")],
    )


FEATURES = 1 << 16


def prepared(spark: SparkSession, folder: str) -> DataFrame:
    """The labelled documents, kept in the shared folder: the solvers read them many times."""
    return cut(labelled(spark, folder))


# So many slots that words of one document do not meet by chance.
WIDE = 1 << 30


@query(
    "F3_vectorize",
    """WITH k AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM documents),
    tf AS (SELECT doc_id, token, count(*) AS tf FROM k GROUP BY ALL), v AS (SELECT doc_id, count(*) AS slots, string_agg(tf, ',' ORDER BY tf) AS counts FROM tf GROUP BY 1)
    SELECT doc_id, coalesce(slots, 0)::BIGINT AS slots, coalesce(counts, '') AS counts FROM documents LEFT JOIN v USING (doc_id)""",
)
def f3(spark, folder):
    """How many slots each document's vector has, and what they hold, in order."""
    docs = documents(spark, folder).select("doc_id", "text")
    model = Pipeline(stages=learn.vectorize(WIDE)).fit(docs)
    # Of a sparse vector's text, (size, [slots], [values]), the values.
    values = F.from_json(F.concat(F.lit("["), F.regexp_extract(F.col("counts").cast("string"), r"\],\[(.*)\]\)$", 1), F.lit("]")), "array<double>")
    held = model.transform(docs).select("doc_id", F.array_sort(values.cast("array<bigint>")).alias("v"))
    return held.select("doc_id", F.size("v").cast("bigint").alias("slots"), F.array_join("v", ",").alias("counts"))


@query(
    "F4_weight",
    """WITH k AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM documents),
    tf AS (SELECT doc_id, token, count(*) AS tf FROM k GROUP BY ALL), df AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
    w AS (SELECT doc_id, token, tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)) AS w FROM tf JOIN df USING (token))
    SELECT doc_id, token, round(w / nullif(sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 0), 6) AS weight FROM w""",
)
def f4(spark, folder):
    """Every word's weight in its document, as vectors of length 1."""
    # Texts move, once a pass, in place of their counted words.
    docs = deal(read_table(spark, folder, "documents").select("doc_id", "text"), "doc_id")
    tf = terms.term_counts(docs).groupBy("doc_id", "token").agg(F.sum("tf").alias("tf"))
    weights = terms.unit_weights(terms.tf_idf(tf, cut(terms.doc_freq(tf)), docs.count()))
    return weights.select("doc_id", "token", F.round("weight", 6).alias("weight"))


def _pipeline(pipeline_of):
    def build(spark, folder):
        data = prepared(spark, folder)
        model = learn.train(pipeline_of(), data.filter("side = 'train'"))
        scored = learn.score_table(model, data.filter("side = 'test'"), ["doc_id", "label"])
        return scored.withColumn("label", F.col("label").cast("bigint"))

    return build


def _library_sql(train: str, scored: str) -> str:
    """Multinomial Naive Bayes with smoothed priors over all words of the training documents, every scored document kept."""
    return f"""lab AS (SELECT l.doc_id, l.toxic AS label, d.text, {_fold_sql('l.doc_id', 5)} = 0 AS test
      FROM labels l JOIN documents d ON l.doc_id = d.doc_id WHERE l.toxic IS NOT NULL),
    tr AS (SELECT label, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM lab WHERE {train}),
    vocab AS (SELECT DISTINCT token FROM tr), counts AS (SELECT token, label, count(*) AS c FROM tr GROUP BY ALL),
    totals AS (SELECT label, count(*) AS t FROM tr GROUP BY label),
    classes AS (SELECT label, ln(count(*) + 1) - ln((SELECT count(*) FROM lab WHERE {train}) + (SELECT count(DISTINCT label) FROM lab WHERE {train})) AS prior
      FROM lab WHERE {train} GROUP BY label),
    model AS (SELECT v.token, k.label, ln((coalesce(c.c, 0) + 1) / (t.t + (SELECT count(*) FROM vocab))) AS ll
      FROM vocab v CROSS JOIN classes k JOIN totals t ON t.label = k.label LEFT JOIN counts c ON c.token = v.token AND c.label = k.label),
    te AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM {scored}),
    tf AS (SELECT doc_id, token, count(*) AS tf FROM te GROUP BY ALL),
    s AS (SELECT d.doc_id, k.label, any_value(k.prior) + coalesce(sum(tf.tf * m.ll), 0) AS score FROM (SELECT doc_id FROM {scored}) d CROSS JOIN classes k
      LEFT JOIN tf ON tf.doc_id = d.doc_id LEFT JOIN model m ON m.token = tf.token AND m.label = k.label GROUP BY ALL),
    pred AS (SELECT doc_id, arg_max(label, score)::DOUBLE AS prediction FROM s GROUP BY doc_id)"""


def _fit_smoothed(train: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The library's multinomial Naive Bayes as tables: priors are smoothed too."""
    return classify.nb_fit(terms.term_counts(train, key=["doc_id", "label"]), train, prior_smoothing=1.0)


def _multinomial(spark, folder):
    data = prepared(spark, folder)
    test = data.filter("side = 'test'")
    tf = terms.term_counts(test, key=["doc_id", "label"])
    found = classify.nb_predict(*_fit_smoothed(data.filter("side = 'train'")), test, tf, ["doc_id", "label"])
    return found.select("doc_id", F.col("label").cast("bigint"), F.col("prediction").cast("double"))


query(
    "F8_naive_bayes_multinomial",
    f"WITH {_library_sql('NOT test', '(SELECT * FROM lab WHERE test)')} SELECT doc_id, label::BIGINT AS label, prediction FROM pred JOIN lab USING (doc_id)",
)(_multinomial)
NB_SQL = f"""lab AS (SELECT l.doc_id, l.toxic AS label, d.text, {_fold_sql('l.doc_id', 5)} = 0 AS test
      FROM labels l JOIN documents d ON l.doc_id = d.doc_id WHERE l.toxic IS NOT NULL),
    k AS (SELECT doc_id, label, test, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM lab),
    tf AS (SELECT doc_id, label, test, token, count(*) AS tf FROM k GROUP BY ALL),
    classes AS (SELECT label, count(*) AS n FROM lab WHERE NOT test GROUP BY label),
    vocab AS (SELECT token, sum(tf) AS t FROM tf WHERE NOT test GROUP BY token),
    cells AS (SELECT v.token, c.label, c.n, v.t, coalesce(sum(tf.tf), 0) AS f, count(tf.tf) AS d FROM vocab v CROSS JOIN classes c
      LEFT JOIN (SELECT * FROM tf WHERE NOT test) tf ON tf.token = v.token AND tf.label = c.label GROUP BY ALL)"""
SCORED_SQL = """scores AS (SELECT l.doc_id, l.label AS truth, c.label, any_value(c.prior) + coalesce(sum(x.w * m.w), 0) AS score
      FROM (SELECT * FROM lab WHERE test) l CROSS JOIN prior c LEFT JOIN seen x ON x.doc_id = l.doc_id LEFT JOIN model m ON m.token = x.token AND m.label = c.label GROUP BY ALL)
    SELECT doc_id, truth::BIGINT AS label, arg_max(label, (round(score, 9), -label))::DOUBLE AS prediction, round(max(score), 6) AS score FROM scores GROUP BY ALL"""


def _nb_tables(spark: SparkSession, folder: str, fit, seen) -> DataFrame:
    data = prepared(spark, folder)
    train, test = (data.filter(f"side = '{side}'") for side in ("train", "test"))
    tf = terms.term_counts(data, key=["doc_id", "label", "side"])
    model = fit(tf.filter("side = 'train'"), train)
    asked = seen(tf.filter("side = 'test'").drop("side"))
    found = classify.nb_predict(*model, test, asked, ["doc_id", "label"])
    return found.select(
        "doc_id", F.col("label").cast("bigint"), F.col("prediction").cast("double"), F.round("score", 6).alias("score")
    )


@query(
    "F8_naive_bayes_complement",
    f"""WITH {NB_SQL}, raw AS (SELECT token, label, ln((t - f + 1) / (sum(t) OVER l - sum(f) OVER l + count(*) OVER l)) AS w FROM cells WINDOW l AS (PARTITION BY label)),
    model AS (SELECT token, label, w / sum(w) OVER (PARTITION BY label) AS w FROM raw), prior AS (SELECT label, 0.0 AS prior FROM classes),
    seen AS (SELECT doc_id, token, tf AS w FROM tf WHERE test), {SCORED_SQL}""",
)
def f8_complement(spark, folder):
    return _nb_tables(spark, folder, classify.nb_fit_complement, lambda tf: tf)


@query(
    "F8_naive_bayes_bernoulli",
    f"""WITH {NB_SQL}, raw AS (SELECT token, label, (d + 1) / (n + 2) AS p FROM cells), model AS (SELECT token, label, ln(p / (1 - p)) AS w FROM raw),
    prior AS (SELECT label, ln(any_value(n) / (SELECT sum(n) FROM classes)) + sum(ln(1 - p)) AS prior FROM raw JOIN classes USING (label) GROUP BY label),
    seen AS (SELECT doc_id, token, 1 AS w FROM tf WHERE test), {SCORED_SQL}""",
)
def f8_bernoulli(spark, folder):
    return _nb_tables(spark, folder, classify.nb_fit_bernoulli, classify.presence)


query("F9_logistic")(_pipeline(lambda: learn.logistic(FEATURES, 20)))
query("F10_svm")(_pipeline(lambda: learn.svm(FEATURES, 10)))


@query("F14_cross_validate")
def f14(spark, folder):
    data = classify.fold(prepared(spark, folder), 3, "doc_id")
    model = NaiveBayes(featuresCol="counts", labelCol="label")
    pipeline = Pipeline(stages=[*learn.vectorize(FEATURES), model])
    grid = ParamGridBuilder().addGrid(model.smoothing, [0.1, 1.0]).build()
    found = learn.cross_validate(pipeline, grid, data, "fold", 3)
    rows = [(float(p[model.smoothing]), float(m)) for p, m in zip(grid, found.avgMetrics)]
    return spark.createDataFrame(rows, "smoothing double, f1 double")


@query("F15_save_model_score_table", f"WITH {_library_sql('true', 'documents')} SELECT doc_id, prediction FROM pred")
def f15(spark, folder):
    path = fresh_path(spark, "model")
    classify.save_nb(*_fit_smoothed(prepared(spark, folder)), path)
    docs = documents(spark, folder).select("doc_id", "text")
    found = classify.nb_predict(*classify.load_nb(spark, path), docs, terms.term_counts(docs))
    return found.select("doc_id", F.col("prediction").cast("double"))


@query("F16_lexicon_features")
def f16(spark, folder):
    data = prepared(spark, folder)
    scored = opinion.count_polarity(data, fx.opinion_lexicon(spark), key=["doc_id", "label", "side"])
    style = data.select(
        "doc_id",
        T.occurrences("text", T.EXCLAMATION).alias("exclamations"),
        T.shouted_words("text").alias("shouted"),
    )
    rows = scored.join(style, "doc_id")
    features = learn.lexicon_features(["pos", "neg", "net", "tokens", "exclamations", "shouted"])
    model = Pipeline(stages=[features, LogisticRegression(labelCol="label", maxIter=20)])
    fitted = model.fit(rows.filter("side = 'train'"))
    return fitted.transform(rows.filter("side = 'test'")).select("doc_id", "label", "prediction")
