"""Registered queries: sources, tokens and term statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosewell.operators import opinion, terms
from prosewell.plans import fixtures as fx
from prosewell.plans.registry import query
from prosewell.sources.corpus import write_corpus
from prosewell.sources.store import cut, fresh_path
from prosewell.sources.tables import deal, documents_as_corpus, read_table


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents", "doc_id")


def doc_count(spark: SparkSession, folder: str) -> int:
    return read_table(spark, folder, "documents").count()


@query(
    "A2_write_corpus",
    "SELECT doc_id, lang, source, length(text)::BIGINT AS chars, md5(text) AS digest FROM documents",
)
def a2(spark, folder):
    path = fresh_path(spark, "corpus")
    write_corpus(documents(spark, folder), path, partition_by="lang")
    return spark.read.parquet(path).select(
        "doc_id",
        F.col("lang").cast("string").alias("lang"),
        "source",
        F.length("text").cast("bigint").alias("chars"),
        F.md5("text").alias("digest"),
    )


@query(
    "A3_read_opinion_lexicon",
    f"""WITH {fx.HITS_SQL}
    SELECT l.word, l.polarity::INTEGER AS polarity, count(h.token) AS hits
    FROM lexicon l LEFT JOIN hits h ON l.word = h.token GROUP BY ALL""",
)
def a3(spark, folder):
    return opinion.lexicon_use(terms.tokenize(documents(spark, folder)), fx.opinion_lexicon(spark))


@query(
    "A5_documents_as_corpus",
    """SELECT d.doc_id, coalesce(l.toxic, -1)::BIGINT AS label, d.text
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def a5(spark, folder):
    out = documents_as_corpus(spark, folder)
    return out.select("doc_id", F.coalesce("label", F.lit(-1)).cast("bigint").alias("label"), "text")


@query("C1_tokenize", f"WITH {fx.TOKENS_SQL} SELECT doc_id, pos::BIGINT AS pos, token FROM tokens")
def c1(spark, folder):
    out = terms.tokenize(documents(spark, folder))
    return out.withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "C2_sentences",
    r"""WITH s AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[.!?]+\s+'), lambda x: trim(x) <> '') AS a
      FROM documents)
    SELECT doc_id, unnest(a) AS sentence, (generate_subscripts(a, 1) - 1)::BIGINT AS sent_no FROM s""",
)
def c2(spark, folder):
    out = terms.sentences(documents(spark, folder))
    return out.withColumn("sent_no", F.col("sent_no").cast("bigint"))


@query(
    "C3_remove_stop_words",
    f"""WITH {fx.TOKENS_SQL}
    SELECT doc_id, pos::BIGINT AS pos, token FROM tokens WHERE token NOT IN (SELECT word FROM {fx.STOPS_SQL})""",
)
def c3(spark, folder):
    tokens = terms.tokenize(documents(spark, folder))
    out = terms.remove_stop_words(tokens, fx.word_table(spark, fx.STOP_WORDS))
    return out.withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "C4_ngrams",
    f"""WITH {fx.TOKENS_SQL}, g AS (SELECT doc_id, pos,
      token || ' ' || lead(token, 1) OVER w || ' ' || lead(token, 2) OVER w AS ngram
      FROM tokens WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
    SELECT doc_id, pos::BIGINT AS pos, ngram FROM g WHERE ngram IS NOT NULL""",
)
def c4(spark, folder):
    out = terms.ngrams(documents(spark, folder), 3)
    return out.withColumn("pos", F.col("pos").cast("bigint"))


def _lemma_sql() -> str:
    rules = " UNION ALL ".join(
        f"SELECT token, {i} AS rank, left(token, length(token) - {len(s)}) || '{e}' AS lemma FROM forms "
        f"WHERE token LIKE '%{s}' AND length(token) > {len(s)}"
        for i, (_, s, e) in enumerate(terms.DETACHMENT_RULES, start=1)
    )
    return f"""WITH {fx.TOKENS_SQL},
    vocab AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM benchmark),
    forms AS (SELECT token, count(*) AS n FROM tokens GROUP BY token),
    cand AS (SELECT token, 0 AS rank, token AS lemma FROM forms UNION ALL {rules}),
    known AS (SELECT c.* FROM cand c SEMI JOIN vocab v ON c.lemma = v.word
      UNION ALL SELECT form, -1, lemma FROM {fx.EXCEPTION_SQL}),
    best AS (SELECT token, min_by(lemma, rank) AS lemma FROM known GROUP BY token)
    SELECT coalesce(b.lemma, f.token) AS lemma, sum(f.n)::BIGINT AS n, count(*)::BIGINT AS forms
    FROM forms f LEFT JOIN best b ON f.token = b.token GROUP BY 1"""


@query("C5_lemmatize", _lemma_sql())
def c5(spark, folder):
    vocabulary = (
        terms.tokenize(read_table(spark, folder, "benchmark"), key="item_id")
        .select(F.col("token").alias("word"))
        .distinct()
    )
    tokens = terms.tokenize(documents(spark, folder))
    lemmas = terms.lemmatize(tokens, vocabulary, fx.exception_table(spark))
    per_form = lemmas.groupBy("lemma", "token").agg(F.count(F.lit(1)).alias("n"))
    return per_form.groupBy("lemma").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("forms")
    )


@query(
    "C6_doc_stats",
    """WITH s AS (SELECT doc_id, coalesce(regexp_extract_all(lower(text), '[a-z]+'), []) AS t FROM documents)
    SELECT doc_id, len(t)::BIGINT AS tokens, len(list_distinct(t))::BIGINT AS distinct_tokens,
      coalesce(round(length(array_to_string(t, '')) / nullif(len(t), 0), 6), -1) AS mean_length,
      coalesce(round(len(list_distinct(t)) / nullif(len(t), 0), 6), -1) AS type_token_ratio FROM s""",
)
def c6(spark, folder):
    out = terms.doc_stats(documents(spark, folder))
    for c in ("mean_length", "type_token_ratio"):
        out = out.withColumn(c, F.coalesce(F.round(c, 6), F.lit(-1.0)))
    return out


@query(
    "C7_term_counts",
    f"WITH {fx.TOKENS_SQL} SELECT doc_id, token, count(*) AS tf FROM tokens GROUP BY ALL",
)
def c7(spark, folder):
    return terms.term_counts(documents(spark, folder))


@query(
    "C7_count_tokens",
    f"""WITH {fx.TOKENS_SQL} SELECT doc_id, token, count(*) AS tf FROM tokens
    WHERE token NOT IN (SELECT word FROM {fx.STOPS_SQL}) GROUP BY ALL""",
)
def c7b(spark, folder):
    # Counts of (document, word) are held by the task that has the document.
    tokens = terms.tokenize(deal(read_table(spark, folder, "documents").select("doc_id", "text"), "doc_id"))
    return terms.count_tokens(terms.remove_stop_words(tokens, fx.word_table(spark, fx.STOP_WORDS)))


TF_SQL = (
    fx.TOKENS_SQL
    + """, tf AS (SELECT doc_id, lang, source, token, count(*) AS tf FROM tokens GROUP BY ALL),
df AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
n AS (SELECT count(*) AS n FROM documents),
tfidf AS (SELECT tf.*, df.df, tf.tf * ln((n.n + 1) / (df.df + 1)) AS tf_idf FROM tf JOIN df ON tf.token = df.token, n)
"""
)


@query("C8_doc_freq", f"WITH {TF_SQL} SELECT token, df FROM df WHERE df BETWEEN 2 AND 500")
def c8(spark, folder):
    return terms.doc_freq(terms.term_counts(documents(spark, folder)), 2, 500)


@query(
    "C9_tf_idf", f"WITH {TF_SQL} SELECT doc_id, token, tf, df, round(tf_idf, 6) AS tf_idf FROM tfidf"
)
def c9(spark, folder):
    tf = terms.term_counts(documents(spark, folder))
    out = terms.tf_idf(tf, cut(terms.doc_freq(tf)), doc_count(spark, folder))
    return out.withColumn("tf_idf", F.round("tf_idf", 6))


@query(
    "C10_top_terms",
    f"""WITH {TF_SQL}, s AS (SELECT lang, source, token, sum(tf_idf) AS score FROM tfidf GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY round(score, 9) DESC, token) AS rank FROM s)
    SELECT lang, source, token, round(score, 6) AS score, rank FROM r WHERE rank <= 10""",
)
def c10(spark, folder):
    tf = terms.term_counts(documents(spark, folder), key=["doc_id", "lang", "source"])
    weights = terms.group_tf_idf(tf, ["lang", "source"], doc_count(spark, folder))
    out = terms.top_terms(weights, ["lang", "source"], 10)
    return out.select(
        "lang", "source", "token", F.round("score", 6).alias("score"), F.col("rank").cast("bigint")
    )


def association_ctes(label: str) -> str:
    return (
        TF_SQL
        + f""", lab AS (SELECT doc_id, {label} AS label FROM labels WHERE {label} IS NOT NULL),
    nl AS (SELECT label, count(*) AS n_label FROM lab GROUP BY label),
    big AS (SELECT count(*)::DOUBLE AS n FROM lab),
    tl AS (SELECT token, label, count(*) AS n_both FROM tf JOIN lab USING (doc_id) GROUP BY ALL),
    nt AS (SELECT token, sum(n_both) AS n_token FROM tl GROUP BY token),
    cells AS (SELECT token, label, n_both::DOUBLE AS a, (n_token - n_both)::DOUBLE AS b,
      (n_label - n_both)::DOUBLE AS c, (n - n_token - n_label + n_both)::DOUBLE AS d, n
      FROM tl JOIN nt USING (token) JOIN nl USING (label), big)
    """
    )


CHI_SQL = "coalesce(n * pow(a * d - b * c, 2) / nullif((a + b) * (c + d) * (a + c) * (b + d), 0), 0)"
MI_SQL = " + ".join(
    f"(CASE WHEN {x} > 0 THEN {x} / n * ln(n * {x} / (({r}) * ({k}))) ELSE 0 END)"
    for x, r, k in (
        ("a", "a + b", "a + c"),
        ("b", "a + b", "b + d"),
        ("c", "c + d", "a + c"),
        ("d", "c + d", "b + d"),
    )
)
ODDS_SQL = "ln((a + 0.5) * (d + 0.5) / ((b + 0.5) * (c + 0.5)))"


def _association(measure: str):
    def build(spark, folder):
        out = terms.term_association(documents_as_corpus(spark, folder), measure)
        return out.select("token", F.col("label").cast("bigint").alias("label"), F.round("score", 6).alias("score"))

    return build


for _measure, _sql in (("chi_square", CHI_SQL), ("mutual_information", MI_SQL), ("log_odds", ODDS_SQL)):
    query(
        f"C11_term_association_{_measure}",
        f"""WITH {association_ctes('toxic')}
        SELECT token, label::BIGINT AS label, round({_sql}, 6) AS score FROM cells""",
    )(_association(_measure))
