"""Registered queries: sense lexicon and word-sense disambiguation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosewell.operators import senses as S
from prosewell.operators import terms
from prosewell.operators.joins import lookup
from prosewell.plans import fixtures as fx
from prosewell.plans.registry import query, values_sql
from prosewell.plans.sentiment import scores
from prosewell.plans.text import documents
from prosewell.sources.store import cut

K = 5

SENSE_CTES = f"""{fx.HITS_SQL}, synsets AS (SELECT * FROM {fx.SENSES_SQL}),
ex AS (SELECT unnest(string_split(terms, ' ')) AS term, pos AS pos_tag, synset_id, pos_score::DOUBLE AS pos_score,
  neg_score::DOUBLE AS neg_score, gloss FROM synsets),
senses AS (SELECT string_split(term, '#')[1] AS lemma, pos_tag, string_split(term, '#')[2]::INT AS sense_no, synset_id,
  pos_score, neg_score, gloss FROM ex),
lemmas AS (SELECT DISTINCT lemma FROM senses),
targets AS (SELECT k.* FROM tokens k JOIN lemmas l ON k.token = l.lemma),
cand AS (SELECT t.doc_id, t.lang, t.source, t.pos, t.token, s.pos_tag, s.sense_no, s.synset_id, s.pos_score, s.neg_score
  FROM targets t JOIN senses s ON t.token = s.lemma),
first_ AS (SELECT *, row_number() OVER (PARTITION BY doc_id, pos ORDER BY sense_no, pos_tag, synset_id) AS rn FROM cand),
first_sense AS (SELECT * FROM first_ WHERE rn = 1),
ctx AS (SELECT a.doc_id, a.pos, a.token, b.token AS word FROM targets a
  JOIN tokens b ON a.doc_id = b.doc_id AND b.pos BETWEEN a.pos - {K} AND a.pos + {K} AND a.pos <> b.pos),
gw AS (SELECT DISTINCT pos_tag, synset_id, word FROM (SELECT pos AS pos_tag, synset_id, unnest(regexp_extract_all(lower(gloss), '[a-z]+')) AS word FROM synsets)
  WHERE word NOT IN (SELECT word FROM {fx.STOPS_SQL})),
ov AS (SELECT c.doc_id, c.pos, c.pos_tag, c.synset_id, c.sense_no, count(DISTINCT x.word) AS overlap FROM cand c
  JOIN gw g ON g.synset_id = c.synset_id AND g.pos_tag = c.pos_tag JOIN ctx x ON x.doc_id = c.doc_id AND x.pos = c.pos AND x.word = g.word GROUP BY ALL),
rk AS (SELECT c.*, coalesce(o.overlap, 0) AS overlap, row_number() OVER (PARTITION BY c.doc_id, c.pos
  ORDER BY coalesce(o.overlap, 0) DESC, c.sense_no, c.pos_tag, c.synset_id) AS rn
  FROM cand c LEFT JOIN ov o ON o.doc_id = c.doc_id AND o.pos = c.pos AND o.pos_tag = c.pos_tag AND o.synset_id = c.synset_id AND o.sense_no = c.sense_no),
chosen AS (SELECT * FROM rk WHERE rn = 1),
ss AS (SELECT doc_id, sum(pos_score) AS p, sum(neg_score) AS q FROM chosen GROUP BY doc_id),
sense_scores AS (SELECT doc_id, p, q, round(p - q, 9) AS net,
  CASE WHEN round(p - q, 9) > 0 THEN 'positive' WHEN round(p - q, 9) < 0 THEN 'negative' ELSE 'neutral' END AS class FROM ss)
"""


def sense_table(spark: SparkSession) -> DataFrame:
    return S.explode_senses(fx.sense_lexicon(spark))


def chosen(spark: SparkSession, folder: str, key: list[str] | None = None) -> DataFrame:
    table = sense_table(spark)
    inventory = S.sense_inventory(table, fx.word_table(spark, fx.STOP_WORDS))
    contexts = S.target_contexts(documents(spark, folder), table, K, key=key or ["doc_id"])
    return S.disambiguate(contexts, inventory)


@query(
    "A4_read_sense_lexicon",
    f"""WITH {SENSE_CTES} SELECT y.synset_id, y.pos AS pos_tag, round(1 - y.pos_score::DOUBLE - y.neg_score::DOUBLE, 6) AS obj_score, y.gloss,
      count(c.doc_id) AS uses FROM synsets y LEFT JOIN cand c ON c.synset_id = y.synset_id AND c.pos_tag = y.pos GROUP BY ALL""",
)
def a4(spark, folder):
    synsets = fx.sense_lexicon(spark)
    uses = (
        S.candidate_senses(terms.tokenize(documents(spark, folder)), S.explode_senses(synsets))
        .groupBy(F.col("sense_pos_tag").alias("pos"), "synset_id")
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    return synsets.join(uses, ["pos", "synset_id"], "left").select(
        "synset_id",
        F.col("pos").alias("pos_tag"),
        F.round("obj_score", 6).alias("obj_score"),
        "gloss",
        F.coalesce("uses", F.lit(0)).cast("bigint").alias("uses"),
    )


@query(
    "E1_explode_senses",
    f"""WITH {SENSE_CTES} SELECT s.lemma, s.pos_tag, s.sense_no::BIGINT AS sense_no, s.synset_id, count(t.token) AS occurrences
    FROM senses s LEFT JOIN targets t ON t.token = s.lemma GROUP BY ALL""",
)
def e1(spark, folder):
    table = sense_table(spark)
    found = (
        S.candidate_senses(terms.tokenize(documents(spark, folder)), table)
        .groupBy(F.col("token").alias("lemma"), F.col("sense_pos_tag").alias("pos_tag"), "synset_id", "sense_no")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )
    return table.join(found, ["lemma", "pos_tag", "synset_id", "sense_no"], "left").select(
        "lemma",
        "pos_tag",
        F.col("sense_no").cast("bigint"),
        "synset_id",
        F.coalesce("occurrences", F.lit(0)).cast("bigint").alias("occurrences"),
    )


@query(
    "E2_candidate_senses",
    f"WITH {SENSE_CTES} SELECT doc_id, pos::BIGINT AS pos, token, pos_tag, sense_no::BIGINT AS sense_no, synset_id FROM cand",
)
def e2(spark, folder):
    out = S.candidate_senses(terms.tokenize(documents(spark, folder)), sense_table(spark))
    return out.select(
        "doc_id",
        F.col("pos").cast("bigint"),
        "token",
        F.col("sense_pos_tag").alias("pos_tag"),
        F.col("sense_no").cast("bigint"),
        "synset_id",
    )


@query(
    "E2_candidate_senses_tagged",
    f"""WITH {SENSE_CTES} SELECT c.doc_id, c.pos::BIGINT AS pos, c.token, c.pos_tag, c.synset_id
    FROM cand c JOIN {values_sql(fx.POS_TAGS, 'token, pos_tag')} ON c.token = t.token AND c.pos_tag = t.pos_tag""",
)
def e2b(spark, folder):
    tags = fx.table(spark, fx.POS_TAGS, "token string, pos_tag string")
    tagged = lookup(terms.tokenize(documents(spark, folder)), tags, "token")
    out = S.candidate_senses(tagged, sense_table(spark))
    return out.select("doc_id", F.col("pos").cast("bigint"), "token", "pos_tag", "synset_id")


@query(
    "E3_first_sense_score",
    f"WITH {SENSE_CTES} SELECT doc_id, pos::BIGINT AS pos, token, synset_id, pos_score, neg_score FROM first_sense",
)
def e3(spark, folder):
    out = S.first_sense_score(terms.tokenize(documents(spark, folder)), sense_table(spark))
    return out.withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "E4_weighted_sense_score",
    f"""WITH {SENSE_CTES}, w AS (SELECT lemma, pos_tag, sum(pos_score / sense_no) / sum(1.0::DOUBLE / sense_no) AS p,
      sum(neg_score / sense_no) / sum(1.0::DOUBLE / sense_no) AS q FROM senses GROUP BY ALL),
    v AS (SELECT lemma, avg(p) AS p, avg(q) AS q FROM w GROUP BY lemma)
    SELECT t.doc_id, round(sum(v.p), 6) AS pos, round(sum(v.q), 6) AS neg FROM targets t JOIN v ON t.token = v.lemma GROUP BY t.doc_id""",
)
def e4(spark, folder):
    weighted = S.weighted_sense_score(sense_table(spark))
    any_pos = weighted.groupBy(F.col("lemma").alias("token")).agg(
        F.avg("pos_score").alias("pos_score"), F.avg("neg_score").alias("neg_score")
    )
    hits = lookup(terms.tokenize(documents(spark, folder)), any_pos, "token")
    out = S.score_senses(hits)
    return out.select("doc_id", F.round("pos", 6).alias("pos"), F.round("neg", 6).alias("neg"))


@query(
    "E5_context_words",
    f"WITH {SENSE_CTES} SELECT doc_id, pos::BIGINT AS pos, token, word, count(*) AS n FROM ctx GROUP BY ALL",
)
def e5(spark, folder):
    out = S.context_words(documents(spark, folder), sense_table(spark), K)
    return out.groupBy("doc_id", F.col("pos").cast("bigint").alias("pos"), "token", "word").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "E6_gloss_words",
    f"""WITH {SENSE_CTES}, f AS (SELECT token, count(*) AS n FROM tokens GROUP BY token)
    SELECT pos_tag, synset_id, word, coalesce(f.n, 0) AS n FROM gw LEFT JOIN f ON gw.word = f.token""",
)
def e6(spark, folder):
    words = S.gloss_words(sense_table(spark), fx.word_table(spark, fx.STOP_WORDS))
    vocabulary = words.select(F.col("word").alias("token")).distinct()
    seen = (
        lookup(terms.tokenize(documents(spark, folder)), vocabulary, "token", "left_semi")
        .groupBy(F.col("token").alias("word"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return words.join(seen, "word", "left").select(
        "pos_tag", "synset_id", "word", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


@query(
    "E7_disambiguate",
    f"""WITH {SENSE_CTES} SELECT doc_id, pos::BIGINT AS pos, token, sense_no::BIGINT AS sense_no, pos_tag, synset_id,
    overlap FROM chosen""",
)
def e7(spark, folder):
    return chosen(spark, folder).select(
        "doc_id",
        F.col("pos").cast("bigint"),
        "token",
        F.col("sense_no").cast("bigint"),
        F.col("sense_pos_tag").alias("pos_tag"),
        "synset_id",
        F.col("overlap").cast("bigint"),
    )


@query(
    "E8_score_senses",
    f"WITH {SENSE_CTES} SELECT doc_id, round(p, 6) AS pos, round(q, 6) AS neg, round(net, 6) AS net, class FROM sense_scores",
)
def score_senses(spark, folder):
    """Polarity of every document from the senses its words have in context."""
    out = S.score_senses(chosen(spark, folder))
    return out.select("doc_id", *[F.round(c, 6).alias(c) for c in ("pos", "neg", "net")], "class")


@query(
    "E9_spot_phrases",
    f"""WITH {SENSE_CTES}, ph AS (SELECT DISTINCT replace(lemma, '_', ' ') AS phrase, len(string_split(lemma, '_')) AS n
      FROM senses WHERE contains(lemma, '_')),
    g AS (SELECT doc_id, pos, token || ' ' || lead(token, 1) OVER w AS g2,
      token || ' ' || lead(token, 1) OVER w || ' ' || lead(token, 2) OVER w AS g3
      FROM tokens WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
    h AS (SELECT doc_id, pos, n, phrase FROM g JOIN ph ON phrase = g2 UNION ALL SELECT doc_id, pos, n, phrase FROM g JOIN ph ON phrase = g3)
    SELECT doc_id, pos::BIGINT AS pos, n::BIGINT AS n, phrase FROM h a WHERE NOT EXISTS (SELECT 1 FROM h b
      WHERE b.doc_id = a.doc_id AND b.pos < a.pos + a.n AND a.pos < b.pos + b.n
      AND (b.n > a.n OR (b.n = a.n AND b.pos < a.pos)))""",
)
def e9(spark, folder):
    out = S.spot_phrases(documents(spark, folder), sense_table(spark))
    return out.select("doc_id", F.col("pos").cast("bigint"), F.col("n").cast("bigint"), "phrase")


@query(
    "E10_sense_distribution",
    f"""WITH {SENSE_CTES} SELECT token AS lemma, lang, count(*) FILTER (sense_no = 1) AS sense_1,
    count(*) FILTER (sense_no = 2) AS sense_2, count(*) FILTER (sense_no NOT IN (1, 2)) AS other FROM chosen GROUP BY ALL""",
)
def e10(spark, folder):
    return S.sense_distribution(chosen(spark, folder, ["doc_id", "lang"]), "lang", [1, 2])


FIRST_SCORES_SQL = """, fs AS (SELECT doc_id, round(sum(pos_score) - sum(neg_score), 9) AS net FROM first_sense GROUP BY doc_id),
first_scores AS (SELECT doc_id, CASE WHEN net > 0 THEN 'positive' WHEN net < 0 THEN 'negative' ELSE 'neutral' END AS class FROM fs)
"""
AGREEMENT_SQL = """, t AS (SELECT coalesce(a.class, 'none') AS class_a, coalesce(b.class, 'none') AS class_b, count(*) AS n
  FROM {a} a FULL OUTER JOIN {b} b ON a.doc_id = b.doc_id GROUP BY ALL)
"""


@query(
    "E11_compare_lexicon_senses",
    f"WITH {SENSE_CTES} {AGREEMENT_SQL.format(a='classed', b='sense_scores')} SELECT class_a, class_b, n FROM t",
)
def e11(spark, folder):
    return S.agreement_table(scores(spark, folder), S.score_senses(chosen(spark, folder)))


def _kappa_sql(a: str, b: str) -> str:
    return f"""WITH {SENSE_CTES} {FIRST_SCORES_SQL} {AGREEMENT_SQL.format(a=a, b=b)},
    ra AS (SELECT class_a AS c, sum(n)::DOUBLE AS a FROM t GROUP BY 1), rb AS (SELECT class_b AS c, sum(n)::DOUBLE AS b FROM t GROUP BY 1),
    z AS (SELECT sum(n)::DOUBLE AS n, coalesce(sum(n) FILTER (class_a = class_b), 0)::DOUBLE AS same FROM t),
    e AS (SELECT coalesce(sum(a * b), 0) AS ab FROM ra JOIN rb USING (c))
    SELECT n::BIGINT AS n, round(same / n, 6) AS agreement, round(ab / (n * n), 6) AS expected,
      round((same / n - ab / (n * n)) / (1 - ab / (n * n)), 6) AS kappa FROM z, e"""


def _kappa(table: DataFrame) -> DataFrame:
    out = S.cohen_kappa(cut(table))
    return out.select("n", *[F.round(c, 6).alias(c) for c in ("agreement", "expected", "kappa")])


@query("E11_kappa_lexicon_senses", _kappa_sql("classed", "sense_scores"))
def e11b(spark, folder):
    return _kappa(e11(spark, folder))


@query("E11_kappa_first_chosen", _kappa_sql("first_scores", "sense_scores"))
def e11c(spark, folder):
    first = S.score_senses(
        S.first_sense_score(terms.tokenize(documents(spark, folder)), sense_table(spark))
    )
    return _kappa(S.agreement_table(first, S.score_senses(chosen(spark, folder))))
