"""Registered queries: opinion lexicon."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosewell.operators import opinion, terms
from prosewell.plans import fixtures as fx
from prosewell.plans.registry import query, values_sql
from prosewell.plans.text import documents
from prosewell.sources.tables import read_table


def scores(spark: SparkSession, folder: str) -> DataFrame:
    return opinion.classify_polarity(
        opinion.count_polarity(
            documents(spark, folder), fx.opinion_lexicon(spark), key=["doc_id", "lang", "source"]
        )
    )


def score_opinions(spark: SparkSession, folder: str) -> DataFrame:
    """How positive and negative the documents are, by language and source with subtotals."""
    out = opinion.polarity_by(scores(spark, folder), ["lang", "source"])
    return out.select(
        F.coalesce("lang", F.lit("(all)")).alias("lang"),
        F.coalesce("source", F.lit("(all)")).alias("source"),
        "level",
        "docs",
        *[
            F.round(c, 6).alias(c)
            for c in ("mean_net", "share_positive", "share_negative", "share_neutral")
        ],
    )


@query(
    "D1_spot_words",
    f"WITH {fx.HITS_SQL} SELECT doc_id, pos::BIGINT AS pos, token, polarity::BIGINT AS polarity FROM hits",
)
def d1(spark, folder):
    out = opinion.spot_words(terms.tokenize(documents(spark, folder)), fx.opinion_lexicon(spark))
    return out.select("doc_id", F.col("pos").cast("bigint"), "token", F.col("polarity").cast("bigint"))


@query("D2_count_polarity", f"WITH {fx.HITS_SQL} SELECT doc_id, tokens, pos, neg, net FROM scores")
def d2(spark, folder):
    return opinion.count_polarity(documents(spark, folder), fx.opinion_lexicon(spark))


@query("D3_classify_polarity", f"WITH {fx.HITS_SQL} SELECT doc_id, net, class FROM classed")
def d3(spark, folder):
    return scores(spark, folder).select("doc_id", "net", "class")


@query(
    "D4_normalized_score",
    f"""WITH {fx.HITS_SQL} SELECT doc_id, coalesce(round(net / nullif(pos + neg, 0), 6), -9) AS net_per_hit,
    coalesce(round(net / nullif(tokens, 0), 6), -9) AS net_per_token FROM scores""",
)
def d4(spark, folder):
    out = opinion.normalized_score(scores(spark, folder))
    return out.select(
        "doc_id",
        *[F.coalesce(F.round(c, 6), F.lit(-9.0)).alias(c) for c in ("net_per_hit", "net_per_token")],
    )


@query(
    "D5_negate",
    f"""WITH a AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+(?:''[a-z]+)?') AS t FROM documents),
    k AS (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS pos FROM a),
    f AS (SELECT *, coalesce(max(CASE WHEN token IN ({', '.join("'" + w.replace("'", "''") + "'" for w in fx.NEGATORS)}) THEN 1 ELSE 0 END)
      OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 0) AS neg FROM k)
    SELECT doc_id, pos::BIGINT AS pos, token, neg = 1 AS negated,
      (CASE WHEN neg = 1 THEN -polarity ELSE polarity END)::BIGINT AS polarity
    FROM f JOIN {fx.LEXICON_SQL} ON f.token = t.word""",
)
def d5(spark, folder):
    out = opinion.negate(documents(spark, folder), fx.opinion_lexicon(spark), fx.NEGATORS, 3)
    return out.withColumn("pos", F.col("pos").cast("bigint")).withColumn(
        "polarity", F.col("polarity").cast("bigint")
    )


SENTENCE_SQL = f"""a AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[.!?]+\\s+'), lambda x: trim(x) <> '') AS s FROM documents),
    b AS (SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS sent_no FROM a),
    k AS (SELECT doc_id, sent_no, unnest(regexp_extract_all(lower(sentence), '[a-z]+')) AS token FROM b),
    h AS (SELECT doc_id, sent_no, sum(polarity) AS net FROM k JOIN {fx.LEXICON_SQL} ON k.token = t.word GROUP BY ALL),
    p AS (SELECT b.doc_id, b.sent_no, coalesce(h.net, 0)::BIGINT AS net FROM b LEFT JOIN h USING (doc_id, sent_no))"""


@query(
    "D6_sentence_polarity",
    f"WITH {SENTENCE_SQL} SELECT doc_id, sent_no::BIGINT AS sent_no, net FROM p",
)
def d6(spark, folder):
    out = opinion.sentence_polarity(documents(spark, folder), fx.opinion_lexicon(spark))
    return out.withColumn("sent_no", F.col("sent_no").cast("bigint"))


@query(
    "D6_sentence_majority",
    f"""WITH {SENTENCE_SQL}, m AS (SELECT doc_id, count(*) AS sentences, count(*) FILTER (net > 0) AS pos_sentences,
      count(*) FILTER (net < 0) AS neg_sentences FROM p GROUP BY doc_id)
    SELECT *, CASE WHEN pos_sentences > neg_sentences THEN 'positive'
      WHEN pos_sentences < neg_sentences THEN 'negative' ELSE 'neutral' END AS class FROM m""",
)
def d6b(spark, folder):
    return opinion.sentence_majority(
        opinion.sentence_polarity(documents(spark, folder), fx.opinion_lexicon(spark))
    )


# The generated prose holds no emoticons. Each document gets marks that follow from its own
# punctuation: "!!" is read as a smile and "##" as a frown.
MARKED_SQL = "replace(replace(text, '!!', ' :) '), '##', ' :-( ')"


@query(
    "D7_spot_emoticons",
    f"""WITH a AS (SELECT doc_id, regexp_extract_all({MARKED_SQL}, '[:;]-?[)(DP]') AS e FROM documents),
    b AS (SELECT doc_id, unnest(e) AS emoticon, generate_subscripts(e, 1) - 1 AS seq FROM a)
    SELECT doc_id, seq::BIGINT AS seq, b.emoticon, t.polarity::BIGINT AS polarity
    FROM b JOIN {fx.EMOTICON_SQL} ON b.emoticon = t.emoticon""",
)
def d7(spark, folder):
    marked = documents(spark, folder).select("doc_id", F.expr(MARKED_SQL).alias("text"))
    out = opinion.spot_emoticons(marked, fx.emoticon_table(spark))
    return out.select("doc_id", F.col("seq").cast("bigint"), "emoticon", F.col("polarity").cast("bigint"))


query(
    "D8_polarity_by",
    f"""WITH {fx.HITS_SQL}
    SELECT coalesce(lang, '(all)') AS lang, coalesce(source, '(all)') AS source,
      grouping(lang, source)::BIGINT AS level, count(*) AS docs, round(avg(net), 6) AS mean_net,
      round(avg((class = 'positive')::INT), 6) AS share_positive,
      round(avg((class = 'negative')::INT), 6) AS share_negative,
      round(avg((class = 'neutral')::INT), 6) AS share_neutral
    FROM classed GROUP BY ROLLUP (lang, source)""",
)(score_opinions)


def _grouped_sql(grouping: str) -> str:
    return f"""WITH {fx.HITS_SQL}, g AS (SELECT *, doc_id % 3 AS part FROM classed)
    SELECT coalesce(lang, '(all)') AS lang, coalesce(source, '(all)') AS source, coalesce(part, -1)::BIGINT AS part, grouping(lang, source, part)::BIGINT AS level,
      count(*) AS docs, round(avg(net), 6) AS mean_net, round(avg((class = 'negative')::INT), 6) AS share_negative FROM g GROUP BY {grouping}"""


def _grouped(spark: SparkSession, folder: str, how: str | list[list[str]]) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "lang", "source", "text")
    counted = opinion.count_polarity(docs, fx.opinion_lexicon(spark), key=["doc_id", "lang", "source"])
    classed = opinion.classify_polarity(counted).withColumn("part", F.col("doc_id") % 3)
    out = opinion.polarity_by(classed, ["lang", "source", "part"], how)
    return out.select(
        F.coalesce("lang", F.lit("(all)")).alias("lang"),
        F.coalesce("source", F.lit("(all)")).alias("source"),
        F.coalesce("part", F.lit(-1)).cast("bigint").alias("part"),
        "level",
        "docs",
        F.round("mean_net", 6).alias("mean_net"),
        F.round("share_negative", 6).alias("share_negative"),
    )


@query("D8_polarity_cube", _grouped_sql("CUBE (lang, source, part)"))
def d8_cube(spark, folder):
    """Polarity by every combination of language, source and a third of the documents."""
    return _grouped(spark, folder, "cube")


@query("D8_polarity_sets", _grouped_sql("GROUPING SETS ((lang, part), (source), ())"))
def d8_sets(spark, folder):
    return _grouped(spark, folder, [["lang", "part"], ["source"], []])


@query(
    "D9_top_opinion_words",
    f"""WITH {fx.HITS_SQL}, c AS (SELECT lang, polarity, token, count(*) AS n FROM hits GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY lang, polarity ORDER BY n DESC, token) AS rank FROM c)
    SELECT lang, polarity::BIGINT AS polarity, token, n, rank FROM r WHERE rank <= 3""",
)
def d9(spark, folder):
    tokens = terms.tokenize(documents(spark, folder), key=["doc_id", "lang"])
    out = opinion.top_opinion_words(opinion.spot_words(tokens, fx.opinion_lexicon(spark)), "lang", 3)
    return out.withColumn("polarity", F.col("polarity").cast("bigint")).withColumn(
        "rank", F.col("rank").cast("bigint")
    )


@query(
    "D10_lexicon_coverage",
    f"""WITH {fx.HITS_SQL}, n AS (SELECT count(*) AS tokens FROM tokens),
    s AS (SELECT count(*) AS hits, count(DISTINCT token) AS seen FROM hits),
    z AS (SELECT count(*) AS lexicon_words FROM lexicon)
    SELECT tokens, hits, round(hits / tokens, 6) AS share, lexicon_words, lexicon_words - seen AS never_seen FROM n, s, z""",
)
def d10(spark, folder):
    out = opinion.lexicon_coverage(terms.tokenize(documents(spark, folder)), fx.opinion_lexicon(spark))
    return out.withColumn("share", F.round("share", 6))


def conversation_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Turns scored by frequent words of the generated prose; none of the insults occurs in them."""
    turns = read_table(spark, folder, "conversations", ["conv_id", "turn"])
    lexicon = fx.table(spark, TURN_LEXICON, "word string, polarity int")
    return opinion.count_polarity(turns, lexicon, key=["conv_id", "turn", "role"])


TURN_LEXICON = [("the", 1), ("with", 1), ("la", 1), ("die", 1), ("of", -1), ("de", -1), ("und", -1), ("that", -1)]


def _turn_sql(by: str) -> str:
    return f"""WITH k AS (SELECT conv_id, turn, role, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM conversations),
    h AS (SELECT conv_id, turn, count(*) FILTER (polarity > 0) AS pos, count(*) FILTER (polarity < 0) AS neg
      FROM k JOIN {values_sql(TURN_LEXICON, 'word, polarity')} ON k.token = t.word GROUP BY ALL)
    SELECT c.{by}, count(*) AS docs, coalesce(sum(pos), 0)::BIGINT AS pos, coalesce(sum(neg), 0)::BIGINT AS neg,
      (coalesce(sum(pos), 0) - coalesce(sum(neg), 0))::BIGINT AS net
    FROM conversations c LEFT JOIN h USING (conv_id, turn) GROUP BY 1"""


@query("D11_thread_polarity", _turn_sql("conv_id"))
def d11(spark, folder):
    return opinion.polarity_of(conversation_scores(spark, folder), "conv_id")


@query("D11_sender_polarity", _turn_sql("role"))
def d11b(spark, folder):
    return opinion.polarity_of(conversation_scores(spark, folder), "role")


@query(
    "D12_extreme_documents",
    f"""WITH {fx.HITS_SQL}
    (SELECT doc_id, net, 'positive' AS "end" FROM scores ORDER BY net DESC, doc_id LIMIT 20)
    UNION ALL (SELECT doc_id, net, 'negative' AS "end" FROM scores ORDER BY net, doc_id LIMIT 20)""",
)
def d12(spark, folder):
    return opinion.extreme_documents(scores(spark, folder).select("doc_id", "net"), 20)
