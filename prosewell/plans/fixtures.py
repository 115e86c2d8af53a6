"""Small hand-written lexicons for the registered queries, in the published layouts."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from prosewell.plans.registry import values_sql
from prosewell.sources.lexicons import merge_word_lists, parse_sense_lexicon

# The opinion lexicon used against the generated documents.
POSITIVE_FILE = """; positive words
best
"""
NEGATIVE_FILE = """; negative words
idiot
trash
scum
clown
moron
worthless
pathetic
loser
disgusting
stupid
"""

# Stop words, negators, emoticons and irregular forms.
STOP_WORDS = ["a", "the", "of", "and", "to", "in"]
# The generated prose has no English negators, so two frequent words stand in beside the real ones.
NEGATORS = ["not", "no", "never", "isn't", "don't", "of", "that"]
EMOTICONS = [(":)", 1), (":-)", 1), (";)", 1), (";-)", 1), (":D", 1), (":(", -1), (":-(", -1)]
EXCEPTIONS = [("been", "be", "v"), ("was", "be", "v"), ("were", "be", "v"), ("men", "man", "n")]

# A tiny graded sense lexicon; scores and glosses are invented.
SENSE_FILE = """# pos\tid\tpos_score\tneg_score\tterms\tgloss
a\t00000001\t0.75\t0\tbest#1\tof the highest quality that is in reach
r\t00000001\t0.5\t0.125\tbest#2\tin the way that was on for it; "by the best"
n\t00000003\t0\t0.625\tidiot#1 moron#1\ta person that is not with it at all
n\t00000004\t0\t0.25\tmoron#2\tan old word for one that was by the shore
n\t00000005\t0\t0.375\ttrash#1\tthings to be thrown out from here
v\t00000005\t0\t0.75\ttrash#2\tto speak of it as are the worst
n\t00000007\t0\t0.5\tscum#1\ta film that is on the water
n\t00000008\t0\t0.875\tscum#2 trash#3\tpeople that are as low as this
n\t00000009\t0.125\t0.25\tclown#1\tone that is in the show for this
v\t00000009\t0\t0.375\tclown#2\tto act as it was with you
a\t00000011\t0\t0.75\tworthless#1\tof no use by or for this
a\t00000012\t0\t0.5\tpathetic#1 stupid#2\tthat is to be pitied
n\t00000013\t0\t0.625\tloser#1\tone that was on the end of it
a\t00000014\t0\t1\tdisgusting#1\twith a taste that are to be left
a\t00000003\t0\t0.625\tstupid#1\tnot at all with it
n\t00000016\t0\t0\thand#1\tthe end of the arm that is to hold with
n\t00000017\t0.25\t0\thand#2\tone that was for work as this
v\t00000016\t0.125\t0\thand#3\tto pass it on by arm from one to another
n\t00000019\t0.25\t0\trest#1\tan end of work for you
v\t00000019\t0.125\t0.125\trest#2\tto be at ease on it
n\t00000021\t0\t0.125\theat#1\tthat which is from fire
v\t00000021\t0\t0\theat#2\tto warm it with or by fire
n\t00000023\t0\t0.5\tsting#1\ta hurt that was by this
n\t00000024\t0\t0\tof_the#1\ta phrase that is from the text
n\t00000025\t0.125\t0\tthe_of#1\ta phrase that was from it
n\t00000026\t0.25\t0\tof_the_and#1 and_the_of#1\ta long phrase for this
n\t00000027\t0\t0.25\tthe_and#1\tanother phrase with this
"""

POS_TAGS = [("best", "a"), ("trash", "v"), ("clown", "n"), ("hand", "n"), ("rest", "v"), ("heat", "n")]


def table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table that is part of the plan itself."""
    names = [field.split()[0] for field in schema.split(", ")]
    columns = {name: [row[i] for row in rows] for i, name in enumerate(names)}
    return spark.createDataFrame(pa.table(columns), schema)


def lines(spark: SparkSession, content: str) -> DataFrame:
    return table(spark, [(line,) for line in content.split("\n")], "value string")


def opinion_lexicon(spark: SparkSession) -> DataFrame:
    return merge_word_lists(lines(spark, POSITIVE_FILE), lines(spark, NEGATIVE_FILE))


def sense_lexicon(spark: SparkSession) -> DataFrame:
    return parse_sense_lexicon(lines(spark, SENSE_FILE))


def word_table(spark: SparkSession, words: list[str]) -> DataFrame:
    return table(spark, [(w,) for w in words], "word string")


def emoticon_table(spark: SparkSession) -> DataFrame:
    return table(spark, EMOTICONS, "emoticon string, polarity int")


def exception_table(spark: SparkSession) -> DataFrame:
    return table(spark, EXCEPTIONS, "form string, lemma string, pos string")


def _words(content: str) -> list[str]:
    return [w for w in content.split("\n") if w and not w.startswith(";")]


LEXICON_SQL = values_sql(
    [(w, 1) for w in _words(POSITIVE_FILE)] + [(w, -1) for w in _words(NEGATIVE_FILE)],
    "word, polarity",
)
SENSE_ROWS = [
    (p, i, float(a), float(b), t, g)
    for p, i, a, b, t, g in (
        line.split("\t") for line in SENSE_FILE.split("\n") if "\t" in line and line[0] != "#"
    )
]
SENSES_SQL = values_sql(SENSE_ROWS, "pos, synset_id, pos_score, neg_score, terms, gloss")
STOPS_SQL = values_sql([(w,) for w in STOP_WORDS], "word")
EMOTICON_SQL = values_sql(EMOTICONS, "emoticon, polarity")
EXCEPTION_SQL = values_sql(EXCEPTIONS, "form, lemma, pos")

# Shared opening of the oracles: one row per document with its token list, and one row per token.
TOKENS_SQL = """
toks AS (SELECT doc_id, lang, source, regexp_extract_all(lower(text), '[a-z]+') AS t FROM documents),
tokens AS (SELECT doc_id, lang, source, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS pos FROM toks)
"""
HITS_SQL = (
    TOKENS_SQL
    + f""", lexicon AS (SELECT * FROM {LEXICON_SQL}),
hits AS (SELECT k.doc_id, k.lang, k.source, k.pos, k.token, l.polarity
  FROM tokens k JOIN lexicon l ON k.token = l.word),
scores AS (SELECT d.doc_id, d.lang, d.source, coalesce(len(d.t), 0) AS tokens,
  count(h.token) FILTER (h.polarity > 0) AS pos, count(h.token) FILTER (h.polarity < 0) AS neg,
  coalesce(sum(h.polarity), 0)::BIGINT AS net
  FROM toks d LEFT JOIN hits h ON d.doc_id = h.doc_id GROUP BY d.doc_id, d.lang, d.source, d.t),
classed AS (SELECT *, CASE WHEN net > 0 THEN 'positive' WHEN net < 0 THEN 'negative' ELSE 'neutral' END AS class FROM scores)
"""
)
