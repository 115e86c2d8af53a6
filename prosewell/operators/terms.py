"""Tokens and term statistics.

A document is one row, so everything that concerns a single document (n-grams,
term counts, statistics) is computed inside that row without a shuffle. Only
corpus-wide counts shuffle, after map-side combining.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prosewell.functions import text as T
from prosewell.operators.joins import frequent_lookup, lookup, names, top_k
from prosewell.sources.store import cut

# The published WordNet detachment rules, (part of speech, suffix, ending).
DETACHMENT_RULES = [
    ("n", "s", ""),
    ("n", "ses", "s"),
    ("n", "xes", "x"),
    ("n", "zes", "z"),
    ("n", "ches", "ch"),
    ("n", "shes", "sh"),
    ("n", "men", "man"),
    ("n", "ies", "y"),
    ("v", "s", ""),
    ("v", "ies", "y"),
    ("v", "es", "e"),
    ("v", "es", ""),
    ("v", "ed", "e"),
    ("v", "ed", ""),
    ("v", "ing", "e"),
    ("v", "ing", ""),
    ("a", "er", ""),
    ("a", "est", ""),
    ("a", "er", "e"),
    ("a", "est", "e"),
]


def tokenize(
    docs: DataFrame, col: str = "text", key: str | Sequence[str] = "doc_id", apostrophe: bool = False
) -> DataFrame:
    """(key, pos, token), positions from 0."""
    tokens = T.words_with_apostrophe(col) if apostrophe else T.words(col)
    return docs.select(*names(key), F.posexplode(tokens).alias("pos", "token"))


def sentences(
    docs: DataFrame, col: str = "text", key: str | Sequence[str] = "doc_id"
) -> DataFrame:
    """(key, sent_no, sentence); blank sentences are not numbered."""
    return docs.select(
        *names(key), F.posexplode(T.sentence_array(col)).alias("sent_no", "sentence")
    )


def remove_stop_words(tokens: DataFrame, stops: DataFrame) -> DataFrame:
    """Tokens not in `stops(word)`."""
    words = stops.select(F.col("word").alias("token")).distinct()
    return lookup(tokens, words, "token", "left_anti")


def ngrams(
    docs: DataFrame, n: int, col: str = "text", key: str | Sequence[str] = "doc_id"
) -> DataFrame:
    """(key, pos, ngram): adjacent n-grams, position of the first token."""
    grams = T.word_ngrams(T.words(col), n)
    return docs.select(*names(key), F.posexplode(grams).alias("pos", "ngram"))


def inflected_forms(vocabulary: DataFrame, exceptions: DataFrame) -> DataFrame:
    """(form, lemma): every form the rules and exceptions lead back to a word of the vocabulary.

    `vocabulary(word)`, `exceptions(form, lemma, pos)`. A listed exception wins, then the word
    itself, then the first rule. The table is as long as the vocabulary times the rules, never
    as long as the text, so looking it up costs one join and no expansion of the tokens.
    """
    words = vocabulary.select("word").distinct()
    by_rule = F.array(
        F.struct(F.lit(0).alias("rank"), F.col("word").alias("form"), F.lit(True).alias("ok")),
        *[
            F.struct(
                F.lit(i).alias("rank"),
                F.expr(f"concat(substr(word, 1, length(word) - {len(end)}), '{suffix}')").alias("form"),
                (
                    F.col("word").endswith(end) & (F.length("word") > len(end))
                ).alias("ok"),
            )
            for i, (_, suffix, end) in enumerate(DETACHMENT_RULES, start=1)
        ],
    )
    rules = (
        words.select("word", F.inline(by_rule))
        .filter("ok")
        .select("form", F.col("word").alias("lemma"), "rank")
    )
    listed = exceptions.select("form", "lemma", F.lit(-1).alias("rank"))
    return (
        rules.unionByName(listed)
        .groupBy("form")
        .agg(F.min(F.struct("rank", "lemma")).alias("best"))
        .select("form", F.col("best.lemma").alias("lemma"))
    )


def lemmatize(tokens: DataFrame, vocabulary: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Adds `lemma`; a token with no known base form keeps itself."""
    forms = inflected_forms(vocabulary, exceptions).withColumnRenamed("form", "token")
    return lookup(tokens, forms, "token", "left").withColumn("lemma", F.coalesce("lemma", "token"))


def doc_stats(
    docs: DataFrame, col: str = "text", key: str | Sequence[str] = "doc_id"
) -> DataFrame:
    """(key, tokens, distinct_tokens, mean_length, type_token_ratio); ratios null without tokens."""
    with_tokens = docs.select(*names(key), F.coalesce(T.words(col), F.array()).alias("_t"))
    sized = with_tokens.select(
        *names(key),
        F.size("_t").cast("bigint").alias("tokens"),
        F.size(F.array_distinct("_t")).cast("bigint").alias("distinct_tokens"),
        F.length(F.array_join("_t", "")).alias("_letters"),
    )
    return sized.select(
        *names(key),
        "tokens",
        "distinct_tokens",
        F.try_divide("_letters", "tokens").alias("mean_length"),
        F.try_divide("distinct_tokens", "tokens").alias("type_token_ratio"),
    )


def term_counts(
    docs: DataFrame, col: str = "text", key: str | Sequence[str] = "doc_id"
) -> DataFrame:
    """(key, token, tf) straight from the text. A document is one row, so nothing is shuffled."""
    return docs.select(*names(key), F.inline(T.counted_terms(T.words(col))))


def count_tokens(tokens: DataFrame, key: str | Sequence[str] = "doc_id") -> DataFrame:
    """(key, token, tf) from a token table that was filtered or changed on the way."""
    return tokens.groupBy(*names(key), "token").agg(F.count(F.lit(1)).alias("tf"))


def doc_freq(tf: DataFrame, min_df: int = 1, max_df: int | None = None) -> DataFrame:
    """(token, df) of the tokens found in min_df to max_df documents."""
    out = tf.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= min_df)
    return out if max_df is None else out.filter(F.col("df") <= max_df)


def tf_idf(tf: DataFrame, df: DataFrame, n_docs: int) -> DataFrame:
    """Adds tf · ln((n+1)/(df+1)). Tokens pruned from `df` are dropped.

    `df` says how many rows of `tf` each token has, so hot tokens are known without counting again. Of a vocabulary beyond the broadcast bounds the tokens of
    most documents are broadcast: only the rows of rare ones move.
    """
    joined = frequent_lookup(tf, df, "token", F.floor(F.log2("df")), rows_per_key="df")
    weight = F.col("tf") * F.log((F.lit(n_docs) + 1) / (F.col("df") + 1))
    return joined.withColumn("tf_idf", weight)


def group_tf_idf(tf: DataFrame, by: str | Sequence[str], n_docs: int) -> DataFrame:
    """(by, token, tf_idf): total tf · idf per group, from (by, token, tf) with a row per document and token.

    The idf is the token's own, so terms are summed first and one row per group and token meets its document frequency,
    in place of one per document and token. Both sums come from one pass over `tf`: `_docs` counts its rows.
    """
    sums = cut(
        tf.groupBy(*names(by), "token").agg(F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("_docs"))
    )
    df = sums.groupBy("token").agg(F.sum("_docs").alias("df"))
    idf = F.log((F.lit(n_docs) + 1) / (F.col("df") + 1))
    return sums.join(df, "token").select(*names(by), "token", (F.col("tf") * idf).alias("tf_idf"))


def top_terms(
    weights: DataFrame, by: str | Sequence[str], k: int, score: str = "tf_idf"
) -> DataFrame:
    """(by, token, score, rank): the k terms of highest total weight per group, ties by term."""
    total = weights.groupBy(*names(by), "token").agg(F.sum(score).alias("score"))
    total = total.withColumn("_order", F.round("score", 9))
    return top_k(total, by, [F.desc("_order"), F.asc("token")], k).drop("_order")


def term_label_counts(tf: DataFrame, sizes: DataFrame) -> DataFrame:
    """The 2×2 document counts of each (token, label) that occurs.

    `tf` has one row per labelled document and token and carries the document's `label`: label
    the documents before counting their terms, so that the join moves documents, not terms.
    `sizes` is `label_sizes` of the same documents.
    Returns (token, label, both, token_only, label_only, neither).
    """
    total = sizes.agg(F.sum("n_label").alias("n")).scalar()
    seen = (
        tf.filter("label is not null")
        .groupBy("token", "label")
        .agg(F.count(F.lit(1)).alias("both"))
    )
    per_token = seen.groupBy("token").agg(F.sum("both").alias("n_token"))
    joined = lookup(seen.join(per_token, "token"), sizes, "label")
    return joined.select(
        "token",
        "label",
        "both",
        (F.col("n_token") - F.col("both")).alias("token_only"),
        (F.col("n_label") - F.col("both")).alias("label_only"),
        (total - F.col("n_token") - F.col("n_label") + F.col("both")).alias("neither"),
    )


def label_sizes(docs: DataFrame) -> DataFrame:
    """(label, n_label) of the labelled documents."""
    return docs.filter("label is not null").groupBy("label").agg(F.count(F.lit(1)).alias("n_label"))


def _chi_square() -> Column:
    a, b, c, d = (F.col(x).cast("double") for x in ("both", "token_only", "label_only", "neither"))
    margins = (a + b) * (c + d) * (a + c) * (b + d)
    return F.coalesce(F.try_divide((a + b + c + d) * F.pow(a * d - b * c, F.lit(2.0)), margins), F.lit(0.0))


def _mutual_information() -> Column:
    a, b, c, d = (F.col(x).cast("double") for x in ("both", "token_only", "label_only", "neither"))
    n = a + b + c + d

    def cell(x: Column, row: Column, column: Column) -> Column:
        return F.when(x > 0, x / n * F.log(n * x / (row * column))).otherwise(F.lit(0.0))

    return (
        cell(a, a + b, a + c) + cell(b, a + b, b + d) + cell(c, c + d, a + c) + cell(d, c + d, b + d)
    )


def _log_odds() -> Column:
    a, b, c, d = (F.col(x).cast("double") for x in ("both", "token_only", "label_only", "neither"))
    return F.log((a + 0.5) * (d + 0.5) / ((b + 0.5) * (c + 0.5)))


MEASURES = {
    "chi_square": _chi_square,
    "mutual_information": _mutual_information,
    "log_odds": _log_odds,
}


def term_association(
    docs: DataFrame, measure: str = "chi_square", col: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(token, label, score) of the labelled documents by chi-square, mutual information or
    smoothed log-odds."""
    labelled = docs.filter("label is not null")
    tf = term_counts(labelled, col, [key, "label"])
    counts = term_label_counts(tf, label_sizes(labelled))
    return counts.select("token", "label", MEASURES[measure]().alias("score"))


def select_features(association: DataFrame, k: int) -> DataFrame:
    """(token, score): the k tokens with the best score over any label, ties by token."""
    best = association.groupBy("token").agg(F.max(F.round("score", 9)).alias("score"))
    return best.orderBy(F.desc("score"), F.asc("token")).limit(k)


def unit_weights(weights: DataFrame, key: str | Sequence[str] = "doc_id", value: str = "tf_idf") -> DataFrame:
    """`weights` (key, token, value) with `weight`: each document's values divided by their length as a vector; null where that is 0. Rows move once, and not at all if a document's are together."""
    squares = F.sum(F.col(value) * F.col(value)).over(Window.partitionBy(*names(key)))
    return weights.withColumn("weight", F.try_divide(F.col(value), F.sqrt(squares)))
