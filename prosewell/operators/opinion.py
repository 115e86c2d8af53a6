"""Word spotting and counting with an opinion lexicon `(word, polarity)`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosewell.functions import text as T
from prosewell.operators.joins import lookup, names, top_k


INLINE_WORDS = 20_000


def _entries(lexicon: DataFrame) -> DataFrame:
    """(token, polarity), each pair once however often the lexicon lists it."""
    return lexicon.select(F.col("word").alias("token"), "polarity").filter("polarity <> 0").distinct()


def spot_words(tokens: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Every token that is in the lexicon, with its polarity."""
    return lookup(tokens, _entries(lexicon), "token")


def inline_words(lexicon: DataFrame, limit: int = INLINE_WORDS) -> tuple[list[str], list[str]] | None:
    """The positive and negative words of a small lexicon; None when it has more than `limit`."""
    rows = _entries(lexicon).limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    return (
        sorted({r.token for r in rows if r.polarity > 0}),
        sorted({r.token for r in rows if r.polarity < 0}),
    )


def _among(tokens: Column, listed: list[str]) -> Column:
    """How many of the tokens are listed."""
    if not listed:
        return F.lit(0).cast("bigint")
    return F.size(F.filter(tokens, lambda t: t.isin(listed))).cast("bigint")


def lexicon_signs(lexicon: DataFrame) -> DataFrame:
    """(token, _pos, _neg): 1 where the lexicon lists the word with that sign, else 0."""
    return _entries(lexicon).groupBy("token").agg(
        F.max((F.col("polarity") > 0).cast("int")).alias("_pos"),
        F.max((F.col("polarity") < 0).cast("int")).alias("_neg"),
    )


def count_polarity(
    docs: DataFrame, lexicon: DataFrame, col: str = "text", key: str | Sequence[str] = "doc_id"
) -> DataFrame:
    """(key, tokens, pos, neg, net), one row per document; documents without a hit count 0.

    A lexicon of a few thousand words becomes a set inside the plan: every document is scored in
    its own row, without a join, an aggregate or a shuffle. A larger one is looked up by a join;
    a document's tokens are then combined in the task that made them. Both give the same rows: a word listed twice counts
    once, one listed with both signs counts on both sides, and documents that share a key keep a row each.
    """
    keys = names(key)
    small = inline_words(lexicon)
    if small is not None:
        empty = F.array().cast("array<string>")
        counts = T.let(
            F.coalesce(T.words(col), empty),
            lambda t: F.struct(
                F.size(t).cast("bigint").alias("tokens"),
                _among(t, small[0]).alias("pos"),
                _among(t, small[1]).alias("neg"),
            ),
        )
        scored = docs.select(*keys, F.inline(F.array(counts)))
    else:
        per_word = lexicon_signs(lexicon)
        rows = docs.withColumn("_row", F.monotonically_increasing_id())
        tokens = rows.select(*keys, "_row", F.explode_outer(T.words(col)).alias("token"))
        marked = lookup(tokens, per_word, "token", "left")
        scored = marked.groupBy(*keys, "_row").agg(
            F.count("token").alias("tokens"),
            F.coalesce(F.sum("_pos"), F.lit(0)).alias("pos"),
            F.coalesce(F.sum("_neg"), F.lit(0)).alias("neg"),
        )
        scored = scored.drop("_row")
    return scored.withColumn("net", F.col("pos") - F.col("neg"))


def polarity_class(net: Column | str, margin: float = 0) -> Column:
    net = F.col(net) if isinstance(net, str) else net
    return (
        F.when(net > margin, "positive").when(net < -margin, "negative").otherwise("neutral")
    )


def classify_polarity(scores: DataFrame, margin: float = 0) -> DataFrame:
    """Adds `class`; a tie within the margin is neutral."""
    return scores.withColumn("class", polarity_class("net", margin))


def normalized_score(scores: DataFrame) -> DataFrame:
    """Adds net/(pos+neg) and net/tokens, null on 0."""
    return scores.withColumn(
        "net_per_hit", F.try_divide(F.col("net"), F.col("pos") + F.col("neg"))
    ).withColumn("net_per_token", F.try_divide(F.col("net"), F.col("tokens")))


def negate(
    docs: DataFrame,
    lexicon: DataFrame,
    negators: Sequence[str],
    k: int = 3,
    col: str = "text",
    key: str | Sequence[str] = "doc_id",
) -> DataFrame:
    """(key, pos, token, negated, polarity): hits, flipped when a negator is among the k tokens before.

    The window of k tokens is read inside the document's own row. With a small lexicon only the
    hits leave the row.
    """
    keys = names(key)
    negator_list = F.array(*[F.lit(w) for w in negators])
    small = inline_words(lexicon)

    def mark(t: Column, w: Column, i: Column) -> Column:
        before = F.slice(t, F.greatest(i - k, F.lit(0)) + 1, F.least(i, F.lit(k)))
        found = F.struct(
            i.alias("pos"),
            w.alias("token"),
            F.arrays_overlap(before, negator_list).alias("negated"),
        )
        return found if small is None else F.when(w.isin(small[0] + small[1]), found)

    def marks(t: Column) -> Column:
        return F.filter(F.transform(t, lambda w, i: mark(t, w, i)), lambda m: m.isNotNull())

    marked = docs.select(*keys, F.inline(T.let(T.words_with_apostrophe(col), marks)))
    hits = lookup(marked, _entries(lexicon), "token")
    return hits.withColumn(
        "polarity", F.when(F.col("negated"), -F.col("polarity")).otherwise(F.col("polarity"))
    ).select(*keys, "pos", "token", "negated", "polarity")


def sentence_polarity(
    docs: DataFrame, lexicon: DataFrame, col: str = "text", key: str | Sequence[str] = "doc_id"
) -> DataFrame:
    """(key, sent_no, net), one row per sentence."""
    keys = names(key)
    split = docs.select(*keys, F.posexplode(T.sentence_array(col)).alias("sent_no", "_sentence"))
    scored = count_polarity(split, lexicon, "_sentence", [*keys, "sent_no"])
    return scored.select(*keys, "sent_no", "net")


def sentence_majority(scores: DataFrame, key: str | Sequence[str] = "doc_id") -> DataFrame:
    """(key, sentences, pos_sentences, neg_sentences, class) from `sentence_polarity`."""
    out = scores.groupBy(*names(key)).agg(
        F.count(F.lit(1)).alias("sentences"),
        F.count_if(F.col("net") > 0).alias("pos_sentences"),
        F.count_if(F.col("net") < 0).alias("neg_sentences"),
    )
    return out.withColumn(
        "class", polarity_class(F.col("pos_sentences") - F.col("neg_sentences"))
    )


def spot_emoticons(
    docs: DataFrame,
    emoticons: DataFrame,
    col: str = "text",
    key: str | Sequence[str] = "doc_id",
    pattern: str = T.EMOTICON,
) -> DataFrame:
    """(key, seq, emoticon, polarity): emoticons as lexicon entries `(emoticon, polarity)`."""
    found = docs.select(
        *names(key),
        F.posexplode(F.regexp_extract_all(col, F.lit(pattern), F.lit(0))).alias("seq", "emoticon"),
    )
    return lookup(found, emoticons.select("emoticon", "polarity"), "emoticon")


def polarity_by(
    scores: DataFrame, dims: Sequence[str], how: str | Sequence[Sequence[str]] = "rollup"
) -> DataFrame:
    """Mean net and share of each class per group of `dims`.

    `how` is "rollup" (subtotals from the right), "cube" (every combination), "groups" (no subtotal), or a list of the sets of `dims` to group by.
    `level` tells a subtotal's null from a null in the data: a bit per dimension, set where it is summed over.
    """
    share = {c: F.avg((F.col("class") == c).cast("double")) for c in ("positive", "negative", "neutral")}
    if how == "rollup":
        grouped = scores.rollup(*dims)
    elif how == "cube":
        grouped = scores.cube(*dims)
    else:
        sets = [list(dims)] if how == "groups" else [list(s) for s in how]
        grouped = scores.groupingSets([[F.col(f"`{c}`") for c in s] for s in sets], *(F.col(f"`{c}`") for c in dims))
    return grouped.agg(
        F.grouping_id().cast("bigint").alias("level"),
        F.count(F.lit(1)).alias("docs"),
        F.avg("net").alias("mean_net"),
        *[share[c].alias(f"share_{c}") for c in share],
    )


def top_opinion_words(hits: DataFrame, by: str | Sequence[str], k: int) -> DataFrame:
    """(by, polarity, token, n, rank): the k most frequent hits per group and polarity."""
    groups = [*names(by), "polarity"]
    counts = hits.groupBy(*groups, "token").agg(F.count(F.lit(1)).alias("n"))
    return top_k(counts, groups, [F.desc("n"), F.asc("token")], k)


def lexicon_use(tokens: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(word, polarity, hits) for every lexicon word, 0 for those never seen.

    Hits are combined down to lexicon size before they meet the lexicon again; an anti join of
    the lexicon against all tokens would shuffle every token.
    """
    hits = (
        spot_words(tokens, lexicon).groupBy("token").agg(F.count(F.lit(1)).alias("hits"))
    )
    words = lexicon.select("word", "polarity")
    return words.join(hits.withColumnRenamed("token", "word"), "word", "left").select(
        "word", "polarity", F.coalesce("hits", F.lit(0)).cast("bigint").alias("hits")
    )


def lexicon_coverage(tokens: DataFrame, lexicon: DataFrame) -> DataFrame:
    """One row: tokens, hits, share of tokens that hit, lexicon words, words never seen."""
    entries = _entries(lexicon).withColumn("_hit", F.lit(1))
    marked = lookup(tokens, entries, "token", "left")
    size = _entries(lexicon).agg(F.count(F.lit(1)).alias("n")).scalar()
    per_word = marked.groupBy(F.when(F.col("_hit") == 1, F.col("token")).alias("word")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_word.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(F.when(F.col("word").isNotNull(), F.col("n"))), F.lit(0)).alias("hits"),
        F.count("word").alias("words_seen"),
    ).select(
        "tokens",
        "hits",
        F.try_divide("hits", "tokens").alias("share"),
        size.alias("lexicon_words"),
        (size - F.col("words_seen")).alias("never_seen"),
    )


def polarity_of(scores: DataFrame, by: str | Sequence[str]) -> DataFrame:
    """Total polarity per thread, sender or any other key carried by the scores."""
    return scores.groupBy(*names(by)).agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
        F.sum("net").alias("net"),
    )


def thread_polarity(scores: DataFrame) -> DataFrame:
    return polarity_of(scores, "thread")


def sender_polarity(scores: DataFrame) -> DataFrame:
    return polarity_of(scores, "from_email")


def extreme_documents(scores: DataFrame, k: int, key: str = "doc_id") -> DataFrame:
    """The k most positive and the k most negative documents, ties by key."""
    best = scores.orderBy(F.desc("net"), F.asc(key)).limit(k).withColumn("end", F.lit("positive"))
    worst = scores.orderBy(F.asc("net"), F.asc(key)).limit(k).withColumn("end", F.lit("negative"))
    return best.unionByName(worst)
