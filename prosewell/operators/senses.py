"""Word spotting with a graded sense lexicon and word-sense disambiguation.

Everything that concerns one occurrence (its neighbors, its candidate senses, the overlap with
their glosses) is kept in that occurrence's row. The lexicon is grouped by lemma once and
joined once; there is no self-join of the text and no join of context words with gloss words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prosewell.functions import text as T
from prosewell.operators.joins import inline_values, lookup, names
from prosewell.operators.opinion import polarity_class

# A synset id is unique within its part of speech only.
SYNSET = ["pos_tag", "synset_id"]


def explode_senses(synsets: DataFrame) -> DataFrame:
    """(lemma, pos_tag, sense_no, synset_id, pos_score, neg_score, gloss), one row per term."""
    term = F.split("term", "#")
    return synsets.withColumn("term", F.explode(F.split("terms", " +"))).select(
        F.lower(F.get(term, F.lit(0))).alias("lemma"),
        F.col("pos").alias("pos_tag"),
        F.get(term, F.lit(1)).try_cast("int").alias("sense_no"),
        "synset_id",
        "pos_score",
        "neg_score",
        "gloss",
    ).filter("sense_no is not null")


def _sense_keys(tokens: DataFrame) -> list[str]:
    return ["token", "pos_tag"] if "pos_tag" in tokens.columns else ["token"]


def _as_lookup(senses: DataFrame, tokens: DataFrame) -> DataFrame:
    renamed = senses.withColumnRenamed("lemma", "token")
    if "pos_tag" in tokens.columns:
        return renamed
    return renamed.withColumnRenamed("pos_tag", "sense_pos_tag")


def candidate_senses(tokens: DataFrame, senses: DataFrame) -> DataFrame:
    """Every sense of each token, of its own part of speech where the tokens carry `pos_tag`."""
    return lookup(tokens, _as_lookup(senses, tokens), _sense_keys(tokens))


def first_senses(senses: DataFrame, with_pos: bool = False) -> DataFrame:
    """(lemma, synset_id, pos_score, neg_score): the lowest sense number, ties by part of speech."""
    by = ["lemma", "pos_tag"] if with_pos else ["lemma"]
    first = F.min(F.struct("sense_no", "pos_tag", "synset_id", "pos_score", "neg_score"))
    return senses.groupBy(*by).agg(first.alias("s")).select(
        *by, "s.synset_id", "s.pos_score", "s.neg_score"
    )


def first_sense_score(tokens: DataFrame, senses: DataFrame) -> DataFrame:
    """The baseline: each spotted token with the scores of its first sense."""
    with_pos = "pos_tag" in tokens.columns
    table = first_senses(senses, with_pos).withColumnRenamed("lemma", "token")
    return lookup(tokens, table, _sense_keys(tokens))


def weighted_sense_score(senses: DataFrame) -> DataFrame:
    """(lemma, pos_tag, pos_score, neg_score): senses averaged with weight 1/sense_no."""
    weight = 1 / F.col("sense_no")
    return senses.groupBy("lemma", "pos_tag").agg(
        (F.sum(F.col("pos_score") * weight) / F.sum(weight)).alias("pos_score"),
        (F.sum(F.col("neg_score") * weight) / F.sum(weight)).alias("neg_score"),
    )


def target_contexts(
    docs: DataFrame,
    targets: DataFrame,
    k: int,
    col: str = "text",
    key: str | Sequence[str] = "doc_id",
) -> DataFrame:
    """(key, pos, token, context): each target with the array of words within k of it.

    With few enough targets, only their occurrences leave the document's row.
    """
    keys = names(key)
    words = targets.select(F.col("lemma").alias("token")).distinct()
    listed = inline_values(words)

    def around(t: Column, w: Column, i: Column) -> Column:
        before = F.slice(t, F.greatest(i - k, F.lit(0)) + 1, F.least(i, F.lit(k)))
        found = F.struct(
            i.alias("pos"),
            w.alias("token"),
            F.concat(before, F.slice(t, i + 2, F.lit(k))).alias("context"),
        )
        return found if listed is None else F.when(w.isin(listed), found)

    def occurrences(t: Column) -> Column:
        return F.filter(F.transform(t, lambda w, i: around(t, w, i)), lambda o: o.isNotNull())

    found = docs.select(*keys, F.inline(T.let(T.words(col), occurrences)))
    if listed is None:
        found = lookup(found, words, "token", "left_semi")
    return found.select(*keys, "pos", "token", "context")


def context_words(
    docs: DataFrame,
    targets: DataFrame,
    k: int,
    col: str = "text",
    key: str | Sequence[str] = "doc_id",
) -> DataFrame:
    """(key, pos, token, word): one row per word within k of a target, the target excluded."""
    found = target_contexts(docs, targets, k, col, key)
    return found.select(*names(key), "pos", "token", F.explode("context").alias("word"))


def gloss_words(senses: DataFrame, stops: DataFrame) -> DataFrame:
    """(pos_tag, synset_id, word): the distinct words of each gloss without the stop words."""
    words = senses.select(*SYNSET, F.explode(T.words("gloss")).alias("word")).distinct()
    return lookup(words, stops.select("word").distinct(), "word", "left_anti")


def sense_inventory(senses: DataFrame, stops: DataFrame, with_pos: bool = False) -> DataFrame:
    """One row per lemma: its senses in order of sense number, each with its gloss words."""
    by = ["lemma", "pos_tag"] if with_pos else ["lemma"]
    signature = gloss_words(senses, stops).groupBy(*SYNSET).agg(F.collect_set("word").alias("words"))
    full = senses.join(signature, SYNSET, "left").withColumn(
        "words", F.coalesce("words", F.array().cast("array<string>"))
    )
    order = F.struct(
        "sense_no", F.col("pos_tag").alias("tag"), "synset_id", "pos_score", "neg_score", "words"
    )
    return full.groupBy(*by).agg(F.array_sort(F.collect_list(order)).alias("senses"))


def choose_sense(context: Column, senses: Column) -> Column:
    """struct(overlap, place): most distinct context words in the gloss, ties to the first sense."""
    return F.array_max(
        F.transform(
            senses,
            lambda s, i: F.struct(
                F.size(F.array_intersect(s["words"], context)).alias("overlap"), (-i).alias("place")
            ),
        )
    )


def disambiguate(contexts: DataFrame, inventory: DataFrame) -> DataFrame:
    """Simplified Lesk: each target of `target_contexts` with the chosen sense."""
    on = _sense_keys(contexts)
    found = lookup(contexts, inventory.withColumnRenamed("lemma", "token"), on)
    best = found.withColumn("_best", choose_sense(F.col("context"), F.col("senses")))
    chosen = best.withColumn("_s", F.get("senses", -F.col("_best.place"))).withColumn(
        "overlap", F.col("_best.overlap")
    )
    kept = [c for c in contexts.columns if c != "context"]
    return chosen.select(
        *kept,
        F.col("_s.sense_no").alias("sense_no"),
        F.col("_s.tag").alias("sense_pos_tag"),
        F.col("_s.synset_id").alias("synset_id"),
        F.col("_s.pos_score").alias("pos_score"),
        F.col("_s.neg_score").alias("neg_score"),
        "overlap",
    )


def score_senses(chosen: DataFrame, key: str | Sequence[str] = "doc_id") -> DataFrame:
    """(key, pos, neg, net, class): scores summed per document."""
    total = chosen.groupBy(*names(key)).agg(
        F.sum("pos_score").alias("pos"), F.sum("neg_score").alias("neg")
    )
    net = F.round(F.col("pos") - F.col("neg"), 9)
    return total.withColumn("net", net).withColumn("class", polarity_class("net"))


def spot_phrases(
    docs: DataFrame, senses: DataFrame, col: str = "text", key: str | Sequence[str] = "doc_id"
) -> DataFrame:
    """(key, pos, n, phrase): multi-word terms of the lexicon found in the text.

    A match is dropped when it overlaps a longer one, or one of its own length that starts
    earlier. Only matches are shuffled, never the n-grams they were looked up with.
    """
    keys = names(key)
    phrases = (
        senses.filter(F.col("lemma").contains("_"))
        .select(F.regexp_replace("lemma", "_", " ").alias("phrase"))
        .distinct()
    )
    length = F.size(F.split("phrase", " "))
    longest = phrases.agg(F.max(length)).first()[0]
    if longest is None:
        return docs.select(
            *keys, F.lit(0).alias("pos"), F.lit(0).alias("n"), F.lit("").alias("phrase")
        ).limit(0)

    def run(t: Column, i: Column, n: Column) -> Column:
        return F.struct(
            i.alias("pos"), n.alias("n"), F.array_join(F.slice(t, i + 1, n), " ").alias("phrase")
        )

    def runs(t: Column) -> Column:
        if listed is None:
            lengths = F.sequence(F.lit(2), F.lit(longest))
            return F.flatten(F.transform(t, lambda w, i: F.transform(lengths, lambda n: run(t, i, n))))
        # Most words begin no phrase: they are dropped before any string is built.
        first = {}
        for phrase in listed:
            word, *rest = phrase.split(" ")
            first.setdefault(len(rest) + 1, set()).add(word)
        starts = F.transform(
            t,
            lambda w, i: F.filter(
                F.array(*(F.when(w.isin(sorted(first[n])), F.struct(i.alias("i"), F.lit(n).alias("n"))) for n in sorted(first))),
                lambda x: x.isNotNull(),
            ),
        )
        found = F.transform(F.flatten(starts), lambda x: run(t, x["i"], x["n"]))
        return F.filter(found, lambda r: r["phrase"].isin(listed))

    listed = inline_values(phrases)
    candidates = docs.select(*keys, F.inline(T.let(T.words(col), runs)))
    hits = lookup(candidates, phrases, "phrase")
    # The last words of a text give short runs twice; a run counts once, at its own length.
    hits = hits.filter(F.size(F.split("phrase", " ")) == F.col("n"))
    near = Window.partitionBy(*keys).orderBy("pos").rangeBetween(-(longest - 1), longest - 1)
    around = hits.withColumn("_near", F.collect_list(F.struct("pos", "n")).over(near))
    beaten = F.exists(
        "_near",
        lambda o: (o["pos"] < F.col("pos") + F.col("n"))
        & (F.col("pos") < o["pos"] + o["n"])
        & ((o["n"] > F.col("n")) | ((o["n"] == F.col("n")) & (o["pos"] < F.col("pos")))),
    )
    return around.filter(~beaten).select(*keys, "pos", "n", "phrase")


def sense_distribution(chosen: DataFrame, by: str, sense_nos: Sequence[int]) -> DataFrame:
    """(lemma, by, sense_1, ..., other): how often each group uses each sense of a word; `other` counts senses not listed."""
    listed = F.col("sense_no").isin(list(sense_nos))
    return chosen.groupBy(F.col("token").alias("lemma"), by).agg(
        *[F.count_if(F.col("sense_no") == s).alias(f"sense_{s}") for s in sense_nos],
        F.count_if(~F.coalesce(listed, F.lit(False))).alias("other"),
    )


def agreement_table(a: DataFrame, b: DataFrame, key: str | Sequence[str] = "doc_id") -> DataFrame:
    """(class_a, class_b, n) of two methods; a document scored by one only counts as "none"."""
    keys = names(key)
    joined = a.select(*keys, F.col("class").alias("class_a")).join(
        b.select(*keys, F.col("class").alias("class_b")), keys, "full_outer"
    )
    none = F.lit("none")
    return joined.groupBy(
        F.coalesce("class_a", none).alias("class_a"), F.coalesce("class_b", none).alias("class_b")
    ).agg(F.count(F.lit(1)).alias("n"))


def cohen_kappa(table: DataFrame) -> DataFrame:
    """One row from an agreement table: n, agreement, agreement expected by chance, kappa."""
    sides = table.select(
        F.inline(
            F.array(
                F.struct(F.col("class_a").alias("c"), F.col("n").alias("a"), F.lit(0).cast("bigint").alias("b")),
                F.struct(F.col("class_b").alias("c"), F.lit(0).cast("bigint").alias("a"), F.col("n").alias("b")),
            )
        )
    )
    margins = sides.groupBy("c").agg(F.sum("a").cast("double").alias("a"), F.sum("b").cast("double").alias("b"))
    chance = margins.agg((F.sum(F.col("a") * F.col("b")) / F.pow(F.sum("a"), F.lit(2))).alias("e")).scalar()
    same = F.sum(F.when(F.col("class_a") == F.col("class_b"), F.col("n")).otherwise(0))
    out = table.agg(F.sum("n").alias("n"), (same / F.sum("n")).alias("agreement"))
    return out.withColumn("expected", chance).withColumn(
        "kappa",
        F.coalesce(
            F.try_divide(F.col("agreement") - F.col("expected"), 1 - F.col("expected")), F.lit(1.0)
        ),
    )
