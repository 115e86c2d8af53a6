"""Supervised learning as relational steps: splits, Naive Bayes tables, evaluation."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prosewell.operators.cluster import vector_sum
from prosewell.operators.joins import frequent_lookup, lookup, names
from prosewell.sources.store import cut

MAX_CLASSES = 10_000
# Beyond this many classes the model is counted in long form: a plan with a sum per class would grow too large.
WIDE_CLASSES = 100


def class_list(df: DataFrame, label: str = "label") -> list:
    """The distinct labels in order. Classes are few by nature; refuse a column that is not one."""
    found = df.select(label).filter(F.col(label).isNotNull()).distinct().limit(MAX_CLASSES + 1)
    values = sorted(r[0] for r in found.collect())
    if len(values) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} values; it is not a class column")
    return values


def index_labels(df: DataFrame, label: str = "label") -> DataFrame:
    """Adds `label_index`, the rank of the label by name from 0."""
    classes = class_list(df, label)
    table = df.sparkSession.createDataFrame(
        [(c, i) for i, c in enumerate(classes)],
        f"{label} {df.schema[label].dataType.simpleString()}, label_index int",
    )
    return lookup(df, table, label, "left", max_rows=MAX_CLASSES)


def fold(df: DataFrame, n: int, key: str | Sequence[str], name: str = "fold") -> DataFrame:
    """Adds a repeatable fold 0..n-1 from the key alone; every row is kept.

    All rows with one key share a fold: with the thread as key, replies never leak across.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in names(key)]))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return df.withColumn(name, F.pmod(number, F.lit(n)).cast("int"))


def split(df: DataFrame, key: str | Sequence[str], n: int = 5, test: int = 0) -> DataFrame:
    """Adds `side`: "test" for one fold of n, "train" for the rest."""
    out = fold(df, n, key, "_fold")
    side = F.when(F.col("_fold") == test, F.lit("test")).otherwise(F.lit("train"))
    return out.withColumn("side", side).drop("_fold")


def nb_priors(labels: DataFrame, smoothing: float = 0.0) -> DataFrame:
    """(label, docs, log_prior) of `labels(key, label)`."""
    counts = labels.filter("label is not null").groupBy("label").agg(F.count(F.lit(1)).alias("docs"))
    total = counts.agg((F.sum("docs") + smoothing * F.count(F.lit(1))).alias("n")).scalar()
    return counts.withColumn("log_prior", F.log((F.col("docs") + smoothing) / total))


def nb_fit(
    tf: DataFrame, docs: DataFrame, smoothing: float = 1.0, prior_smoothing: float = 0.0
) -> tuple[DataFrame, DataFrame]:
    """Multinomial Naive Bayes as two tables: (label, docs, log_prior), (label, token, log_likelihood).

    `docs` has a row per training document with its `label`; `tf` holds their term counts and
    carries the label along. The second table has every class for every token of the training
    vocabulary: one aggregate by token counts all classes side by side, so the table of zero
    counts is never built. Both are written to the shared folder: a model is read more often
    than it is fitted.
    """
    known = docs.filter("label is not null").select("label")
    classes = class_list(known)
    train = tf.filter("label is not null").select("token", "label", "tf")
    if not classes:
        kind = docs.schema["label"].dataType.simpleString()
        spark = docs.sparkSession
        priors = spark.createDataFrame([], f"label {kind}, docs bigint, log_prior double")
        return priors, spark.createDataFrame([], f"token string, label {kind}, log_likelihood double")
    if len(classes) > WIDE_CLASSES:
        return cut(nb_priors(known, prior_smoothing)), cut(_long_likelihoods(train, known, smoothing))
    per_class = [F.sum(F.when(F.col("label") == c, F.col("tf")).otherwise(0)) for c in classes]
    wide = train.groupBy("token").agg(F.array(*per_class).alias("counts"))
    sums = wide.agg(
        F.array(*[F.sum(F.get("counts", F.lit(i))) for i in range(len(classes))]).alias("totals"),
        F.count(F.lit(1)).alias("vocabulary"),
    )
    whole = sums.select(F.struct("totals", "vocabulary").alias("s")).scalar()
    long = wide.select(
        "token",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("label"),
                        F.log(
                            (F.get("counts", F.lit(i)) + smoothing)
                            / (F.get(whole["totals"], F.lit(i)) + smoothing * whole["vocabulary"])
                        ).alias("log_likelihood"),
                    )
                    for i, c in enumerate(classes)
                ]
            )
        ),
    )
    return cut(nb_priors(known, prior_smoothing)), cut(long)


def _class_counts(tf: DataFrame, classes: Sequence, value: Column) -> tuple[DataFrame, Column, Column]:
    """(token, counts): `value` summed per class, side by side; and, as scalars, the classes' totals and the number of tokens."""
    per_class = [F.sum(F.when(F.col("label") == c, value).otherwise(0)) for c in classes]
    wide = cut(tf.groupBy("token").agg(F.array(*per_class).alias("counts")))
    sums = wide.agg(
        F.array(*[F.sum(F.get("counts", F.lit(i))) for i in range(len(classes))]).alias("totals"),
        F.count(F.lit(1)).alias("vocabulary"),
    )
    whole = sums.select(F.struct("totals", "vocabulary").alias("s")).scalar()
    return wide, whole["totals"], whole["vocabulary"]


def _few_classes(docs: DataFrame) -> list:
    classes = class_list(docs.filter("label is not null").select("label"))
    if not 0 < len(classes) <= WIDE_CLASSES:
        raise ValueError(f"between 1 and {WIDE_CLASSES} classes are needed")
    return classes


def _per_class(wide: DataFrame, classes: Sequence, of: Callable[[int], Column]) -> DataFrame:
    """(token, label, log_likelihood) with `of(i)` for class i."""
    entries = [F.struct(F.lit(c).alias("label"), of(i).alias("log_likelihood")) for i, c in enumerate(classes)]
    return wide.select("token", F.inline(F.array(*entries)))


def nb_fit_bernoulli(
    tf: DataFrame, docs: DataFrame, smoothing: float = 1.0, prior_smoothing: float = 0.0
) -> tuple[DataFrame, DataFrame]:
    """Naive Bayes over which words a document has, as the tables of `nb_fit`.

    A word's likelihood is the log odds of it being in a document of the class, and the prior holds what all words' absence adds, so `nb_predict` scores it
    from the words that are there, each with tf 1: see `presence`.
    """
    classes = _few_classes(docs)
    known = docs.filter("label is not null").select("label")
    priors = cut(nb_priors(known, prior_smoothing))
    n = {r["label"]: r["docs"] for r in priors.collect()}
    present = tf.filter("label is not null AND tf > 0").select("token", "label")
    wide, _, _ = _class_counts(present, classes, F.lit(1))

    def chance(i: int) -> Column:
        return (F.get("counts", F.lit(i)) + smoothing) / (n[classes[i]] + 2 * smoothing)

    absent = wide.agg(F.array(*[F.sum(F.log(1 - chance(i))) for i in range(len(classes))]).alias("a"))
    absent = absent.select(F.posexplode(F.arrays_zip(F.array(*map(F.lit, classes)).alias("label"), F.col("a"))).alias("i", "z"))
    absent = absent.select("z.label", F.coalesce("z.a", F.lit(0.0)).alias("a"))
    whole = priors.join(absent, "label").select("label", "docs", (F.col("log_prior") + F.col("a")).alias("log_prior"))
    odds = _per_class(wide, classes, lambda i: F.log(chance(i) / (1 - chance(i))))
    return cut(whole), cut(odds)


def presence(tf: DataFrame) -> DataFrame:
    """Every counted word once."""
    return tf.filter("tf > 0").withColumn("tf", F.lit(1).cast("bigint"))


def nb_fit_complement(tf: DataFrame, docs: DataFrame, smoothing: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Complement Naive Bayes as the tables of `nb_fit`: a word counts for a class by how rare it is in all others.

    A class's weights are the logs of the word's smoothed share in the other classes, divided by their sum. Priors play no part: they are 0.
    """
    classes = _few_classes(docs)
    train = tf.filter("label is not null").select("token", "label", "tf")
    wide, totals, vocabulary = _class_counts(train, classes, F.col("tf"))

    def total(values: Column) -> Column:
        return reduce(add, (F.get(values, F.lit(i)) for i in range(len(classes))))

    def weight(i: int) -> Column:
        others = total(F.col("counts")) - F.get("counts", F.lit(i)) + smoothing
        return F.log(others / (total(totals) - F.get(totals, F.lit(i)) + smoothing * vocabulary))

    sums = wide.agg(F.array(*[F.sum(weight(i)) for i in range(len(classes))]).alias("s")).scalar()
    weights = _per_class(wide, classes, lambda i: F.try_divide(weight(i), F.get(sums, F.lit(i))))
    priors = nb_priors(docs.select("label")).withColumn("log_prior", F.lit(0.0))
    return cut(priors), cut(weights)


def _long_likelihoods(train: DataFrame, known: DataFrame, smoothing: float) -> DataFrame:
    """The same table from one count per (token, label). Each token's counts meet in one map, no larger than the classes."""
    counts = cut(train.groupBy("token", "label").agg(F.sum("tf").alias("n")))
    totals = known.distinct().join(counts.groupBy("label").agg(F.sum("n").alias("total")), "label", "left")
    size = counts.select("token").distinct().count()
    table = cut(totals.select("label", F.coalesce("total", F.lit(0)).alias("total")))
    listed = table.agg(F.collect_list(F.struct("label", "total")).alias("classes")).scalar()
    seen = counts.groupBy("token").agg(F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("seen"))
    every = seen.select("token", "seen", F.explode(listed).alias("c"))
    n = F.coalesce(F.try_element_at("seen", F.col("c.label")), F.lit(0))
    value = F.log((n + smoothing) / (F.col("c.total") + smoothing * size))
    return every.select("token", F.col("c.label").alias("label"), value.alias("log_likelihood"))


def nb_predict(
    priors: DataFrame,
    likelihoods: DataFrame,
    docs: DataFrame,
    tf: DataFrame,
    key: str | Sequence[str] = "doc_id",
) -> DataFrame:
    """(key, prediction, score): argmax over classes, ties to the lowest label; a row for each of `docs`.

    Words outside the vocabulary are ignored. A document with none inside it gets the class of the highest prior. A model without classes gives
    nulls. Up to `WIDE_CLASSES` classes are columns of the plan; more of them are the elements of one array, which is summed as a vector.
    """
    keys = names(key)
    none = docs.select(*keys, F.lit(None).cast("string").alias("token"), F.lit(0).cast("bigint").alias("tf"))
    tf = tf.select(*keys, "token", F.col("tf").cast("bigint").alias("tf")).unionByName(none)
    classes = sorted((r["label"], r["log_prior"]) for r in priors.collect())
    label_of = F.array(*[F.lit(c) for c, _ in classes]).cast(f"array<{priors.schema['label'].dataType.simpleString()}>")
    if not classes:
        return docs.select(*keys, F.get(label_of, F.lit(0)).alias("prediction"), F.lit(None).cast("double").alias("score"))
    if len(classes) > WIDE_CLASSES:
        return _predict_many(classes, likelihoods, tf, keys, label_of)
    per_token = likelihoods.groupBy("token").agg(
        *[F.max(F.when(F.col("label") == c, F.col("log_likelihood"))).alias(f"_l{i}") for i, (c, _) in enumerate(classes)]
    )
    weight = [F.coalesce(F.col("tf") * F.col(f"_l{i}"), F.lit(0.0)) for i in range(len(classes))]
    # Words that some class has often come first: these are broadcast, and only the others' counts move.
    often = F.floor(F.greatest(*[F.col(f"_l{i}") for i in range(len(classes))], F.lit(None)) / math.log(2))
    scored = frequent_lookup(tf, cut(per_token), "token", often, "left").groupBy(*keys).agg(
        *[(F.lit(p) + F.sum(weight[i])).alias(f"_s{i}") for i, (_, p) in enumerate(classes)]
    )
    best = F.greatest(*[F.struct(F.col(f"_s{i}").alias("score"), F.lit(-i).alias("i")) for i in range(len(classes))]) if len(classes) > 1 else F.struct(F.col("_s0").alias("score"), F.lit(0).alias("i"))
    return scored.select(*keys, best.alias("_best")).select(
        *keys,
        F.get(label_of, -F.col("_best.i")).alias("prediction"),
        F.col("_best.score").alias("score"),
    )


def _predict_many(
    classes: Sequence[tuple], likelihoods: DataFrame, tf: DataFrame, keys: Sequence[str], label_of: Column
) -> DataFrame:
    """`nb_predict` with one array of scores a document, in the order of the classes."""
    n = len(classes)
    kind = likelihoods.schema["label"].dataType.simpleString()
    places = likelihoods.sparkSession.createDataFrame([(c, i) for i, (c, _) in enumerate(classes)], f"label {kind}, _i int")
    entries = lookup(likelihoods, places, "label", max_rows=MAX_CLASSES)
    # A token has an entry per class; one that lacks some counts 0 there.
    found = entries.groupBy("token").agg(F.array_sort(F.collect_list(F.struct("_i", "log_likelihood"))).alias("_e"))
    listed = F.transform("_e", lambda e: e["log_likelihood"])
    held = F.map_from_entries("_e")
    filled = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.coalesce(F.try_element_at(held, i), F.lit(0.0)))
    per_token = found.select("token", F.when(F.size("_e") == n, listed).otherwise(filled).alias("_l"))
    nothing = F.array_repeat(F.lit(0.0), n)
    parts = lookup(tf, per_token, "token", "left").withColumn(
        "_s", F.coalesce(F.transform("_l", lambda x: x * F.col("tf")), nothing)
    )
    priors = F.array(*[F.lit(float(p)) for _, p in classes])
    summed = parts.groupBy(*keys).agg(vector_sum("_s").alias("_s"))
    scores = summed.select(*keys, F.zip_with("_s", priors, lambda s, p: s + p).alias("_s"))
    best = F.array_max("_s")
    return scores.select(
        *keys, F.get(label_of, F.array_position("_s", best).cast("int") - 1).alias("prediction"), best.alias("score")
    )


def save_nb(priors: DataFrame, likelihoods: DataFrame, path: str) -> None:
    """Write both tables of a model below `path`."""
    priors.write.mode("overwrite").parquet(f"{path}/priors")
    likelihoods.write.mode("overwrite").parquet(f"{path}/likelihoods")


def load_nb(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/priors"), spark.read.parquet(f"{path}/likelihoods")


def majority_baseline(train: DataFrame, test: DataFrame) -> DataFrame:
    """Adds `prediction`, the most frequent training label, ties to the lowest."""
    counts = train.filter("label is not null").groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    best = counts.orderBy(F.desc("n"), F.asc("label")).limit(1).select("label").scalar()
    return test.withColumn("prediction", best)


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    """(label, prediction, n) for every pair of classes, zero cells kept."""
    counted = cut(predictions.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n")))
    classes = class_list(counted.select(F.explode(F.array("label", "prediction")).alias("c")), "c")
    kind = counted.schema["label"].dataType.simpleString()
    each = F.array(*map(F.lit, classes)).cast(f"array<{kind}>")
    cells = counted.sparkSession.createDataFrame([(c,) for c in classes], f"label {kind}").select(
        "label", F.explode(each).alias("prediction")
    )
    return cells.join(counted, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def class_metrics(confusion: DataFrame) -> DataFrame:
    """(label, support, precision, recall, f1); 0 where a class was never predicted."""
    sides = confusion.select(
        F.inline(
            F.array(
                F.struct(F.col("label").alias("c"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("predicted"), F.lit(0).cast("bigint").alias("hit")),
                F.struct(F.col("prediction").alias("c"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("predicted"), F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit")),
            )
        )
    )
    sums = sides.groupBy(F.col("c").alias("label")).agg(
        F.sum("actual").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit")
    )
    zero = F.lit(0.0)
    return sums.select(
        "label",
        "support",
        F.coalesce(F.try_divide("hit", "predicted"), zero).alias("precision"),
        F.coalesce(F.try_divide("hit", "support"), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("hit"), F.col("predicted") + F.col("support")), zero).alias("f1"),
    )


def overall_metrics(confusion: DataFrame) -> DataFrame:
    """One row: n, accuracy (equal to micro precision, recall and F1) and the macro averages."""
    accuracy = confusion.agg(
        (F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)) / F.sum("n")).alias("a")
    ).scalar()
    return class_metrics(confusion).agg(
        F.sum("support").alias("n"),
        F.first(accuracy).alias("accuracy"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
    )
