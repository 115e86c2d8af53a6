"""Supervised learning with `pyspark.ml` pipelines."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, NaiveBayes, OneVsRest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    CountVectorizerModel,
    HashingTF,
    Normalizer,
    SQLTransformer,
    UnivariateFeatureSelector,
    VectorAssembler,
)
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosewell.functions import text as T

# Texts that are projected at once: a task holds their vectors, not those of a whole batch.
PROJECTED_ROWS = 256
# Slots that words are hashed to before they are projected, and signed places of the projection per slot.
SLOTS = 1 << 18
PLACES = 8


def token_stage(col: str = "text") -> SQLTransformer:
    """The same tokens as `tokenize`, as a stage that is saved with the pipeline."""
    return SQLTransformer(
        statement=f"SELECT *, array_remove(split(lower({col}), '{T.NOT_WORD}'), '') AS tokens FROM __THIS__"
    )


def vectorize(n: int = 1 << 18, kind: str = "hash", min_df: float = 1.0) -> list:
    """Bag-of-words stages: hashed (one pass, no vocabulary on the driver) or counted.

    A counted vocabulary lives on the driver, and `n` must be above the corpus's distinct words: `train` refuses one that is full.
    Beyond that, hash, or take the tables of `classify`: no word is dropped.
    """
    if kind == "hash":
        counts = HashingTF(inputCol="tokens", outputCol="counts", numFeatures=n)
    elif kind == "count":
        counts = CountVectorizer(inputCol="tokens", outputCol="counts", vocabSize=n, minDF=min_df)
    else:
        raise ValueError(f"unknown vectorizer {kind!r}")
    return [token_stage(), counts]


def weight(min_doc_freq: int = 1, source: str = "counts") -> list:
    """IDF and unit length."""
    return [
        IDF(inputCol=source, outputCol="weighted", minDocFreq=min_doc_freq),
        Normalizer(inputCol="weighted", outputCol="features", p=2.0),
    ]


def select_by_chi_square(k: int, source: str = "counts", target: str = "selected"):
    return (
        UnivariateFeatureSelector(
            featuresCol=source, outputCol=target, labelCol="label", selectionMode="numTopFeatures"
        )
        .setFeatureType("categorical")
        .setLabelType("categorical")
        .setSelectionThreshold(k)
    )


def naive_bayes(kind: str = "multinomial", n: int = 1 << 18, vectorizer: str = "hash") -> Pipeline:
    """multinomial, complement or bernoulli."""
    stages = vectorize(n, vectorizer)
    source = "counts"
    if kind == "bernoulli":
        stages[1].setBinary(True)
    model = NaiveBayes(modelType=kind, featuresCol=source, labelCol="label", smoothing=1.0)
    return Pipeline(stages=[*stages, model])


def logistic(n: int = 1 << 18, max_iter: int = 50, reg: float = 0.001) -> Pipeline:
    model = LogisticRegression(family="multinomial", labelCol="label", maxIter=max_iter, regParam=reg)
    return Pipeline(stages=[*vectorize(n), *weight(), model])


def svm(n: int = 1 << 18, max_iter: int = 30, reg: float = 0.001) -> Pipeline:
    one = LinearSVC(maxIter=max_iter, regParam=reg)
    return Pipeline(stages=[*vectorize(n), *weight(), OneVsRest(classifier=one, labelCol="label")])


def train(pipeline: Pipeline, docs: DataFrame) -> PipelineModel:
    """Fit on labelled rows. The rows are read once per pass of the solver, so keep them near."""
    rows = docs.filter("label is not null").select("text", docs["label"].cast("double").alias("label"))
    model = pipeline.fit(rows)
    for stage in model.stages:
        if isinstance(stage, CountVectorizerModel) and len(stage.vocabulary) >= stage.getVocabSize():
            raise ValueError(f"the vocabulary of {stage.getVocabSize()} words is full; words may be missing")
    return model


def train_nb(docs: DataFrame, kind: str = "multinomial", **options) -> PipelineModel:
    return train(naive_bayes(kind, **options), docs)


def train_logistic(docs: DataFrame, **options) -> PipelineModel:
    return train(logistic(**options), docs)


def train_svm(docs: DataFrame, **options) -> PipelineModel:
    return train(svm(**options), docs)


def score_table(model: PipelineModel, docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """`keep` plus `prediction` for every row."""
    return model.transform(docs).select(*keep, "prediction")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def cross_validate(
    pipeline: Pipeline, grid: list, docs: DataFrame, fold_col: str, folds: int, metric: str = "f1"
) -> CrossValidatorModel:
    """Grid search over a fold column made by `classify.fold`."""
    validator = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=grid,
        evaluator=MulticlassClassificationEvaluator(labelCol="label", metricName=metric),
        numFolds=folds,
        foldCol=fold_col,
        parallelism=2,
    )
    rows = docs.filter("label is not null").withColumn("label", docs["label"].cast("double"))
    return validator.fit(rows)


def lexicon_features(columns: Sequence[str], target: str = "features") -> VectorAssembler:
    """Lexicon scores and style counts as model input."""
    return VectorAssembler(inputCols=list(columns), outputCol=target, handleInvalid="keep")


def project_text(
    docs: DataFrame, width: int, keep: Sequence[str], col: str = "text", seed: int = 11
) -> DataFrame:
    """(keep, vector): TF-IDF weights over 2^18 hashed words, projected at random to `width` dimensions.

    A hashed word has eight places with random signs, the same in every task, so that dot products of the long sparse vectors are
    kept in the mean. Document frequencies are counted over all documents; they are one number per slot, whatever the corpus.
    A text without words has a zero vector.
    """
    slots = F.transform(T.words(col), lambda w: F.pmod(F.crc32(w.cast("binary")), F.lit(SLOTS)).cast("int"))
    rows = docs.select(*keep, F.coalesce(slots, F.array().cast("array<int>")).alias("_slots"))
    found = rows.select(F.explode(F.array_distinct("_slots")).alias("s")).groupBy("s").count().collect()
    df = np.zeros(SLOTS)
    for r in found:
        df[r["s"]] = r["count"]
    idf = np.log((docs.count() + 1) / (df + 1))
    rng = np.random.default_rng(seed)
    place = rng.integers(0, width, (SLOTS, PLACES), dtype=np.int32)
    sign = rng.integers(0, 2, (SLOTS, PLACES), dtype=np.int8) * 2 - 1

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, PROJECTED_ROWS):
                batch = whole.slice(start, PROJECTED_ROWS)
                lists = batch.column("_slots")
                ends, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
                out = np.zeros((batch.num_rows, width))
                for row in range(batch.num_rows):
                    seen, n = np.unique(values[ends[row] : ends[row + 1]], return_counts=True)
                    weight = (n * idf[seen])[:, None] * sign[seen]
                    out[row] = np.bincount(place[seen].ravel(), weight.ravel(), minlength=width)
                vectors = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * width, pa.int32()), pa.array(out.ravel()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), vectors], [*keep, "vector"])

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return rows.mapInArrow(project, f"{kinds}vector array<double>")
