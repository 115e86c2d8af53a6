"""Quality by hierarchical empirical Bayes: what a document's text says, and what its host and path are known for.

A logistic classifier, trained on a bounded sample of labelled documents, gives each text a probability to be good. Sums of these by host and
by path give posteriors: a path with few documents is drawn to its host, a host with few documents to all of them. How strongly follows
from the spread of the hosts' (paths') own means, by moments. A document's own evidence is left out of its site's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosewell.llm import text_counts
from prosewell.llm.common import sampled, sliced, stored, text_of
from prosewell.operators.joins import lookup
from prosewell.sources.store import cut

SAMPLE_DOCS = 10_000
FEATURES = 14
KEEP_AT = 0.5
# Evidence of one text, in log odds, is held within this: no text is certain.
MAX_EVIDENCE = 8.0
# Bounds of the prior's weight, in documents.
STRENGTH = (2.0, 200.0)


@dataclass
class TextModel:
    weights: np.ndarray
    center: np.ndarray
    scale: np.ndarray
    prior: float

    def log_odds(self, features: np.ndarray) -> np.ndarray:
        z = ((features - self.center) / self.scale) @ self.weights[1:] + self.weights[0]
        return np.clip(z, -MAX_EVIDENCE, MAX_EVIDENCE)


def text_features(text: str) -> tuple[float, ...]:
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    if not n:
        return (0.0,) * FEATURES
    lines = [line for line in text.split("\n") if text_counts.has_word(line)]
    symbols, upper, lower, digits, shouts, bars = text_counts.shares(data)
    chars = sum(map(len, words))
    ends = sum(line.rstrip()[-1:] in ".?!:" for line in lines)
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return (
        1.0,
        np.log1p(n),
        symbols / chars,
        min(1.0, symbols / n),
        upper / (upper + lower + 1),
        min(1.0, shouts / n),
        digits / chars,
        min(1.0, bars / n),
        same / n,
        text_counts.repeat_words(words) / n,
        1.0 - len(set(lines)) / len(lines),
        ends / len(lines),
        min(chars / n, 20.0),
        np.log1p(n / len(lines)),
    )


def fit(features: np.ndarray, good: np.ndarray, rounds: int = 40, ridge: float = 1.0) -> TextModel:
    """Logistic regression by Newton steps, with a ridge on all weights but the first."""
    n = len(good)
    center = features.mean(axis=0) if n else np.zeros(FEATURES)
    scale = features.std(axis=0) if n else np.ones(FEATURES)
    scale = np.where(scale > 1e-9, scale, 1.0)
    prior = float((good.sum() + 1) / (n + 2))
    weights = np.zeros(FEATURES + 1)
    weights[0] = np.log(prior / (1 - prior))
    if len(np.unique(good)) == 2:
        x = np.c_[np.ones(n), (features - center) / scale]
        penalty = np.r_[1e-6, np.full(FEATURES, ridge)]
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
            step = np.linalg.solve(hessian, x.T @ (good - p) - penalty * weights)
            weights += step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
    return TextModel(weights, center, scale, prior)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in sliced(whole, 500):
            rows = [list(text_features(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("quality"), pa.array(rows, pa.list_(pa.float64()))],
                ["quality", "features"],
            )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS) -> TextModel:
    """A classifier from `docs` (doc_id, text) and `labels` (doc_id, quality; 1 is good).

    Reads about `sample` labelled documents, chosen by a hash of doc_id. With one kind of label, or none, all texts get the same odds.
    """
    known = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias("key"), F.col("quality").cast("int").alias("quality")
    )
    chosen = sampled(known, [F.col("key")], sample, known.count())
    rows = docs.select(F.col("doc_id").alias("key"), text_of().alias("text"))
    found = rows.join(F.broadcast(chosen), "key").select("quality", "text")
    table = found.mapInArrow(_feature_rows, "quality int, features array<double>").toPandas()
    features = np.array(table["features"].tolist(), dtype=float).reshape(-1, FEATURES)
    return fit(features, table["quality"].to_numpy(dtype=float))


def evidence(text: Column, model: TextModel) -> Column:
    """Log odds of each text to be good; a null text counts as empty."""

    def score(texts: pd.Series) -> pd.Series:
        rows = np.array([text_features(t or "") for t in texts], dtype=float)
        return pd.Series(model.log_odds(rows.reshape(-1, FEATURES)))

    return F.pandas_udf(score, "double")(text)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, n: str, good: str, toward: Column) -> Column:
    """Weight of the prior: p (1 - p) over the spread of group means around what they are drawn to, less chance's share."""
    own = F.col(good) / F.col(n)
    spread = F.sum(F.col(n) * (own - toward) ** 2) / F.sum(n)
    chance = F.sum(toward * (1 - toward)) / F.sum(n)
    even = F.sum(F.col(n) * toward * (1 - toward)) / F.sum(n)
    between = F.greatest(spread - chance, F.lit(1e-9))
    return F.least(F.greatest(even / between - 1, F.lit(STRENGTH[0])), F.lit(STRENGTH[1]))


def site_posteriors(scored: DataFrame) -> DataFrame:
    """(host, path, n, good, host_n, host_good, mean, host_strength, path_strength) from (host, path, _evidence); a row per path.

    Sums are combined in each task before they are shuffled, so a host with a third of all documents costs no more than another.
    """
    p = 1 / (1 + F.exp(-F.col("_evidence")))
    paths = cut(
        scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum(p).alias("good"))
    )
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    row = hosts.agg(F.sum("host_good") / F.sum("host_n")).first()
    mean = min(max(row[0] if row[0] is not None else 0.5, 1e-3), 1 - 1e-3)
    host_strength = hosts.agg(_strength(hosts, "host_n", "host_good", F.lit(mean))).first()[0]
    host_strength = STRENGTH[1] if host_strength is None else host_strength
    both = paths.join(hosts, paths["host"].eqNullSafe(hosts["host"])).drop(hosts["host"])
    drawn = (F.lit(host_strength * mean) + F.col("host_good")) / (F.col("host_n") + host_strength)
    both = cut(both.withColumn("host_posterior", drawn))
    path_strength = both.agg(_strength(both, "n", "good", F.col("host_posterior"))).first()[0]
    return both.select(
        "*",
        F.lit(mean).alias("mean"),
        F.lit(host_strength).alias("host_strength"),
        F.lit(STRENGTH[1] if path_strength is None else path_strength).alias("path_strength"),
    )


def combined(scored: DataFrame, sites: DataFrame, keep_at: float = KEEP_AT) -> DataFrame:
    """Adds text_score, host_posterior, path_posterior, score and kept to (host, path, _evidence, any other columns)."""
    own = {"host": "_h", "path": "_p"}
    table = sites.select(
        F.xxhash64("host", "path", F.isnull("host"), F.isnull("path")).alias("_site"),
        *(F.col(c).alias(f"_s_{c}") for c in sites.columns if c not in own),
    )
    keyed = scored.withColumn(
        "_site", F.xxhash64("host", "path", F.isnull("host"), F.isnull("path"))
    )
    rows = lookup(keyed, table, "_site")
    text = 1 / (1 + F.exp(-F.col("_evidence")))
    mean, k_host, k_path = F.col("_s_mean"), F.col("_s_host_strength"), F.col("_s_path_strength")
    host = (k_host * mean + F.col("_s_host_good") - text) / (k_host + F.col("_s_host_n") - 1)
    path = (k_path * F.col("host_posterior") + F.col("_s_good") - text) / (k_path + F.col("_s_n") - 1)
    inside = lambda x: F.least(F.greatest(x, F.lit(1e-3)), F.lit(1 - 1e-3))
    score = 1 / (1 + F.exp(-(F.col("_evidence") - _logit(mean) + _logit(F.col("path_posterior")))))
    rows = rows.withColumn("text_score", text).withColumn("host_posterior", inside(host))
    rows = rows.withColumn("path_posterior", inside(path)).withColumn("score", score)
    rows = rows.withColumn("kept", F.col("score") >= keep_at)
    return rows.drop("_site", *(f"_s_{c}" for c in sites.columns))


def keep_good(docs: DataFrame, model: TextModel, host: Column, path: Column) -> DataFrame:
    """The rows of `docs` (text, any other columns) that are kept, with all their columns.

    A null host or path is a site of its own. Rows need no key: repeated rows are judged each alike.
    """
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        host.alias("host"),
        path.alias("path"),
        evidence(F.col("text"), model).alias("_evidence"),
    )
    rows = stored(rows, "evidence")
    judged = combined(rows, site_posteriors(rows.drop("row")))
    return judged.filter("kept").select("row.*")
