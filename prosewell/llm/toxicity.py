"""Toxicity by positive-unlabelled learning.

Confirmed toxic texts are the positives; all other training texts are unlabelled, whatever they are. A linear classifier minimizes the
non-negative risk: prior * loss on positives as toxic, plus what unlabelled texts lose as clean beyond what the prior says
the toxic ones among them lose, never below 0. Without that floor a flexible classifier makes the second term negative.

Features are words and beginnings of words (insults are inflected) present in the whole text, hashed to slots. Only slots that positives
have clearly more often than unlabelled texts are weighted; they are chosen from counts over all training texts. Weights are fitted on a
bounded sample, chosen by a hash of doc_id; a slot that none of the sampled positives has is weighted by its counts.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosewell.llm.common import fraction, sampled, sliced, text_of
from prosewell.operators.joins import lookup
from prosewell.sources.store import cut

POSITIVES = 4_000
UNLABELLED = 12_000
SLOTS = 1 << 20
PREFIXES = (4, 5)
CHANCE = 0.05
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
CACHED_WORDS = 500_000
# Bytes that end a word: ASCII but for letters. Other bytes are parts of letters.
_PARTS = bytes(
    b if b > 127 or chr(b).isalpha() else 32 for b in range(256)
)


@dataclass
class ToxicModel:
    """Weight by slot, and the score in log odds of a text without any of them."""

    weights: dict[int, float] = field(default_factory=dict)
    bias: float = -30.0


def word_set(text: str) -> set[bytes]:
    return set(text.lower().encode("utf-8", "surrogatepass").translate(_PARTS).split())


def slots_of(word: bytes) -> tuple[int, ...]:
    """The slots of a word and of its beginnings."""
    starts = (b"%d " % n + word[:n] for n in PREFIXES if len(word) > n)
    return tuple(zlib.crc32(part) & (SLOTS - 1) for part in (word, *starts))


def text_slots(text: str) -> np.ndarray:
    return np.unique([s for w in word_set(text) for s in slots_of(w)]).astype(np.int32)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of doc_id as text leaves the held-out remainder; no doc_id is not held out."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(rest == HELD_OUT, F.lit(False))


def _document_counts(rows: list[np.ndarray]) -> np.ndarray:
    """Texts that have each slot; a row names a slot once."""
    counts = np.zeros(SLOTS, dtype=np.int64)
    for row in rows:
        counts[row] += 1
    return counts


def _select(p: np.ndarray, u: np.ndarray, n_p: int, n_u: int) -> np.ndarray:
    """Slots that more positives have than chance gives to any slot; the clearest first.

    p and u are how many of the `n_p` positives and `n_u` unlabelled texts have each slot. Were a word as likely in positives as elsewhere,
    `expected` of them would have it; the chance of so many is at most exp(tail). It must be below `CHANCE` by the number of slots that were tried.
    """
    expected = n_p * (p + u + 1) / max(1, n_p + n_u)
    with np.errstate(divide="ignore", invalid="ignore"):
        tail = np.where(p > expected, p - expected - p * np.log(p / expected), 0.0)
    good = np.flatnonzero(tail < np.log(CHANCE / max(1, int(((p + u) > 0).sum()))))
    return good[np.argsort(tail[good], kind="stable")]


class _Matrix:
    """Which of the chosen slots each row has: zeros and ones of which only the ones are kept."""

    def __init__(self, rows: list[np.ndarray], chosen: np.ndarray) -> None:
        place = np.full(SLOTS, -1, dtype=np.intp)
        place[chosen] = np.arange(len(chosen))
        found = [at[at >= 0] for at in (place[row] for row in rows)]
        self.shape = (len(rows), len(chosen))
        self.column = np.concatenate([np.zeros(0, dtype=np.intp), *found])
        self.row = np.repeat(np.arange(len(rows), dtype=np.intp), [len(at) for at in found])

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.column], self.shape[0])

    def transposed_times(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, values[self.row], self.shape[1])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float,
    rounds: int = 400, decay: float = 1e-4, rate: float = 0.05, chosen: np.ndarray | None = None, unseen: np.ndarray | None = None,
) -> ToxicModel:
    """Non-negative risk minimized with the sigmoid loss, by Adam over the whole sample.

    The loss has a bound, so a prior that is a little off cannot pull the second term far below 0. Where it falls below, a step goes up its
    gradient instead, so that it comes back. `chosen` are the slots to weight, from the sample's own counts if not given; `unseen` are
    the weights of those of them that no sampled positive has.
    """
    if not positive or not unlabelled or not 0 < prior < 1:
        return ToxicModel()
    if chosen is None:
        chosen = _select(_document_counts(positive), _document_counts(unlabelled), len(positive), len(unlabelled))
    if not len(chosen):
        return ToxicModel(bias=float(np.log(prior / (1 - prior))))
    xp, xu = _Matrix(positive, chosen), _Matrix(unlabelled, chosen)
    n_p, n_u = len(positive), len(unlabelled)
    theta = np.zeros(len(chosen) + 1)
    theta[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        w, b = theta[:-1], theta[-1]
        fp, fu = xp.times(w) + b, xu.times(w) + b
        sp, su = _sigmoid(fp), _sigmoid(fu)
        # Gradients of the mean losses: 1 - sigmoid(f) as toxic, sigmoid(f) as clean.
        gp, gu = sp * (1 - sp), su * (1 - su)
        p_clean = np.r_[xp.transposed_times(gp), gp.sum()] / n_p
        u_clean = np.r_[xu.transposed_times(gu), gu.sum()] / n_u
        below = su.mean() - prior * sp.mean() < 0
        grad = -(u_clean - prior * p_clean) if below else u_clean - 2 * prior * p_clean
        grad = grad + decay * np.r_[w, 0]
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad**2
        theta = theta - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    fitted = theta[:-1]
    if unseen is not None:
        fitted = np.where(xp.transposed_times(np.ones(n_p)) > 0, fitted, unseen)
    weights = {int(s): float(w) for s, w in zip(chosen, fitted, strict=True) if w}
    return ToxicModel(weights, float(theta[-1]))


class _Slots(dict):
    """The slots of each word met, hashed the first time."""

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        slots = slots_of(word)
        if len(self) < CACHED_WORDS:
            self[word] = slots
        return slots


def _slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slot, p, u): how many toxic and other texts of a task have each slot; slot -1 counts the texts. Held in tables of `SLOTS`."""
    counts, texts, known = np.zeros((2, SLOTS), dtype=np.int64), [0, 0], _Slots()
    for batch in batches:
        for small in sliced(batch, 500):
            for toxic, text in zip(small.column("toxic").to_pylist(), small.column("text").to_pylist(), strict=True):
                kind = 0 if toxic else 1
                slots = set().union(*map(known.__getitem__, word_set(text)))
                counts[kind][np.fromiter(slots, dtype=np.int64, count=len(slots))] += 1
                texts[kind] += 1
    found = np.flatnonzero(counts.any(axis=0))
    for start in range(0, len(found), 100_000):
        at = found[start : start + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(counts[0][at], pa.int64()), pa.array(counts[1][at], pa.int64())], ["slot", "p", "u"]
        )
    yield pa.RecordBatch.from_arrays(
        [pa.array([-1], pa.int32()), pa.array(texts[:1], pa.int64()), pa.array(texts[1:], pa.int64())], ["slot", "p", "u"]
    )


def _chosen_slots(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The slots to weight, and the weights their counts give, from all training texts (toxic or null, text).

    Toxic texts are counted as unlabelled ones too: unlabelled texts are as they come, toxic or not.
    """
    table = rows.mapInArrow(_slot_counts, "slot int, p long, u long").groupBy("slot")
    table = cut(table.agg(F.sum("p").alias("p"), F.sum(F.col("p") + F.col("u")).alias("u")))
    texts = table.filter("slot < 0").first()
    n_p, n_u = (texts["p"], texts["u"]) if texts else (0, 0)
    table = table.filter("slot >= 0")
    p, expected = F.col("p"), n_p * (F.col("p") + F.col("u") + 1) / max(1, n_p + n_u)
    tail = F.when(p > expected, p - expected - p * F.log(p / expected)).otherwise(0.0)
    # As in _select; only the slots it would choose reach the driver.
    good = table.filter(tail < float(np.log(CHANCE / max(1, table.count())))).orderBy(tail, "slot").toPandas()
    weights = np.log((good["p"] + 0.5) / (n_p + 1)) - np.log((good["u"] + 0.5) / (n_u + 1))
    return good["slot"].to_numpy(), weights.to_numpy()


def _slot_rows(chosen: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(SLOTS, dtype=bool)
        wanted[chosen] = True
        for whole in batches:
            for batch in sliced(whole, 500):
                found = (text_slots(t) for t in batch.column("text").to_pylist())
                rows = [slots[wanted[slots]] for slots in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("toxic"), pa.array(rows, pa.list_(pa.int32()))], ["toxic", "slots"]
                )

    return rows_of


def train(
    docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED
) -> ToxicModel:
    """A model from `docs` (doc_id, text) and `labels` (doc_id, toxic); held-out rows of both are left alone.

    The class prior is the share of toxic rows among the labelled ones. Slots are counted in all documents; weights are fitted on about
    `positives` toxic and `unlabelled` other ones.
    Without a toxic example every text scores 0.
    """
    known = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("key")).agg(F.max("toxic").alias("toxic"))
    counts = known.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    if not counts["toxic"]:
        return ToxicModel()
    toxic = known.filter("toxic = 1").select("key", F.lit(1).alias("toxic"))
    rows = docs.filter(~held_out(F.col("doc_id"))).select(
        F.col("doc_id").alias("key"), text_of().alias("text")
    )
    total, parts = docs.count(), 1 << 30
    few = fraction(parts, F.lit("unlabelled"), F.col("key")) < int(
        parts * min(1.0, unlabelled * FOLDS / (FOLDS - 1) / max(total, 1))
    )
    all_rows = lookup(rows, cut(toxic), "key", "left")
    chosen, unseen = _chosen_slots(all_rows.select("toxic", "text"))
    some = sampled(toxic, [F.col("key")], positives, counts["toxic"])
    table = (
        rows.join(F.broadcast(some), "key", "left")
        .filter(F.col("toxic").isNotNull() | few)
        .withColumn("both", F.col("toxic").isNotNull() & few)
        .select(F.when(F.col("both"), 2).otherwise(F.coalesce("toxic", F.lit(0))).alias("toxic"), "text")
        .mapInArrow(_slot_rows(chosen), "toxic int, slots array<int>")
        .toPandas()
    )
    slots, kind = [np.asarray(s, dtype=np.int32) for s in table["slots"]], table["toxic"].to_numpy()
    return fit(
        [s for s, k in zip(slots, kind, strict=True) if k],
        [s for s, k in zip(slots, kind, strict=True) if k != 1],
        counts["toxic"] / counts["n"],
        chosen=chosen,
        unseen=unseen,
    )


class _Weighted(dict):
    """The weighted slots of each word met, hashed the first time; most words have none."""

    def __init__(self, weights: dict[int, float]) -> None:
        super().__init__()
        self._weights = weights

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        slots = tuple(s for s in slots_of(word) if s in self._weights)
        if len(self) < CACHED_WORDS:
            self[word] = slots
        return slots


def score_text(text: str, model: ToxicModel, known: dict[bytes, tuple[int, ...]] | None = None) -> float:
    known = _Weighted(model.weights) if known is None else known
    present = set().union(*filter(None, map(known.__getitem__, word_set(text))))
    return float(_sigmoid(np.float64(model.bias + math.fsum(model.weights[s] for s in present))))


def scores(docs: DataFrame, model: ToxicModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted): a row per row of `docs` (doc_id, text, any other columns); a null text counts as empty."""

    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = _Weighted(model.weights)
        for batch in texts:
            yield pd.Series([score_text(t, model, known) for t in batch], dtype=float)

    score.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    rows = docs.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.pandas_udf(score, "double")(text_of()).alias("score"),
    )
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
