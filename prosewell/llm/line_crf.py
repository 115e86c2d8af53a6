"""Quality rules: base counts, then a linear-chain conditional random field that marks lines content or boilerplate.

The chain runs over the lines of a document; Viterbi decoding gives the most likely sequence, and the share of word characters in content lines
decides. Weights are learnt from a bounded sample of labelled documents: lines of good ones are content, lines of bad ones are boilerplate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosewell.llm import text_counts
from prosewell.llm.common import sampled, sliced, stored, text_of

# Bounds of the training sample: documents, bytes of a document that may be in it.
SAMPLE_DOCS = 6_000
SAMPLE_BYTES = 40_000
# Lines of all documents of the sample, about, and of a chain in training.
SAMPLE_LINES = 400_000
STRETCH = 256
MIN_WORDS = 10
REPEAT_PERCENT = 20
MIN_CONTENT = 0.5
FEATURES = 15

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
VERDICT = f"{COUNTS}, base_failed boolean, content_share double, kept boolean"


@dataclass
class LineModel:
    """Boilerplate minus content weight of each feature; scores of steps from state to state and of first states."""

    weights: np.ndarray = field(default_factory=lambda: np.r_[-4.0, np.zeros(FEATURES - 1)])
    steps: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    first: np.ndarray = field(default_factory=lambda: np.zeros(2))


def line_features(lines: list[str]) -> np.ndarray:
    """A row of features per line."""
    count: dict[str, int] = {}
    for line in lines:
        count[line] = count.get(line, 0) + 1
    rows = []
    for line in lines:
        data = line.encode("utf-8", "surrogatepass")
        words = data.split()
        n = len(words)
        if not n:
            rows.append((1.0, 1.0) + (0.0,) * (FEATURES - 2))
            continue
        symbols, upper, lower, digits, shouts, bars = text_counts.shares(data)
        chars = sum(map(len, words))
        mean = chars / n
        rows.append(
            (
                1.0,
                0.0,
                symbols / chars,
                min(1.0, symbols / n),
                upper / (upper + lower + 1),
                min(1.0, shouts / n),
                digits / chars,
                1.0 - len(set(words)) / n,
                float(count[line] > 1),
                float(n <= 3),
                float(words[-1][-1:] in (b".", b"?", b"!", b":")),
                min(1.0, n / 50),
                min(1.0, bars / n),
                float(mean > 12 or mean < 2),
                float(upper > lower),
            )
        )
    return np.array(rows).reshape(-1, FEATURES)


def viterbi(model: LineModel, features: np.ndarray) -> np.ndarray:
    """1 for boilerplate, 0 for content, by line."""
    scores = (features @ model.weights).tolist()
    (s00, s01), (s10, s11) = model.steps.tolist()
    a, b = model.first[0], model.first[1] + scores[0]
    back = []
    for score in scores[1:]:
        to_a, to_b = a + s00 < b + s10, a + s01 < b + s11
        back.append((to_a, to_b))
        a, b = (b + s10 if to_a else a + s00), (b + s11 if to_b else a + s01) + score
    state = int(b > a)
    out = [state]
    for choice in reversed(back):
        state = int(choice[state])
        out.append(state)
    return np.array(out[::-1])


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def fit(documents: list[tuple[np.ndarray, int]], rounds: int = 150, decay: float = 1e-3) -> LineModel:
    """Maximum conditional likelihood by gradient steps; a document's lines all have its label.

    A document longer than `STRETCH` lines is learnt from as several chains of that length at most. Lines are kept in one array, line 0 of
    all chains first, then line 1 of those that have one, longest chain first: nothing is padded, and memory follows the number of lines.
    Forward and backward sums run over all chains at once, a line a step.
    """
    model = LineModel()
    if len({label for _, label in documents}) < 2:
        return model
    chains = [
        (rows[at : at + STRETCH], label)
        for rows, label in documents
        for at in range(0, len(rows), STRETCH)
    ]
    chains.sort(key=lambda d: -len(d[0]))
    lengths = np.array([len(x) for x, _ in chains])
    gold = np.array([label for _, label in chains])
    share = np.bincount([label for _, label in documents], minlength=2) / len(documents)
    n, longest = len(chains), int(lengths[0])
    active = [int((lengths > t).sum()) for t in range(longest)]
    starts = np.append(0, np.cumsum(active))
    # Place of line t of chain i: starts[t] + i.
    at = np.concatenate([starts[: len(rows)] + i for i, (rows, _) in enumerate(chains)])
    x = np.empty((int(lengths.sum()), FEATURES), dtype=np.float32)
    x[at] = np.concatenate([rows for rows, _ in chains])
    line = [slice(int(starts[t]), int(starts[t + 1])) for t in range(longest)]
    label = np.empty(len(x))
    for t in range(longest):
        label[line[t]] = gold[: active[t]]
    last = starts[lengths - 1] + np.arange(n)
    total = lengths.sum()
    theta = np.zeros(FEATURES + 6)
    theta[0] = np.log(share[1] / share[0])
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    forward, backward = np.zeros((len(x), 2)), np.zeros((len(x), 2))
    norms = np.empty(len(x))
    for step in range(1, rounds + 1):
        w, steps, first = theta[:FEATURES], theta[FEATURES : FEATURES + 4].reshape(2, 2), theta[-2:]
        emit = x @ w
        forward[line[0]] = first + np.stack([np.zeros(n), emit[line[0]]], 1)
        for t in range(1, longest):
            before = forward[line[t - 1]][: active[t]]
            new = _log_sum(before[:, :, None] + steps, 1)
            new[:, 1] += emit[line[t]]
            forward[line[t]] = new
        backward[:] = 0
        for t in range(longest - 2, -1, -1):
            k = active[t + 1]
            after = backward[line[t + 1]].copy()
            after[:, 1] += emit[line[t + 1]]
            backward[starts[t] : starts[t] + k] = _log_sum(steps[None] + after[:, None, :], 2)
        norm = _log_sum(forward[last], 1)
        for t in range(longest):
            norms[line[t]] = norm[: active[t]]
        missing = label - np.exp(forward[:, 1] + backward[:, 1] - norms)
        grad = np.zeros_like(theta)
        grad[:FEATURES] = missing @ x
        grad[-1] = missing[line[0]].sum()
        grad[-2] = -grad[-1]
        g_steps = np.zeros((2, 2))
        for t in range(1, longest):
            k = active[t]
            after = backward[line[t]].copy()
            after[:, 1] += emit[line[t]]
            before = forward[line[t - 1]][:k]
            pair = np.exp(before[:, :, None] + steps + after[:, None, :] - norm[:k, None, None])
            g_steps -= pair.sum(axis=0)
            g_steps[[0, 1], [0, 1]] += np.bincount(gold[:k], minlength=2)
        grad[FEATURES : FEATURES + 4] = g_steps.ravel()
        grad = grad / total - decay * theta
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad**2
        theta = theta + 0.1 * (mean / (1 - 0.9**step)) / (
            np.sqrt(square / (1 - 0.99**step)) + 1e-8
        )
    return LineModel(theta[:FEATURES].copy(), theta[FEATURES : FEATURES + 4].reshape(2, 2).copy(), theta[-2:].copy())


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in sliced(whole, 200):
            rows = [line_features(t.split("\n")).astype("<f4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("quality"), pa.array(rows, pa.binary())],
                ["quality", "features"],
            )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS) -> LineModel:
    """A model from `docs` (doc_id, text) and `labels` (doc_id, quality; 0 is bad).

    Reads about `sample` labelled documents of at most `SAMPLE_BYTES` with about `SAMPLE_LINES` lines in all, chosen by a hash of doc_id. Without both kinds of documents
    the model marks every line content. Null ids and other labels are left out; a text of an id that repeats counts as often as it occurs.
    """
    known = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias("key"), F.col("quality").cast("int").alias("quality")
    )
    chosen = sampled(known, [F.col("key")], sample, known.count())
    rows = docs.select(F.col("doc_id").alias("key"), text_of().alias("text"))
    rows = rows.filter(F.octet_length("text").between(1, SAMPLE_BYTES))
    found = stored(rows.join(F.broadcast(chosen), "key").select("key", "quality", "text"), "labelled")
    lines = found.agg(F.coalesce(F.sum(F.size(F.split("text", "\n"))), F.lit(0))).first()[0]
    found = sampled(found, [F.lit("lines"), F.col("key")], SAMPLE_LINES, lines).select("quality", "text")
    table = found.mapInArrow(_line_rows, "quality int, features binary").collect()
    rows = [(np.frombuffer(r.features, "<f4").reshape(-1, FEATURES), 1 - r.quality) for r in table]
    return fit(sorted(rows, key=lambda r: (r[1], r[0].tobytes())))


def judge(text: str, model: LineModel, min_content: float = MIN_CONTENT) -> tuple:
    """The columns of `VERDICT` for one text."""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = text.split("\n")
    n, repeats = len(words), text_counts.repeat_words(words)
    failed = n < MIN_WORDS or 100 * repeats > REPEAT_PERCENT * n
    share = 0.0
    if n:
        sizes = np.array([text_counts.word_chars(line) for line in lines])
        bad = viterbi(model, line_features(lines))
        share = float(sizes[bad == 0].sum() / sizes.sum())
    return (
        n, text_counts.word_chars(text), sum(map(text.count, text_counts.SYMBOLS)),
        text_counts.dup_lines(lines), repeats, failed, share, not failed and share >= min_content,
    )


_TYPES = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
_NAMES = [c.split()[0] for c in VERDICT.split(", ")]


def _judged(model: LineModel) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, 200):
                texts = batch.column("text").to_pylist()
                rows = zip(*(judge(t, model) for t in texts), strict=True)
                found = [pa.array(r, t) for r, t in zip(rows, _TYPES, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *found], ["doc_id", *_NAMES])

    return run


def verdicts(docs: DataFrame, model: LineModel) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_share, kept): a row per row of `docs`.

    A null text counts as empty: no words, so it fails. Repeated rows, null doc_ids and other columns change nothing.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(_judged(model), f"doc_id long, {VERDICT}")


def keep_good(docs: DataFrame, model: LineModel) -> DataFrame:
    """The rows of `docs` (text, any other columns) that are kept, with all their columns."""

    def kept(texts: pd.Series) -> pd.Series:
        return pd.Series([judge(t or "", model)[-1] for t in texts], dtype=bool)

    return docs.filter(F.pandas_udf(kept, "boolean")(F.col("text")))
