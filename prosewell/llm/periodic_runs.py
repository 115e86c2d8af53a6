"""Periodic runs of words by an enhanced suffix array.

A run is a stretch of words of smallest period p, at least twice as long as p, that neither neighbour extends. Its last square ends where
it ends, and is branching: the suffixes at its start i and at i + p agree on p words and no further. So they lie in one LCP interval
of depth p, in two different children of it. Of each interval all children but the largest are gone through; for each
of their suffixes i the inverse array tells whether i + depth or i - depth lies in the interval outside i's own child. A suffix is looked at
only where its part of the array at least doubles, so that is O(n log n) look-ups, and no tree is built: an interval is two bounds and a depth.
A square is rotated left as far as its words allow; squares that cover the same stretch are one run, of the smallest of their periods.

The suffix array comes from doubled prefixes. The ranks of every doubling stay (n numbers each, as many as the logarithm of the longest
repeat), since they tell in as many steps how far two places agree, to the right for the LCP and to the left for the rotations.
Words of different documents never compare equal, so the documents of a batch share one array.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosewell.llm.common import ascii_words, sliced_by_bytes, text_of

BATCH_BYTES = 1 << 19
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def suffix_ranks(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of `codes`, and the ranks of all places by their first 1, 2, 4, ... codes.

    `ends` holds, for each place, where its document ends. A place's rank is where the places equal to it begin in the order. The
    last ranks are the inverse of the suffix array.
    """
    n = len(codes)
    place = np.arange(n)
    order = np.argsort(codes, kind="stable")
    ordered = codes[order]
    new = np.ones(n, dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    head = np.maximum.accumulate(np.where(new, place, 0))
    rank = np.empty(n, dtype=np.int32)
    rank[order] = head
    levels, step = [rank], 1
    open_ = place[~(new & np.append(new[1:], True))]
    while len(open_):
        suffix = order[open_]
        follower = suffix + step
        inside = follower < ends[suffix]
        key = head[open_] * np.int64(n + 1)
        key[inside] += rank[follower[inside]] + np.int64(1)
        by_key = np.argsort(key)
        suffix, key = suffix[by_key], key[by_key]
        new = np.ones(len(key), dtype=bool)
        np.not_equal(key[1:], key[:-1], out=new[1:])
        heads = np.maximum.accumulate(np.where(new, open_, 0))
        order[open_], head[open_] = suffix, heads
        rank = rank.copy()
        rank[suffix] = heads
        levels.append(rank)
        open_ = open_[~(new & np.append(new[1:], True))]
        step *= 2
    return order, levels


def _agree_right(a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """How many codes the suffixes at `a` and at `b` share."""
    n = len(levels[0])
    shared = np.zeros(len(a), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + shared, b + shared
        both = np.flatnonzero((x < n) & (y < n))
        same = both[levels[k][x[both]] == levels[k][y[both]]]
        shared[same] += 1 << k
    return shared


def _agree_left(a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """How many codes before `a` equal those before `b`; a < b in every pair."""
    shared = np.zeros(len(a), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x = a - shared - (1 << k)
        inside = np.flatnonzero(x >= 0)
        same = inside[levels[k][x[inside]] == levels[k][(b - shared - (1 << k))[inside]]]
        shared[same] += 1 << k
    return shared


def lcp_intervals(
    where: np.ndarray, depth: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First place, last place and depth of each LCP interval, and the interval of each boundary.

    `where` are the places of the array that share `depth` > 0 codes with the place before.
    """
    firsts: list[int] = []
    lasts: list[int] = []
    depths: list[int] = []
    owner: list[int] = []
    open_: list[int] = []
    previous = -2
    for k, d in zip(where.tolist(), depth.tolist(), strict=True):
        first = k - 1
        if previous != first:
            for m in open_:
                lasts[m] = previous
            open_.clear()
        while open_ and depths[open_[-1]] > d:
            m = open_.pop()
            lasts[m] = k - 1
            first = firsts[m]
        if not open_ or depths[open_[-1]] < d:
            open_.append(len(firsts))
            firsts.append(first)
            lasts.append(k)
            depths.append(d)
        owner.append(open_[-1])
        previous = k
    for m in open_:
        lasts[m] = previous
    return tuple(np.array(x, dtype=np.int64) for x in (firsts, lasts, depths, owner))  # type: ignore[return-value]


def branching_squares(
    order: np.ndarray, inverse: np.ndarray, lcp: np.ndarray, deepest: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of every branching square of a period up to `deepest` of its start."""
    where = np.flatnonzero(lcp)
    firsts, lasts, depths, owner = lcp_intervals(where, lcp[where])
    # The children of an interval begin at its first place and at its boundaries.
    by_owner = np.argsort(owner, kind="stable")
    sizes = np.bincount(owner, minlength=len(firsts)) + 1
    at = np.cumsum(sizes) - sizes
    begin = np.empty(sizes.sum(), dtype=np.int64)
    is_first = np.zeros(len(begin), dtype=bool)
    is_first[at] = True
    begin[is_first], begin[~is_first] = firsts, where[by_owner]
    parent = np.repeat(np.arange(len(firsts)), sizes)
    stop = np.append(begin[1:], 0)
    stop[at + sizes - 1] = lasts + 1
    width = stop - begin
    # All children but the largest of each interval.
    largest = np.maximum.reduceat(width, at) if len(at) else width
    big = np.flatnonzero(width == largest[parent])
    chosen = np.ones(len(begin), dtype=bool)
    chosen[big[np.unique(parent[big], return_index=True)[1]]] = False
    chosen &= depths[parent] <= deepest[order[begin]] if len(begin) else chosen
    child = np.flatnonzero(chosen)
    width = width[child]
    member = np.repeat(begin[child] + width - np.cumsum(width), width) + np.arange(width.sum())
    child = np.repeat(child, width)
    suffix, period = order[member], depths[parent[child]]
    low, high = firsts[parent[child]], lasts[parent[child]]
    starts, periods = [], []
    for other in (suffix + period, suffix - period):
        some = np.flatnonzero((other >= 0) & (other < len(order)))
        place = inverse[other[some]]
        mine = child[some]
        found = some[
            (place >= low[some]) & (place <= high[some])
            & ((place < begin[mine]) | (place >= stop[mine]))
        ]
        starts.append(np.minimum(suffix[found], other[found]))
        periods.append(period[found])
    return np.concatenate(starts), np.concatenate(periods)


def find_runs(
    codes: np.ndarray, lengths: np.ndarray, min_length: int = 2, min_exponent: int = 2
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of every run, by document, start and period.

    `codes` are the codes of all documents' words, one document after the other, and `lengths` their sizes. A run is as long as
    `min_length` words and `min_exponent` (2 or more) periods at least.
    """
    none = np.empty(0, dtype=np.int64)
    if not len(codes):
        return none, none, none, none
    document = np.repeat(np.arange(len(lengths)), lengths)
    begins = np.cumsum(lengths) - lengths
    ends = (begins + lengths)[document]
    order, levels = suffix_ranks(codes + document * (codes.max() + 1), ends)
    lcp = np.zeros(len(order), dtype=np.int64)
    ordered = levels[0][order]
    near = np.flatnonzero(ordered[1:] == ordered[:-1]) + 1
    lcp[near] = _agree_right(order[near - 1], order[near], levels)
    start, period = branching_squares(
        order, levels[-1], lcp, (lengths // max(2, min_exponent))[document]
    )
    rotations = _agree_left(start, start + period, levels)
    stop, start = start + 2 * period, start - rotations
    long_enough = stop - start >= np.maximum(min_length, min_exponent * period)
    start, stop, period = start[long_enough], stop[long_enough], period[long_enough]
    # Squares over the same stretch are one run; the others repeat its words a whole number of times.
    by_stretch = np.lexsort((period, stop, start))
    start, stop, period = start[by_stretch], stop[by_stretch], period[by_stretch]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, period = start[new], stop[new], period[new]
    kept = stop - start >= min_exponent * period
    start, stop, period = start[kept], stop[kept], period[kept]
    by_period = np.lexsort((period, start))
    start, stop, period = start[by_period], stop[by_period], period[by_period]
    where = document[start]
    return where, start - begins[where], stop - start, period


def _coded(words: Sequence[bytes]) -> np.ndarray:
    table = dict.fromkeys(words)
    table = dict(zip(table, range(len(table)), strict=True))
    return np.fromiter(map(table.__getitem__, words), dtype=np.int64, count=len(words))


def _batch(texts: Sequence[str], min_length: int, min_exponent: int) -> list[pa.Array]:
    """n_words, runs and collapsed of each text."""
    split = [ascii_words(t) for t in texts]
    lengths = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    words = [w for one in split for w in one]
    where, start, length, period = find_runs(_coded(words), lengths, min_length, min_exponent)
    collapsed = [b" ".join(one) for one in split]
    per_text = np.bincount(where, minlength=len(split))
    ends = np.cumsum(per_text)
    for i in np.flatnonzero(per_text).tolist():
        mine = slice(ends[i] - per_text[i], ends[i])
        # +1 where a run's later periods begin, -1 behind it: above zero, some run covers the word again.
        change = np.zeros(lengths[i] + 1, dtype=np.int64)
        np.add.at(change, start[mine] + period[mine], 1)
        np.add.at(change, start[mine] + length[mine], -1)
        kept = np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()
        collapsed[i] = b" ".join(map(split[i].__getitem__, kept))
    runs = pa.StructArray.from_arrays(
        [pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"]
    )
    offsets = pa.array(np.append(0, ends), pa.int32())
    return [
        pa.array(lengths, pa.int64()),
        pa.ListArray.from_arrays(offsets, runs),
        pa.array(collapsed, pa.binary()).cast(pa.string()),
    ]


def collapse_runs(
    docs: DataFrame,
    min_length: int = 6,
    min_exponent: int = 4,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, n_words, runs, collapsed), a row per row of `docs`.

    `runs` are all stretches of words that repeat with a smallest period, at least `min_length` words and `min_exponent` periods long, as
    (start, length, period) in words, by start, then period. `collapsed` is the text without a run's words after its first period, words
    parted by single blanks; a word goes if any run drops it.

    Text null, empty or blank: no words, no runs, an empty text. Keys may be null or repeat: every row is judged by itself. Other columns of `docs`,
    whatever their names, are not read. An empty table gives an empty one. No shuffle: a task holds the words of half a megabyte of
    texts, or of one longer text, and some ranks of each.
    """

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced_by_bytes(whole, "_text", BATCH_BYTES):
                found = _batch(batch.column("_text").to_pylist(), min_length, min_exponent)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *found], [key, "n_words", "runs", "collapsed"]
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(f"`{key}`"), text_of(text).alias("_text")).mapInArrow(
        collapse, f"`{key}` {kind}, n_words long, runs {RUNS}, collapsed string"
    )
