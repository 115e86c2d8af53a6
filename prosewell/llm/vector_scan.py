"""Approximate nearest neighbours: probed lists, scanned a few rotated dimensions at a time.

Vectors are rotated at random, so that any few dimensions are a fair sample of all, and kept in lists around centers. A list is cut into blocks
of bounded size, each stored as blocks of columns. A query probes the nearest lists. Within a block it sums squared differences one column
block at a time; after each, a hypothesis test drops candidates whose partial distance makes it unlikely that they are within the
query's bound. What survives all columns is measured exactly on the original vectors.

The bound of a query is its distance to the 3 k-th nearest vector of the training sample. Those are candidates themselves, so some may be missed
before there are too few. A query that is left with too few all the same is answered from all lists without a bound.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prosewell.llm.common import sampled, sliced, stored
from prosewell.operators.joins import lookup, top_k
from prosewell.sources.store import cut

# Bounds: vectors that are sampled for centers and bounds, lists, vectors of a block, queries of a chunk.
SAMPLE = 8_192
MAX_LISTS = 1_024
BLOCK = 512
CHUNK = 256
COLUMNS = 8
ROUNDS = 8
# Share of the lists that a query probes, and the test's width: larger drops fewer true neighbours.
PROBED = 0.7
WIDTH = 2.1
# The bound lets so many times k vectors of the sample pass.
SPARE = 3
SEED = 17


@dataclass
class Lists:
    rotation: np.ndarray
    centers: np.ndarray
    sample: np.ndarray
    probes: int


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of `a` to all rows of `b`."""
    out = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None] - 2 * a @ b.T
    return np.maximum(out, 0, out=out)


def fit(sample: np.ndarray, total: int, probed: float = PROBED) -> Lists:
    """Centers by k-means on the sample, one per square root of `total`, and a random rotation."""
    rng = np.random.default_rng(SEED)
    rotation, _ = np.linalg.qr(rng.standard_normal((sample.shape[1], sample.shape[1])))
    n = max(1, min(MAX_LISTS, len(sample), math.isqrt(total)))
    centers = sample[np.sort(rng.choice(len(sample), n, replace=False))]
    for _ in range(ROUNDS):
        at = squared(sample, centers).argmin(axis=1)
        counts = np.bincount(at, minlength=n)
        sums = np.zeros_like(centers)
        np.add.at(sums, at, sample)
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
    return Lists(rotation, centers, sample, max(1, math.ceil(probed * n)))


def _vectors(batch: pa.RecordBatch, column: str) -> np.ndarray:
    lists = batch.column(column)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(batch.num_rows, -1)


def _assigned(lists: Lists) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole):
                at = squared(_vectors(batch, "vector"), lists.centers).argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at, pa.int32()), *batch.columns], ["list", *batch.schema.names]
                )

    return run


def _blocks(lists: Lists, columns: int) -> Callable:
    """Rows of one list and block, in order, as one row with the block's column blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def give() -> pa.RecordBatch:
            ids = [i for part, _ in held for i in part]
            vectors = np.concatenate([v for _, v in held])
            rotated = (vectors @ lists.rotation).astype(np.float32)
            parts = [
                np.ascontiguousarray(rotated[:, c : c + columns]).tobytes()
                for c in range(0, rotated.shape[1], columns)
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()),
                 pa.array([ids], pa.list_(pa.list_(pa.int64()))),
                 pa.array([parts], pa.list_(pa.binary())), pa.array([vectors.tobytes()], pa.binary())],
                ["list", "block", "ids", "parts", "vectors"],
            )

        for batch in batches:
            keys = list(zip(batch.column("list").to_pylist(), batch.column("block").to_pylist(), strict=True))
            vectors, ids = _vectors(batch, "vector"), batch.column("ids").to_pylist()
            start = 0
            for at in range(1, len(keys) + 1):
                if at == len(keys) or keys[at] != keys[start]:
                    if held and keys[start] != key:
                        yield give()
                        held = []
                    key = keys[start]
                    held.append((ids[start:at], vectors[start:at]))
                    start = at
        if held:
            yield give()

    return run


_INDEX = "list int, block int, ids array<array<long>>, parts array<binary>, vectors binary"


def build_index(groups: DataFrame, lists: Lists, block: int = BLOCK) -> DataFrame:
    """A row per block from (ids, vector). A block holds about `block` vectors; a longer list has more blocks."""
    kinds = "list int, ids array<long>, vector array<double>"
    rows = stored(groups.select("ids", "vector").mapInArrow(_assigned(lists), kinds), "assigned")
    sizes = rows.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    number = F.pmod(F.xxhash64(F.get("ids", F.lit(0))), F.col("blocks")).cast("int")
    cut_up = rows.join(F.broadcast(sizes), "list").select("list", number.alias("block"), "ids", "vector")
    ordered = cut_up.repartition("list", "block").sortWithinPartitions("list", "block", F.get("ids", F.lit(0)))
    return stored(ordered.mapInArrow(_blocks(lists, COLUMNS), _INDEX), "vector-index")


def _routed(lists: Lists, k: int, chunk: int) -> Callable:
    """For each list the queries of a batch that probe it, in chunks: their names, vectors and bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, chunk):
                names = batch.column("search").to_numpy()
                vectors = _vectors(batch, "vector")
                to_sample = squared(vectors, lists.sample)
                bounds = np.full(len(names), np.inf)
                if to_sample.shape[1] >= SPARE * k:
                    # A hair above, as the exact distance may round otherwise.
                    at = SPARE * k - 1
                    bounds = np.partition(to_sample, at, axis=1)[:, at] * (1 + 1e-9) + 1e-9
                order = np.argsort(squared(vectors, lists.centers), axis=1, kind="stable")
                probed = np.zeros((len(names), len(lists.centers)), dtype=bool)
                np.put_along_axis(probed, order[:, : lists.probes], True, axis=1)
                for number in np.flatnonzero(probed.any(axis=0)):
                    who = np.flatnonzero(probed[:, number])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number], pa.int32()), pa.array([names[who].tolist()], pa.list_(pa.int64())),
                         pa.array([vectors[who].tobytes()], pa.binary()),
                         pa.array([bounds[who].tolist()], pa.list_(pa.float64()))],
                        ["list", "searches", "queries", "bounds"],
                    )

    return run


def scan(
    queries: np.ndarray, bounds: np.ndarray, parts: list[np.ndarray], rotation: np.ndarray, width: float = WIDTH
) -> tuple[np.ndarray, np.ndarray]:
    """(query, candidate) places that pass all tests.

    With d of D rotated dimensions seen, d/D of the distance is expected, and the estimate strays by about 1/sqrt(d) of it. A candidate goes
    when its partial distance is above bound * d/D * (1 + width/sqrt(d))**2.
    """
    rotated = (queries @ rotation).astype(np.float32)
    total, seen = rotated.shape[1], 0
    q = c = None
    partial = None
    for part in parts:
        step = part.shape[1]
        own = rotated[:, seen : seen + step]
        if q is None:
            partial = squared(own.astype(np.float64), part.astype(np.float64))
        else:
            partial = partial + ((own[q] - part[c]).astype(np.float64) ** 2).sum(axis=1)
        seen += step
        slack = (1 + width / math.sqrt(seen)) ** 2 if seen < total else 1 + 1e-5
        limit = bounds * (seen / total) * slack + 1e-6
        if q is None:
            q, c = np.nonzero(partial <= limit[:, None])
            partial = partial[q, c]
        else:
            stays = partial <= limit[q]
            q, c, partial = q[stays], c[stays], partial[stays]
    return q, c


_FOUND = "search long, vec_id long, score double"


def _scanned(lists: Lists, k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = lists.rotation.shape[0]
        for whole in batches:
            for batch in sliced(whole, 1):
                row = {name: batch.column(name)[0].as_py() for name in batch.schema.names}
                vectors = np.frombuffer(row["vectors"]).reshape(-1, size)
                parts = [np.frombuffer(p, np.float32).reshape(len(vectors), -1) for p in row["parts"]]
                queries = np.frombuffer(row["queries"]).reshape(-1, size)
                q, c = scan(queries, np.array(row["bounds"]), parts, lists.rotation)
                scores = np.sqrt(((queries[q] - vectors[c]) ** 2).sum(axis=1))
                found = sorted(
                    (int(a), float(s), i)
                    for a, b, s in zip(q, c, scores, strict=True)
                    for i in row["ids"][b]
                )
                out, count = [], {}
                for a, s, i in found:
                    count[a] = count.get(a, 0) + 1
                    if count[a] <= k:
                        out.append((row["searches"][a], i, s))
                if out:
                    columns = zip(*out, strict=True)
                    kinds = (pa.int64(), pa.int64(), pa.float64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(columns, kinds, strict=True)],
                        ["search", "vec_id", "score"],
                    )

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of rows with an id and a finite vector other than zero, of any length."""
    values = F.col("embedding").cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), values.alias("vector"), bad.alias("bad"))
    rows = rows.filter("vec_id IS NOT NULL AND vector IS NOT NULL AND NOT bad AND size(vector) > 0")
    return rows.filter(F.exists("vector", lambda x: x != 0)).select("vec_id", "vector")


def _search(searches: DataFrame, index: DataFrame, lists: Lists, k: int) -> DataFrame:
    """(search, near, score): the `k` nearest found of each of (search, vector)."""
    kinds = "list int, searches array<long>, queries binary, bounds array<double>"
    routed = searches.mapInArrow(_routed(lists, k, CHUNK), kinds)
    blocks = index.groupBy("list").agg(F.max("block").alias("last"))
    routed = routed.join(F.broadcast(blocks), "list")
    routed = routed.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("last")))).drop("last")
    met = index.join(routed, ["list", "block"])
    found = met.select("ids", "parts", "vectors", "searches", "queries", "bounds")
    found = found.mapInArrow(_scanned(lists, k), _FOUND)
    best = top_k(found.distinct(), "search", [F.col("score"), F.col("vec_id")], k, "place")
    return best.select("search", F.col("vec_id").alias("near"), "score")


_NEAREST = "query_id long, rank int, vec_id long, score double"


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, probed: float = PROBED) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose vec_id is divisible by `every`, the `k` nearest found of all other rows.

    Vectors of one length are searched among themselves, each length in turn: there is no distance between different lengths. A vec_id that has vectors of several
    lengths, or several of one, is asked with each, and its nearest rows of all are ranked together; each of them counts once, by its nearest vector. Equal vectors are one entry with
    their k + 1 smallest ids, which are all that any answer can need, and equal queries are one search. Repeated rows count once. Without usable vectors there are no rows.
    """
    rows = stored(usable(vectors), "vectors")
    lengths = sorted(r[0] for r in rows.select(F.size("vector")).distinct().collect())
    found = [_nearest_of(rows.filter(F.size("vector") == n), every, k, probed) for n in lengths]
    if not found:
        return rows.sparkSession.createDataFrame([], _NEAREST)
    if len(found) == 1:
        return found[0]
    pairs = reduce(DataFrame.unionByName, found).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return _ranked(pairs, k)


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    ranked = top_k(pairs, "query_id", [F.col("score"), F.col("vec_id")], k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _nearest_of(rows: DataFrame, every: int, k: int, probed: float) -> DataFrame:
    """`nearest` over (vec_id, vector) of one length, at least one row."""
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("place", F.dense_rank().over(smallest)).filter(F.col("place") <= k + 1)
    groups = few.groupBy("vector").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
    groups = stored(groups.select("ids", "vector"), "entries")
    total = groups.count()
    chosen = sampled(groups, [F.col("ids")], SAMPLE, total).select("vector").toPandas()
    sample = np.array(chosen["vector"].tolist(), dtype=np.float64)
    if not len(sample):
        sample = np.array([groups.first()["vector"]], dtype=np.float64)
    sample = sample[np.lexsort(sample.T[::-1])]
    lists = fit(sample, total, probed)
    index = build_index(groups, lists)

    asking = stored(rows.filter(F.col("vec_id") % every == 0).distinct(), "queries")
    searches = asking.groupBy("vector").agg(F.min("vec_id").alias("search"))
    searches = stored(searches.select("search", "vector"), "searches")
    best = cut(_search(searches, index, lists, k + 1))
    wanted = min(k + 1, rows.select("vec_id").distinct().count())
    enough = best.groupBy("search").count().filter(F.col("count") >= wanted).select("search")
    short = cut(searches.join(enough, "search", "left_anti"))
    if not short.isEmpty():
        everywhere = replace(lists, probes=len(lists.centers), sample=lists.sample[:0])
        again = _search(short, index, everywhere, k + 1)
        best = cut(best.join(short, "search", "left_anti").unionByName(again))
    named = lookup(asking, searches, "vector").select("vec_id", "search")
    pairs = lookup(cut(named), best, "search").filter("vec_id <> near")
    pairs = pairs.select(F.col("vec_id").alias("query_id"), F.col("near").alias("vec_id"), "score")
    return _ranked(pairs, k)
