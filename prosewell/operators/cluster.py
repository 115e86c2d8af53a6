"""BIRCH summaries and spherical k-means over `array<double>` vectors.

A cluster feature (CF) is (n, ls, ss): the number of points, their sum, and the sum of their
squared lengths. CFs add, so a corpus of any size is first condensed to a bounded number of CFs
and the iterative part runs on those.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosewell.functions import vectors as V
from prosewell.operators import terms
from prosewell.operators.joins import names, top_k
from prosewell.sources.store import cut

CF_SCHEMA = "part int, cf_id int, n bigint, ls array<double>, ss double, threshold double"
MAX_CENTERS = 20_000
# Centers that a batch of points meets at once, and points that are absorbed at once.
CENTER_BLOCK = 512
CHUNK = 256
# Points that meet the centers in one product; as many times the centers of a block are held.
ASSIGNED = 1_000
# Entries of a tree node.
BRANCHING = 16
# Groups of points that are summarized apart: so many at least, and one for every so many points. They come from the key, so results do not depend on the number of cores.
GROUPS = 64
GROUP_POINTS = 1 << 16


def unit_vectors(
    df: DataFrame, key: str | Sequence[str], vector: str = "vector"
) -> tuple[DataFrame, DataFrame]:
    """(key, vector) of length 1, and a table of the keys whose vector has no direction."""
    sized = df.select(*names(key), F.col(vector).cast("array<double>").alias("vector"))
    sized = sized.withColumn("_norm", V.norm("vector"))
    good = sized.filter("_norm > 0").select(
        *names(key), V.scaled("vector", F.col("_norm")).alias("vector")
    )
    rejects = sized.filter("_norm is null or not _norm > 0").select(*names(key))
    return good, rejects


def vector_sum(vector: Column | str) -> Column:
    """Element-wise sum of a group's vectors, combined map-side."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    return vector_to_array(Summarizer.sum(array_to_vector(vector)))


def point_features(df: DataFrame, by: str | Sequence[str], vector: str = "vector") -> DataFrame:
    """(by, n, ls, ss) of groups of points."""
    return df.groupBy(*names(by)).agg(
        F.count(F.lit(1)).alias("n"),
        vector_sum(vector).alias("ls"),
        F.sum(V.dot(vector, vector)).alias("ss"),
    )


def merge_features(cf: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """(key, n, ls, ss): CFs of one key added up."""
    return cf.groupBy(*names(key)).agg(
        F.sum("n").alias("n"), vector_sum("ls").alias("ls"), F.sum("ss").alias("ss")
    )


def cf_stats(cf: DataFrame) -> DataFrame:
    """Adds centroid, direction (null without length) and radius."""
    centroid = F.transform("ls", lambda x: x / F.col("n"))
    with_centroid = cf.withColumn("centroid", centroid)
    spread = F.col("ss") / F.col("n") - V.dot("centroid", "centroid")
    return with_centroid.withColumn("direction", V.unit("ls")).withColumn(
        "radius", F.sqrt(F.greatest(F.lit(0.0), spread))
    )


class Node:
    """Up to `branching` CFs and their directions; in an inner node each CF is the sum of a child's."""

    __slots__ = ("n", "ls", "ss", "direction", "size", "children")

    def __init__(self, branching: int, width: int, leaf: bool):
        room = branching + 1
        self.n, self.ss = np.zeros(room), np.zeros(room)
        self.ls, self.direction = np.zeros((room, width)), np.zeros((room, width))
        self.size = 0
        self.children: list[Node] | None = None if leaf else []

    def put(self, i: int, n: float, ls: np.ndarray, ss: float) -> None:
        length = float(np.sqrt(ls @ ls))
        self.n[i], self.ls[i], self.ss[i] = n, ls, ss
        self.direction[i] = ls / length if length > 0 else 0.0

    def append(self, n: float, ls: np.ndarray, ss: float, child: Node | None = None) -> None:
        self.put(self.size, n, ls, ss)
        self.size += 1
        if child is not None:
            self.children.append(child)

    def total(self) -> tuple[float, np.ndarray, float]:
        m = self.size
        return float(self.n[:m].sum()), self.ls[:m].sum(axis=0), float(self.ss[:m].sum())


class CFTree:
    """A height-balanced tree of CFs that absorbs points and CFs, and is built anew with a wider threshold when it has too many leaf entries.

    A point goes down to the entry of nearest direction, `branching` comparisons a level, and joins it if the radius stays within the threshold; else it is an
    entry of its own. A node above `branching` entries is split by its two entries of least like direction. By distance to the mean, a wide entry near the
    origin would draw everything to itself, so nearness is by direction.
    """

    def __init__(self, threshold: float, max_entries: int, branching: int = BRANCHING):
        self.threshold = threshold
        self.max_entries = max(1, max_entries)
        self.branching = max(2, branching)
        self.entries = 0
        self.compared = 0
        self.root: Node | None = None

    def _fits(self, n: float, ls: np.ndarray, ss: float) -> bool:
        return ss / n - float(ls @ ls) / n**2 <= self.threshold**2

    def _insert(self, node: Node, n: float, ls: np.ndarray, ss: float) -> tuple[Node, Node] | None:
        """Add a CF below `node`; the two nodes that take its place if it had to be split."""
        m = node.size
        near = int(np.argmax(node.direction[:m] @ ls)) if m else -1
        self.compared += m
        if node.children is None:
            if m:
                merged = node.n[near] + n, node.ls[near] + ls, node.ss[near] + ss
                if self._fits(*merged):
                    node.put(near, *merged)
                    return None
            node.append(n, ls, ss)
            self.entries += 1
        else:
            halves = self._insert(node.children[near], n, ls, ss)
            if halves is None:
                node.put(near, node.n[near] + n, node.ls[near] + ls, node.ss[near] + ss)
                return None
            node.children[near] = halves[0]
            node.put(near, *halves[0].total())
            node.append(*halves[1].total(), halves[1])
        return self._split(node) if node.size > self.branching else None

    def _split(self, node: Node) -> tuple[Node, Node]:
        m = node.size
        alike = node.direction[:m] @ node.direction[:m].T
        a, b = divmod(int(np.argmin(alike)), m)
        if a == b:
            a, b = 0, m - 1
        to_b = alike[:, b] > alike[:, a]
        to_b[a], to_b[b] = False, True
        halves = tuple(Node(self.branching, node.ls.shape[1], node.children is None) for _ in range(2))
        for i in range(m):
            child = node.children[i] if node.children is not None else None
            halves[int(to_b[i])].append(node.n[i], node.ls[i], node.ss[i], child)
        return halves

    def add(self, n: float, ls: np.ndarray, ss: float) -> None:
        if self.root is None:
            self.root = Node(self.branching, len(ls), True)
        halves = self._insert(self.root, n, ls, ss)
        if halves is not None:
            self.root = Node(self.branching, len(ls), False)
            for half in halves:
                self.root.append(*half.total(), half)
        while self.entries > self.max_entries:
            self._rebuild()

    def absorb(self, x: np.ndarray) -> None:
        """Add points. They go down together; those of an entry that stays within the threshold with all of them join by grouped sums, the rest one by one."""
        rest = self._absorb(self.root, x) if self.root is not None else x
        for row in rest:
            self.add(1.0, row, float(row @ row))

    def _absorb(self, node: Node, x: np.ndarray) -> np.ndarray:
        """The points that found no place."""
        m = node.size
        near = np.argmax(x @ node.direction[:m].T, axis=1)
        self.compared += m * len(x)
        if node.children is not None:
            rest = []
            for i in np.unique(near):
                mine = x[near == i]
                left = self._absorb(node.children[i], mine)
                if len(left) < len(mine):
                    node.put(i, *node.children[i].total())
                rest.append(left)
            return np.concatenate(rest)
        n, ss, ls = node.n[:m].copy(), node.ss[:m].copy(), node.ls[:m].copy()
        np.add.at(n, near, 1)
        np.add.at(ls, near, x)
        np.add.at(ss, near, np.einsum("ij,ij->i", x, x))
        fits = ss / n - np.einsum("ij,ij->i", ls, ls) / n**2 <= self.threshold**2
        for i in np.unique(near[fits[near]]):
            node.put(i, n[i], ls[i], ss[i])
        return x[~fits[near]]

    def leaves(self) -> Iterator[Node]:
        """The leaves, from left to right."""
        waiting = [self.root] if self.root is not None else []
        while waiting:
            node = waiting.pop()
            if node.children is None:
                yield node
            else:
                waiting += reversed(node.children)

    def height(self) -> int:
        node, levels = self.root, 0
        while node is not None:
            levels, node = levels + 1, node.children[0] if node.children else None
        return levels

    def _rebuild(self) -> None:
        """Raise the threshold until a quarter of the entries could merge with the nearest one of their leaf, and insert them anew."""
        radii, old = [], []
        for leaf in self.leaves():
            m = leaf.size
            old += [(leaf.n[i], leaf.ls[i].copy(), leaf.ss[i]) for i in range(m)]
            if m > 1:
                alike = leaf.direction[:m] @ leaf.direction[:m].T
                np.fill_diagonal(alike, -np.inf)
                near = np.argmax(alike, axis=1)
                total = leaf.n[:m] + leaf.n[near]
                mean = (leaf.ls[:m] + leaf.ls[near]) / total[:, None]
                radii.append((leaf.ss[:m] + leaf.ss[near]) / total - np.einsum("ij,ij->i", mean, mean))
        wanted = float(np.sqrt(max(np.quantile(np.concatenate(radii), 0.25), 0.0))) if radii else 0.0
        # Where no two entries share a leaf, and where that is not enough, the threshold grows all the same.
        self.threshold = max(wanted, self.threshold * (1.01 if radii else 1.5), 1e-9)
        self.root, self.entries = None, 0
        for n, ls, ss in old:
            self.add(float(n), ls, float(ss))

    def rows(self, part: int) -> pd.DataFrame:
        found = [(leaf.n[i], leaf.ls[i].copy(), leaf.ss[i]) for leaf in self.leaves() for i in range(leaf.size)]
        m = len(found)
        return pd.DataFrame(
            {
                "part": np.full(m, part, dtype="int32"),
                "cf_id": np.arange(m, dtype="int32"),
                "n": np.array([f[0] for f in found]).astype("int64"),
                "ls": [f[1] for f in found],
                "ss": np.array([f[2] for f in found], dtype="float64"),
                "threshold": np.full(m, self.threshold),
            }
        )


def _by_part(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, pd.DataFrame]]:
    """Rows sorted by part in chunks of `CHUNK` rows of one part, whatever the batches are cut like."""
    held = None
    for batch in batches:
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        while len(held):
            same = int((held["part"] == held["part"].iloc[0]).sum())
            if same < CHUNK and same == len(held):
                break
            take = min(same, CHUNK)
            yield int(held["part"].iloc[0]), held.iloc[:take]
            held = held.iloc[take:].reset_index(drop=True)
    if held is not None and len(held):
        yield int(held["part"].iloc[0]), held


def _summarized(threshold: float, max_entries: int, points: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, found = None, None
        for number, chunk in _by_part(batches):
            if number != part:
                if found is not None:
                    yield found.rows(part)
                part, found = number, CFTree(threshold, max_entries)
            if points:
                found.absorb(np.stack([np.asarray(v, dtype="float64") for v in chunk["vector"]]))
                continue
            for n, ls, ss, t in zip(chunk["n"], chunk["ls"], chunk["ss"], chunk["threshold"]):
                found.threshold = max(found.threshold, float(t))
                found.add(float(n), np.asarray(ls, dtype="float64"), float(ss))
        if found is not None:
            yield found.rows(part)

    return run


def _usable(vector: Column) -> Column:
    """Not null, with elements, all of them finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def _points(df: DataFrame, keep: Sequence[Column], vector: str) -> DataFrame:
    """`keep` and `vector array<double>` of the rows whose vector is usable and of the commonest length: vectors of unlike lengths have no sum."""
    values = F.col(vector).cast("array<double>")
    rows = df.select(*keep, values.alias("vector")).filter(_usable(F.col("vector")))
    widths = rows.groupBy(F.size("vector").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).limit(2).collect()
    return rows.filter(F.size("vector") == widths[0]["w"]) if len(widths) > 1 else rows


def cluster_features(
    df: DataFrame,
    threshold: float,
    max_entries: int = 256,
    key: str | Sequence[str] = "doc_id",
    vector: str = "vector",
    groups: int | None = None,
) -> DataFrame:
    """One pass over the points, a CF tree for each group of them by a hash of the key. Memory is bounded by `max_entries` vectors.

    Within a group points are taken in key order and in chunks of a fixed size, so the CFs are the same on any number of
    cores. Without `groups` there is one for every `GROUP_POINTS` points, and `GROUPS` at least. Vectors that are null, empty or not finite, or not of the commonest
    length, are left out. An empty table gives an empty one.
    """
    points = _points(df, [F.col(f"`{c}`") for c in names(key)], vector)
    groups = groups or max(GROUPS, -(-points.count() // GROUP_POINTS))
    part = F.pmod(F.xxhash64(*names(key)), F.lit(groups)).cast("int")
    ordered = points.withColumn("part", part).repartition(groups, "part").sortWithinPartitions("part", *names(key), "vector")
    return ordered.select("part", "vector").mapInPandas(_summarized(threshold, max_entries, True), CF_SCHEMA)


def condense(
    cf: DataFrame, threshold: float, max_entries: int = 256, partitions: int | None = None, fan_in: int = 8
) -> DataFrame:
    """Merge CF tables level by level, `fan_in` groups into one, until one is left.

    A group sees at most `fan_in` × `max_entries` CFs, whatever the size of the corpus, and a task holds one group at a time.
    """
    out = cf
    if partitions is None:
        out = cut(cf)
        partitions = (out.agg(F.max("part")).first()[0] or 0) + 1
    left = max(1, partitions)
    while True:
        left = max(1, -(-left // fan_in))
        moved = out.withColumn("_from", F.col("part")).withColumn("part", F.pmod("part", F.lit(left)))
        grouped = moved.repartition("part").sortWithinPartitions("part", "_from", "cf_id").drop("_from")
        out = cut(grouped.mapInPandas(_summarized(threshold, max_entries, False), CF_SCHEMA))
        if left == 1:
            return out


def _cosine_centers(points: DataFrame, k: int, seed: int, max_iter: int) -> DataFrame:
    """(k, center) of (vector, w); without a vector of some length there are none."""
    points = points.filter("w > 0").select(array_to_vector(V.scaled("vector", V.norm("vector"))).alias("features"), "w")
    if points.isEmpty():
        return points.sparkSession.createDataFrame([], "k int, center array<double>")
    if k == 1:
        # The solver asks for two clusters at least. The best single center is the direction of the weighted sum.
        weighted = points.select(F.transform(vector_to_array("features"), lambda x: x * F.col("w")).alias("v"))
        return _center_table(points, [np.array(weighted.agg(vector_sum("v")).first()[0])])
    model = KMeans(k=k, seed=seed, maxIter=max_iter, distanceMeasure="cosine", weightCol="w").fit(points)
    return _center_table(points, model.clusterCenters())


def spherical_kmeans_cf(cf: DataFrame, k: int, seed: int = 7, max_iter: int = 20) -> DataFrame:
    """(k, center) from CFs: a point ls/‖ls‖ of weight ‖ls‖ keeps Σ x·c of the CF exactly. No CFs, no centers."""
    return _cosine_centers(cf.select(F.col("ls").alias("vector"), V.norm("ls").alias("w")), k, seed, max_iter)


def _center_table(df: DataFrame, centers: Sequence[np.ndarray]) -> DataFrame:
    units = [np.asarray(c, dtype="float64") for c in centers]
    rows = [(i, (c / np.linalg.norm(c)).tolist()) for i, c in enumerate(units) if np.linalg.norm(c) > 0]
    return df.sparkSession.createDataFrame(rows, "k int, center array<double>")


def _center_matrix(centers: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The centers as one matrix. k × width values, the size every k-means holds on the driver."""
    found = centers.select("k", "center").orderBy("k").limit(MAX_CENTERS + 1).collect()
    if len(found) > MAX_CENTERS:
        raise ValueError(f"at most {MAX_CENTERS} centers can be met at once")
    return np.array([r["k"] for r in found]), np.array([r["center"] for r in found], dtype="float64")


def assign(df: DataFrame, centers: DataFrame, vector: str = "vector") -> DataFrame:
    """Adds `k` and `sim`: the center of largest cosine, ties to the lowest k.

    One matrix product per Arrow batch and block of centers. Points are not joined with centers, so nothing is
    multiplied by k and nothing is shuffled. A vector without length gets a null, as does one that is null, not finite or not as long as the
    centers, and every one if there are no centers.
    """
    ids, matrix = _center_matrix(centers)
    if not len(ids):
        return df.withColumns({"k": F.lit(None).cast("int"), "sim": F.lit(None).cast("double")})
    matrix = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)

    @F.pandas_udf("k int, sim double")
    def nearest(batch: pd.Series) -> pd.DataFrame:
        parts = [nearest_of(batch.iloc[i : i + ASSIGNED]) for i in range(0, len(batch), ASSIGNED)]
        if not parts:
            return pd.DataFrame({"k": pd.Series(dtype="int32"), "sim": pd.Series(dtype="float64")})
        return pd.concat(parts, ignore_index=True)

    def nearest_of(batch: pd.Series) -> pd.DataFrame:
        width = matrix.shape[1]
        x = np.stack([np.zeros(width) if v is None or len(v) != width else np.asarray(v, dtype="float64") for v in batch])
        x[~np.isfinite(x).all(axis=1)] = 0.0
        length = np.linalg.norm(x, axis=1)
        best, top = np.zeros(len(x), dtype=np.int64), np.full(len(x), -np.inf)
        for start in range(0, len(matrix), CENTER_BLOCK):
            sims = x @ matrix[start : start + CENTER_BLOCK].T
            here = sims.argmax(axis=1)
            value = sims[np.arange(len(x)), here]
            better = value > top
            best[better], top[better] = here[better] + start, value[better]
        with np.errstate(divide="ignore", invalid="ignore"):
            sim = np.where(length > 0, top / length, np.nan)
        chosen = pd.Series(ids[best].astype("int32"))
        return pd.DataFrame({"k": chosen, "sim": pd.Series(sim)})

    # Marked so that a filter on the result is not turned into a second evaluation.
    once = nearest.asNondeterministic()
    found = df.withColumn("_n", once(F.col(vector).cast("array<double>")))
    known = F.col("_n.sim").isNotNull() & ~F.isnan("_n.sim")
    return (
        found.withColumn("k", F.when(known, F.col("_n.k")))
        .withColumn("sim", F.when(known, F.col("_n.sim")))
        .drop("_n")
    )


def recenter(assigned: DataFrame, centers: DataFrame, vector: str = "vector") -> DataFrame:
    """(k, center): the direction of each cluster's sum; a cluster without points keeps its center."""
    sums = assigned.filter("k is not null").groupBy("k").agg(vector_sum(vector).alias("s"))
    moved = sums.select("k", V.unit("s").alias("moved"))
    return centers.select("k", "center").join(moved, "k", "left").select(
        "k", F.coalesce("moved", "center").alias("center")
    )


def spherical_kmeans(
    df: DataFrame, k: int, seed: int = 7, max_iter: int = 20, vector: str = "vector"
) -> DataFrame:
    """(k, center) from all points: the full-data form to compare with the CF form. Vectors without a direction take no part."""
    points = _points(df, [], vector)
    return _cosine_centers(points.withColumn("w", F.when(V.norm("vector") > 0, 1.0).otherwise(0.0)), k, seed, max_iter)


def birch(
    df: DataFrame,
    k: int,
    threshold: float = 0.5,
    max_entries: int = 256,
    seed: int = 7,
    key: str | Sequence[str] = "doc_id",
    vector: str = "vector",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(assigned, centers, cf): summarize, condense, cluster the summary, assign every point."""
    first = cut(cluster_features(df, threshold, max_entries, key, vector))
    cf = condense(first, threshold, max_entries)
    centers = spherical_kmeans_cf(cf, k, seed)
    return assign(df, centers, vector), centers, cf


def cluster_terms(
    docs: DataFrame, assigned: DataFrame, k: int, col: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(k, token, score, rank): the k terms of highest TF-IDF weight in each cluster.

    Documents learn their cluster before their terms are counted, so the join moves documents. Document frequencies are those of all
    documents, with or without a cluster.
    """
    placed = docs.select(key, col).join(assigned.select(key, "k"), key, "left")
    weights = terms.group_tf_idf(terms.term_counts(placed, col, [key, "k"]), "k", docs.count())
    return terms.top_terms(weights.filter("k is not null"), "k", k)


def contingency(assigned: DataFrame, label: str = "label") -> DataFrame:
    """(k, label, n): documents per cluster and true group."""
    return assigned.groupBy("k", F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def contingency_pivot(assigned: DataFrame, values: Sequence, label: str = "label") -> DataFrame:
    """(k, one column per value, other): `other` counts points of any other label or none."""
    listed = F.coalesce(F.col(label).isin(list(values)), F.lit(False))
    return assigned.groupBy("k").agg(
        *[F.count_if(F.col(label) == v).alias(str(v)) for v in values],
        F.count_if(~listed).alias("other"),
    )


def cluster_quality(cells: DataFrame) -> DataFrame:
    """One row from (k, label, n): purity, normalized mutual information, adjusted Rand index."""
    x = F.col("n").cast("double")
    rows = cells.groupBy("k").agg(F.sum(x).alias("row"), F.max(x).alias("top"))
    columns = cells.groupBy("label").agg(F.sum(x).alias("col"))
    n = cells.agg(F.sum(x).alias("n")).scalar()

    def pairs(v: Column) -> Column:
        return v * (v - 1) / 2

    def entropy(v: Column) -> Column:
        return -F.sum(v / n * F.log(v / n))

    of_rows = rows.agg(
        entropy(F.col("row")).alias("h_k"),
        F.sum(pairs(F.col("row"))).alias("p_k"),
        (F.sum("top") / F.max(n)).alias("purity"),
    )
    of_columns = columns.agg(
        entropy(F.col("col")).alias("h_l"), F.sum(pairs(F.col("col"))).alias("p_l")
    )
    joined = cells.join(rows, "k").join(columns, "label")
    of_cells = joined.agg(
        F.sum(x / n * F.log(n * x / (F.col("row") * F.col("col")))).alias("mi"),
        F.sum(pairs(x)).alias("p_kl"),
    )
    r = of_rows.select(F.struct("*").alias("s")).scalar()
    c = of_columns.select(F.struct("*").alias("s")).scalar()
    expected = r["p_k"] * c["p_l"] / pairs(n)
    ceiling = (r["p_k"] + c["p_l"]) / 2
    return of_cells.select(
        r["purity"].alias("purity"),
        F.coalesce(F.try_divide(F.col("mi"), (r["h_k"] + c["h_l"]) / 2), F.lit(1.0)).alias("nmi"),
        F.coalesce(F.try_divide(F.col("p_kl") - expected, ceiling - expected), F.lit(1.0)).alias("ari"),
    )


def cohesion(assigned: DataFrame) -> DataFrame:
    """(k, n, cohesion): mean similarity to the own center, and overall as k = -1."""
    out = assigned.filter("k is not null").rollup("k").agg(
        F.count(F.lit(1)).alias("n"), F.avg("sim").alias("cohesion")
    )
    return out.withColumn("k", F.coalesce("k", F.lit(-1)))


def silhouette(assigned: DataFrame, vector: str = "vector") -> float:
    points = assigned.select(array_to_vector(vector).alias("features"), F.col("k").alias("prediction"))
    return ClusteringEvaluator(distanceMeasure="cosine").evaluate(points)


def choose_k(cf: DataFrame, ks: Sequence[int], seed: int = 7) -> DataFrame:
    """(k, cohesion) for several k, measured on the CF table alone: Σ ls·c / Σ n is exact for it."""
    rows = []
    for k in ks:
        centers = spherical_kmeans_cf(cf, k, seed)
        found = assign(cf, centers, "ls")
        total = found.agg(F.sum(F.col("sim") * V.norm("ls")) / F.sum("n")).first()[0]
        rows.append((int(k), float(total)))
    return cf.sparkSession.createDataFrame(rows, "k int, cohesion double")


def outliers(cf: DataFrame, min_n: int) -> DataFrame:
    """CFs of fewer than `min_n` points."""
    return cf.filter(F.col("n") < min_n)


def far_documents(assigned: DataFrame, n: int, key: str = "doc_id") -> DataFrame:
    """(k, key, sim, rank): the n points least like the center of their cluster."""
    ranked = assigned.filter("k is not null").withColumn("_sim", F.round("sim", 9))
    return top_k(ranked, "k", [F.asc("_sim"), F.asc(key)], n).select("k", key, "sim", "rank")
