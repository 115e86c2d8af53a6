"""Exact set-similarity join: every pair of sets whose Jaccard index reaches a threshold, without comparing all pairs.

All elements have one order. Two sets of Jaccard index t or more share an element among the first n - ceil(t·n) + 1 of each, so only these are indexed. Index entries of one element meet
if their lengths allow the threshold and both sets have enough elements from there on, as they must where they first meet; a pair whose entries just before meet too has met there. Each
pair is then verified once. Any order is right; which one decides how many entries meet.

Documents: the order is that of the elements' hashes, but elements in the prefixes of several sets come last, rarest first. So a fifth of the elements moves (t = 0.8), twice, in
arrays that numpy sorts. Shingle sets are not stored; they are made again where they are needed.
Given sets: the order is by how many sets hold an element, rarest first. Elements of one set alone take up places of the prefix and need no index row. Elements move once, to be counted, as
(element, set, size) with the element cut to as many bits as tell all elements apart but for a few thousandths. Elements that fall together count as one and only cost a candidate.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prosewell.operators.joins import lookup, sliced_join
from prosewell.sources.store import cut

# Slack for products of a threshold and a count: a bound may only err to the safe side.
EPS = 1e-9
# Bits by which an element is told apart beyond those that number all elements.
SPARE_BITS = 12
WORD_BLOCK = 1 << 16
# Elements of sets that are held while others are compared with them, and pairs that are compared by one task.
SLICE_ELEMENTS = 1 << 20
SLICE_PAIRS = 1 << 22
# Elements that a task gathers before it hands them on, and that a partition of them is meant to hold.
HELD_ELEMENTS = 1 << 20
# Elements in the prefixes of so many sets come last in the order, the most frequent ones if there are more than a task may hold.
SEVERAL = 4
MOST_FREQUENT = 1 << 21
BATCH_ROWS = 200
# Odd factors for rolling a hash along letters and along words, and the two steps that spread its bits.
BASE = np.uint64(0xD6E8FEB86659FD93)
FACTOR = np.uint64(0x9E3779B97F4A7C15)
SPREAD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
# For words of 0 to 16 letters: which of 16 bytes are theirs.
OWN_LETTERS = np.where(np.arange(16) < np.arange(17)[:, None], 255, 0).astype(np.uint8)
_NOT_LETTERS = bytes(b if 97 <= b <= 122 else 32 for b in range(256))


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * SPREAD[0]
    x = (x ^ (x >> np.uint64(27))) * SPREAD[1]
    return x ^ (x >> np.uint64(31))


def _word_codes(letters: np.ndarray, starts: np.ndarray, ends: np.ndarray, known: dict[str, np.ndarray]) -> np.ndarray:
    """A 64-bit code of each word, letters[start:end], from its first 16 letters as two numbers and a polynomial of the others; `WORD_BLOCK` words at a time."""
    sizes = ends - starts
    padded = np.concatenate([letters, np.zeros(16, dtype=np.uint8)])
    # The 16 bytes from each place on, as one value.
    ahead = np.ndarray((len(letters) + 1,), dtype="V16", buffer=padded, strides=(1,))
    own = OWN_LETTERS.view("<u8")
    out = np.empty(len(starts), dtype=np.uint64)
    for first in range(0, len(starts), WORD_BLOCK):
        block = slice(first, first + WORD_BLOCK)
        numbers = ahead[starts[block]].view("<u8").reshape(-1, 2)
        numbers &= own[np.minimum(sizes[block], 16)]
        out[block] = _spread(_spread(numbers[:, 0]) * FACTOR + numbers[:, 1])
    long = np.flatnonzero(sizes > 16)
    longest = int(sizes.max(initial=0))
    powers = known.get("powers")
    if powers is None or len(powers) < longest:
        powers = known["powers"] = np.cumprod(np.full(longest, BASE, dtype=np.uint64), dtype=np.uint64)
    for first in range(0, len(long), WORD_BLOCK):
        block = long[first : first + WORD_BLOCK]
        size = sizes[block] - 16
        before = np.cumsum(size) - size
        inside = np.arange(size.sum()) - np.repeat(before, size)
        values = letters[inside + np.repeat(starts[block] + 16, size)].astype(np.uint64) * powers[inside]
        out[block] = _spread(out[block] + np.add.reduceat(values, before))
    return out


def _rolled(codes: np.ndarray, size: int) -> np.ndarray:
    """The hashes of all stretches of `size` words."""
    out = np.zeros(max(len(codes) - size + 1, 0), dtype=np.uint64)
    for i in range(size):
        out = out * FACTOR + codes[i : i + len(out)]
    # The number of words is part of a shingle, so that a short text is no part of a longer one.
    return _spread(out + np.uint64(size))


def shingle_hashes(texts: Sequence[str | None], n: int, known: dict[str, np.ndarray]) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's shingles of n words (a to z, lower-cased); a shorter text is one shingle, one without a word none.

    The words of all texts are hashed at once. `known` remembers the powers of the base between calls.
    """
    lowered = [(text or "").lower().encode("utf-8", "surrogatepass") for text in texts]
    letters = np.frombuffer(b" ".join([*lowered, b""]).translate(_NOT_LETTERS), dtype=np.uint8)
    edges = np.flatnonzero(np.diff(letters != 32, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    bounds = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in lowered)]))
    out = []
    with np.errstate(over="ignore"):
        codes = _word_codes(letters, starts, ends, known)
        rolled = _rolled(codes, n)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            found = np.sort(rolled[a : b - n + 1]) if b - a >= n else _rolled(codes[a:b], b - a)[: b - a]
            first = np.ones(len(found), dtype=bool)
            np.not_equal(found[1:], found[:-1], out=first[1:])
            out.append(found[first])
    return out


def _shingled(n: int, of: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, np.ndarray] = {}
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(start, BATCH_ROWS)
                sets = shingle_hashes(batch.column("_text").to_pylist(), n, known)
                yield from of(batch, [k for k, s in enumerate(sets) if len(s)], sets)

    return run


def set_name(values: np.ndarray) -> tuple[int, int]:
    """A name of a set, 128 bits."""
    import xxhash

    both = xxhash.xxh3_128_digest(values.tobytes())
    return tuple(np.frombuffer(both, dtype=np.int64).tolist())  # type: ignore[return-value]


def document_sets(docs: DataFrame, n: int, col: str) -> DataFrame:
    """(_id, shingles): the sets of the documents with a word, by name; one of many copies comes once from each task that meets them."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()

        def fresh(batch: pa.RecordBatch, kept: list[int], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            new = {name: sets[k] for k in kept if (name := set_name(sets[k])[0]) not in seen}
            seen.update(new)
            flat = np.concatenate([*new.values(), np.zeros(0, dtype=np.uint64)])
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, new.values())]), pa.int32()), pa.array(flat.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array([*new], pa.int64()), lists], ["_id", "shingles"])

        yield from _shingled(n, fresh)(batches)

    return docs.select(F.col(f"`{col}`").cast("string").alias("_text")).mapInArrow(rows, "_id long, shingles array<long>")


def set_bits(elements: int) -> int:
    """Bits that tell so many elements apart but for a few thousandths."""
    return min(64, max(1, elements).bit_length() + SPARE_BITS)


def as_elements(sets: DataFrame, bits: int, values: str = "shingles") -> DataFrame:
    """(element, _id, _n, _m): the elements of each set, cut to their last `bits` bits, and how many of them fall together there."""
    cut_to = F.col("element") if bits >= 64 else F.col("element").bitwiseAND(F.lit((1 << bits) - 1))
    rows = sets.select("_id", "_n", F.explode(values).alias("element"))
    return rows.groupBy(cut_to.alias("element"), "_id", "_n").agg(F.count(F.lit(1)).cast("int").alias("_m"))


def prefix_size(n: np.ndarray, threshold: float) -> np.ndarray:
    """How many elements of a set of n, in any order, one of the first of which any partner's own first elements hold."""
    return n - np.ceil(n * threshold - EPS).astype(np.int64) + 1


def document_prefixes(docs: DataFrame, n: int, col: str, threshold: float, keep: Sequence[str] = ()) -> DataFrame:
    """(keep, _id, _check, _n, prefix) of every document with a word: the name of its set, and the first elements in the order of their hashes."""
    names = [*keep, "_id", "_check", "_n", "prefix"]

    def rows(batch: pa.RecordBatch, kept: list[int], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        digests = np.array([set_name(sets[k]) for k in kept], dtype=np.int64).reshape(-1, 2)
        sizes = np.array([len(sets[k]) for k in kept], dtype=np.int64)
        first = [sets[k][:size] for k, size in zip(kept, prefix_size(sizes, threshold).tolist())]
        flat = np.concatenate(first) if kept else np.zeros(0, dtype=np.uint64)
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, first)]), pa.int32()), pa.array(flat.view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(pa.array(kept, pa.int64())) for c in keep),
             pa.array(digests[:, 0]), pa.array(digests[:, 1]), pa.array(sizes, pa.int32()), lists], names,
        )

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    rows_in = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{col}`").cast("string").alias("_text"))
    return rows_in.mapInArrow(_shingled(n, rows), f"{kinds}_id long, _check long, _n int, prefix array<long>")


class _Dealt:
    """Gathers columns of elements and hands them on by part, a row of arrays for each part."""

    def __init__(self, parts: int, fields: Sequence[str]) -> None:
        self.parts, self.fields, self.size = parts, fields, 0
        self.held: list[list[np.ndarray]] = []

    def add(self, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(list(columns))
        self.size += len(columns[0])
        if self.size >= HELD_ELEMENTS:
            yield from self.rows()

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            columns = [np.concatenate(c) for c in zip(*self.held)]
            # The last bits of an element have nothing to do with the order, which the first ones decide.
            part = ((columns[0] & np.uint64(0xFFFFFFFF)) * np.uint64(self.parts)) >> np.uint64(32)
            order = np.argsort(part, kind="stable")
            counts = np.bincount(part.astype(np.int64), minlength=self.parts)
            ends, used = np.cumsum([0, *counts[counts > 0]]), np.flatnonzero(counts)
            values = [(c.view(np.int64) if c.dtype == np.uint64 else c)[order] for c in columns]
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v)) for v in values]
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *lists], ["part", *self.fields])
        self.held, self.size = [], 0


def _gathered(batches: Iterator[pa.RecordBatch], fields: Sequence[str]) -> list[np.ndarray]:
    """All elements of a partition of what `_Dealt` handed on, sorted by the first field."""
    held = [[batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in fields] for batch in batches]
    columns = [np.concatenate(c) for c in zip(*held)] or [np.zeros(0, dtype=np.int64) for _ in fields]
    order = np.argsort(columns[0])
    return [c[order] for c in columns]


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and how long they are."""
    starts = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]])[: len(sorted_values)])
    return starts, np.diff(starts, append=len(sorted_values))


def frequent_elements(prefixes: DataFrame, parts: int) -> DataFrame:
    """(element, rows): elements in the prefixes (_id, prefix) of `SEVERAL` sets or more. A set is counted once by each task that meets copies of it."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, seen = _Dealt(parts, ["elements"]), set()
        for batch in batches:
            lists = batch.column("prefix")
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            for k, name in enumerate(batch.column("_id").to_pylist()):
                if name not in seen:
                    seen.add(name)
                    yield from out.add(values[ends[k] : ends[k + 1]].view(np.uint64))
        yield from out.rows()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (elements,) = _gathered(batches, ["elements"])
        starts, rows = _runs(elements)
        often = rows >= SEVERAL
        yield pa.RecordBatch.from_arrays([pa.array(elements[starts[often]]), pa.array(rows[often])], ["element", "rows"])

    moved = prefixes.select("_id", "prefix").mapInArrow(dealt, "part int, elements array<long>")
    return moved.repartitionById(parts, "part").mapInArrow(counted, "element long, rows long")


def last_in_order(frequent: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The elements that come last, sorted, and the place of each among them: rarest first. No more than `MOST_FREQUENT`, the most frequent by powers of two."""
    level = F.floor(F.log2("rows")).cast("int")
    sizes = frequent.groupBy(level.alias("v")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("v")).collect()
    lowest, total = 64, 0
    for v, n in sizes:
        total += n
        if total > MOST_FREQUENT:
            break
        lowest = v
    table = frequent.filter(level >= lowest).toArrow()
    elements, rows = (table.column(c).to_numpy() for c in ("element", "rows"))
    elements = elements.view(np.uint64)
    place = np.empty(len(elements), dtype=np.int32)
    place[np.lexsort((elements, rows))] = np.arange(len(elements), dtype=np.int32)
    order = np.argsort(elements)
    return elements[order], place[order]


def _first_elements(sets: list[np.ndarray], last: tuple[np.ndarray, np.ndarray], marks: np.ndarray, threshold: float) -> list[np.ndarray]:
    """Of each set's first elements, with those of `last` behind all others: (element, number of the set, place in its order)."""
    sizes = np.array([len(s) for s in sets])
    flat, number = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    behind = marks[flat & np.uint64(len(marks) - 1)]
    maybe = np.flatnonzero(behind)
    at = np.minimum(np.searchsorted(last[0], flat[maybe]), max(len(last[0]) - 1, 0))
    behind[maybe] = last[0][at] == flat[maybe] if len(last[0]) else False
    late = np.flatnonzero(behind)
    rank = last[1][np.searchsorted(last[0], flat[late])]
    late = late[np.lexsort((rank, number[late]))]
    begins = np.cumsum(sizes) - sizes
    early = np.cumsum(~behind)
    place = early - 1 - np.repeat((early - ~behind)[begins], sizes)
    lates = np.bincount(number[late], minlength=len(sets))
    place[late] = (sizes - lates)[number[late]] + np.arange(len(late)) - (np.cumsum(lates) - lates)[number[late]]
    kept = place < np.repeat(prefix_size(sizes, threshold), sizes)
    return [flat[kept], number[kept], place[kept]]


def document_index(docs: DataFrame, n: int, col: str, threshold: float, last: tuple[np.ndarray, np.ndarray], parts: int) -> DataFrame:
    """(element, place, last, _id, _n): the prefixes' elements that two sets or more have there, a row per set.

    Elements are held by partition, `HELD_ELEMENTS` as a rule. One that is in the prefixes of many sets adds 24 bytes for each; a set of many copies adds them once per task.
    """
    held = docs.sparkSession.sparkContext.broadcast(last)
    bits = max(16, min(24, 3 + len(last[0]).bit_length()))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, seen = _Dealt(parts, ["elements", "ids", "sizes", "places"]), set()
        marks = np.zeros(1 << bits, dtype=bool)
        marks[held.value[0] & np.uint64(len(marks) - 1)] = True

        def fresh(batch: pa.RecordBatch, kept: list[int], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            names = {set_name(sets[k])[0]: k for k in kept}
            new = [k for name, k in names.items() if name not in seen]
            ids = np.array([name for name in names if name not in seen], dtype=np.int64)
            seen.update(names)
            if new:
                sizes = np.array([len(sets[k]) for k in new], dtype=np.int32)
                element, number, place = _first_elements([sets[k] for k in new], held.value, marks, threshold)
                yield from out.add(element, ids[number], sizes[number], place.astype(np.int32))

        yield from _shingled(n, fresh)(batches)
        yield from out.rows()

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = _gathered(batches, ["elements", "ids", "sizes", "places"])
        for _ in range(2):
            # Copies of a set that several tasks met are dropped among what is left, so what they alone had in common is left out then.
            starts, rows = _runs(columns[0])
            columns = [c[np.repeat(rows > 1, rows)] for c in columns]
            columns = [c[np.lexsort((columns[1], columns[0]))] for c in columns]
            new = np.ones(len(columns[0]), dtype=bool)
            new[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
            columns = [c[new] for c in columns]
        elements, ids, sizes, places = columns
        for start in range(0, len(elements), WORD_BLOCK):
            block = slice(start, start + WORD_BLOCK)
            place = pa.array(places[block])
            yield pa.RecordBatch.from_arrays(
                [pa.array(elements[block]), place, place, pa.array(ids[block]), pa.array(sizes[block])], ["element", "place", "last", "_id", "_n"]
            )

    texts = docs.select(F.col(f"`{col}`").cast("string").alias("_text"))
    moved = texts.mapInArrow(dealt, "part int, elements array<long>, ids array<long>, sizes array<int>, places array<int>")
    return moved.repartitionById(parts, "part").mapInArrow(shared, "element long, place int, last int, _id long, _n int")


def set_classes(sets: DataFrame, key: str = "doc_id", values: str = "shingles") -> tuple[DataFrame, DataFrame]:
    """(members, classes): equal sets are one class, known by its lowest key.

    members: (key, _id, leader) per row of `sets`. classes: (_id, leader, copies, _n, values). Copies are combined map-side, so a set that a third
    of all rows hold costs one row per task.
    """
    digest = F.md5(F.array_join(values, " "))
    rows = cut(sets.select(key, digest.alias("_digest"), values))
    counted = rows.groupBy("_digest").agg(F.min(key).alias("leader"), F.count(F.lit(1)).alias("copies"))
    one_of_each = rows.select("_digest", values).dropDuplicates(["_digest"])
    classes = cut(
        one_of_each.join(counted, "_digest")
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_n", F.size(values))
    )
    ids = classes.filter("copies > 1").select("_digest", "_id", "leader", "copies")
    members = lookup(rows.select(key, "_digest"), ids, "_digest", rows_per_key="copies")
    return members.select(key, "_id", "leader"), classes.drop("_digest")


def shared_elements(elements: DataFrame) -> DataFrame:
    """(element, _id, _n, _m, sets): the elements that two sets or more hold, each with their number, a row per set that holds it.

    One shuffle by element. An element that is in a third of all sets is a small part of all elements; its rows are counted and handed on as a stream that spills.
    """
    spread = elements.repartition(F.col("element"))
    same = Window.partitionBy("element")
    # One sort by element and set serves both windows. Documents of one set bring the same row.
    before = F.lag("_id").over(same.orderBy("_id"))
    marked = spread.withColumn("_first", before.isNull() | (before != F.col("_id")))
    held = marked.withColumn("sets", F.count_if("_first").over(same))
    return held.filter("_first AND sets > 1").drop("_first")


def prefix_index(shared: DataFrame, threshold: float) -> DataFrame:
    """(element, _id, _n, place, last): the shared elements that lie in each set's prefix, with their first and last place in the set's order.

    Elements that fall together are as many places next to each other.
    """
    own = Window.partitionBy("_id", "_n")
    ordered = own.orderBy("sets", "element").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = shared.withColumn("_upto", F.sum("_m").over(ordered)).withColumn("_held", F.sum("_m").over(own))
    # Elements of no other set come first.
    last = F.col("_n") - F.col("_held") + F.col("_upto") - 1
    prefix = F.col("_n") - F.ceil(F.col("_n") * threshold - EPS) + 1
    found = placed.select("element", (last - F.col("_m") + 1).alias("place"), last.alias("last"), "_id", "_n")
    return found.filter(F.col("place") < prefix)


def candidate_pairs(index: DataFrame, threshold: float) -> DataFrame:
    """(a, b, _n): each pair of sets that may reach the threshold, once. The index holds all elements of the sets' prefixes that two of them share. `_n` is the size of a, the shorter one.

    Entries meet by element and class of length: the shorter set looks among lengths up to its own by the threshold, two classes as a rule. An
    element that is in many prefixes is sliced by the join; its entries are paired only within the lengths that can match. What is stored and shuffled
    grows with the index, the candidates and the pairs found, never with the square of the table.
    """
    # The two entries before each in its set: where one is of both sets, the pair has met already.
    own = Window.partitionBy("_id").orderBy("place")
    index = cut(index.withColumns({"_before": F.lag("element").over(own), "_before2": F.lag("element", 2).over(own)}))
    step = max(-math.log(threshold), 0.01)

    def length_class(n: Column) -> Column:
        return F.floor(F.log(n) / step + EPS).cast("int")

    n, other_n = F.col("_n"), F.col("_other_n")
    reach = F.sequence(length_class(n), length_class(n / threshold + EPS))
    place, other_place = F.col("place"), F.col("_other_place")
    share = threshold / (1 + threshold)
    entries = index.select("element", "place", "_id", "_n", "_before", "_before2")
    shorter = entries.filter(n - place >= F.ceil(2 * n * share - EPS)).withColumn("_class", F.explode(reach))
    longer = entries.select(
        "element",
        length_class(n).alias("_class"),
        F.col("_id").alias("_other"),
        n.alias("_other_n"),
        place.alias("_other_place"),
        F.col("_before").alias("_other_before"),
        F.col("_before2").alias("_other_before2"),
    )
    # Where two sets first meet, what they share is this element and others behind it in both.
    least = F.ceil((n + other_n) * share - EPS)
    first = (n < other_n) | ((n == other_n) & (F.col("_id") < F.col("_other")))
    met = reduce(or_, [F.coalesce(F.col(x) == F.col(y), F.lit(False)) for x in ("_before", "_before2") for y in ("_other_before", "_other_before2")])
    return cut(
        sliced_join(shorter, longer, ["element", "_class"])
        .filter(first & (n >= other_n * threshold - EPS) & (F.least(n - place, other_n - other_place) >= least) & ~met)
        .select(F.col("_id").alias("a"), F.col("_other").alias("b"), "_n")
        .distinct()
    )


def jaccard_of(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sets as arrays of distinct numbers, not both empty."""
    both = np.concatenate([a, b])
    both.sort()
    shared = np.count_nonzero(both[1:] == both[:-1])
    return shared / (len(both) - shared)


def with_jaccard(pairs: DataFrame, keep: Sequence[str], a: str, b: str) -> DataFrame:
    """(keep, jaccard) of rows that hold two sets, as lists of distinct whole numbers of 64 bits; not both are empty."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(c) for c in (a, b)]
            ends = [x.offsets.to_numpy() for x in lists]
            values = [x.values.to_numpy() for x in lists]
            out = np.empty(batch.num_rows)
            for k in range(batch.num_rows):
                out[k] = jaccard_of(*(v[e[k] : e[k + 1]] for v, e in zip(values, ends)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(out)], [*keep, "jaccard"])

    kinds = "".join(f"`{c}` {pairs.schema[c].dataType.simpleString()}, " for c in keep)
    return pairs.select(*keep, a, b).mapInArrow(rows, f"{kinds}jaccard double")


def meeting_places(pairs: DataFrame) -> DataFrame:
    """(home, slice, id, side, partners) from pairs (a, b, n of a): where the sets of pairs meet, so that a set moves once per place and not once per pair.

    The home of a pair is the least neighbour of either set: one for all pairs of a group of near copies. Within a home the sets on side 0 (a) are cut into slices of
      `SLICE_ELEMENTS` and `SLICE_PAIRS`, by a hash; a set on side 1 (b) has a row, with its partners, in each slice that it has partners in.
    """
    both = F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("other")), F.struct(F.col("b").alias("id"), F.col("a").alias("other"))))
    ends = pairs.select(both.alias("_end")).select("_end.*")
    nearest = cut(ends.groupBy("id").agg(F.min("other").alias("_least")).select("id", F.least("id", "_least").alias("_near")))
    named = lookup(lookup(pairs, nearest.toDF("a", "_near_a"), "a"), nearest.toDF("b", "_near_b"), "b")
    homed = cut(named.select(F.least("_near_a", "_near_b").alias("home"), "a", "b", "_n"))
    per_set = homed.groupBy("home", "a").agg(F.max("_n").alias("_n"), F.count(F.lit(1)).alias("_pairs"))
    slices = F.ceil(F.greatest(F.sum("_n") / SLICE_ELEMENTS, F.sum("_pairs") / SLICE_PAIRS)).cast("int")
    large = cut(per_set.groupBy("home").agg(slices.alias("_slices")).filter("_slices > 1"))
    slice_ = F.pmod(F.xxhash64("a"), F.coalesce("_slices", F.lit(1))).cast("int")
    placed = homed.join(F.broadcast(large), "home", "left").select("home", slice_.alias("slice"), "a", "b")
    sides = F.explode(F.array(
        F.struct(F.col("a").alias("id"), F.lit(0).alias("side"), F.lit(None).cast("long").alias("partner")),
        F.struct(F.col("b").alias("id"), F.lit(1).alias("side"), F.col("a").alias("partner")),
    ))
    rows = placed.select("home", "slice", sides.alias("_end")).select("home", "slice", "_end.*")
    return rows.groupBy("home", "slice", "id", "side").agg(F.collect_list("partner").alias("partners"))


def odd_bits(values: np.ndarray) -> np.ndarray:
    """1,024 bits: which remainders an odd number of the values has. An element of only one of two sets changes one bit, so sets differ by as many elements as bits, at least."""
    return np.packbits((np.bincount(values & 1023, minlength=1024) & 1).astype(np.uint8)).view(np.uint64)


class _Place:
    """The sets on side 0 of a place where pairs meet."""

    def __init__(self, name: tuple | None) -> None:
        self.name, self.sets, self.bits = name, {}, None

    def near(self, partners: np.ndarray, own: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """Those of `partners` whose index with `own` reaches the threshold. Sets whose bits already tell too many elements apart are not compared."""
        if self.bits is None:
            self.names = np.array(sorted(self.sets), dtype=np.int64)
            self.bits = np.array([odd_bits(self.sets[name]) for name in self.names.tolist()])
            self.sizes = np.array([len(self.sets[name]) for name in self.names.tolist()])
        at = np.searchsorted(self.names, partners)
        apart = np.bitwise_count(self.bits[at] ^ odd_bits(own)).sum(axis=1, dtype=np.int64)
        both = self.sizes[at] + len(own)
        left = partners[apart <= both - 2 * np.ceil(both * (threshold / (1 + threshold)) - EPS)]
        found = [(name, jaccard_of(self.sets[name], own)) for name in left.tolist()]
        return [f for f in found if f[1] >= threshold]


def verified(pairs: DataFrame, sets: DataFrame, threshold: float, values: str = "shingles") -> DataFrame:
    """(a, b, jaccard) of the pairs (a, b, size of a as _n) that reach the threshold, measured on the whole `sets` (_id, values)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = _Place(None)
        for batch in batches:
            found = []
            lists = [batch.column(c) for c in ("partners", "_set")]
            ends, values_ = [x.offsets.to_numpy() for x in lists], [x.values.to_numpy() for x in lists]
            columns = [batch.column(c).to_pylist() for c in ("home", "slice", "id", "side")]
            for k, (home, slice_, name, side) in enumerate(zip(*columns)):
                partners, own = (v[e[k] : e[k + 1]] for v, e in zip(values_, ends))
                if place.name != (home, slice_):
                    place = _Place((home, slice_))
                if side == 0:
                    place.sets[name] = own.copy()
                else:
                    found += [(a, name, value) for a, value in place.near(partners, own, threshold)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))], ["a", "b", "jaccard"]
            )

    places = cut(meeting_places(pairs))
    whole = sliced_join(places, sets.select(F.col("_id").alias("id"), F.col(values).alias("_set")), "id")
    met = whole.repartition("home", "slice").sortWithinPartitions("home", "slice", "side")
    return met.select("home", "slice", "id", "side", "partners", "_set").mapInArrow(rows, "a long, b long, jaccard double")


def _checked(threshold: float) -> None:
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is above 0 and at most 1")


def similar_classes(classes: DataFrame, threshold: float, values: str = "shingles") -> DataFrame:
    """(a, b, jaccard): each pair of classes (_id, _n, values) whose index reaches the threshold once, by their `_id`. Values are whole numbers of 64 bits."""
    _checked(threshold)
    total = classes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    shared = shared_elements(as_elements(classes, set_bits(total), values))
    return verified(candidate_pairs(prefix_index(shared, threshold), threshold), classes, threshold, values)


def exact_near_duplicates(
    docs: DataFrame, threshold: float = 0.8, n: int = 5, col: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(key, leader, jaccard): all near copies by word shingles, as classes and their pairs.

    Every document whose shingles equal those of a document of lower key points at the lowest such key, with index 1. Of two classes whose index reaches
    the threshold, the leader of higher key points at the other one. No pair is missed. Documents without a word, or without a text, have no near
    copies. Rows that share a key and their words are one document; rows that share a key only are compared like any two, and may point at their own key.
    Rows without a key point at their leader; a class without any key gives pairs with a null.
    """
    _checked(threshold)
    rows = cut(document_prefixes(docs, n, col, threshold, [key]))
    grouped = rows.groupBy("_id").agg(
        F.min(key).alias("leader"), F.count(F.lit(1)).alias("copies"), F.max("_n").alias("_n"),
        F.min("_check").alias("_low"), F.max("_check").alias("_high"),
    )
    classes = cut(grouped)
    total, clash = classes.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max(F.col("_low") != F.col("_high")), F.lit(False))).first()
    if clash:
        raise ValueError("two sets share a 64-bit name; give the documents in parts")
    several = classes.filter("copies > 1").select("_id", "leader", "copies")
    members = lookup(rows.select(key, "_id"), several, "_id", rows_per_key="copies")
    copies = members.filter(~F.col(key).eqNullSafe(F.col("leader"))).select(key, "leader", F.lit(1.0).alias("jaccard"))

    parts = max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil(total * (1 - threshold) / HELD_ELEMENTS))
    last = last_in_order(cut(frequent_elements(rows, parts)))
    pairs = candidate_pairs(document_index(docs, n, col, threshold, last, parts), threshold)
    asked = cut(pairs.select(F.explode(F.array("a", "b")).alias("_id")).distinct())
    # The texts of the lowest key of each class that is in a candidate, not those of all its copies.
    wanted = cut(lookup(classes.select("_id", "leader"), asked, "_id", "left_semi"))
    leaders = wanted.filter("leader IS NOT NULL").select(F.col("leader").alias(key)).distinct()
    texts = lookup(docs.select(key, col), leaders, key, "left_semi")
    if not wanted.filter("leader IS NULL").isEmpty():
        texts = texts.unionByName(docs.select(key, col).filter(F.col(f"`{key}`").isNull()))
    sets = lookup(document_sets(texts, n, col), asked, "_id", "left_semi")
    # A set that came from several tasks gives its pairs several times.
    found = verified(pairs, sets, threshold).distinct()
    names = classes.select("_id", "leader")
    named = lookup(found, names.toDF("a", "_first"), "a")
    named = lookup(named, names.toDF("b", "_second"), "b")
    low, high = F.least("_first", "_second"), F.greatest("_first", "_second")
    no_key = F.col("_first").isNull() | F.col("_second").isNull()
    linked = named.select(
        F.when(~no_key, high).alias(key), F.when(no_key, F.coalesce(low, high)).otherwise(low).alias("leader"), "jaccard"
    )
    return copies.unionByName(linked)
