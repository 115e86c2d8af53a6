"""Near copies by SimHash fingerprints and a positional byte index with count filtering.

A fingerprint is eight bytes, each at its position. Fingerprints that differ in at most `bits` bits (under 5 of them) share at
least 8 - `bits` bytes at the same positions. Copies of one fingerprint are one entry. The index lists entries by the bytes at several positions at once, chosen so that any two
entries with enough shared bytes meet in some list: the eight positions form `bits` + 2 groups, of which at least two agree. Within a list the shared bytes of each
pair are tallied, pairs below the guaranteed minimum are dropped, and the rest are verified by bit distance.

Lists are read as sorted streams. One longer than `LONG_LIST` is not compared pair by pair: its entries go on to an index of all byte positions
but `bits`, where a list holds at most 256**bits entries, whatever the data, and partners are found by flipping bits.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prosewell.llm.common import LOWER, sliced, stored, text_of
from prosewell.operators.joins import lookup
from prosewell.sources.store import cut

SHINGLE = 3
BITS = 2
SEED = 42
LONG_LIST = 256
PIECE_BYTES = 1 << 20
BROADCAST_ROWS = 200_000
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)

# ---------------------------------------------------------------------------- fingerprints


def _word_pieces(data: bytes, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """Words of a text a piece at a time; a piece ends where a word ends."""
    start = 0
    while start < len(data):
        end = start + size
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        yield data[start:end].split()
        start = end


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64 majority bits of the hashes of all word shingles; 0 without a word."""
    data = text.encode("utf-8", "surrogatepass").translate(LOWER)
    counts, n, held = np.zeros(64, dtype=np.int64), 0, []
    for words in _word_pieces(data):
        held += words
        if len(held) < shingle:
            continue
        parts = [held[i:] for i in range(shingle)]
        hashes = [xxhash.xxh64_intdigest(b" ".join(s), seed) for s in zip(*parts, strict=False)]
        bits = np.unpackbits(
            np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        )
        counts += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
        held = held[len(held) - shingle + 1 :] if shingle > 1 else []
    if not n and held:
        return xxhash.xxh64_intdigest(b" ".join(held), seed)
    majority = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _fingerprints(shingle: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, 200):
                found = [
                    _signed(fingerprint(t, shingle)) for t in batch.column("text").to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(found, pa.int64())], [*batch.schema.names[:-1], "fp"]
                )

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, marks: Sequence[str] = ()) -> DataFrame:
    """(doc_id, marks, fp): a row per document; a null text counts as empty, and an empty one has fingerprint 0. `marks` are whole numbers to carry along."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *marks, text_of().alias("text"))
    kinds = "".join(f"{m} long, " for m in marks)
    return rows.mapInArrow(_fingerprints(shingle), f"doc_id long, {kinds}fp long")


# ---------------------------------------------------------------------------- links


def _short_names(bits: int) -> list[list[int]]:
    """Byte positions that name a list: pairs of the `bits` + 2 groups."""
    groups = [list(map(int, g)) for g in np.array_split(np.arange(8), bits + 2)]
    return [a + b for a, b in itertools.combinations(groups, 2)]


def _long_names(bits: int) -> list[list[int]]:
    return [list(c) for c in itertools.combinations(range(8), 8 - bits)]


def _postings(names: list[list[int]]) -> Callable:
    """(slot, name, fp) of every entry for every kind of list; `name` holds the listed bytes."""

    masks = [
        int.from_bytes(bytes(255 if p in keep else 0 for p in range(8)), "little") for keep in names
    ]

    def expand(fps: DataFrame) -> DataFrame:
        slots = F.array(
            *(
                F.struct(
                    F.lit(i).cast("byte").alias("slot"),
                    F.col("fp").bitwiseAND(F.lit(_signed(mask)).cast("long")).alias("name"),
                )
                for i, mask in enumerate(masks)
            )
        )
        return fps.select("fp", F.explode(slots).alias("s")).select("s.slot", "s.name", "fp")

    return expand


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links of a batch as links from each entry to the least one it reaches: as connected, and no more than entries."""
    if not len(a):
        return a, b
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    other = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[other], nodes[root[other]]


def _whole_lists(batches: Iterator[pa.RecordBatch], long_list: int | None) -> Iterator[tuple]:
    """(start of each list, entries, None) for whole lists of two entries or more, or (None, None, entries) for a part of a long one.

    The stream is sorted by list. Of the list at the end of a batch, what was read so far is held; beyond `long_list`
    entries it is passed on in parts.
    """
    key, held, is_long = None, [], False

    def over(n: int) -> bool:
        return long_list is not None and n > long_list

    def close() -> Iterator[tuple]:
        if held:
            fps = np.concatenate(held)
            if is_long or over(len(fps)):
                yield None, None, fps
            elif len(fps) > 1:
                yield np.array([0]), fps, None

    for batch in batches:
        slot, name, fp = (
            batch.column(c).to_numpy(zero_copy_only=False) for c in ("slot", "name", "fp")
        )
        if not len(fp):
            continue
        new = np.flatnonzero((slot[1:] != slot[:-1]) | (name[1:] != name[:-1])) + 1
        starts = np.concatenate([[0], new])
        if (slot[0], name[0]) == key:
            held.append(fp[: starts[1] if len(starts) > 1 else len(fp)])
            starts = starts[1:]
        if len(starts):
            yield from close()
            sizes = np.diff(starts)
            for at, size in zip(starts, sizes, strict=False):
                if over(size):
                    yield None, None, fp[at : at + size]
            wanted = (sizes > 1) & ~np.array([over(n) for n in sizes], dtype=bool)
            if wanted.any():
                at, size = starts[:-1][wanted], sizes[wanted]
                first = np.concatenate([[0], np.cumsum(size)[:-1]])
                yield first, fp[np.repeat(at - first, size) + np.arange(size.sum())], None
            key, held, is_long = (slot[-1], name[-1]), [fp[starts[-1] :]], False
        if is_long or over(sum(map(len, held))):
            yield None, None, np.concatenate(held)
            held, is_long = [], True
    yield from close()


def _pairs(starts: np.ndarray, fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within lists: tally shared bytes, keep the guaranteed minimum, verify the distance."""
    entries = fps.view(np.uint64).view(np.uint8).reshape(-1, 8)
    ends = np.repeat(np.concatenate([starts[1:], [len(fps)]]), np.diff(np.concatenate([starts, [len(fps)]])))
    a, b = [], []
    alive, lag = np.arange(len(fps)), 1
    while True:
        alive = alive[alive + lag < ends[alive]]
        if not len(alive):
            break
        shared = (entries[alive] == entries[alive + lag]).sum(axis=1)
        i = alive[shared >= 8 - bits]
        distance = _POPCOUNT[entries[i] ^ entries[i + lag]].sum(axis=1)
        i = i[distance <= bits]
        a.append(fps[i])
        b.append(fps[i + lag])
        lag += 1
    return np.concatenate(a) if a else fps[:0], np.concatenate(b) if b else fps[:0]


def _flips(positions: list[int], bits: int) -> np.ndarray:
    """All changes of 1 to `bits` bits within the bytes at `positions`."""
    ones = [1 << (8 * p + k) for p in positions for k in range(8)]
    changes = [
        sum(c) for n in range(1, bits + 1) for c in itertools.combinations(ones, n)
    ]
    return np.array(changes, dtype=np.uint64)


_LINKS = "a long, b long, long_entry long"


def _found(a: np.ndarray, b: np.ndarray, forest: bool) -> pa.RecordBatch:
    a, b = _forest(a, b) if forest else (a, b)
    columns = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.nulls(len(a), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["a", "b", "long_entry"])


def _short_links(bits: int, long_list: int, forest: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for starts, fps, part in _whole_lists(batches, long_list):
            if part is None:
                yield _found(*_pairs(starts, fps, bits), forest)
            else:
                nulls = pa.nulls(len(part), pa.int64())
                columns = [nulls, nulls, pa.array(part, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b", "long_entry"])

    return run


def _long_links(bits: int, names: list[list[int]], forest: bool) -> Callable:
    free = [[p for p in range(8) if p not in keep] for keep in names]
    bytes_of = [sum(255 << (8 * p) for p in positions) for positions in free]
    changes = [_flips(positions, bits) for positions in free]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for starts, fps, _ in _whole_lists(batches, None):
            for start, end in zip(starts, [*starts[1:], len(fps)], strict=True):
                one = np.sort(fps[start:end].view(np.uint64))
                differ = int(np.bitwise_or.reduce(one ^ one[0]))
                slot = next(i for i, mask in enumerate(bytes_of) if not differ & ~mask)
                for change in changes[slot]:
                    other = one ^ change
                    at = np.minimum(np.searchsorted(one, other), len(one) - 1)
                    hit = (one[at] == other) & (one < other)
                    if hit.any():
                        yield _found(one[hit].view(np.int64), other[hit].view(np.int64), forest)

    return run


def links(
    entries: DataFrame, bits: int = BITS, long_list: int = LONG_LIST, forest: bool = True
) -> DataFrame:
    """(a, b): links of distinct `entries` (fp) that differ in at most `bits` bits.

    With `forest` what a task finds in one go is handed on as a forest that connects the same entries, so there are fewer links than
    entries in each list; without it every linked pair is given, once or more.
    """
    if not 1 <= bits <= 3:
        raise ValueError("the positional index serves distances of 1 to 3 bits")
    short = _postings(_short_names(bits))(entries)
    ordered = short.repartition("slot", "name").sortWithinPartitions("slot", "name")
    first = stored(ordered.mapInArrow(_short_links(bits, long_list, forest), _LINKS), "links")
    names = _long_names(bits)
    rest = first.filter("long_entry IS NOT NULL").select(F.col("long_entry").alias("fp")).distinct()
    longer = _postings(names)(rest).repartition("slot", "name").sortWithinPartitions("slot", "name")
    second = longer.mapInArrow(_long_links(bits, names, forest), _LINKS)
    return first.filter("a IS NOT NULL").select("a", "b").unionByName(second.select("a", "b"))


# ---------------------------------------------------------------------------- components


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for each node of `edges` (a, b) the least node that it reaches.

    Alternates two steps until nothing changes: every node hands its greater neighbours to its least one, then every node hands its
    lesser neighbours to the least of them. Least neighbours come from an aggregate, so a node with many neighbours costs
    its task one row per task before; they are handed out by a join that cuts hot nodes into slices.
    """
    lo, hi = F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")
    now = cut(edges.filter("a <> b").select(lo, hi).distinct())
    while True:
        both = now.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(
            now.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = lookup(both.filter("v > u"), cut(least), "u", max_rows=BROADCAST_ROWS)
        large = cut(joined.select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct())
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        joined = lookup(large, cut(least), "hi", max_rows=BROADCAST_ROWS)
        handed = joined.select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
        own = least.select(F.col("m").alias("lo"), "hi")
        new = cut(handed.unionByName(own).filter("lo <> hi").distinct())
        same = _digest(now) == _digest(new)
        now = new
        if same:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def _digest(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("lo", "hi")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(mixed), F.sum(F.shiftright(mixed, 24))).first())


def near_copies(
    docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, long_list: int = LONG_LIST
) -> DataFrame:
    """(doc_id, fingerprint, component_id): a row per document, in groups linked by at most `bits` differing bits.

    `component_id` is the smallest doc_id of the group; rows without doc_id are in their groups all the same, and a
    group of none but such rows has none. Empty and null texts share fingerprint 0 and link like any other. Repeated rows stay.
    An empty table gives no row.
    """
    rows = grouped(stored(fingerprints(docs, shingle), "fingerprints"), bits, long_list)
    return rows.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def grouped(prints: DataFrame, bits: int = BITS, long_list: int = LONG_LIST) -> DataFrame:
    """The rows of `prints` (doc_id, fp, any other columns), stored, with `root`, the least fingerprint that theirs reaches, and `component_id`."""
    entries = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(entries.select("fp"), bits, long_list))
    linked = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    linked = cut(entries.join(linked, entries["fp"] == linked["node"]).select("fp", "first", "root"))
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = lookup(linked.select("fp", "root"), cut(least), "root", max_rows=BROADCAST_ROWS)
    component = F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("component_id"))
    whole = entries.join(groups, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), component.alias("component_id")
    )
    return lookup(prints, cut(whole), "fp", max_rows=BROADCAST_ROWS)


# Two hashes of a whole row, as its name: rows of one name are equal.
MARKS = ["_mark1", "_mark2"]


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """The rows of `docs` (doc_id, text, any other columns) but for one row of each group: of the smallest doc_id, and of its rows the one of the smallest hash.

    Rows decide, not ids: doc_ids may repeat with unlike texts or be missing (they come last), and every group keeps exactly one row. The rows that go, and
    the names of rows that occur more than once, are joined with the texts; a name is a hash of the whole row, 128 bits long.
    """
    columns = [F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, T.MapType)]
    named = docs.withColumns({m: F.xxhash64(F.lit(i), *columns) for i, m in enumerate(MARKS)})
    rows = stored(grouped(stored(fingerprints(named, shingle, MARKS), "fingerprints"), bits), "groups")
    own = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", *MARKS)
    winners = cut(rows.groupBy("root").agg(F.min(own).alias("w"), F.count(F.lit(1)).alias("members")))
    several = winners.filter("members > 1").select("root", F.col("w._mark1").alias("_w1"), F.col("w._mark2").alias("_w2"), "members")
    met = lookup(rows.select("root", *MARKS), several, "root", rows_per_key="members", max_rows=BROADCAST_ROWS)
    wins = (F.col("_mark1") == F.col("_w1")) & (F.col("_mark2") == F.col("_w2"))
    gone = cut(met.filter(~wins).select(*MARKS).distinct())
    again = cut(met.filter(wins).groupBy(*MARKS).count().filter("count > 1").select(*MARKS))
    kept = lookup(named, gone, MARKS, "left_anti", max_rows=BROADCAST_ROWS)
    if again.isEmpty():
        return kept.drop(*MARKS)
    single = lookup(kept, again, MARKS, "left_anti", max_rows=BROADCAST_ROWS)
    repeated = lookup(kept, again, MARKS, "left_semi", max_rows=BROADCAST_ROWS)
    return single.unionByName(repeated.dropDuplicates(MARKS)).drop(*MARKS)
