"""Byte-level merges with a segment tree per part, and the way back.

A part (a match of the pattern) is a row of bytes. Leaf i of its tree holds the rank of the pair that starts at byte i, a node the
smaller of its two children, so the root is the pair to merge next. A leaf is `rank << bits | position`: equal ranks fall to the
leftmost pair without a word more. A merge writes three leaves (the pair's own, the one before, the one swallowed) and the nodes
above them, so a part of n bytes takes O(n log n) however long it is.

Short parts of a batch move together, one merge each in a round, as rows of one array. A long part has a tree of its own.
Parts met before are looked up; that table has a bound and changes no result.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosewell.llm.common import sliced, sliced_by_bytes, text_of

# Longest part, in bytes, that moves together with others.
TOGETHER = 64
# Cells of the arrays that hold the parts of one round.
CELLS = 1 << 16
CACHED_PARTS = 300_000
BATCH_BYTES = 4 << 20
DECODED_ROWS = 1_000
NONE = np.iinfo(np.int64).max


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank of each byte string of a rank file: a line has the string in base 64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class MergeCoder:
    """Ids of texts and texts of ids. The ids are the ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cached: int = CACHED_PARTS) -> None:
        import regex

        self._parts = regex.compile(pattern).findall
        self._ranks = ranks
        self._longest = max(map(len, ranks))
        self._byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self._cached = cached
        self._known: dict[str, bytes] = {}
        size = self._size = max(ranks.values()) + 1
        keys, merged = array("q"), array("q")
        for spelled, rank in ranks.items():
            for cut in range(1, len(spelled)):
                left, right = ranks.get(spelled[:cut]), ranks.get(spelled[cut:])
                if left is not None and right is not None:
                    keys.append(left * size + right)
                    merged.append(rank)
        # One pair that no ids spell keeps the table from being empty.
        keys.append(size * size)
        merged.append(0)
        order = np.argsort(keys)
        self._pairs = np.asarray(keys)[order]
        self._merged = np.asarray(merged)[order]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, NONE where no merge joins them."""
        key = left * np.int64(self._size) + right
        at = self._pairs.searchsorted(key)
        return np.where(self._pairs[at] == key, self._merged[at], NONE)

    def merge_together(self, parts: Sequence[bytes], bits: int) -> list[bytes]:
        """Ids (little-endian uint32) of parts of 1 to 2**bits bytes, a merge of each in every round.

        Cell `row * width + i` of the flat arrays is byte i of a row's part, node j of its tree is `row * 2 * width + j`.
        """
        n, width = len(parts), 1 << bits
        lengths = np.fromiter(map(len, parts), dtype=np.int64, count=n)
        alive = np.arange(width) < lengths[:, None]
        ids = np.zeros(n * width, dtype=np.int64)
        cells = np.flatnonzero(alive)
        ids[cells] = self._byte[np.frombuffer(b"".join(parts), dtype=np.uint8)]
        following = np.arange(1, n * width + 1)
        before = following - 2
        stops = np.arange(n) * width + lengths
        alive = alive.ravel()
        tree = np.full((n, 2 * width), NONE, dtype=np.int64)

        def leaves(rank: np.ndarray, cell: np.ndarray) -> np.ndarray:
            return np.where(rank == NONE, NONE, (rank << bits) | (cell & (width - 1)))

        inner = np.ones(len(cells), dtype=bool)
        inner[np.cumsum(lengths) - 1] = False
        cells = cells[inner]
        # Leaf of a cell: its row's tree begins at twice the row's first cell, its leaves `width` nodes later.
        start = cells & -width
        tree.ravel()[cells + start + width] = leaves(self._rank(ids[cells], ids[cells + 1]), cells)
        for level in range(bits - 1, -1, -1):
            below = tree[:, 2 << level : 4 << level]
            np.minimum(below[:, ::2], below[:, 1::2], out=tree[:, 1 << level : 2 << level])
        tree = tree.ravel()
        root = np.arange(n) * (2 * width) + 1
        while True:
            best = tree[root]
            busy = best != NONE
            if not busy.all():
                root, best, stops = root[busy], best[busy], stops[busy]
                if not len(root):
                    break
            start = root >> 1
            at = start + (best & (width - 1))
            joined = best >> bits
            ids[at] = joined
            gone = following[at]
            after = following[gone]
            following[at] = after
            alive[gone] = False
            inside = after < stops
            after = np.where(inside, after, at)
            before[after[inside]] = at[inside]
            left = np.where(at > start, before[at], at)
            shift = start + width
            tree[gone + shift] = NONE
            rank = self._rank(joined, ids[after])
            tree[at + shift] = np.where(inside, leaves(rank, at), NONE)
            has_left = np.flatnonzero(left < at)
            rank = self._rank(ids[left[has_left]], joined[has_left])
            tree[(left + shift)[has_left]] = leaves(rank, left[has_left])
            # The nodes above the three leaves, level by level; a tree is an even number of nodes, so halves stay in it.
            first = root - 1
            nodes = np.concatenate([gone - start, at - start, left - start]) + width
            first = np.concatenate([first, first, first])
            for _ in range(bits):
                nodes >>= 1
                child = first + 2 * nodes
                tree[first + nodes] = np.minimum(tree[child], tree[child + 1])
        flat = ids[alive].astype("<u4").tobytes()
        ends = np.cumsum(alive.reshape(n, width).sum(axis=1) * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def merge_alone(self, part: bytes) -> bytes:
        """Ids (little-endian uint32) of one part of any length."""
        n, ranks, longest = len(part), self._ranks, self._longest
        bits = max(1, (n - 1).bit_length())
        width = 1 << bits
        start = self._byte[np.frombuffer(part, dtype=np.uint8)]
        first = np.full(2 * width, NONE, dtype=np.int64)
        pair = self._rank(start[:-1], start[1:])
        first[width : width + n - 1] = np.where(
            pair == NONE, NONE, (pair << bits) | np.arange(n - 1)
        )
        for level in range(bits - 1, -1, -1):
            below = first[2 << level : 4 << level]
            first[1 << level : 2 << level] = np.minimum(below[::2], below[1::2])
        tree = array("q", first.tobytes())
        following = array("q", range(1, n + 1))
        before = array("q", range(-1, n))
        none, mask = int(NONE), width - 1

        def put(position: int, value: int) -> None:
            node = position + width
            tree[node] = value
            while node > 1:
                other = tree[node ^ 1]
                if other < value:
                    value = other
                node >>= 1
                if tree[node] == value:
                    return
                tree[node] = value

        def leaf(left: int, end: int) -> int:
            if end - left > longest:
                return none
            rank = ranks.get(part[left:end])
            return none if rank is None else rank << bits | left

        while (best := tree[1]) != none:
            at = best & mask
            gone = following[at]
            after = following[gone]
            following[at] = after
            before[after] = at
            put(gone, none)
            put(at, leaf(at, following[after]) if after < n else none)
            if at:
                left = before[at]
                put(left, leaf(left, after))
        out, at = array("I"), 0
        while at < n:
            out.append(ranks[part[at : following[at]]])
            at = following[at]
        return out.tobytes()

    def _learn(self, new: list[str]) -> None:
        classes: dict[int, list[tuple[str, bytes]]] = {}
        for part in new:
            spelled = part.encode("utf-8", "surrogatepass")
            rank = self._ranks.get(spelled)
            if rank is not None:
                self._known[part] = array("I", [rank]).tobytes()
            elif len(spelled) > TOGETHER:
                self._known[part] = self.merge_alone(spelled)
            else:
                classes.setdefault((len(spelled) - 1).bit_length(), []).append((part, spelled))
        for bits, some in classes.items():
            step = max(1, CELLS >> bits)
            for i in range(0, len(some), step):
                names, parts = zip(*some[i : i + step], strict=True)
                self._known |= zip(names, self.merge_together(parts, bits), strict=True)

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Little-endian uint32 ids of each text."""
        parts = [self._parts(t) for t in texts]
        met: set[str] = set()
        met.update(*parts)
        new = list(met.difference(self._known))
        self._learn(new)
        get = self._known.__getitem__
        out = [b"".join(map(get, p)) for p in parts]
        if len(self._known) > self._cached:
            for part in new:
                del self._known[part]
        return out


_coders: dict[tuple[str, str], MergeCoder] = {}


def coder(path: str, pattern: str) -> MergeCoder:
    """The worker's coder of this file; Python workers are used again by later tasks."""
    if (path, pattern) not in _coders:
        _coders[path, pattern] = MergeCoder(read_ranks(path), pattern)
    return _coders[path, pattern]


def spellings(ranks: dict[bytes, int]) -> pa.BinaryArray:
    """The bytes of each id."""
    spelled = [b""] * (max(ranks.values()) + 1)
    for one, rank in ranks.items():
        spelled[rank] = one
    return pa.array(spelled, pa.large_binary())


def decode_lists(lists: pa.ListArray, spelled: pa.BinaryArray) -> pa.BinaryArray:
    """The bytes that each list of ids spells: one gather of all, cut where the lists end."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    bytes_ = spelled.take(lists.flatten())
    _, offsets, data = bytes_.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64, count=len(bytes_) + 1 + bytes_.offset)
    at = offsets[bytes_.offset + np.cumsum(np.append(0, sizes))]
    buffers = [None, pa.py_buffer(at.astype(np.int64).tobytes()), data]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), buffers)


def encode_documents(
    docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, ids array<int>), a row per row of `docs`.

    Text null or empty: no ids. Strings of special tokens are plain text. Keys may be null or repeat; other columns of `docs`, whatever
    their names, are not read. An empty table gives an empty one. No shuffle: memory is a batch's texts, or one text where it is longer.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = coder(ranks, pattern)
        for whole in batches:
            for batch in sliced_by_bytes(whole, "_text", BATCH_BYTES):
                ids = known.encode(batch.column("_text").to_pylist())
                ends = np.cumsum([0, *map(len, ids)]) // 4
                values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([batch.column(0), lists], [key, "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(f"`{key}`"), text_of(text).alias("_text")).mapInArrow(
        encode, f"`{key}` {kind}, ids array<int>"
    )


def decode_documents(encoded: DataFrame, ranks: str) -> DataFrame:
    """`encoded` with `decoded binary`: the bytes that `ids` spell. Ids null: no bytes."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = spellings(read_ranks(ranks))
        for whole in batches:
            for batch in sliced(whole, DECODED_ROWS):
                lists = batch.column(batch.schema.get_field_index("ids"))
                found = decode_lists(lists, spelled).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, found], [*batch.schema.names, "decoded"]
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(decode, f"{fields}, decoded binary")
