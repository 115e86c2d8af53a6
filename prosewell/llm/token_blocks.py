"""Token ids as patched frame-of-reference blocks.

A segment holds the ids of whole documents, cut into blocks of `BLOCK` ids. A block stores ids minus its minimum in
`width` bits; the width is the one that holds a chosen percentile of them. Ids that need more bits keep their low
bits in place and put the rest on an exception list. The segment's head lists where each block starts, so one
block can be read alone.

Segment, little endian: magic `PFR1`, uint32 block size, uint64 ids, uint32 blocks, uint64 offset per block and one for
the end, then the blocks. Block: uint32 minimum, uint8 width, uint16 exceptions, the packed low bits (lowest bit first),
uint16 position and uint32 high part per exception.

A file is a Parquet table with a row per segment. Its parts follow the document order: all of part 0 comes before all of
part 1. Memory per task is one segment, or one document where a document is longer than a segment.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prosewell.llm.common import sliced, text_of

BLOCK = 1024
SEGMENT = 1 << 18
PERCENTILE = 0.95
END_ID = 2
HEAD = struct.Struct("<4sIQI")
BLOCK_HEAD = struct.Struct("<IBH")
CACHED_PIECES = 400_000
ROWS = 2_000

SEGMENTS = (
    "part int, segment int, first long, doc_ids array<long>, lengths array<long>, payload binary"
)
SPANS = "part int, segment int, at int, doc_id long, first long, n_tokens long, ids_crc32 long"


# ---------------------------------------------------------------------------- blocks


def _pack(rows: np.ndarray, width: int) -> np.ndarray:
    """Low `width` bits of each row's values, as bytes."""
    bits = (rows[:, :, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.reshape(len(rows), -1).astype(np.uint8), axis=1, bitorder="little")


def _unpack(rows: np.ndarray, n: int, width: int) -> np.ndarray:
    bits = np.unpackbits(rows, axis=1, count=n * width, bitorder="little")
    padded = np.zeros((len(rows), n, 32), dtype=np.uint8)
    padded[:, :, :width] = bits.reshape(len(rows), n, width)
    return np.packbits(padded, axis=2, bitorder="little").view("<u4").reshape(len(rows), n)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits each value needs; 0 for 0."""
    return np.frexp(values.astype(np.float64))[1]


def encode_segment(
    ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE
) -> bytes:
    """The bytes of one segment; `ids` is uint32 and may be empty."""
    ids = np.ascontiguousarray(ids, dtype=np.uint32)
    n_blocks = -(-len(ids) // block)
    full = len(ids) // block
    groups = [ids[: full * block].reshape(full, block)]
    if full < n_blocks:
        groups.append(ids[full * block :].reshape(1, -1))
    blocks: list[bytes] = []
    for rows in groups:
        if not len(rows):
            continue
        low = rows.min(axis=1)
        rest = rows - low[:, None]
        rank = max(0, int(np.ceil(percentile * rest.shape[1])) - 1)
        widths = _bits(np.partition(rest, rank, axis=1)[:, rank])
        packed: list[bytes] = [b""] * len(rows)
        for width in np.unique(widths):
            at = np.flatnonzero(widths == width)
            if width:
                for i, row in zip(at, _pack(rest[at], int(width)), strict=True):
                    packed[i] = row.tobytes()
        for i, body in enumerate(packed):
            width = int(widths[i])
            high = rest[i].astype(np.uint64) >> np.uint64(width)
            where = np.flatnonzero(high)
            blocks.append(
                BLOCK_HEAD.pack(int(low[i]), width, len(where))
                + body
                + where.astype("<u2").tobytes()
                + high[where].astype("<u4").tobytes()
            )
    head = HEAD.pack(b"PFR1", block, len(ids), len(blocks))
    sizes = np.array([0, *map(len, blocks)], dtype=np.uint64)
    starts = np.cumsum(sizes, dtype=np.uint64) + np.uint64(len(head) + 8 * len(sizes))
    return head + starts.astype("<u8").tobytes() + b"".join(blocks)


def _head(data: bytes) -> tuple[int, int, np.ndarray]:
    magic, block, n, n_blocks = HEAD.unpack_from(data)
    if magic != b"PFR1":
        raise ValueError("not a segment of token blocks")
    return block, n, np.frombuffer(data, "<u8", n_blocks + 1, HEAD.size).astype(np.int64)


def decode_block(data: bytes, number: int) -> np.ndarray:
    """The ids of one block, found through the list of block starts."""
    block, n, starts = _head(data)
    return _blocks(data, starts, np.array([number]), min(block, n - number * block))[0]


def _blocks(data: bytes, starts: np.ndarray, numbers: np.ndarray, size: int) -> np.ndarray:
    """Blocks of `size` ids each, as rows."""
    out = np.zeros((len(numbers), size), dtype=np.uint32)
    heads = [BLOCK_HEAD.unpack_from(data, starts[k]) for k in numbers]
    widths = np.array([h[1] for h in heads])
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        if width:
            n = -(-size * int(width) // 8)
            rows = [
                np.frombuffer(data, np.uint8, n, starts[numbers[i]] + BLOCK_HEAD.size) for i in at
            ]
            out[at] = _unpack(np.stack(rows), size, int(width))
    for i, (low, width, n) in enumerate(heads):
        if n:
            at = starts[numbers[i]] + BLOCK_HEAD.size + -(-size * width // 8)
            where = np.frombuffer(data, "<u2", n, at)
            high = np.frombuffer(data, "<u4", n, at + 2 * n).astype(np.uint64)
            out[i, where] |= (high << np.uint64(width)).astype(np.uint32)
        out[i] += np.uint32(low)
    return out


def decode_segment(data: bytes) -> np.ndarray:
    """All ids of a segment."""
    block, n, starts = _head(data)
    full = n // block
    out = [_blocks(data, starts, np.arange(full), block).ravel()] if full else []
    if n % block:
        out.append(_blocks(data, starts, np.array([full]), n % block)[0])
    return np.concatenate(out) if out else np.empty(0, np.uint32)


# ---------------------------------------------------------------------------- tokens

# Marks put before what does not follow a blank: a line's first word, a stop or comma. Texts that hold them go whole.
_FIRST, _STUCK = _MARKS = ("\x1d", "\x1f")
# Classes of bytes: a letter or digit, a stop or comma, part of a longer character, a mark, anything else.
_CLASSES = bytes(
    ord("h") if b > 127 else ord(".") if chr(b) in ".," else ord("a") if chr(b).isalnum()
    else ord("m") if 0x1C <= b <= 0x1F else ord("x")
    for b in range(256)
)
_LATIN = re.compile("[A-Za-zªµºÀ-ÖØ-öø-ɏ]+")
# The letters that byte-level vocabularies are spelled with: printable Latin-1 is itself, the rest follows from U+0100 on.
_OWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(_OWN))}
_BEFORE_STOP = re.compile(r"([^\x00-\x7F])[.,]")


class PieceEncoder:
    """Ids of whole texts by a byte-level tokenizer file.

    Such a tokenizer always parts a text before a blank that is followed by a word, around a lone newline, and between a letter or digit
    and a stop or comma. So a text of single blanks and newlines is encoded part by part, and a part met before is looked up. The parts of a
    batch are cut and told apart by Arrow; only distinct ones come to Python, and ids are gathered for all at once. The
    table of parts has a bound; beyond it the parts that were met in fewest batches go. Any other text is encoded whole.
    """

    def __init__(self, path: str, cached: int = CACHED_PIECES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._specials = [t.content for t in self._library.get_added_tokens_decoder().values()]
        self._cached = cached
        self._known: dict[str, int] = {}
        # By part: its ids, from one start to the next, and whether it must not be encoded alone: empty, or with other white space in it.
        self._ids = np.zeros(0, dtype="<u4")
        self._starts = np.zeros(1, dtype=np.int64)
        self._odd = np.zeros(0, dtype=bool)
        self._met = np.zeros(0, dtype=np.int32)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        found = self._library.encode_batch_fast(texts, add_special_tokens=False)
        return [e.ids for e in found]

    def _learn(self, parts: list[str]) -> None:
        """Add parts to the table. Words of Latin letters are one piece by themselves and go to the merges at once, spelled as their vocabulary is."""
        merges, latin, letters = self._library.model.tokenize, _LATIN.fullmatch, _LETTERS
        ids: list[list[int]] = [[]] * len(parts)
        odd = np.zeros(len(parts), dtype=bool)
        rest, plain = [], []
        for k, part in enumerate(parts):
            if latin(part):
                spelled = part if part.isascii() else part.encode().decode("latin-1").translate(letters)
                ids[k] = [t.id for t in merges("Ġ" + spelled)]
                continue
            text = part[1:] if part[:1] in _MARKS else part if part == "\n" else " " + part
            odd[k] = part != "\n" and text.split() != [text.removeprefix(" ")]
            rest.append(k)
            plain.append(text)
        for k, one in zip(rest, self._whole(plain), strict=True):
            ids[k] = one
        first = len(self._known)
        self._known |= zip(parts, range(first, first + len(parts)), strict=True)
        ends = self._starts[-1] + np.cumsum([len(one) for one in ids], dtype=np.int64)
        flat = array("I", chain.from_iterable(ids))
        self._ids = np.append(self._ids, np.asarray(flat, dtype="<u4"))
        self._starts = np.append(self._starts, ends)
        self._odd = np.append(self._odd, odd)
        self._met = np.append(self._met, np.zeros(len(parts), dtype=np.int32))

    def _forget(self) -> None:
        """Keep the parts met in most batches: those of more than one, at most half of the bound."""
        least = 2
        while (kept := self._met >= least).sum() > self._cached // 2:
            least *= 2
        sizes = np.diff(self._starts)
        self._ids = self._ids[np.repeat(kept, sizes)]
        self._starts = np.append(0, np.cumsum(sizes[kept]))
        self._odd, self._met = self._odd[kept], self._met[kept] // 2
        parts = compress(self._known, kept.tolist())
        self._known = dict(zip(parts, range(int(kept.sum())), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian uint32 ids of each text."""
        prepared = pa.array([self._prepared(t) for t in texts], pa.large_string())
        lists = pc.split_pattern(prepared, " ")
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        parts = lists.flatten().dictionary_encode()
        distinct = parts.dictionary.to_pylist()
        new = [p for p in distinct if p not in self._known]
        self._learn(new)
        codes = np.fromiter(map(self._known.__getitem__, distinct), np.int32, len(distinct))
        self._met[codes] += 1
        alone = prepared.is_valid().to_numpy(zero_copy_only=False)
        odd = self._odd[codes]
        if odd.any():
            text = np.repeat(np.arange(len(texts)), counts)
            alone &= np.bincount(text[odd[parts.indices.to_numpy()]], minlength=len(texts)) == 0
        table = pa.LargeListArray.from_arrays(self._starts, pa.array(self._ids))
        found = table.take(pa.array(codes)).take(parts.indices)
        flat = memoryview(found.flatten().to_numpy()).cast("B")
        ends = found.offsets.to_numpy()[np.append(0, np.cumsum(counts))] - found.offsets[0].as_py()
        ends = (4 * ends).tolist()
        out = [bytes(flat[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        whole = np.flatnonzero(~alone).tolist()
        for k, ids in zip(whole, self._whole([texts[k] for k in whole]), strict=True):
            out[k] = array("I", ids).tobytes()
        if len(self._known) > self._cached:
            self._forget()
        return out

    def _prepared(self, text: str) -> str | None:
        """The text with a blank between any two of its parts; None if it is to be encoded whole."""
        classes = text.encode("utf-8", "surrogatepass").translate(_CLASSES)
        if b"m" in classes or any(s in text for s in self._specials):
            return None
        alone = b"x." not in classes and b".." not in classes and classes[:1] != b"."
        if alone and b"h." in classes:
            alone = all(map(str.isalnum, set(_BEFORE_STOP.findall(text))))
        if alone:
            text = text.replace(",", " \x1f,").replace(".", " \x1f.")
        return _FIRST + text.replace("\n", " \n \x1d")


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder of this file; Python workers are used again by later tasks."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


# ---------------------------------------------------------------------------- writing and reading


def _segment_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [
        pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(),
    ]
    names = ["part", "segment", "first", "doc_ids", "lengths", "payload"]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
    )


def _writer(
    tokenizer: str, end_id: int, segment: int, block: int, percentile: float
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, first = TaskContext.get().partitionId(), 0, 0
        end = struct.pack("<I", end_id)
        doc_ids: list[int | None] = []
        texts: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, first, size
            data = np.frombuffer(b"".join(texts), "<u4")
            row = (part, number, first, list(doc_ids), [len(t) // 4 for t in texts],
                   encode_segment(data, block, percentile))
            number, first, size = number + 1, first + len(data), 0
            doc_ids.clear()
            texts.clear()
            return _segment_batch([row])

        for whole in batches:
            for batch in sliced(whole, ROWS):
                ids = encoder(tokenizer).encode(batch.column("text").to_pylist())
                for doc_id, one in zip(batch.column("doc_id").to_pylist(), ids, strict=True):
                    doc_ids.append(doc_id)
                    texts.append(one + end)
                    size += len(one) // 4 + 1
                    if size >= segment:
                        yield flush()
        if doc_ids:
            yield flush()

    return write


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = END_ID,
    segment: int = SEGMENT,
    block: int = BLOCK,
    percentile: float = PERCENTILE,
) -> None:
    """Encode `docs` (doc_id, text, any other columns) and write the ids to `path`, by ascending doc_id.

    A null text is encoded as an empty one: it has the end id only. Rows without doc_id come first; rows that share a
    doc_id follow each other by a hash of their text, and equal rows are all kept. An empty table gives an empty file.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    parts = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    write = _writer(tokenizer, end_id, segment, block, percentile)
    parts.select("doc_id", "text").mapInArrow(write, SEGMENTS).write.parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = decode_segment(row["payload"]).astype("<u4", copy=False)
            stops = np.cumsum(row["lengths"])
            starts = stops - row["lengths"]
            data = memoryview(ids.tobytes())
            crc = [
                zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts, stops, strict=True)
            ]
            n = len(stops)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["part"]] * n, pa.int32()),
                    pa.array([row["segment"]] * n, pa.int32()),
                    pa.array(range(n), pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts + row["first"], pa.int64()),
                    pa.array(row["lengths"], pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                ["part", "segment", "at", "doc_id", "first", "n_tokens", "ids_crc32"],
            )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, part, segment, at): a row per document, decoded from the files.

    `start` counts the ids of all documents before it: those of earlier parts, whose sums make a table of one row per
    part, and those before it in its own part.
    """
    files = spark.read.schema(SEGMENTS).parquet(path)
    length = F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x)
    totals = files.groupBy("part").agg(F.sum(length).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset")
    )
    docs = files.mapInArrow(_read, SPANS).join(F.broadcast(offsets), "part")
    return docs.select(
        "doc_id",
        (F.col("first") + F.col("offset")).alias("start"),
        "n_tokens", "ids_crc32", "part", "segment", "at",
    )


def read_token_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For `mapInArrow` over the files: (doc_id, ids) of every document."""
    for batch in batches:
        for row in batch.to_pylist():
            ids = decode_segment(row["payload"])
            stops = np.concatenate([[0], np.cumsum(row["lengths"])]).astype(np.int64)
            values = pa.array(ids.astype(np.int64), pa.int64())
            lists = pa.LargeListArray.from_arrays(pa.array(stops, pa.int64()), values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), lists.cast(pa.list_(pa.int64()))],
                ["doc_id", "ids"],
            )
