"""Alignment of two tokenizers' tokens by the bytes they cover.

A document is a blank and its text. A byte-level tokenizer (A) cuts it into tokens, a SentencePiece model (B) too. Where tokens of both end, the
document is cut into groups; in a group every token of A is linked to each token of B that shares a byte with it.

Fragments. A byte range of a document, with the tokens that end in it, is a fragment: an open head up to its first cut, the closed groups up
to its last cut, an open tail behind it; without any cut all of it is head. Two neighbours compose: the tail of the first and the head
of the second are one group, or part of one. Composition is associative and the empty fragment is neutral, so the fragments of
a long document are composed by a tree, in any grouping of neighbours, on any executor. A document of one piece is
one fragment, which is closed at both ends where it is made.

Pieces. Neither tokenizer has a token across a place where a blank follows something that is not blank, so a text can be tokenized from one
such place to another. Words are looked up, giant texts are tokenized piece by piece. Ranges of bytes do not follow these places.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator, Sequence
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosewell.llm.common import sliced_by_bytes, stored, text_of
from prosewell.operators.joins import lookup

# A longer text goes by pieces of at least so many characters.
PIECE = 1 << 16
# Bytes of a fragment, and how many neighbours a step composes.
RANGE = 1 << 14
FAN = 8
BATCH_BYTES = 1 << 19
CACHED_UNITS = 200_000
# The table of linked pairs is broadcast up to this many rows (and the bytes of `joins.lookup`).
PAIR_ROWS = 2_000_000

LINKS = "array<struct<a:int,b:int,n:int>>"
ALIGNED = f"n_a long, n_b long, n_groups long, n_links long, groups string, links {LINKS}"
OPEN = "struct<a:array<int>,a_ends:array<bigint>,b:array<int>,b_ends:array<bigint>>"
FRAGMENT = f"ok boolean, has_cut boolean, head {OPEN}, {ALIGNED}, tail {OPEN}"
LINK_TYPE = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int32())]))

# A blank after something not blank, and not the text's last character.
_CUT = re.compile(r"(?<=\S) (?=.)", re.S)
# Blanks that do not stand alone between two words.
_ODD = re.compile(r"(?:^|\s) | $")
# A word of Latin letters, and a stop or comma after it.
_PLAIN = re.compile("([A-Za-zªµºÀ-ÖØ-öø-ɏ]+)([.,]?)")


def units_of(text: str) -> list[str]:
    """The text cut where neither tokenizer has a token across; each unit stands for a blank and itself."""
    return _CUT.split(text) if _ODD.search(text) else text.split(" ")


def pieces_of(text: str, size: int) -> Iterator[tuple[int, str]]:
    """(byte, piece) of a text, cut like units but only after `size` characters; byte 0 is the blank before the text."""
    start, at = 0, 0
    while True:
        found = _CUT.search(text, start + size)
        piece = text[start : found.start()] if found else text[start:]
        yield at, piece
        if not found:
            return
        at += 1 + len(piece.encode("utf-8", "surrogatepass"))
        start = found.end()


def _byte_of_letter() -> dict[str, int]:
    """The letters that byte-level vocabularies are spelled with: printable Latin-1 is itself, the rest follows from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class TokenTables:
    """Both tokenizers' ids of units, each unit looked up once."""

    def __init__(self, byte_level: str, pieces: str, cached: int = CACHED_UNITS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(byte_level)
        self._a.encode_special_tokens = True
        self._b = SentencePieceProcessor(model_file=pieces)
        letters = _byte_of_letter()
        self._letters = {b: ord(c) for c, b in letters.items()}
        vocabulary = self._a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in letters for c in token)
            self.a_bytes[i] = bytes(map(letters.__getitem__, token)) if known else token.encode()
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if self._b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(map(self._b.id_to_piece, range(self._b.get_piece_size())))
        ]
        self.a_size = np.array(list(map(len, self.a_bytes)), dtype=np.int64)
        self.b_size = np.array(list(map(len, self.b_bytes)), dtype=np.int64)
        # The spellings of ids with what follows them in a group; see `render`.
        a, b = len(self.a_bytes), len(self.b_bytes)
        self.spelled = pa.array(
            [f"{i}{end}" for n, ends in ((a, ",|"), (b, ",;")) for end in ends for i in range(n)]
            + [str(i) for i in range(b)],
            pa.large_string(),
        )
        self._cached = cached
        self._known: dict[str, int] = {}
        # Per unit: are its bytes kept by both, and where its tokens begin. The last start is the end of all.
        self._ok = np.zeros(0, dtype=bool)
        self._ids = [np.zeros(0, dtype=np.int32)] * 2
        self._starts = [np.zeros(1, dtype=np.int64)] * 2

    def _encode_a(self, units: list[str]) -> list[list[int]]:
        """Ids of a blank and each unit. A word is one part for the merges, a stop or comma after it another."""
        merges, out, rest = self._a.model.tokenize, [], []
        for k, unit in enumerate(units):
            plain = _PLAIN.fullmatch(unit)
            if plain:
                spelled = plain[1].encode().decode("latin-1").translate(self._letters)
                ids = [t.id for t in merges("Ġ" + spelled)]
                out.append(ids + [t.id for t in merges(plain[2])] if plain[2] else ids)
            else:
                out.append([])
                rest.append(k)
        found = self._a.encode_batch_fast([" " + units[k] for k in rest], add_special_tokens=False)
        for k, one in zip(rest, found, strict=True):
            out[k] = one.ids
        return out

    def _learn(self, units: list[str]) -> None:
        a, b = self._encode_a(units), self._b.encode(units, num_threads=1)
        ids, starts = [], []
        for found in (a, b):
            counts = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            flat = array("i", chain.from_iterable(found))
            ids.append(np.asarray(flat, dtype=np.int32))
            starts.append(np.append(0, np.cumsum(counts)))
        wanted = [b" " + u.encode("utf-8", "surrogatepass") for u in units]
        lengths = np.fromiter(map(len, wanted), dtype=np.int64, count=len(wanted))
        ok = np.ones(len(units), dtype=bool)
        for flat, start, size, spelled in zip(
            ids, starts, (self.a_size, self.b_size), (self.a_bytes, self.b_bytes), strict=True
        ):
            upto = np.append(0, np.cumsum(size[flat]))[start]
            whole = b"".join(map(spelled.__getitem__, flat.tolist()))
            if (np.diff(upto) == lengths).all() and whole == b"".join(wanted):
                continue
            for k, (x, y) in enumerate(zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)):
                ok[k] &= whole[x:y] == wanted[k]
        first = len(self._known)
        self._known |= zip(units, range(first, first + len(units)), strict=True)
        self._ok = np.append(self._ok, ok)
        for side in (0, 1):
            self._ids[side] = np.append(self._ids[side], ids[side])
            self._starts[side] = np.append(
                self._starts[side], self._starts[side][-1] + starts[side][1:]
            )

    def tokens(self, texts: Sequence[str]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
        """Which texts both tokenizers keep, and for A and B: ids, ends and number of tokens per text.

        The texts lie one behind the other, each after a blank; ends are counted over all of them. A text that is not kept, or empty, has no tokens.
        """
        split = [units_of(t) if t else [] for t in texts]
        known = len(self._known)
        met: set[str] = set()
        met.update(*split)
        new = list(met.difference(self._known))
        if new:
            self._learn(new)
        counts = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        total = int(counts.sum())
        codes = np.fromiter(
            map(self._known.__getitem__, chain.from_iterable(split)), np.int64, total
        )
        text = np.repeat(np.arange(len(split)), counts)
        ok = np.bincount(text[~self._ok[codes]], minlength=len(split)) == 0
        kept = ok[text]
        codes, text = codes[kept], text[kept]
        ids, ends, sizes = [], [], []
        for side, size in enumerate((self.a_size, self.b_size)):
            start = self._starts[side][codes]
            n = self._starts[side][codes + 1] - start
            flat = self._ids[side][np.repeat(start + n - np.cumsum(n), n) + np.arange(n.sum())]
            ids.append(flat)
            ends.append(np.cumsum(size[flat]))
            sizes.append(np.bincount(text, weights=n, minlength=len(split)).astype(np.int64))
        if len(self._known) > self._cached:
            for unit in new:
                del self._known[unit]
            self._ok = self._ok[:known].copy()
            for side in (0, 1):
                self._starts[side] = self._starts[side][: known + 1].copy()
                self._ids[side] = self._ids[side][: self._starts[side][-1]].copy()
        return ok, ids, ends, sizes

    def render(
        self, ids: Sequence[np.ndarray], ends: Sequence[np.ndarray], cuts: np.ndarray, lasts: np.ndarray
    ) -> tuple[np.ndarray, pa.Buffer]:
        """All groups spelled as `a1,a2|b1;a3|b2,b3`, and where each token's spelling ends.

        `cuts` are the ends of the groups and `lasts` tells which of them end a text: no semicolon follows there.
        """
        a_upto = np.searchsorted(ends[0], cuts, "right")
        b_upto = np.searchsorted(ends[1], cuts, "right")
        group_a = np.repeat(np.arange(len(cuts)), np.diff(a_upto, prepend=0))
        group_b = np.repeat(np.arange(len(cuts)), np.diff(b_upto, prepend=0))
        a, b = len(self.a_bytes), len(self.b_bytes)
        spelled_a, spelled_b = ids[0].astype(np.int64), ids[1] + np.int64(2 * a)
        spelled_a[a_upto - 1] += a
        spelled_b[b_upto - 1] += np.where(lasts, 2 * b, b)
        order = np.empty(len(group_a) + len(group_b), dtype=np.int64)
        order[np.arange(len(group_a)) + np.append(0, b_upto)[group_a]] = spelled_a
        order[np.arange(len(group_b)) + a_upto[group_b]] = spelled_b
        text = self.spelled.take(pa.array(order))
        _, offsets, data = text.buffers()
        return np.frombuffer(offsets, dtype=np.int64, count=len(text) + 1), data


_tables: dict[tuple[str, str], TokenTables] = {}


def tables(byte_level: str, pieces: str) -> TokenTables:
    """The worker's tables; Python workers are used again by later tasks."""
    if (byte_level, pieces) not in _tables:
        _tables[byte_level, pieces] = TokenTables(byte_level, pieces)
    return _tables[byte_level, pieces]


def common_ends(ends: Sequence[np.ndarray]) -> np.ndarray:
    return np.intersect1d(ends[0], ends[1], assume_unique=True)


def overlaps(ends: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(token of A, token of B) that share bytes, where both lists of tokens cover the same bytes.

    Between two neighbouring ends, of either list, lies one token of each, and each such pair lies there only once.
    """
    a, b = ends
    b_of_a = np.searchsorted(b, a)
    alone = np.ones(len(b), dtype=bool)
    alone[b_of_a[b[b_of_a] == a]] = False
    alone = np.flatnonzero(alone)
    return (
        np.append(np.arange(len(a)), np.searchsorted(a, b[alone])),
        np.append(b_of_a, alone),
    )


# ---------------------------------------------------------------------------- fragments


class Open(NamedTuple):
    """Tokens of a group that has not ended, or whose beginning is elsewhere."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray

    def __add__(self, other: Open) -> Open:  # type: ignore[override]
        return Open(*(np.append(x, y) for x, y in zip(self, other, strict=True)))


NOTHING = Open(*(np.zeros(0, dtype=d) for d in (np.int32, np.int64, np.int32, np.int64)))


class Closed(NamedTuple):
    """Whole groups: numbers of tokens, groups and links, their spelling, and how often each pair is linked."""

    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    groups: str
    links: dict[tuple[int, int], int]

    def __add__(self, other: Closed) -> Closed:  # type: ignore[override]
        links = dict(self.links)
        for pair, n in other.links.items():
            links[pair] = links.get(pair, 0) + n
        numbers = (x + y for x, y in zip(self[:4], other[:4], strict=True))
        return Closed(*numbers, ";".join(filter(None, (self.groups, other.groups))), links)


NO_GROUPS = Closed(0, 0, 0, 0, "", {})


class Fragment(NamedTuple):
    """What a byte range of a document tells; `ok` is false where a tokenizer does not keep the bytes."""

    ok: bool
    has_cut: bool
    head: Open
    closed: Closed
    tail: Open


EMPTY = Fragment(True, False, NOTHING, NO_GROUPS, NOTHING)


def closed(tokens: Open, known: TokenTables) -> Closed:
    """Whole groups, from tokens that begin and end at a cut."""
    ids, ends = (tokens.a, tokens.b), (tokens.a_ends, tokens.b_ends)
    if not len(tokens.a):
        return NO_GROUPS
    cuts = common_ends(ends)
    last = np.zeros(len(cuts), dtype=bool)
    last[-1] = True
    offsets, data = known.render(ids, ends, cuts, last)
    a, b = overlaps(ends)
    pairs, counts = np.unique(np.stack([tokens.a[a], tokens.b[b]]), axis=1, return_counts=True)
    links = dict(zip(map(tuple, pairs.T.tolist()), counts.tolist(), strict=True))
    spelled = data[: int(offsets[-1])].to_pybytes().decode()
    return Closed(len(ids[0]), len(ids[1]), len(cuts), len(a), spelled, links)


def fragment(tokens: Open, known: TokenTables) -> Fragment:
    """The fragment of the tokens that end in a byte range."""
    cuts = common_ends((tokens.a_ends, tokens.b_ends))
    if not len(cuts):
        return Fragment(True, False, tokens, NO_GROUPS, NOTHING)

    def between(low: int, high: float) -> Open:
        a = (tokens.a_ends > low) & (tokens.a_ends <= high)
        b = (tokens.b_ends > low) & (tokens.b_ends <= high)
        return Open(tokens.a[a], tokens.a_ends[a], tokens.b[b], tokens.b_ends[b])

    first, last = int(cuts[0]), int(cuts[-1])
    inner = closed(between(first, last), known)
    return Fragment(True, True, between(-1, first), inner, between(last, np.inf))


def compose(left: Fragment, right: Fragment, known: TokenTables) -> Fragment:
    """The fragment of two neighbouring byte ranges."""
    ok = left.ok and right.ok
    if not right.has_cut:
        if not left.has_cut:
            return Fragment(ok, False, left.head + right.head, NO_GROUPS, NOTHING)
        return Fragment(ok, True, left.head, left.closed, left.tail + right.head)
    if not left.has_cut:
        return Fragment(ok, True, left.head + right.head, right.closed, right.tail)
    middle = closed(left.tail + right.head, known)
    return Fragment(ok, True, left.head, left.closed + middle + right.closed, right.tail)


def finished(whole: Fragment, known: TokenTables) -> Closed:
    """The groups of a whole document: nothing lies before its head."""
    return closed(whole.head, known) + whole.closed if whole.ok else NO_GROUPS


def range_fragments(at: int, text: str, known: TokenTables, size: int) -> Iterator[tuple[int, Fragment]]:
    """(number of the byte range, fragment) of a piece that begins at byte `at` of its document."""
    ok, ids, ends, _ = known.tokens([text])
    if not ok[0]:
        yield at // size, EMPTY._replace(ok=False)
        return
    ends = [e + at for e in ends]
    ranges = [(e - 1) // size for e in ends]
    for number in np.union1d(*ranges).tolist():
        (a, b) = (slice(*np.searchsorted(r, [number, number + 1])) for r in ranges)
        yield number, fragment(Open(ids[0][a], ends[0][a], ids[1][b], ends[1][b]), known)


# ---------------------------------------------------------------------------- on Spark


def _row(one: Fragment) -> dict:
    links = [{"a": a, "b": b, "n": n} for (a, b), n in sorted(one.closed.links.items())]
    sides = {k: {f: x.tolist() for f, x in getattr(one, k)._asdict().items()} for k in ("head", "tail")}
    return {"ok": one.ok, "has_cut": one.has_cut, **one.closed._asdict(), "links": links, **sides}


def _fragment(row: dict) -> Fragment:
    kinds = [x.dtype for x in NOTHING]
    sides = [
        Open(*(np.array(row[k][f], dtype=d) for f, d in zip(Open._fields, kinds, strict=True)))
        for k in ("head", "tail")
    ]
    links = {(x["a"], x["b"]): x["n"] for x in row["links"]}
    numbers = (row[c] for c in ("n_a", "n_b", "n_groups", "n_links", "groups"))
    return Fragment(row["ok"], row["has_cut"], sides[0], Closed(*numbers, links), sides[1])


def _align_batch(texts: Sequence[str], known: TokenTables) -> list[pa.Array]:
    """The columns of ALIGNED for texts of one piece each: fragments closed at both ends."""
    _, ids, ends, sizes = known.tokens(texts)
    n = len(texts)
    upto = [np.cumsum(s) for s in sizes]
    filled = np.flatnonzero(sizes[0])
    cuts = common_ends(ends)
    text_ends = ends[0][upto[0][filled] - 1]
    lasts = np.zeros(len(cuts), dtype=bool)
    lasts[np.searchsorted(cuts, text_ends)] = True
    offsets, data = known.render(ids, ends, cuts, lasts)
    spelled = pa.LargeStringArray.from_buffers(
        n, pa.py_buffer(offsets[np.append(0, upto[0] + upto[1])].tobytes()), data
    )
    text_of_a = np.repeat(np.arange(n), sizes[0])
    a, b = overlaps(ends)
    where = text_of_a[a]
    width = np.int64(len(known.b_bytes))
    both = np.int64(len(known.a_bytes)) * width
    pairs, counts = np.unique(where * both + ids[0][a] * width + ids[1][b], return_counts=True)
    per_text = np.bincount(pairs // both, minlength=n)
    pair = pairs % both
    links = pa.StructArray.from_arrays(
        [pa.array(x, pa.int32()) for x in (pair // width, pair % width, counts)], ["a", "b", "n"]
    )
    group_text = np.searchsorted(text_ends, cuts)
    groups = np.zeros(n, dtype=np.int64)
    groups[filled] = np.bincount(group_text, minlength=len(filled))
    numbers = (sizes[0], sizes[1], groups, np.bincount(where, minlength=n))
    offsets = pa.array(np.append(0, np.cumsum(per_text)), pa.int32())
    return [
        *(pa.array(x, pa.int64()) for x in numbers),
        spelled.cast(pa.string()),
        pa.ListArray.from_arrays(offsets, links),
    ]


ALIGNED_NAMES = ["n_a", "n_b", "n_groups", "n_links", "groups", "links"]


def _align_short(docs: DataFrame, key: str, kind: str, byte_level: str, pieces: str) -> DataFrame:
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tables(byte_level, pieces)
        for whole in batches:
            for batch in sliced_by_bytes(whole, "_text", BATCH_BYTES):
                found = _align_batch(batch.column("_text").to_pylist(), known)
                yield pa.RecordBatch.from_arrays([batch.column(0), *found], [key, *ALIGNED_NAMES])

    return docs.mapInArrow(align, f"`{key}` {kind}, {ALIGNED}")


def _align_long(
    docs: DataFrame, key: str, kind: str, byte_level: str, pieces: str, piece: int, size: int
) -> DataFrame | None:
    """Long texts: pieces over all tasks, a fragment per byte range, then a tree of compositions."""
    rows = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "long-texts")
    longest = rows.agg(F.max(F.octet_length("_text"))).first()[0]
    if longest is None:
        return None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                doc, text, number = (c[0].as_py() for c in one.columns)
                for k, (at, part) in enumerate(pieces_of(text, piece)):
                    columns = ([number], [doc], [k], [at], [part])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, cut_types, strict=True)],
                        ["_row", key, "_piece", "_at", "_text"],
                    )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tables(byte_level, pieces)
        for batch in batches:
            for row in batch.to_pylist():
                for number, one in range_fragments(row["_at"], row["_text"], known, size):
                    place = {"_row": row["_row"], key: row[key], "_number": row["_piece"] + number}
                    yield pa.RecordBatch.from_pylist([place | _row(one)], schema=fragment_schema)

    def join(table: pa.Table) -> pa.Table:
        known = tables(byte_level, pieces)
        some = sorted(table.to_pylist(), key=lambda r: r["_number"])
        whole = EMPTY
        for row in some:
            whole = compose(whole, _fragment(row), known)
        place = {k: some[0][k] for k in ("_row", key)} | {"_number": some[0]["_number"] // FAN}
        return pa.Table.from_pylist([place | _row(whole)], schema=fragment_schema)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tables(byte_level, pieces)
        for batch in batches:
            for row in batch.to_pylist():
                whole = finished(_fragment(row), known)
                links = [{"a": a, "b": b, "n": n} for (a, b), n in sorted(whole.links.items())]
                result = {key: row[key], **whole._asdict(), "links": links}
                yield pa.RecordBatch.from_pylist([result], schema=final_schema)

    from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

    head = f"_row long, `{key}` {kind}"
    fragment_ddl = f"{head}, _number long, {FRAGMENT}"
    spark = docs.sparkSession
    cut_ddl = f"{head}, _piece long, _at long, _text string"
    empty = spark.createDataFrame([], cut_ddl)
    cut_types = [to_arrow_type(f.dataType) for f in empty.schema.fields]
    fragment_schema = to_arrow_schema(spark.createDataFrame([], fragment_ddl).schema)
    final_schema = to_arrow_schema(spark.createDataFrame([], f"`{key}` {kind}, {ALIGNED}").schema)
    tasks = spark.sparkContext.defaultParallelism
    spread = rows.mapInArrow(cut, cut_ddl).repartition(
        max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions"))), "_row", "_piece"
    )
    fragments = spread.mapInArrow(make, fragment_ddl)
    last = (longest + 1) // size + longest // piece + 1
    while last:
        fragments = fragments.groupBy(
            "_row", F.floor(F.col("_number") / FAN).alias("_next")
        ).applyInArrow(join, fragment_ddl)
        last //= FAN
    return fragments.mapInArrow(finish, f"`{key}` {kind}, {ALIGNED}")


def align_documents(
    docs: DataFrame,
    byte_level: str,
    pieces: str,
    key: str = "doc_id",
    text: str = "text",
    piece: int = PIECE,
    size: int = RANGE,
) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, groups, links), a row per row of `docs`.

    `groups` spells the ids of the groups in order, `a1,a2|b1;a3|b2,b3`; `links` tells how often each pair of ids is linked in the document.
    Texts over `piece` bytes are tokenized by pieces of that many characters at least and aligned by byte ranges of `size`; neither number changes a result.

    Text null or empty, or not given back byte by byte by both tokenizers: no tokens, zeros and an empty spelling. Strings of special tokens are
    plain text. Keys may be null or repeat: every row stands for itself. Other columns of `docs`, whatever their names, are not read.
    An empty table gives an empty one.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`"), text_of(text).alias("_text"))
    is_long = F.octet_length("_text") > piece
    short = _align_short(rows.filter(~is_long), key, kind, byte_level, pieces)
    long = _align_long(rows.filter(is_long), key, kind, byte_level, pieces, piece, size)
    return short if long is None else short.unionByName(long)


def linked_pairs(aligned: DataFrame) -> DataFrame:
    """(a, b, documents, best): how many rows link the pair, and whether no pair of the same `a` is in more.

    Counts are summed before they move, so a pair that is in every document costs a row per task.
    """
    pairs = aligned.select(F.explode("links").alias("l")).groupBy("l.a", "l.b")
    counts = stored(pairs.agg(F.count(F.lit(1)).alias("documents")), "linked-pairs")
    most = counts.groupBy("a").agg(F.max("documents").alias("_most"))
    return (
        counts.join(most, "a")
        .withColumn("best", F.col("documents") == F.col("_most"))
        .drop("_most")
    )


def score_links(aligned: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of `aligned` without groups and links, with `n_best` (links whose pair is best) and `count_sum` (documents of the pairs of all links).

    `aligned` is to be a stored table: its rows are numbered.
    """
    kept = [c for c in aligned.columns if c not in ("groups", "links")]
    rows = aligned.withColumn("_row", F.monotonically_increasing_id())
    links = rows.select("_row", *kept, F.explode_outer("links").alias("_l")).select(
        "_row", *kept, "_l.a", "_l.b", F.col("_l.n").alias("_n")
    )
    scored = lookup(links, pairs, ["a", "b"], "left", max_rows=PAIR_ROWS)
    return (
        scored.groupBy("_row", *kept)
        .agg(
            F.coalesce(F.sum(F.when(F.col("best"), F.col("_n"))), F.lit(0)).alias("n_best"),
            F.coalesce(F.sum(F.col("_n") * F.col("documents")), F.lit(0)).alias("count_sum"),
        )
        .drop("_row")
    )
