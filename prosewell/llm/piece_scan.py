"""SentencePiece ids by a best-path search that splits giant documents, and texts back from ids.

A text, with a blank before it and blanks written as U+2581, is cut into pieces of a model file so that the sum of their scores is greatest. Scores
are whole numbers, so sums are exact and may be taken in any grouping. The state at a place in the text is by how many characters the
last piece reaches beyond it. A chunk of text is then a matrix: the best sum from each state at its start to each state at its end. Matrices combine by
(max, +), which is associative. So chunks give their matrices in parallel, blocks of neighbouring matrices are combined in parallel, a scan over the few block
products gives the best sums at the start of every block, and from there at every chunk. With these each chunk tells alone from which state at its start the path to each state
at its end comes; following that from the text's end gives the states at all boundaries, and each chunk is traced back alone between its two. Of equal sums the
longest last piece wins everywhere, so chunks give the path that a search of the whole text gives.

The file's merges have ranks, not probabilities. A piece of rank r scores log(1 / (r + 2)) as a rank-frequency law has it, in
thousandths. Characters that no piece spells become byte pieces. U+2581 itself in a text becomes its three byte pieces, so
that every text comes back exactly.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosewell.llm.common import sliced, stored, text_of
from prosewell.operators.joins import lookup
from prosewell.sources.store import cut

BLANK = "▁"
CHUNK = 1 << 15
GIANT = 1 << 16
# Added to the least piece score for a character no piece spells.
UNKNOWN_PENALTY = 10_000
LOW = -(1 << 60)
# Neighbouring chunks whose matrices are combined to one.
BLOCK = 16
CACHED_WORDS = 300_000
# Characters of a part whose sum of scores is exact in single precision.
EXACT = 256
# Stands for U+2581 in a text. It is half a surrogate pair, so neither a text nor a piece has it.
_OWN_BLANK = "\ud800"


@dataclass(frozen=True)
class Pieces:
    """The vocabulary: id and score of each piece, 0 for what only begins pieces, ids of bytes, and where no piece reaches across."""

    ids: dict[str, int]
    scores: dict[str, int]
    begun: dict[str, int]
    longest: int
    bytes_: list[int]
    unknown: int
    spelled: dict[int, bytes]
    words: re.Pattern | None
    library: object


_loaded: dict[str, Pieces] = {}


def load(path: str) -> Pieces:
    """Read a model file; kept for later tasks of the same worker."""
    if path in _loaded:
        return _loaded[path]
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    normal = [(i, p.piece, p.score) for i, p in enumerate(proto.pieces) if p.type == p.NORMAL]
    order = sorted(normal, key=lambda x: (-x[2], x[0]))
    scores = {piece: round(-1000 * np.log(rank + 2)) for rank, (_, piece, _) in enumerate(order)}
    byte_ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == p.BYTE}
    bytes_ = [byte_ids[f"<0x{b:02X}>"] for b in range(256)]
    spelled = {i: piece.replace(BLANK, " ").encode() for i, piece, _ in normal}
    spelled |= {i: bytes([b]) for b, i in enumerate(bytes_)}
    begun = {p[:n]: 0 for p in scores for n in range(1, len(p))} | scores
    _loaded[path] = Pieces(
        {piece: i for i, piece, _ in normal}, scores, begun, max(map(len, scores)), bytes_,
        min(scores.values()) - UNKNOWN_PENALTY, spelled, _forced_cuts(scores), _library(proto, scores),
    )
    return _loaded[path]


def _library(proto, scores: dict[str, int]):
    """The library's own best-path search with these scores, for parts of a text: no blank is put before them."""
    from sentencepiece import SentencePieceProcessor

    proto.trainer_spec.model_type = proto.trainer_spec.UNIGRAM
    proto.normalizer_spec.add_dummy_prefix = False
    for p in proto.pieces:
        if p.type == p.NORMAL:
            p.score = scores[p.piece]
    return SentencePieceProcessor(model_proto=proto.SerializeToString())


def _forced_cuts(pieces: Iterable[str]) -> re.Pattern | None:
    """What finds the parts of a text that no piece reaches across: words, and letters before a stop or comma, if the pieces are such."""
    if any(BLANK in p.lstrip(BLANK) or "\n" in p for p in pieces):
        return None
    words = r" *[^ \n]+| +|\n"
    if any(re.search(r"[^\W\d_][.,]", p) for p in pieces):
        return re.compile(words)
    return re.compile(rf" *[^ \n.,]*[^\W\d_](?=[.,])|{words}")


def _shown(text: str) -> str:
    """The text as pieces spell it, character for character."""
    return text.replace(BLANK, _OWN_BLANK).replace(" ", BLANK)


def _char_ids(pieces: Pieces, char: str) -> list[int]:
    plain = BLANK if char == _OWN_BLANK else char
    return [pieces.bytes_[b] for b in plain.encode("utf-8", "surrogatepass")]


def _steps(pieces: Pieces, text: str, at: int) -> list[tuple[int, int]]:
    """(length, score) of each piece that starts at `at`; one character always can be passed."""
    get, out = pieces.begun.get, []
    for length in range(1, min(pieces.longest, len(text) - at) + 1):
        score = get(text[at : at + length])
        if score is None:
            break
        if score:
            out.append((length, score))
    return out if out and out[0][0] == 1 else [(1, pieces.unknown), *out]


def _sums(
    pieces: Pieces, text: str, start: int, end: int, first: Sequence[int] = (0,)
) -> tuple[list[int], list[int]]:
    """Best sum at each place from text[start] on, and the length of the last piece there. Of equal sums the longest one wins.

    `first` are the sums with which ways from before arrive at the first places; those places have 0 for the length.
    """
    n, get, longest, last = end - start, pieces.begun.get, pieces.longest, len(text)
    best, back = [LOW] * (n + longest + 1), [0] * (n + longest + 1)
    best[: len(first)] = first
    for at in range(n):
        base = best[at]
        if base == LOW:
            continue
        here, one = start + at, False
        for stop in range(here + 1, min(here + longest, last) + 1):
            score = get(text[here:stop])
            if score is None:
                break
            if score:
                to = stop - start
                one = one or to == at + 1
                if base + score > best[to]:
                    best[to], back[to] = base + score, to - at
        if not one and base + pieces.unknown > best[at + 1]:
            best[at + 1], back[at + 1] = base + pieces.unknown, 1
    return best, back


def came_from(pieces: Pieces, text: str, size: int, ahead: np.ndarray) -> list[int]:
    """For each state at the end of the chunk text[:size], the state at its start that the best path comes through; -1 where there is no path.

    `ahead` are the best sums from the text's start to the states at the chunk's start.
    """
    states = pieces.longest
    best, back = _sums(pieces, text, 0, size, ahead.tolist())
    out = []
    for state in range(states):
        at = size + state
        if best[at] == LOW:
            out.append(-1)
            continue
        while back[at]:
            at -= back[at]
        out.append(at)
    return out


def best_path(pieces: Pieces, text: str, enter: int, size: int, leave: int) -> list[int]:
    """Ids of the best path from place `enter` to place `size + leave` of text, by pieces that start before place `size`."""
    if enter >= size:
        return []
    _, back = _sums(pieces, text, enter, size)
    out: list[list[int]] = []
    at = size + leave
    while at > enter:
        length = back[at - enter]
        piece = text[at - length : at]
        known = pieces.ids.get(piece)
        out.append(_char_ids(pieces, piece) if known is None else [known])
        at -= length
    return [i for ids in reversed(out) for i in ids]


def transfer(pieces: Pieces, text: str, size: int) -> np.ndarray:
    """The matrix of the chunk text[:size]: best sum from each state at its start to each state at its end; LOW where there is no way.

    `text` goes on after the chunk as far as a piece can reach. A row of sums, one per state at the start, moves along the text until no
    piece reaches over the place it is at. From there on all states go the same way, and one sum is enough.
    """
    states = pieces.longest
    rows = np.full((size + 2 * states, states), LOW, dtype=np.int64)
    rows[np.arange(states), np.arange(states)] = 0
    reach, at = states - 1, 0
    while at < size and (reach > at or at == 0):
        base = rows[at]
        if base.max() > LOW:
            for length, score in _steps(pieces, text, at):
                if at + length < len(rows):
                    sums = np.where(base == LOW, LOW, base + score)
                    np.maximum(rows[at + length], sums, out=rows[at + length])
                    reach = max(reach, at + length)
        at += 1
    if at >= size:
        return rows[size : size + states].T.copy()
    best, _ = _sums(pieces, text, at, size)
    tail = np.array(best[size - at : size - at + states], dtype=np.int64)
    head = rows[at]
    low = (head[:, None] == LOW) | (tail[None] == LOW)
    return np.where(low, LOW, head[:, None] + tail[None])


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(max, +) product."""
    sums = np.where((a[:, :, None] == LOW) | (b[None] == LOW), LOW, a[:, :, None] + b[None])
    return sums.max(axis=1)


def applied(ahead: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """The sums behind a chunk from those before it."""
    sums = np.where((ahead[:, None] == LOW) | (matrix == LOW), LOW, ahead[:, None] + matrix)
    return sums.max(axis=0)


def at_start(states: int) -> np.ndarray:
    """The sums before a text's first chunk: there is only state 0."""
    return np.where(np.arange(states) == 0, 0, LOW).astype(np.int64)


class WordEncoder:
    """Ids of texts of ordinary length. The parts that no piece reaches across are searched alone and remembered."""

    def __init__(self, pieces: Pieces, cached: int = CACHED_WORDS) -> None:
        self._pieces = pieces
        self._cached = cached
        self._known: dict[str, bytes] = {}

    def _learn(self, parts: list[str]) -> None:
        """Add the ids of parts. The library sums in single precision, which is exact for short parts; it takes U+2581 for a blank."""
        plain = [p for p in parts if len(p) <= EXACT and BLANK not in p]
        found = self._pieces.library.encode(plain, num_threads=1) if plain else []
        self._known |= {p: array("i", ids).tobytes() for p, ids in zip(plain, found, strict=True)}
        for part in parts:
            if part not in self._known:
                ids = best_path(self._pieces, _shown(part), 0, len(part), 0)
                self._known[part] = array("i", ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian int32 ids of each text."""
        words = self._pieces.words
        parts = [words.findall(" " + t) if words else [" " + t] for t in texts]
        met: set[str] = set()
        met.update(*parts)
        new = list(met.difference(self._known))
        self._learn(new)
        get = self._known.__getitem__
        out = [b"".join(map(get, part)) for part in parts]
        if len(self._known) > self._cached:
            for part in new:
                del self._known[part]
        return out


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(load(path))
    return _encoders[path]


def decode(pieces: Pieces, ids: list[int] | np.ndarray) -> str:
    """The text of `ids`; the blank before it is taken off again."""
    data = b"".join(map(pieces.spelled.__getitem__, ids))
    return data[1:].decode("utf-8", "surrogatepass")


# ---------------------------------------------------------------------------- Spark


def _lists(data: list[bytes]) -> pa.Array:
    stops = np.cumsum([0, *(len(d) // 4 for d in data)]).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(data), "<i4"), pa.int32())
    return pa.ListArray.from_arrays(pa.array(stops), values)


def _encode_short(model: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, 400):
                ids = _encoder(model).encode(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(ids)], ["doc_id", "ids"])

    return run


def _cut_up(chunk: int, longest: int) -> Callable:
    """Chunks of a giant text, each with as much of what follows as a piece can reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, 1):
                text = " " + batch.column("text")[0].as_py()
                name, doc_id = batch.column("name"), batch.column("doc_id")
                for number, start in enumerate(range(0, len(text), chunk)):
                    part = text[start : start + chunk + longest]
                    yield pa.RecordBatch.from_arrays(
                        [name, doc_id, pa.array([number], pa.int32()),
                         pa.array([min(chunk, len(text) - start)], pa.int32()), pa.array([part], pa.string())],
                        ["name", "doc_id", "number", "size", "part"],
                    )

    return run


def _batch(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in columns.values()], list(columns))


def _per_chunk(model: str, name: str, kind: pa.DataType, columns: list[str], step: Callable) -> Callable:
    """(name, doc_id, number, `name`) of every chunk: `step(pieces, part, size, *columns)`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ["part", "size", *columns]), strict=True)
            found = [step(pieces, _shown(part), size, *rest) for part, size, *rest in rows]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("name", "doc_id", "number")), pa.array(found, kind)],
                ["name", "doc_id", "number", name],
            )

    return run


def _matrix(data: bytes) -> np.ndarray:
    flat = np.frombuffer(data, np.int64)
    return flat.reshape(math.isqrt(len(flat)), -1)


def _block_products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One matrix per block, from its chunks' matrices in order."""
    held: tuple[tuple[str, int], np.ndarray] | None = None

    def give() -> pa.RecordBatch:
        (name, block), product = held
        return _batch({"name": ([name], pa.string()), "block": ([block], pa.int32()), "matrix": ([product.tobytes()], pa.binary())})

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("name", "block", "matrix"))
        for name, block, data in zip(*columns, strict=True):
            matrix = _matrix(data)
            if held and held[0] == (name, block):
                held = held[0], combine(held[1], matrix)
                continue
            if held:
                yield give()
            held = (name, block), matrix
    if held:
        yield give()


def _running(place: str, first: str | None) -> Callable:
    """The sums before each matrix of a run, in order of `place`: from a text's start, or from what `first` holds for the run's first row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ahead = None, None
        for batch in batches:
            group = ["name"] if first is None else ["name", "block"]
            rows = list(zip(*(batch.column(c).to_pylist() for c in [*group, place, "matrix", *([first] if first else [])]), strict=True))
            out = []
            for row in rows:
                own, data = row[: len(group)], row[len(group) + 1]
                matrix = _matrix(data)
                if own != key:
                    key = own
                    ahead = np.frombuffer(row[-1], np.int64) if first else at_start(len(matrix))
                out.append(ahead.tobytes())
                ahead = applied(ahead, matrix)
            yield pa.RecordBatch.from_arrays(
                [batch.column("name"), batch.column(place), pa.array(out, pa.binary())], ["name", place, "ahead"]
            )

    return run


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states around each chunk, from last to first: a text ends in state 0."""
    current, state = None, 0
    for batch in batches:
        enter, leave = [], []
        for name, came in zip(batch.column("name").to_pylist(), batch.column("came").to_pylist(), strict=True):
            if name != current:
                current, state = name, 0
            leave.append(state)
            state = came[state]
            enter.append(state)
        yield pa.RecordBatch.from_arrays(
            [batch.column("name"), batch.column("number"), pa.array(enter, pa.int32()), pa.array(leave, pa.int32())],
            ["name", "number", "enter", "leave"],
        )


def encode_giant(docs: DataFrame, model: str, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, ids) of (doc_id, text), every text by chunks. A document's chunks lie in several tasks until its ids are put together.

    Beside a text's chunks a task holds a matrix of 2 kB per chunk of one block, or a few numbers per chunk or block of one text. What the chunks are joined with is
    broadcast only if its measured size allows it; the texts never are.
    """
    pieces = load(model)
    rows = docs.withColumn("name", F.expr("uuid()"))
    kinds = "name string, doc_id long, number int, size int, part string"
    parts = stored(rows.mapInArrow(_cut_up(chunk, pieces.longest), kinds), "chunks")
    if parts.isEmpty():
        return docs.sparkSession.createDataFrame([], "doc_id long, ids array<int>")
    # A given number of partitions is kept: chunks are few bytes but much work, and would else be put into one task.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = parts.repartition(tasks, "name", "number")
    place = ["name", "number"]
    head = "name string, doc_id long, number int"

    def per_chunk(df: DataFrame, name: str, kind: str, arrow: pa.DataType, columns: list[str], step: Callable) -> DataFrame:
        return df.mapInArrow(_per_chunk(model, name, arrow, columns, step), f"{head}, {name} {kind}")

    of_chunk = per_chunk(spread, "matrix", "binary", pa.binary(), [], lambda p, part, size: transfer(p, part, size).tobytes())
    matrices = stored(of_chunk.withColumn("block", F.floor(F.col("number") / BLOCK).cast("int")), "matrices")
    in_blocks = matrices.repartition("name", "block").sortWithinPartitions("name", "block", "number")
    products = in_blocks.select("name", "block", "matrix").mapInArrow(_block_products, "name string, block int, matrix binary")
    ordered = products.repartition("name").sortWithinPartitions("name", "block")
    starts = cut(ordered.mapInArrow(_running("block", None), "name string, block int, ahead binary"))
    begun = lookup(matrices, starts, ["name", "block"]).repartition("name", "block")
    begun = begun.sortWithinPartitions("name", "block", "number").select("name", "block", "number", "matrix", F.col("ahead").alias("first"))
    ahead = cut(begun.mapInArrow(_running("number", "first"), "name string, number int, ahead binary"))
    known = lookup(spread, ahead, place)
    came = per_chunk(
        known, "came", "array<int>", pa.list_(pa.int32()), ["ahead"],
        lambda p, part, size, sums: came_from(p, part, size, np.frombuffer(sums, np.int64)),
    )
    backward = came.select("name", "number", "came").repartition("name").sortWithinPartitions("name", F.desc("number"))
    states = cut(backward.mapInArrow(_followed, "name string, number int, enter int, leave int"))
    traced = per_chunk(
        lookup(spread, states, place), "ids", "array<int>", pa.list_(pa.int32()), ["enter", "leave"],
        lambda p, part, size, enter, leave: best_path(p, part, enter, size, leave),
    )
    by_number = F.array_sort(F.collect_list(F.struct("number", "ids")))
    whole = traced.groupBy("name", "doc_id").agg(F.flatten(by_number["ids"]).alias("ids"))
    return whole.select("doc_id", "ids")


def encode_documents(
    docs: DataFrame, model: str, giant: int = GIANT, chunk: int = CHUNK
) -> DataFrame:
    """(doc_id, ids): a row per row of `docs` (doc_id, text, any other columns).

    Texts of more than `giant` characters go by chunks, the others whole; both give the same ids, equal sums being settled alike. A null text counts as
    empty: a blank alone. Rows without doc_id and repeated rows are encoded like any other.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    long = F.length("text") > giant
    short = rows.filter(~long).mapInArrow(_encode_short(model), "doc_id long, ids array<int>")
    return short.unionByName(encode_giant(rows.filter(long), model, chunk))


def _decoded(model: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        for whole in batches:
            for batch in sliced(whole, 200):
                lists = batch.column("ids")
                values = lists.flatten().to_numpy()
                stops = np.cumsum([0, *lists.value_lengths().fill_null(0).to_pylist()])
                texts = [
                    decode(pieces, values[a:b].tolist()) for a, b in zip(stops, stops[1:], strict=False)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), lists, pa.array(texts, pa.string())],
                    ["doc_id", "ids", "text"],
                )

    return run


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, text) of (doc_id, ids); no ids, or null, are an empty text."""
    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(_decoded(model), "doc_id long, ids array<int>, text string")
