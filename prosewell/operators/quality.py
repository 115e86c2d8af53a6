"""Corpus quality: copies, near copies, blanks, leaks across groups, profiles."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator, Sequence
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import MapType, VariantType

from prosewell.functions import text as T
from prosewell.operators import similarity
from prosewell.operators.joins import lookup, names, sliced_join
from prosewell.sources.store import cut

# The prime and the multipliers of the min-hash permutations (a·x + b) mod p.
PRIME = 2_147_483_647
MULTIPLIER, INCREMENT = 48_271, 1_299_709
# Texts whose shingles are made at once, and values that meet all permutations at once.
BATCH_ROWS = 200
BLOCK = 1 << 14
# MD5 (RFC 1321): what each step adds and by how many bits it turns; messages that are digested at once.
MD5_ADDED = (np.abs(np.sin(np.arange(1, 65))) * 2.0**32).astype(np.uint32)
MD5_TURNED = (7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)
MD5_BLOCK = 1 << 14
# For messages of 0 to 55 bytes: which bytes of the block are theirs, and the mark and the length behind them.
MD5_OWN = np.where(np.arange(64) < np.arange(56)[:, None], 255, 0).astype(np.uint8)
MD5_END = np.zeros((56, 64), dtype=np.uint8)
MD5_END[np.arange(56), np.arange(56)] = 0x80
MD5_END[:, 56], MD5_END[:, 57] = np.arange(56) * 8 & 255, np.arange(56) >> 5
# Shingles, counted once per bucket, that are few enough for the last rounds of near copies to be one task's work.
LAST_SHINGLES = 4_000_000
_NOT_LETTERS = bytes(b if 97 <= b <= 122 else 32 for b in range(256))


def text_digest(col: str = "text") -> Column:
    """Equal for texts that differ in white space only."""
    return F.md5(T.folded(col))


def duplicate_sets(docs: DataFrame, col: str = "text", key: str = "doc_id") -> DataFrame:
    """(digest, copies, first): every text with its number of copies and lowest key. A null text is no copy of another."""
    return (
        docs.filter(F.col(col).isNotNull())
        .select(key, text_digest(col).alias("digest"))
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("copies"), F.min(key).alias("first"))
    )


def exact_duplicates(docs: DataFrame, col: str = "text", key: str = "doc_id") -> DataFrame:
    """(digest, copies, first) of the texts that occur more than once."""
    return duplicate_sets(docs, col, key).filter("copies > 1")


def drop_duplicates(docs: DataFrame, col: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each text, the one of lowest key, and every row without a text.

    Rows decide, not keys: keys may repeat, with one text or with several, or be missing (such rows come last). Rows of one text and key are told apart by a hash of the whole row;
    equal rows are as good as each other. Texts that occur once stay where they are. Of the others each task hands on the best row of a
    text that it has met, so a text that makes up a third of the corpus costs one row per task.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    rows = docs.select(F.struct(*columns).alias("_row"), F.when(F.col(col).isNotNull(), text_digest(col)).alias("_digest"))
    sets = rows.groupBy("_digest").agg(F.count(F.lit(1)).alias("_copies"))
    sets = cut(sets.filter("_copies > 1 AND _digest IS NOT NULL"))
    single = lookup(rows, sets.select("_digest"), "_digest", "left_anti")
    keyed = docs.select(
        F.struct(*columns).alias("_row"),
        text_digest(col).alias("_digest"),
        F.struct(F.col(key).isNull().alias("last"), F.col(key).alias("key"), F.xxhash64(*hashed).alias("hash")).alias("_order"),
    )
    several = lookup(keyed, sets, "_digest", rows_per_key="_copies")
    best = several.groupBy("_digest").agg(F.min_by("_row", "_order").alias("_row"))
    return single.select("_row.*").unionByName(best.select("_row.*"))


def blank_documents(docs: DataFrame, col: str = "text", key: str | Sequence[str] = "doc_id") -> DataFrame:
    """Keys of the documents without a token."""
    return docs.filter(F.col(col).isNull() | ~F.lower(col).rlike("[a-z]")).select(*names(key))


def cross_group_threads(df: DataFrame, thread: str = "thread", group: str = "grp") -> DataFrame:
    """(thread, groups): threads in more than one group, with the sorted group names."""
    pairs = df.select(F.col(thread).alias("thread"), F.col(group).alias("_g")).distinct()
    return (
        pairs.groupBy("thread")
        .agg(F.array_sort(F.collect_set("_g")).alias("groups"))
        .filter(F.size("groups") > 1)
    )


def shared_documents(a: DataFrame, b: DataFrame, col: str = "text", key: str = "doc_id") -> DataFrame:
    """Keys of `a` whose text also occurs in `b`: a leak when a and b are sides of a split."""
    left = a.select(key, text_digest(col).alias("digest"))
    per_text = cut(b.select(text_digest(col).alias("digest")).distinct())
    return lookup(left, per_text, "digest", "left_semi").select(key)


def text_multiplicities(a: DataFrame, b: DataFrame, col: str = "text") -> DataFrame:
    """(digest, in_a, in_b, both, only_a, only_b): how often each text is on each side, as multisets: `both` is matched one to one, the rest is left over.

    Counts are summed before they move, so a text of any number of copies costs a row per task. Rows without a text are no text.
    """
    sides = [
        side.filter(F.col(col).isNotNull()).select(
            text_digest(col).alias("digest"), F.lit(in_a).alias("_a"), F.lit(1 - in_a).alias("_b")
        )
        for side, in_a in ((a, 1), (b, 0))
    ]
    counts = sides[0].unionByName(sides[1]).groupBy("digest").agg(F.sum("_a").alias("in_a"), F.sum("_b").alias("in_b"))
    both = F.least("in_a", "in_b")
    return counts.withColumns({"both": both, "only_a": F.col("in_a") - both, "only_b": F.col("in_b") - both})


def multiset_difference(a: DataFrame, b: DataFrame, col: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, side, matched) of every row of both sides that has a text: which are matched one to one, and which are on one side only.

    Of a text that is m times on one side and n times on the other, the min(m, n) rows of lowest key are matched on each side, rows without a key last. Keys are whole numbers or times. A text of any share of
    the rows is numbered in pieces; see `temporal.numbered`.
    """
    from prosewell.operators.temporal import instant, numbered

    last = (1 << 63) - 1
    rows = None
    for side, name in ((a, "a"), (b, "b")):
        one = side.filter(F.col(col).isNotNull()).select(
            F.col(f"`{key}`"), text_digest(col).alias("digest"), F.lit(name).alias("side"),
            F.coalesce(instant(side, key), F.lit(last)).alias("_t"), F.lit(0).alias("_tie"),
        )
        rows = one if rows is None else rows.unionByName(one)
    # The texts are read once; from here on there are keys and digests.
    rows = cut(rows)
    sides = [F.count_if(F.col("side") == name) for name in ("a", "b")]
    counts = rows.groupBy("digest").agg(F.least(*sides).alias("both"), F.count(F.lit(1)).alias("_rows"))
    both = cut(counts)
    placed = lookup(numbered(rows, ["digest", "side"]), both, "digest", rows_per_key="_rows")
    return placed.select(F.col(f"`{key}`"), "side", (F.col("_number") <= F.col("both")).alias("matched"))


def vocabulary_overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: words in both, only in a, only in b, and the Jaccard index, from two token tables."""
    marked = (
        a.select("token", F.lit(1).alias("in_a"), F.lit(0).alias("in_b"))
        .unionByName(b.select("token", F.lit(0).alias("in_a"), F.lit(1).alias("in_b")))
        .groupBy("token")
        .agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    )
    return marked.agg(
        F.count_if((F.col("in_a") == 1) & (F.col("in_b") == 1)).alias("both"),
        F.count_if(F.col("in_b") == 0).alias("only_a"),
        F.count_if(F.col("in_a") == 0).alias("only_b"),
    ).withColumn("jaccard", F.try_divide(F.col("both"), F.col("both") + F.col("only_a") + F.col("only_b")))


def profile(docs: DataFrame, by: str | Sequence[str], col: str = "text") -> DataFrame:
    """Per group: documents, tokens, bytes (min, median, max), share blank, share of lines quoted.

    The exact median keeps one counter per distinct length, not one value per document.
    """
    lines = F.split(col, "\n")
    tokens = F.coalesce(F.size(T.words(col)), F.lit(0))
    quoted = F.size(F.filter(lines, lambda x: x.rlike(r"^\s*[>|:]")))
    sized = docs.select(
        *names(by),
        tokens.alias("_tokens"),
        F.octet_length(F.coalesce(F.col(col), F.lit(""))).alias("_bytes"),
        F.size(lines).alias("_lines"),
        quoted.alias("_quoted"),
    )
    return sized.groupBy(*names(by)).agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum("_tokens").alias("tokens"),
        F.min("_bytes").alias("min_bytes"),
        F.percentile("_bytes", F.lit(0.5)).alias("median_bytes"),
        F.max("_bytes").alias("max_bytes"),
        F.avg((F.col("_tokens") == 0).cast("double")).alias("share_blank"),
        F.try_divide(F.sum("_quoted"), F.sum("_lines")).alias("share_quoted"),
    )


def md5_number(col: Column) -> Column:
    """A 60-bit number from md5, the same in every engine."""
    return F.conv(F.substring(F.md5(col), 1, 15), 16, 10).cast("bigint")


def shingle_sets(
    docs: DataFrame,
    n: int = 5,
    col: str = "text",
    key: str = "doc_id",
    hashed: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """(key, shingles): sorted distinct hashes of word n-grams; a shorter text is one shingle. Those of `md5_number` are made in numpy."""
    if hashed is md5_number:
        return _md5_shingle_sets(docs, n, col, key)

    def hashes(t: Column) -> Column:
        grams = F.when(F.size(t) >= n, T.word_ngrams(t, n)).otherwise(F.array(F.array_join(t, " ")))
        return F.array_sort(F.array_distinct(F.transform(grams, lambda g: hashed(g))))

    with_words = docs.filter(F.lower(col).rlike("[a-z]"))
    return with_words.select(key, T.let(T.words(col), hashes).alias("shingles"))


def _md5_words(message: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first two words of the MD5 digests of messages of one block, one per column of `message` (16, n) uint32. RFC 1321, all messages at once."""
    first = [np.full(message.shape[1], v, dtype=np.uint32) for v in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
    a, b, c, d = first
    for i in range(64):
        turn, step = divmod(i, 16)
        if turn == 0:
            f, at = d ^ (b & (c ^ d)), step
        elif turn == 1:
            f, at = c ^ (d & (b ^ c)), (5 * step + 1) % 16
        elif turn == 2:
            f, at = b ^ c ^ d, (3 * step + 5) % 16
        else:
            f, at = c ^ (b | ~d), 7 * step % 16
        f += a
        f += MD5_ADDED[i]
        f += message[at]
        left = np.uint32(MD5_TURNED[turn][i % 4])
        a, d, c, b = d, c, b, b + ((f << left) | (f >> (np.uint32(32) - left)))
    return a + first[0], b + first[1]


def _md5_numbers(line: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """`md5_number` of line[start:end], bytes; `MD5_BLOCK` of them at a time. Those that fill more than one block of MD5 go to the library."""
    out = np.empty(len(starts), dtype=np.int64)
    sizes = ends - starts
    padded = np.concatenate([line, np.zeros(64, dtype=np.uint8)])
    # The 64 bytes from each place on, as one value.
    ahead = np.ndarray((len(line) + 1,), dtype="V64", buffer=padded, strides=(1,))
    own, end = MD5_OWN.view("<u4"), MD5_END.view("<u4")
    short = np.flatnonzero(sizes <= 55)
    for first in range(0, len(short), MD5_BLOCK):
        block = short[first : first + MD5_BLOCK]
        size = sizes[block]
        message = ahead[starts[block]].view("<u4").reshape(-1, 16)
        message &= own[size]
        message |= end[size]
        high, low = _md5_words(np.ascontiguousarray(message.T))
        out[block] = (high.byteswap().astype(np.int64) << 28) | (low.byteswap() >> np.uint32(4)).astype(np.int64)
    whole = line.tobytes() if len(short) < len(out) else b""
    for i in np.flatnonzero(sizes > 55).tolist():
        out[i] = int.from_bytes(md5(whole[starts[i] : ends[i]]).digest()[:8], "big") >> 4
    return out


def md5_shingles(texts: Sequence[bytes], n: int) -> list[np.ndarray]:
    """The sorted distinct `md5_number` of each lower-cased text's n-grams of words; of all its words if it has fewer."""
    raw = np.frombuffer(b" ".join([*texts, b""]).translate(_NOT_LETTERS), dtype=np.uint8)
    letters = raw != 32
    ends = np.flatnonzero(letters[:-1] & ~letters[1:])
    # All words in one line, a blank behind each.
    kept = letters.copy()
    kept[1:] |= letters[:-1]
    line = raw[kept]
    stops = np.flatnonzero(line == 32)
    begins = np.concatenate([[0], stops[:-1] + 1])
    last = np.searchsorted(ends, np.cumsum([len(t) + 1 for t in texts]))
    words = np.diff(last, prepend=0)
    grams = np.where(words >= n, words - n + 1, np.minimum(words, 1))
    upto = np.cumsum(grams)
    first = np.arange(grams.sum()) + np.repeat(last - words - upto + grams, grams)
    behind = first + np.repeat(np.minimum(words, n) - 1, grams)
    numbers = _md5_numbers(line, begins[first], stops[behind])
    out = []
    for stop, size in zip(upto.tolist(), grams.tolist()):
        found = np.sort(numbers[stop - size : stop])
        new = np.ones(size, dtype=bool)
        np.not_equal(found[1:], found[:-1], out=new[1:])
        out.append(found[new])
    return out


def _md5_batches(n: int, of: Callable) -> Callable:
    """Batches of texts (`_text`, bytes) to `of(batch, rows with a word, their sets)`, some texts at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(start, BATCH_ROWS)
                sets = md5_shingles(batch.column("_text").to_pylist(), n)
                kept = [k for k, s in enumerate(sets) if len(s)]
                if kept:
                    yield of(batch, pa.array(kept, pa.int64()), [sets[k] for k in kept])

    return run


def _lowered(docs: DataFrame, col: str, key: str) -> tuple[DataFrame, str]:
    """What `_md5_batches` reads, and the key's kind."""
    rows = docs.filter(F.col(col).isNotNull()).select(F.col(f"`{key}`"), F.lower(col).cast("binary").alias("_text"))
    return rows, f"`{key}` {docs.schema[key].dataType.simpleString()}"


def _md5_shingle_sets(docs: DataFrame, n: int, col: str, key: str) -> DataFrame:
    def rows(batch: pa.RecordBatch, kept: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
        ends = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
        lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(sets)))
        return pa.RecordBatch.from_arrays([batch.column(key).take(kept), lists], [key, "shingles"])

    lowered, kind = _lowered(docs, col, key)
    return lowered.mapInArrow(_md5_batches(n, rows), f"{kind}, shingles array<bigint>")


def _md5_signatures(docs: DataFrame, n: int, col: str, key: str, count: int) -> DataFrame:
    """`signatures` of the texts' `md5_number` sets, which are not kept."""
    pairs = permutations(count)

    def rows(batch: pa.RecordBatch, kept: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
        sizes = np.array([*map(len, sets)])
        names_ = np.array([similarity.set_name(s) for s in sets], dtype=np.int64)
        least = min_hashes_of(np.concatenate(sets), np.cumsum(sizes) - sizes, pairs)
        ends = pa.array(np.arange(len(sets) + 1) * count, pa.int32())
        mins = pa.ListArray.from_arrays(ends, pa.array(least.T.astype(np.int32).ravel()))
        return pa.RecordBatch.from_arrays(
            [batch.column(key).take(kept), pa.array(sizes, pa.int32()), pa.array(names_[:, 0]), pa.array(names_[:, 1]), mins],
            [key, "_n", "_id", "_check", "mins"],
        )

    lowered, kind = _lowered(docs, col, key)
    return lowered.mapInArrow(_md5_batches(n, rows), f"{kind}, _n int, _id bigint, _check bigint, mins array<int>")


def permutations(count: int) -> list[tuple[int, int]]:
    """`count` pairs (a, b) from a fixed rule."""
    pairs, a, b = [], 1, 0
    for _ in range(count):
        a, b = a * MULTIPLIER % PRIME, (b * MULTIPLIER + INCREMENT) % PRIME
        pairs.append((a, b))
    return pairs


def min_hashes_of(values: np.ndarray, begins: np.ndarray, pairs: Sequence[tuple[int, int]]) -> np.ndarray:
    """The least (a·x + b) mod p of each stretch of `values` that begins at `begins`, a row per pair (a, b). No stretch is empty.

    In place of k = (a·x + b) mod p its place k / p · 2^64 is made, as the low 64 bits of one product: x / p · 2^64 and b / p · 2^64 are rounded up by less than 1 and
    at most 1, so the place is too high by at most 2^31, and neighbouring k are 2^33 apart. The order is that of k, and the least place tells k exactly.
    """
    x = (values & PRIME) + (values >> 31)
    x = np.where(x >= PRIME, x - PRIME, x).astype(np.uint64)
    # 2^64 / p is 2^33 + 4 + 2^-29 and a rest too small to carry.
    x = (x << np.uint64(33)) + (x << np.uint64(2)) + (x >> np.uint64(29)) + np.uint64(1)
    out = np.full((len(pairs), len(begins)), (1 << 64) - 1, dtype=np.uint64)
    place = np.empty(min(BLOCK, len(x)), dtype=np.uint64)
    factors = [(np.uint64(a), np.uint64(-(-(b << 64) // PRIME))) for a, b in pairs]
    for start in range(0, len(x), BLOCK):
        part = x[start : start + BLOCK]
        one, two = np.searchsorted(begins, start, "right") - 1, np.searchsorted(begins, start + len(part))
        inside = np.maximum(begins[one:two] - start, 0)
        buffer = place[: len(part)]
        for row, (a, b) in zip(out, factors):
            np.multiply(part, a, out=buffer)
            np.add(buffer, b, out=buffer)
            np.minimum(row[one:two], np.minimum.reduceat(buffer, inside), out=row[one:two])
    high, low, p = out >> np.uint64(32), out & np.uint64(0xFFFFFFFF), np.uint64(PRIME)
    return ((high * p + ((low * p) >> np.uint64(32))) >> np.uint64(32)).astype(np.int64)


def _least(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least (a·x + b) mod p, per row of a and b."""
    pairs = [*zip(a.ravel().tolist(), b.ravel().tolist())]
    return min_hashes_of(x, np.zeros(1, dtype=np.int64), pairs)[:, 0]


def min_hashes(shingles: Column | str, pairs: Sequence[tuple[int, int]]) -> Column:
    """array<bigint>: the least (a·x + b) mod p over a set, per pair (a, b). Nothing is exploded."""

    def least(sets: pd.Series) -> pd.Series:
        return pd.Series([min_hashes_of(np.asarray(s) % PRIME, np.zeros(1, dtype=np.int64), pairs)[:, 0].tolist() for s in sets])

    return F.pandas_udf(least, "array<bigint>")(shingles)


def signatures(sets: DataFrame, count: int, key: str = "doc_id") -> DataFrame:
    """(key, _n, _id, _check, mins): size of each set, its name (two hashes of 64 bits), `count` min-hashes. Sets are never empty."""
    return sets.select(
        key,
        F.size("shingles").alias("_n"),
        *(F.xxhash64(F.lit(seed), "shingles").alias(c) for seed, c in ((1, "_id"), (2, "_check"))),
        min_hashes("shingles", permutations(count)).alias("mins"),
    )


def near_duplicates(
    docs: DataFrame,
    threshold: float = 0.8,
    n: int = 5,
    bands: int = 12,
    rows: int = 3,
    col: str = "text",
    key: str = "doc_id",
    hashed: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """(key, leader, jaccard): each document with the leaders it is a near copy of.

    1. Texts with equal shingle sets point at the lowest key among them, which stands for all.
    2. The rest share a bucket when a band of min-hashes agrees. In each bucket the lowest key
       leads; members whose exact Jaccard index with it reaches the threshold point at it. The
       others go on to a finer bucket, parted by one more min-hash, and elect the next leader,
       until every member has led, points at a leader or is alone.

    A bucket of m members costs m pairs per round and falls apart in about log m rounds; there is
    never a pair for each two members. Rounds part members by the min-hashes of the signature first, then by fresh ones, so
    members that the threshold keeps apart go different ways with a chance of at least 1 - threshold every round. Every returned index is exact; as with any min-hash
    method, a near pair is missed with a small probability set by `bands` and `rows`.
    Hot sets, buckets and leaders are sliced by the joins. The first reading of the texts keeps names and min-hashes only; the shingles of those that share a
    bucket are made again, once. Everything read again is written to the shared folder first.
    """
    count = bands * rows
    if hashed is md5_number:
        signed = cut(_md5_signatures(docs, n, col, key, count))
    else:
        signed = cut(signatures(shingle_sets(docs, n, col, key, hashed), count, key))
    firsts = cut(
        signed.groupBy("_id", "_check")
        .agg(F.min(key).alias("leader"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )
    marked = cut(lookup(signed, firsts, ["_id", "_check"], "left", rows_per_key="copies").select(key, "_n", "mins", "leader"))
    is_copy = F.coalesce(F.col(key) != F.col("leader"), F.lit(False))
    copies = marked.filter(is_copy).select(key, "leader", F.lit(1.0).alias("jaccard"))
    distinct = marked.filter(~is_copy).drop("leader")
    buckets = F.array(*(F.xxhash64(F.lit(i), *(F.get("mins", F.lit(i * rows + r)) for r in range(rows))) for i in range(bands)))
    left = distinct.select(key, "_n", F.explode(buckets).alias("bucket"))
    shared = cut(left.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"))
    left = cut(lookup(left, shared, "bucket", rows_per_key="members").drop("members"))
    asked = cut(left.select(key).distinct())
    mins = cut(lookup(distinct.select(key, "mins"), asked, key, "left_semi"))
    mine = cut(shingle_sets(lookup(docs.select(key, col), asked, key, "left_semi"), n, col, key, hashed))
    edges, turn = copies, 0
    while True:
        leaders = _leaders(left, key)
        held = leaders.agg(F.sum("shingles")).first()[0]
        if held is None:
            return edges.distinct()
        leaders = leaders.drop("shingles")
        if held <= LAST_SHINGLES:
            return edges.unionByName(_last_rounds(left, leaders, mins, mine, threshold, bands, rows, turn, key)).distinct()
        members = cut(
            lookup(left, leaders, "bucket", rows_per_key="members").filter(F.col(key) != F.col("leader"))
        )
        # Sets of too unlike sizes need no comparison.
        sizes = F.least("_n", "_leader_n") >= F.greatest("_n", "_leader_n") * threshold - similarity.EPS
        pairs = cut(members.filter(sizes).select(key, "leader").distinct())
        found = cut(_scored(pairs, mine, key).filter(F.col("jaccard") >= threshold))
        edges = edges.unionByName(found)
        apart = cut(lookup(members, found.select(key, "leader"), [key, "leader"], "left_anti").select(key, "_n", "bucket"))
        if turn < count:
            parted = lookup(mins, apart, key).withColumn("_part", F.get("mins", F.lit(refinement(turn, bands, rows))))
        else:
            fresh = min_hashes("shingles", permutations(turn + 1)[-1:])
            parted = lookup(mine, apart, key).withColumn("_part", F.get(fresh, F.lit(0)))
        left = cut(parted.select(key, "_n", F.xxhash64("bucket", "_part").alias("bucket")))
        turn += 1


def _scored(pairs: DataFrame, sets: DataFrame, key: str) -> DataFrame:
    """(key, leader, jaccard) of pairs (key, leader). Only the sets of pairs move, those of leaders once per slice."""
    per_leader = cut(pairs.groupBy("leader").agg(F.count(F.lit(1)).alias("_rows")))
    theirs = lookup(sets.select(F.col(key).alias("leader"), F.col("shingles").alias("_other")), per_leader.select("leader"), "leader", "left_semi")
    both = sliced_join(lookup(sets, pairs, key), theirs, "leader", counts=per_leader)
    return similarity.with_jaccard(both, [key, "leader"], "shingles", "_other")


def refinement(turn: int, bands: int, rows: int) -> int:
    """Which min-hash parts the buckets after a turn: one of each band, then the next of each."""
    return (turn * rows + turn // bands) % (bands * rows)


def _leaders(left: DataFrame, key: str) -> DataFrame:
    """(bucket, leader, members, _leader_n, shingles) of the buckets that still hold more than one document, with all members' sizes summed."""
    first = F.min(F.when(F.col(key).isNotNull(), F.struct(F.col(key).alias("key"), "_n")))
    grouped = left.groupBy("bucket").agg(first.alias("_first"), F.count(F.lit(1)).alias("members"), F.sum("_n").alias("shingles"))
    sizes = [F.col("_first.key").alias("leader"), "members", F.col("_first._n").alias("_leader_n"), "shingles"]
    return cut(grouped.filter("members > 1").select("bucket", *sizes))


def _last_rounds(
    left: DataFrame, leaders: DataFrame, mins: DataFrame, sets: DataFrame, threshold: float, bands: int, rows: int, turn: int, key: str
) -> DataFrame:
    """(key, leader, jaccard) of all rounds from `turn` on, in one task. Buckets do not depend on each other; the caller has measured that their sets are few."""
    open_ = lookup(left, leaders.select("bucket", "members"), "bucket", rows_per_key="members").filter(F.col(key).isNotNull())
    held = cut(open_.groupBy(key).agg(F.collect_list("bucket").alias("_buckets")))
    whole = lookup(lookup(sets, held, key), lookup(mins, held.select(key), key, "left_semi"), key).select(key, "_buckets", "mins", "shingles")

    def rounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list[tuple] = []
        for batch in batches:
            lists = [batch.column(c) for c in ("_buckets", "mins", "shingles")]
            ends, values = [x.offsets.to_numpy() for x in lists], [x.values.to_numpy() for x in lists]
            for k, name in enumerate(batch.column(key).to_pylist()):
                docs.append((name, *(v[e[k] : e[k + 1]].copy() for v, e in zip(values, ends))))
        docs.sort(key=lambda d: d[0])
        buckets: dict = {}
        for i, doc in enumerate(docs):
            for bucket in doc[1].tolist():
                buckets.setdefault(bucket, []).append(i)
        known: dict[tuple[int, int], float] = {}

        def jaccard(i: int, j: int) -> float:
            if (i, j) not in known:
                a, b = docs[i][3], docs[j][3]
                near = min(len(a), len(b)) >= max(len(a), len(b)) * threshold - similarity.EPS
                known[i, j] = similarity.jaccard_of(a, b) if near else 0.0
            return known[i, j]

        for t in itertools.count(turn):
            buckets = {bucket: found for bucket, found in buckets.items() if len(found) > 1}
            if not buckets:
                break
            finer: dict = {}
            for bucket, (first, *others) in buckets.items():
                for i in others:
                    if docs[i][0] != docs[first][0] and jaccard(i, first) < threshold:
                        part = docs[i][2][refinement(t, bands, rows)] if t < bands * rows else _least(docs[i][3] % PRIME, *fresh(t))[0]
                        finer.setdefault((bucket, int(part)), []).append(i)
            buckets = dict(enumerate(finer.values()))
        near = sorted(pair for pair, value in known.items() if value >= threshold)
        names_ = [pa.array([docs[pair[side]][0] for pair in near], kind) for side in (0, 1)]
        yield pa.RecordBatch.from_arrays([*names_, pa.array([known[pair] for pair in near], pa.float64())], [key, "leader", "jaccard"])

    def fresh(t: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = permutations(t + 1)[-1]
        return np.array([a]), np.array([b])

    kind = to_arrow_type(sets.schema[key].dataType)
    named = sets.schema[key].dataType.simpleString()
    return whole.repartition(1).mapInArrow(rounds, f"`{key}` {named}, leader {named}, jaccard double")
