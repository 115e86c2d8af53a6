import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tables import ODD, documents

from prosewell.llm import merge_tree

FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = merge_tree.read_ranks(FILE)
LIBRARY = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)
SPELLED = merge_tree.spellings(RANKS)
CODER = merge_tree.MergeCoder(RANKS, public_tokenizers.PATTERN, cached=50)


def ids(found):
    return memoryview(found).cast("I").tolist()


def plain(part):
    """Merge the leftmost pair of the lowest rank, by looking at every pair each time."""
    tokens = [bytes([b]) for b in part]
    while len(tokens) > 1:
        pairs = [(RANKS.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(tokens, tokens[1:]))]
        rank, i = min(pairs)
        if rank == 1 << 60:
            break
        tokens[i : i + 2] = [tokens[i] + tokens[i + 1]]
    return [RANKS[t] for t in tokens]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=64) | st.text("ab ét", min_size=1, max_size=16).map(str.encode), max_size=20))
def test_both_trees_equal_plain_merges(parts):
    together = CODER.merge_together(parts, 6) if parts else []
    for part, found in zip(parts, together, strict=True):
        assert ids(found) == plain(part) == ids(CODER.merge_alone(part))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=80), max_size=8))
def test_texts_equal_library(texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    for text, found in zip(texts, CODER.encode(texts), strict=True):
        assert ids(found) == LIBRARY.encode_ordinary(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.none() | st.lists(st.integers(0, 50_255), max_size=9), max_size=6), st.integers(0, 3))
def test_decoding_equals_library(lists, skipped):
    found = merge_tree.decode_lists(pa.array(lists, pa.list_(pa.int32()))[skipped:], SPELLED)
    assert found.to_pylist() == [LIBRARY.decode_bytes(x or []) for x in lists[skipped:]]


def test_long_parts():
    rng = random.Random(5)
    some = ["a" * 5_000, "ab" * 3_000, "".join(rng.choice("etaoinéß你") for _ in range(20_000)), " " * 3_000, "=-" * 500]
    for text, found in zip(some, CODER.encode(some), strict=True):
        assert ids(found) == LIBRARY.encode_ordinary(text)


def test_a_lone_byte_vocabulary():
    coder = merge_tree.MergeCoder({bytes([b]): b for b in range(256)}, r"(?s).+")
    assert ids(coder.encode(["abc" * 40])[0]) == list(b"abc" * 40)
    assert ids(coder.encode(["abc"])[0]) == list(b"abc")


def expected(text):
    found = LIBRARY.encode_ordinary(text or "")
    joined = ",".join(map(str, found)).encode()
    return len(found), hashlib.sha256(joined).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_odd_documents(spark):
    file = FILE, public_tokenizers.PATTERN
    rows = merge_tree.decode_documents(
        merge_tree.encode_documents(documents(spark, ODD), *file), FILE
    ).collect()
    key = lambda r: (str(r[0]), r[1])
    found = sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in rows), key=key)
    wanted = [(d, LIBRARY.encode_ordinary(t or ""), (t or "").encode()) for d, t, *_ in ODD]
    assert found == sorted(wanted, key=key)
    empty = merge_tree.encode_documents(documents(spark, []), *file)
    assert merge_tree.decode_documents(empty, FILE).count() == 0


@pytest.mark.parametrize("name", ["op13_merge_tree"])
def test_query_equals_library(spark, folder, name):
    from prosewell.plans.registry import QUERIES

    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES[name](spark, folder).collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found}
    assert len(found) == len(rows) and got == {r.doc_id: expected(r.text) for r in rows}
