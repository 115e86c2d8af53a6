import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tables import ODD, documents

from prosewell.llm import token_blocks as tb
from prosewell.sources.store import fresh_path

MODEL = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(MODEL)


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 100), max_size=300),
    st.sampled_from([1, 7, 64]),
    st.sampled_from([0.0, 0.5, 0.9, 1.0]),
)
def test_segment_round_trip(ids, block, percentile):
    ids = np.array(ids, dtype=np.uint32)
    data = tb.encode_segment(ids, block, percentile)
    assert (tb.decode_segment(data) == ids).all()
    for k in range(-(-len(ids) // block)):
        assert (tb.decode_block(data, k) == ids[k * block : (k + 1) * block]).all()


def test_outliers_do_not_widen_a_block():
    ids = np.r_[np.arange(1000) % 16, [2**31] * 24].astype(np.uint32)
    assert len(tb.encode_segment(ids, 1024, 0.95)) < 1024 * 4 // 8 + 24 * 6 + 100


def test_parts_equal_whole_texts(library):
    rng = random.Random(3)
    some = ["a", "the", "It's", "x", "é", "…", "»", " ", " ", "\n", "\t", ",", ".", "..", "'s", "12", "_",
            "<|endoftext|>", "\x1d", "\xa0", "你", "²", "́", "  ", "\r\n"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randint(0, 12))) for _ in range(5_000)]
    small = tb.PieceEncoder(MODEL, 40)
    found = [ids for i in range(0, len(texts), 100) for ids in small.encode(texts[i : i + 100])]
    wanted = library.encode_batch_fast(texts, add_special_tokens=False)
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [w.ids for w in wanted]


def expected(library, rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    start, out = 0, []
    for doc_id, text, *_ in ordered:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_of_odd_documents(spark, library):
    path = fresh_path(spark, "blocks")
    tb.write_token_files(documents(spark, ODD), path, MODEL, segment=50, block=16)
    rows = tb.read_token_files(spark, path).collect()
    found = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows), key=lambda r: r[1])
    assert found == expected(library, ODD)
    ids = spark.read.parquet(path).mapInArrow(tb.read_token_ids, "doc_id long, ids array<long>")
    assert sorted(len(r.ids) for r in ids.collect()) == sorted(r[2] for r in found)


def test_no_documents(spark):
    path = fresh_path(spark, "blocks")
    tb.write_token_files(documents(spark, []), path, MODEL)
    assert tb.read_token_files(spark, path).count() == 0


def test_query_equals_library(spark, folder, library):
    from prosewell.plans.registry import QUERIES

    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op1_token_blocks"](spark, folder).collect()
    key = lambda r: r[0]
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found), key=key)
    assert got == expected(library, rows)
