import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tables import ODD, documents

from prosewell.llm import piece_scan as ps

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXT = st.lists(
    st.sampled_from(["the", "word", " ", "  ", "\n", "▁", "é", "ing", "你", "x", ".", "tion", "\x00", "🙂"]), max_size=30
).map("".join)


@pytest.fixture(scope="module")
def pieces():
    return ps.load(MODEL)


@pytest.fixture(scope="module")
def library(pieces):
    """The library's own best-path search over the same pieces and scores."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for p in proto.pieces:
        if p.type == p.NORMAL:
            p.score = pieces.scores[p.piece]
    return SentencePieceProcessor(model_proto=proto.SerializeToString())


def whole(pieces, text):
    return np.frombuffer(ps.WordEncoder(pieces).encode([text])[0], "<i4").tolist()


def by_chunks(pieces, text, size):
    raw = " " + text
    starts = range(0, len(raw), size)
    parts = [ps._shown(raw[s : s + size + pieces.longest]) for s in starts]
    sizes = [min(size, len(raw) - s) for s in starts]
    ahead, came = ps.at_start(pieces.longest), []
    for p, n in zip(parts, sizes, strict=True):
        came.append(ps.came_from(pieces, p, n, ahead))
        ahead = ps.applied(ahead, ps.transfer(pieces, p, n))
    states = [0]
    for one in reversed(came):
        states.insert(0, one[states[0]])
    rows = zip(parts, sizes, states, states[1:], strict=False)
    return [i for p, n, a, b in rows for i in ps.best_path(pieces, p, a, n, b)]


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_round_trip_and_library(pieces, library, text):
    ids = whole(pieces, text)
    assert ps.decode(pieces, ids) == text
    if "▁" not in text and text:
        assert ids == library.encode(text) and library.decode(ids) == text


@settings(max_examples=150, deadline=None)
@given(TEXT | st.lists(st.sampled_from([" " * 9, "=" * 7, "-" * 5, "*" * 11, "ab", "\n"]), max_size=12).map("".join), st.integers(1, 40))
def test_chunks_give_the_same_ids(pieces, text, size):
    assert by_chunks(pieces, text, size) == whole(pieces, text)


@pytest.mark.parametrize("text", ["x" + " " * 101 + "y", "*" * 75, "=" * 300, "-" * 999, " \n" * 80, "the " + " " * 700])
@pytest.mark.parametrize("size", [16, 32, 33, 100])
def test_runs_across_borders(pieces, text, size):
    """Blanks and rule lines have many paths of equal sums; chunks take the one that the whole search takes."""
    assert by_chunks(pieces, text, size) == whole(pieces, text)


def test_matrices_combine_associatively(pieces):
    text = ps._shown(" internationalization of the thing")
    cut = [0, 3, 9, 20, len(text)]
    m = [ps.transfer(pieces, text[a:], b - a) for a, b in zip(cut, cut[1:], strict=False)]
    left = ps.combine(ps.combine(ps.combine(m[0], m[1]), m[2]), m[3])
    right = ps.combine(m[0], ps.combine(m[1], ps.combine(m[2], m[3])))
    assert (left == right).all()
    assert (left[0, 0] == ps.transfer(pieces, text, len(text))[0, 0]).all()


def test_odd_documents(spark, pieces):
    docs = documents(spark, ODD)
    encoded = ps.encode_documents(docs, MODEL, giant=40, chunk=11)
    found = ps.decode_documents(encoded, MODEL).collect()
    key = lambda r: (str(r[0]), r[1])
    got = sorted(((r.doc_id, r.text) for r in found), key=key)
    assert got == sorted(((d, t or "") for d, t, *_ in ODD), key=key)
    same = sorted(((r.doc_id, r.ids) for r in ps.encode_documents(docs, MODEL).collect()), key=str)
    assert same == sorted(((d, whole(pieces, t or "")) for d, t, *_ in ODD), key=str)
    assert same == sorted(((r.doc_id, r.ids) for r in encoded.collect()), key=str)
    assert ps.encode_documents(documents(spark, []), MODEL).count() == 0


def test_giant_documents_in_many_blocks(spark, pieces):
    """Repeated rows, long runs and prose by 7 characters at a time, in hundreds of chunks and dozens of blocks, spread over the tasks."""
    rows = [(1, "-" * 2_000, "en", "a"), (2, "some prose, then " * 150, "en", "a"), (2, "some prose, then " * 150, "en", "a"),
            (None, ("x" + " " * 90) * 20, "en", "a")]
    found = ps.encode_giant(documents(spark, rows).select("doc_id", "text"), MODEL, 7)
    got = sorted(((r.doc_id, r.ids) for r in found.collect()), key=str)
    assert got == sorted(((i, whole(pieces, t)) for i, t, *_ in rows), key=str)


def test_texts_of_chunks_are_not_broadcast(spark):
    docs = documents(spark, [(1, "word " * 3_000, "en", "a")]).select("doc_id", "text")
    plan = ps.encode_giant(docs, MODEL, 500)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    for block in plan.split("\n\n"):
        if "BroadcastExchange" in block and "Input" in block:
            assert "part#" not in block
    assert "Exchange" in plan and "REPARTITION_BY_NUM" in plan


def test_nothing_to_decode(spark):
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in ps.decode_documents(rows, MODEL).collect()} == {1: "", 2: ""}


def test_query_gives_texts_back(spark, folder):
    from prosewell.plans.registry import QUERIES

    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in rows}
    found = QUERIES["op10_sentencepiece_scan"](spark, folder).collect()
    assert {r.doc_id: r.text_sha256 for r in found} == want and len(found) == len(rows)
