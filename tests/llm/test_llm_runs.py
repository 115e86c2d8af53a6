import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tables import ODD, documents

from prosewell.llm import periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, min_length=6, min_exponent=4):
    """Every period's stretches, by comparing the words one by one."""
    n, out = len(words), []
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j + q - i
            if j > i and size >= max(min_length, min_exponent * q):
                smaller = (words[i : i + size - r] == words[i + r : i + size] for r in range(1, q))
                if not any(smaller):
                    out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


a_document = st.lists(st.integers(0, 3), max_size=40) | st.builds(
    lambda head, root, times, tail: head + root * times + tail,
    st.lists(st.integers(0, 2), max_size=5), st.lists(st.integers(0, 2), min_size=1, max_size=7),
    st.integers(2, 8), st.lists(st.integers(0, 2), max_size=5),
)


@settings(max_examples=400, deadline=None)
@given(st.lists(a_document, max_size=4), st.sampled_from([(2, 2), (6, 4), (1, 3)]))
def test_runs_equal_plain_search(some, least):
    codes = np.array([c for d in some for c in d], dtype=np.int64)
    found = periodic_runs.find_runs(codes, np.array([len(d) for d in some], dtype=np.int64), *least)
    got = list(zip(*(x.tolist() for x in found), strict=True))
    assert got == [(i, *r) for i, d in enumerate(some) for r in plain_runs(d, *least)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60))
def test_suffix_array_and_intervals(codes):
    n = len(codes)
    order, levels = periodic_runs.suffix_ranks(np.array(codes), np.full(n, n))
    assert order.tolist() == sorted(range(n), key=lambda i: codes[i:])
    assert levels[-1][order].tolist() == list(range(n))


def test_long_runs_stay_cheap():
    one = np.zeros(200_000, dtype=np.int64)
    found = periodic_runs.find_runs(one, np.array([len(one)]), 6, 4)
    assert [x.tolist() for x in found] == [[0], [0], [200_000], [1]]
    seven = np.arange(200_000) % 7
    assert [x.tolist() for x in periodic_runs.find_runs(seven, np.array([len(seven)]))] == [[0], [0], [200_000], [7]]


def test_odd_documents(spark):
    more = [(20, "a b a b a b a b c c c c c c d", "en", "a"), (21, "x " * 7 + "y z " * 5, "en", "a")]
    rows = periodic_runs.collapse_runs(documents(spark, ODD + more)).collect()
    key = lambda r: (str(r[0]), r[3])
    found = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in rows]
    wanted = []
    for doc_id, text, *_ in ODD + more:
        words = WORD.findall(text or "")
        runs = [(0, 30_000, 1)] if doc_id == 8 else plain_runs(words)
        wanted.append((doc_id, len(words), runs, plain_collapse(words, runs)))
    assert sorted(found, key=key) == sorted(wanted, key=key)
    assert periodic_runs.collapse_runs(documents(spark, [])).count() == 0


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = planted(doc_id, WORD.findall(text or ""))
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    milli = best[1] * 1000 // best[2] if runs else None
    return len(runs), *best, milli, digest(lines), digest(plain_collapse(words, runs))


@pytest.mark.parametrize("name", ["op12_periodic_runs"])
def test_query_equals_plain_search(spark, folder, name):
    from prosewell.plans.registry import QUERIES

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES[name](spark, folder).collect()
    assert len(rows) == len(docs) and any(r.n_runs for r in rows)
    # The plain search takes the square of a text's length: the longest texts are left to the tests above.
    short = {i for i, t in docs.items() if len(t or "") < 12_000}
    assert len(short) > 150
    for r in rows:
        if r.doc_id in short:
            assert tuple(r)[1:] == expected(r.doc_id, docs[r.doc_id])


def test_planted_runs(spark, tmp_path):
    rows = [(i, " ".join(f"w{i}x{j % 50}" for j in range(i % 37))) for i in range(300)]
    rows += [(None, "a a a a a a a"), (40, None), (40, ""), (40, "  \n "), (40, "b " * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    from prosewell.plans.registry import QUERIES

    found = sorted((tuple(r) for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()), key=str)
    assert found == sorted(((i, *expected(i, t)) for i, t in rows), key=str)
