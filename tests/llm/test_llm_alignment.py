import hashlib
from bisect import bisect_left
from collections import Counter
from functools import reduce

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tables import ODD, documents
from tokenizers import Tokenizer

from prosewell.llm import alignment

A_FILE = public_tokenizers.path("byte_bpe_50k.json")
B_FILE = public_tokenizers.path("piece_bpe_32k.model")
TABLES = alignment.TokenTables(A_FILE, B_FILE, cached=30)
A = Tokenizer.from_file(A_FILE)
A.encode_special_tokens = True
B = SentencePieceProcessor(model_file=B_FILE)
LETTERS = alignment._byte_of_letter()


def plain_tokens(text):
    """(id, start, end) of both libraries' tokens of the whole text; none where bytes are lost."""
    if not text:
        return [], []
    a = [(i, bytes(LETTERS[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in B.encode(text):
        piece = B.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()))
    wanted = (" " + text).encode()
    if not b"".join(x for _, x in a) == wanted == b"".join(x for _, x in b):
        return [], []
    sides = []
    for tokens in (a, b):
        at, side = 0, []
        for i, spelled in tokens:
            side.append((i, at, at + len(spelled)))
            at += len(spelled)
        sides.append(side)
    return tuple(sides)


def plain(text):
    """(n_a, n_b, n_groups, groups, links) by looking at every token's bytes."""
    a, b = plain_tokens(text)
    cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
    groups = [([], []) for _ in cuts]
    for side in (0, 1):
        for i, _, e in (a, b)[side]:
            groups[bisect_left(cuts, e)][side].append(str(i))
    groups = ["|".join(map(",".join, g)) for g in groups]
    links, k = Counter(), 0
    for i, s, e in a:
        while k < len(b) and b[k][2] <= s:
            k += 1
        m = k
        while m < len(b) and b[m][1] < e:
            links[i, b[m][0]] += 1
            m += 1
    return len(a), len(b), len(cuts), ";".join(groups), links


def as_plain(row):
    links = Counter({(x["a"], x["b"]): x["n"] for x in row.links})
    assert row.n_links == links.total() and len(links) == len(row.links)
    return row.n_a, row.n_b, row.n_groups, row.groups, links


some_text = st.text(max_size=60) | st.text("ab é.,\n\t 你▁1'", max_size=60) | st.sampled_from(
    ["the  quick\n brown", " lead", "trail ", "a\x1c b", "x  y", "<|endoftext|> </s>", "\n\n  y", "don't stop.", "\0 a", "a "]
)


def clean(text):
    return text.encode("utf-8", "replace").decode()


@settings(max_examples=300, deadline=None)
@given(st.lists(some_text.map(clean), max_size=6))
def test_batches_equal_libraries(texts):
    columns = [c.to_pylist() for c in alignment._align_batch(texts, TABLES)]
    for text, n_a, n_b, n_groups, n_links, groups, links in zip(texts, *columns, strict=True):
        found = Counter({(x["a"], x["b"]): x["n"] for x in links})
        assert (n_a, n_b, n_groups, groups, found) == plain(text) and n_links == found.total()


def parts(text, size, piece):
    return [
        f for at, part in alignment.pieces_of(text, piece)
        for _, f in alignment.range_fragments(at, part, TABLES, size)
    ]


def same(x, y):
    return alignment._row(x) == alignment._row(y)


@settings(max_examples=200, deadline=None)
@given((some_text | st.lists(some_text, max_size=5).map(" ".join)).map(clean), st.integers(1, 20), st.integers(1, 30), st.data())
def test_fragments_are_a_monoid(text, size, piece, data):
    some = parts(text, size, piece)
    join = lambda x, y: alignment.compose(x, y, TABLES)
    left = reduce(join, some, alignment.EMPTY)
    right = reduce(lambda x, y: join(y, x), reversed(some), alignment.EMPTY)
    while len(some) > 1:
        k = data.draw(st.integers(0, len(some) - 2))
        some[k : k + 2] = [join(some[k], some[k + 1])]
    tree = some[0] if some else alignment.EMPTY
    if tree.ok:
        assert same(left, tree) and same(right, tree)
    whole = alignment.finished(left, TABLES)
    assert (whole.n_a, whole.n_b, whole.n_groups, whole.groups, whole.links) == plain(text)
    assert alignment.finished(tree, TABLES) == whole == alignment.finished(right, TABLES)


def test_rows_travel_unchanged():
    some = parts("some words, don't 你好 align\n\nhere", 2, 1000)
    assert any(f.has_cut for f in some) and any(not f.has_cut for f in some)
    for one in some:
        assert same(alignment._fragment(alignment._row(one)), one)


@pytest.mark.parametrize(("piece", "size"), [(alignment.PIECE, alignment.RANGE), (40, 16)])
def test_odd_documents(spark, piece, size):
    more = [(21, "wordy text, of many words\nand lines. " * 60, "en", "a"), (22, "你好 " * 50, "en", "a"),
            (23, "kept words " * 9 + "▁ lost", "en", "a")]
    rows = [r if len(r[1] or "") < 20_000 else (r[0], r[1][:2_000], *r[2:]) for r in ODD] + more
    found = alignment.align_documents(documents(spark, rows), A_FILE, B_FILE, piece=piece, size=size)
    got = sorted(((r.doc_id, *as_plain(r)) for r in found.collect()), key=str)
    assert got == sorted(((r[0], *plain(r[1])) for r in rows), key=str)
    assert alignment.align_documents(documents(spark, []), A_FILE, B_FILE).count() == 0


def test_giant_words(spark):
    """No place to cut at: one piece, many byte ranges, and groups that span some of them."""
    rows = [(1, "x" * 70_000, "en", "a"), (2, "é你" * 15_000, "en", "a"), (3, "= " * 40_000, "en", "a")]
    found = alignment.align_documents(documents(spark, rows), A_FILE, B_FILE)
    assert sorted((r.doc_id, *as_plain(r)) for r in found.collect()) == [(r[0], *plain(r[1])) for r in rows]


def expected(docs):
    found = {i: plain(t) for i, t in docs}
    held = Counter(pair for one in found.values() for pair in one[4])
    most = Counter()
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    out = []
    for i, (n_a, n_b, n_groups, groups, links) in found.items():
        best = sum(n for pair, n in links.items() if held[pair] == most[pair[0]])
        total = sum(n * held[pair] for pair, n in links.items())
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        out.append((i, n_a, n_b, n_groups, links.total(), best, total, digest))
    return sorted(out)


@pytest.mark.parametrize("broadcast", [True, False])
def test_query_equals_plain_alignment(spark, folder, monkeypatch, broadcast):
    from prosewell.plans.registry import QUERIES

    if not broadcast:
        monkeypatch.setattr(alignment, "PAIR_ROWS", 10)
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op11_fragment_alignment"](spark, folder)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(tuple(r) for r in found.select(columns).collect()) == expected([tuple(r) for r in rows])
