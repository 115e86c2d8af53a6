import random
import re

import numpy as np
import pytest
import xxhash
from tables import ODD, documents

from prosewell.llm import simhash as sh


def brute_print(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, bits=2):
    """Least place of each place's group."""
    group = list(range(len(prints)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= bits:
                x, y = find(i), find(j)
                group[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def random_prints(n, seed):
    rng = random.Random(seed)
    out = [0, 0]
    while len(out) < n:
        base = rng.choice(out) if rng.random() < 0.7 else rng.getrandbits(64)
        for _ in range(rng.randint(0, 3)):
            base ^= 1 << rng.randrange(64)
        out.append(base)
    return out


@pytest.mark.parametrize("bits,long_list,forest", [(2, 256, False), (2, 1, True), (3, 4, True)])
def test_links_and_components(spark, bits, long_list, forest):
    prints = sorted(set(random_prints(400, bits)))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    entries = spark.createDataFrame([(p,) for p in signed], "fp long")
    edges = sh.links(entries, bits, long_list, forest)
    found = {frozenset((r.a % 2**64, r.b % 2**64)) for r in edges.collect()}
    want = {
        frozenset((a, b)) for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= bits
    }
    assert found == want if not forest else len(found) <= 12 * len(prints)
    roots = {r.node: r.root for r in sh.components(edges).collect()}
    groups = {}
    for p, g in zip(signed, brute_groups(prints, bits), strict=True):
        groups.setdefault(g, set()).add(p)
    for members in groups.values():
        assert {roots.get(p, p) for p in members} == {min(members)}


def test_long_chain(spark):
    chain = [0]
    for i in range(60):
        chain.append(chain[-1] ^ (3 << i))
    edges = spark.createDataFrame(list(zip(chain, chain[1:], strict=False)), "a long, b long")
    assert {r.root for r in sh.components(edges).collect()} == {0}


def test_fingerprint_of_pieces():
    text = "Alpha beta\tgamma " * 500
    whole = sh.fingerprint(text)
    old, sh.PIECE_BYTES = sh.PIECE_BYTES, 64
    try:
        pieces = list(sh._word_pieces(text.encode(), 64))
        assert sum(pieces, []) == text.encode().split() and len(pieces) > 50
    finally:
        sh.PIECE_BYTES = old
    assert whole == brute_print(text)


def test_odd_documents(spark):
    found = sh.near_copies(documents(spark, ODD)).collect()
    prints = [brute_print(t) for _, t, *_ in ODD]
    groups = brute_groups(prints)
    want = []
    for (doc_id, *_), p, g in zip(ODD, prints, groups, strict=True):
        ids = [o[0] for o, h in zip(ODD, groups, strict=True) if h == g and o[0] is not None]
        want.append((doc_id, f"{p:016x}", min(ids, default=None)))
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted((tuple(r) for r in found), key=key) == sorted(want, key=key)


def test_one_of_each(spark):
    docs = documents(spark, ODD)
    kept = sh.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 7, 8, 9]
    assert sh.one_of_each(documents(spark, [])).count() == 0


A, B, C = ("".join(f"{w}{i} " for i in range(40)) for w in "xyz")


@pytest.mark.parametrize(
    "rows",
    [
        [(3, A), (5, A), (5, B), (8, B)],
        [(None, A), (None, A), (None, B), (2, B), (2, B), (2, A), (2, C), (None, None), (4, "")],
        [(1, A)] * 5 + [(1, B)] * 3 + [(None, C)] * 4,
    ],
)
def test_every_group_keeps_one_row(spark, rows):
    """Repeated and missing ids: each text keeps exactly one row, that of the smallest id."""
    docs = documents(spark, [(i, t, "en", f"s{n % 2}") for n, (i, t) in enumerate(rows)])
    kept = sh.one_of_each(docs).collect()
    want = {}
    for i, t in rows:
        want.setdefault(t or "", set()).add(i)
    want = [(min((i for i in ids if i is not None), default=None), t) for t, ids in want.items()]
    assert sorted(((r.doc_id, r.text or "") for r in kept), key=str) == sorted(want, key=str)
    assert {tuple(r) for r in kept} <= {tuple(r) for r in docs.collect()}


def test_query_equals_brute_force(spark, folder):
    from prosewell.plans.registry import QUERIES

    rows = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    prints = [brute_print(r.text) for r in rows]
    want = {
        rows[i].doc_id: (f"{p:016x}", rows[g].doc_id)
        for i, (p, g) in enumerate(zip(prints, brute_groups(prints), strict=True))
    }
    found = QUERIES["op6_simhash_near_dedup"](spark, folder).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == want
    assert np.unique([r.doc_id for r in found]).size == len(rows)
