"""The exact similarity join against brute force."""

import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from prosewell.operators import quality, similarity
from pyspark.sql.classic.dataframe import DataFrame


def brute_force(sets, threshold):
    out = {}
    for (i, a), (j, b) in itertools.combinations(sorted(sets.items()), 2):
        value = len(a & b) / len(a | b)
        if value >= threshold and a != b:
            out[i, j] = value
    return out


def joined(spark, sets, threshold):
    rows = [(i, sorted(s)) for i, s in sets.items()]
    frame = spark.createDataFrame(rows, "doc_id long, shingles array<long>")
    _, classes = similarity.set_classes(frame)
    leader = {r["_id"]: r.leader for r in classes.collect()}
    found = similarity.similar_classes(classes, threshold).collect()
    assert len({(r.a, r.b) for r in found}) == len(found)
    return {tuple(sorted((leader[r.a], leader[r.b]))): r.jaccard for r in found}


def test_many_random_sets(spark):
    """Sets of all lengths from a few base sets by small edits, at thresholds that counts hit exactly."""
    rng = random.Random(11)
    sets, seen = {}, set()
    bases = [rng.sample(range(4_000), k) for k in (1, 2, 4, 5, 9, 10, 15, 20, 40, 100) for _ in range(4)]
    for i in range(700):
        base = set(rng.choice(bases))
        for _ in range(rng.choice([0, 1, 1, 2, 5, 12])):
            base.discard(rng.choice(sorted(base))) if base and rng.random() < 0.5 else base.add(rng.randrange(4_100))
        if base and frozenset(base) not in seen:
            seen.add(frozenset(base))
            sets[i] = base
    for threshold in (0.8, 0.5, 1.0):
        wanted = brute_force(sets, threshold)
        assert joined(spark, sets, threshold) == pytest.approx(wanted)
        assert wanted or threshold == 1


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.frozensets(st.integers(0, 12), min_size=1, max_size=12), min_size=2, max_size=40, unique=True))
def test_dense_sets(spark, sets):
    sets = dict(enumerate(sets))
    assert joined(spark, sets, 0.6) == pytest.approx(brute_force(sets, 0.6))


def test_a_hot_group_of_near_copies(spark):
    """A third of all sets share most elements: every link is found, and the hot elements stay out of the prefixes."""
    sets = {i: set(range(60)) - {i % 60} | {1_000 + i // 60} for i in range(150)}
    sets |= {i: set(range(10_000 + 50 * i, 10_000 + 50 * i + 30)) | {0, 1, 2} for i in range(150, 450)}
    wanted = brute_force(sets, 0.8)
    assert len(wanted) > 10_000 and joined(spark, sets, 0.8) == pytest.approx(wanted)


def shingles(text):
    words = re.findall("[a-z]+", text.lower())
    return frozenset(" ".join(words[i : i + 5]) for i in range(len(words) - 4)) or frozenset([" ".join(words)])


def test_documents_with_repeated_and_missing_keys(spark):
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    edited = base + " eighteen"
    rows = [(1, base), (2, base.upper()), (2, edited), (None, base + "!"), (None, None), (3, ""), (4, " ; "), (5, "short"),
            (6, "short"), (6, "short"), (7, "alone"), (2, edited)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r.doc_id, r.leader, r.jaccard) for r in similarity.exact_near_duplicates(docs).collect()), key=str)
    near = len(shingles(base) & shingles(edited)) / len(shingles(base) | shingles(edited))
    assert near >= 0.8
    assert found == sorted([(2, 1, 1.0), (None, 1, 1.0), (6, 5, 1.0), (6, 5, 1.0), (2, 1, near)], key=str)
    assert similarity.exact_near_duplicates(docs.limit(0)).count() == 0


def test_the_min_hash_form_finds_no_more(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    exact = {(r.doc_id, r.leader): r.jaccard for r in similarity.exact_near_duplicates(docs).collect()}
    sketched = {(r.doc_id, r.leader): r.jaccard for r in quality.near_duplicates(docs).collect()}
    assert sketched.keys() <= exact.keys() and all(exact[p] == pytest.approx(v) for p, v in sketched.items())
    assert len({k for k, _ in sketched}) >= 0.95 * len({k for k, _ in exact})


def test_shingles_equal_a_plain_list():
    """As many distinct shingles as a plain set has, shared alike between texts; short texts are one shingle of their own."""
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["a", "b", "It's", "é", "K", "x1y"]) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    found = similarity.shingle_hashes([*texts, None], 5, {})
    assert len(found[-1]) == 0
    plain = []
    for text in texts:
        words = re.findall("[a-z]+", text.lower())
        plain.append({" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    for (f, p), (g, q) in itertools.product(zip(found, plain), repeat=2):
        assert len(f) == len(p) and len(np.intersect1d(f, g)) == len(p & q)


def test_elements_may_fall_together(spark, monkeypatch):
    """Cut to a few bits, many elements count as one: the pairs stay the same."""
    rng = random.Random(4)
    sets = {i: set(rng.sample(range(10**12), 12)) for i in range(120)}
    sets |= {200 + i: (sets[i] - {min(sets[i])}) | {5} for i in range(60)}
    monkeypatch.setattr(similarity, "set_bits", lambda n: 6)
    assert joined(spark, sets, 0.8) == pytest.approx(brute_force(sets, 0.8))


def test_no_pair_of_all_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    plan = similarity.exact_near_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_words_are_hashed_alike_in_blocks(monkeypatch):
    """Where a block of words ends, and beside what texts a text stands, changes no hash."""
    texts = ["one two three four five six", "x" * 3000 + " b c d e", "", None, "six five four three two one " * 5]
    whole = similarity.shingle_hashes(texts, 5, {})
    monkeypatch.setattr(similarity, "WORD_BLOCK", 3)
    apart = [similarity.shingle_hashes([t], 5, {})[0] for t in texts]
    assert [w.tolist() for w in whole] == [a.tolist() for a in apart]
    assert [len(w) for w in whole] == [2, 1, 0, 0, 6]


def test_prefixes_are_placed_without_a_list_per_set(spark):
    """Places come from running sums, which spill; the elements of a set are not gathered in one value. Equal rows of one set count once."""
    rows = [(e, i, 3, 1) for e, i in ((1, 10), (1, 10), (1, 11), (2, 10), (2, 11), (2, 12), (3, 12), (4, 11))]
    elements = spark.createDataFrame(rows, "element long, _id long, _n int, _m int")
    shared = similarity.shared_elements(elements)
    assert sorted((r.element, r._id, r.sets) for r in shared.collect()) == [(1, 10, 2), (1, 11, 2), (2, 10, 3), (2, 11, 3), (2, 12, 3)]
    index = similarity.prefix_index(shared, 0.5)
    assert "collect_list" not in index._jdf.queryExecution().toString()
    assert sorted((r._id, r.element, r.place, r.last) for r in index.collect()) == [(10, 1, 1, 1), (11, 1, 1, 1)]


def passages(rng, docs):
    """Documents of shared and own passages, some of them copies with an edited word."""
    def word():
        return "".join(rng.choice("abcdefgh") for _ in range(rng.choice([1, 3, 5, 18])))

    common = [[word() for _ in range(rng.randint(6, 25))] for _ in range(12)]
    texts = []
    for i in range(docs):
        if texts and rng.random() < 0.4:
            words = texts[rng.randrange(max(0, i - 15), i)].split()
            words[rng.randrange(len(words))] = word()
        else:
            words = [w for _ in range(rng.randint(1, 4)) for w in (rng.choice(common) if rng.random() < 0.6 else [word() for _ in range(rng.randint(1, 30))])]
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("several, most, size", [(2, 1 << 21, 1 << 20), (4, 60, 40), (4, 0, 1 << 20)])
def test_documents_of_shared_passages(spark, monkeypatch, several, most, size):
    """No pair is missed, whatever elements are put last in the order and however the places of pairs are cut."""
    monkeypatch.setattr(similarity, "SEVERAL", several)
    monkeypatch.setattr(similarity, "MOST_FREQUENT", most)
    monkeypatch.setattr(similarity, "SLICE_ELEMENTS", size)
    texts = passages(random.Random(several + most), 260)
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(3)
    for threshold in (0.8, 0.45):
        sets = {}
        for i, t in enumerate(texts):
            sets.setdefault(shingles(t), i)
        wanted = {(j, i): v for (i, j), v in brute_force({i: s for s, i in sets.items()}, threshold).items()}
        found = [r for r in similarity.exact_near_duplicates(docs, threshold).collect() if r.jaccard < 1]
        assert {(r.doc_id, r.leader): r.jaccard for r in found} == pytest.approx(wanted) and len(found) == len(wanted) > 40


def test_only_the_first_elements_move(spark, folder):
    """A fifth of the elements is handed on, not all of them."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    n, first = similarity.document_prefixes(docs, 5, "text", 0.8).selectExpr("sum(_n)", "sum(size(prefix))").first()
    assert 0 < first < 0.22 * n
    index = similarity.document_index(docs, 5, "text", 0.8, (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32)), 7)
    rows = index.selectExpr("count(*) AS n", "count(DISTINCT element, _id) AS pairs", "max(place / _n) AS place").first()
    assert 0 < rows.n == rows.pairs < first and rows.place <= 0.2


def test_first_elements_equal_a_plain_sort():
    rng = random.Random(6)
    sets = [np.array(sorted(rng.sample(range(200), rng.randint(1, 60))), dtype=np.uint64) for _ in range(80)]
    late = rng.sample(range(200), 120)
    rank = {e: i for i, e in enumerate(late)}
    order = sorted(late)
    last = np.array(order, dtype=np.uint64), np.array([rank[e] for e in order], dtype=np.int32)
    # Marks that several elements share.
    marks = np.zeros(64, dtype=bool)
    marks[last[0] & np.uint64(63)] = True
    element, number, place = similarity._first_elements(sets, last, marks, 0.7)
    wanted = []
    for i, s in enumerate(sets):
        ordered = sorted(s.tolist(), key=lambda e: (e in rank, rank.get(e, e)))
        wanted += [(e, i, k) for k, e in enumerate(ordered[: int(similarity.prefix_size(np.array([len(s)]), 0.7)[0])])]
    assert sorted(zip(element.tolist(), number.tolist(), place.tolist())) == sorted(wanted)


def test_sets_of_a_group_move_once(spark, monkeypatch):
    """All pairs of 60 near copies meet in one place, each set as often as it has a side there; slices add a row per slice."""
    pairs = spark.createDataFrame([(a, b, 10) for a in range(60) for b in range(a + 1, 60)], "a long, b long, _n int")
    rows = similarity.meeting_places(pairs).collect()
    assert len(rows) == 2 * 59 and len({(r.home, r.slice) for r in rows}) == 1
    assert sorted((p, r.id) for r in rows for p in r.partners) == sorted((r.a, r.b) for r in pairs.collect())
    monkeypatch.setattr(similarity, "SLICE_ELEMENTS", 100)
    cut = similarity.meeting_places(pairs).collect()
    held = {}
    for r in cut:
        held.setdefault((r.home, r.slice), set()).add(r.id) if r.side == 0 else None
    assert len(held) == 6 and sum(map(len, held.values())) == 59
    assert all(p in held[r.home, r.slice] for r in cut for p in r.partners)
    monkeypatch.setattr(similarity, "SLICE_ELEMENTS", 1 << 20)
    monkeypatch.setattr(similarity, "SLICE_PAIRS", 600)
    assert len({r.slice for r in similarity.meeting_places(pairs).collect()}) == 3


def test_pairs_leave_the_join_once_per_stretch_of_common_entries(spark):
    """A pair whose entries before also meet has met there: 40 near copies of 200 elements give little more than a row per pair."""
    rng = random.Random(2)
    sets = [sorted({*range(1_000, 1_200)} - {rng.randrange(1_000, 1_200)}) for _ in range(40)]
    rows = [(e, k, k, i, len(s)) for i, s in enumerate(sets) for k, e in enumerate(s[:40])]
    index = spark.createDataFrame(rows, "element long, place int, last int, _id long, _n int")
    seen = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(DataFrame, "distinct", lambda df: seen.append(df.count()) or df.dropDuplicates())
        found = similarity.candidate_pairs(index, 0.8).collect()
    assert sorted((min(r.a, r.b), max(r.a, r.b)) for r in found) == [*itertools.combinations(range(40), 2)]
    assert len(found) <= seen[-1] < 2 * len(found)


def test_bits_tell_no_more_elements_apart_than_there_are():
    rng = np.random.default_rng(9)
    for size, other in ((1, 1), (30, 40), (900, 20), (3_000, 3_000)):
        a, b = (np.unique(rng.integers(-(2**62), 2**62, n)) for n in (size, other))
        b = np.union1d(b, a[: size // 2])
        apart = len(np.setxor1d(a, b))
        assert 0 <= int(np.bitwise_count(similarity.odd_bits(a) ^ similarity.odd_bits(b)).sum()) <= apart
    assert similarity.odd_bits(a).tolist() == similarity.odd_bits(a[::-1]).tolist()
