import numpy as np
import pytest

from prosewell.llm import vector_scan as vs

SCHEMA = "vec_id long, embedding array<float>, label int, list int, search long, rank int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 7, 7, 7) for i, v in rows], SCHEMA)


def brute(rows, every, k):
    """Ranked answers over rows of usable vectors."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[i]), float(d[i])) for i in order]
    return out


def answers(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_odd_vectors(spark):
    good = [(i, [float(np.sin(i * k + k)) for k in range(1, 9)]) for i in range(0, 60)]
    copies = [(i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0]) for i in range(60, 120)]
    odd = [
        (200, None), (201, [None] * 8), (202, [0.0] * 8), (203, [float("nan")] * 8), (204, [1.0] * 5),
        (205, [float("inf")] + [1.0] * 7), (None, [1.0] * 8), (206, []),
    ]
    found = answers(vs.nearest(table(spark, good + copies + odd + good[:20]), every=10, probed=1.0))
    assert found == brute(good + copies, 10, 10)


def test_each_length_is_searched_among_its_own(spark):
    rng = np.random.default_rng(7)
    long = [(i, rng.normal(size=8).tolist()) for i in range(150)]
    short = [(1_000 + i, rng.normal(size=4).tolist()) for i in range(120)]
    lone = [(5_000, [1.0, 2.0, 3.0])]
    found = answers(vs.nearest(table(spark, long + short + lone), probed=1.0))
    assert found == brute(long, 100, 10) | brute(short, 100, 10)


def test_an_id_with_vectors_of_two_lengths(spark):
    rows = [(100, [0.0, 1.0]), (100, [1.0, 1.0, 1.0]), (1, [0.0, 3.0]), (1, [1.0, 1.0, 2.0]), (2, [1.0, 1.0, 9.0])]
    found = answers(vs.nearest(table(spark, rows), probed=1.0))
    assert found == {100: [(1, 1.0), (2, 8.0)]}


@pytest.mark.parametrize("rows", [300, 2_000])
def test_one_rule_at_every_size(spark, rows):
    """Small tables are probed like large ones, and reach the recall that is asked for."""
    rng = np.random.default_rng(rows)
    some = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(rows, 24)).astype(np.float32))]
    found, want = answers(vs.nearest(table(spark, some), every=20)), brute(some, 20, 10)
    assert {q: len(a) for q, a in found.items()} == {q: len(a) for q, a in want.items()}
    hits = [len({i for i, _ in found[q]} & {i for i, _ in want[q]}) / 10 for q in want]
    assert np.mean(hits) >= 0.9


def test_few_or_no_vectors(spark):
    assert vs.nearest(table(spark, [])).count() == 0
    assert vs.nearest(table(spark, [(0, [1.0, 2.0])])).count() == 0
    found = vs.nearest(table(spark, [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [0.0, 2.0])]))
    assert answers(found) == {0: [(1, 0.0), (2, 1.0)]}


def test_tests_drop_few_true_neighbours():
    rng = np.random.default_rng(4)
    x, q = rng.normal(size=(2_000, 64)), rng.normal(size=(40, 64))
    rotation, _ = np.linalg.qr(rng.normal(size=(64, 64)))
    d = vs.squared(q, x)
    bounds = np.partition(d, 19, axis=1)[:, 19]
    rotated = (x @ rotation).astype(np.float32)
    parts = [rotated[:, c : c + 8] for c in range(0, 64, 8)]
    a, b = vs.scan(q, bounds * (1 + 1e-9), parts, rotation)
    assert (d[a, b] <= bounds[a] * (1 + 1e-4)).all()
    assert len(a) >= 0.97 * (d <= bounds[:, None]).sum()
    everything = vs.scan(q, np.full(40, np.inf), parts, rotation)
    assert len(everything[0]) == d.size


@pytest.mark.parametrize("probed", [vs.PROBED])
def test_recall_of_probed_lists(spark, probed):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4_000, 32)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found, want = answers(vs.nearest(table(spark, rows), probed=probed)), brute(rows, 100, 10)
    assert all(len(found[q]) == 10 for q in want)
    hits = [len({i for i, _ in found[q]} & {i for i, _ in want[q]}) / 10 for q in want]
    assert np.mean(hits) >= 0.9
    exact = {q: dict(w) for q, w in want.items()}
    assert all(s == exact[q][i] for q, a in found.items() for i, s in a if i in exact[q])


def test_queries_with_too_few_answers_are_completed(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3_000, 16)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found = answers(vs.nearest(table(spark, rows), every=500, k=40, probed=0.001))
    assert {q: len(a) for q, a in found.items()} == dict.fromkeys(range(0, 3_000, 500), 40)
