import itertools
import random

import pytest
from tables import ODD, documents

from prosewell.llm import mixing


def water_fill(sizes, weights, share=1.5, most=2):
    """Targets by sharing out and capping until none is above."""
    budget, full = share * sum(sizes), set()
    while True:
        left = budget - sum(most * sizes[i] for i in full)
        rest = [i for i in range(len(sizes)) if i not in full]
        weight = sum(weights[i] for i in rest)
        over = [i for i in rest if left * weights[i] / weight > most * sizes[i]]
        if not over:
            return [most * s if i in full else left * weights[i] / weight for i, s in enumerate(sizes)]
        full |= set(over)


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1000, 10, 10, 500], [7], [0, 50, 0, 3], [5, 5, 900, 1, 1, 1, 40]])
def test_targets(spark, sizes):
    rows = [(f"s{i}", s) for i, s in enumerate(sizes)]
    totals = mixing.rotating_weights(spark.createDataFrame(rows, "source string, source_size long"))
    found = {r.source: r.target for r in mixing.share_out(totals).collect()}
    want = water_fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))])
    assert [found[s] for s, _ in rows] == pytest.approx(want)
    assert sum(found.values()) == pytest.approx(1.5 * sum(sizes))


def test_weights_by_code_point_and_null_last(spark):
    rows = [(None, 1), ("é", 1), ("a", 1), ("Z", 1), ("", 1)]
    found = mixing.rotating_weights(spark.createDataFrame(rows, "source string, source_size long"))
    assert {r.source: r.weight for r in found.collect()} == {"": 5, "Z": 2, "a": 1, "é": 5, None: 2}


@pytest.mark.parametrize("bits,level", [(60, 12), (60, 3), (8, 3)])
def test_threshold_is_nearest(spark, bits, level):
    rng = random.Random(level)
    docs = [(rng.choice(["a", "b", None]), rng.choice([0, 1, 5, 400]), rng.getrandbits(bits)) for _ in range(300)]
    # Rows of one turn are rows of one document, so of one size.
    size_of = {}
    docs = [(o, size_of.setdefault((o, t), s), t) for o, s, t in docs + docs[:5] + [("a", 40, 77)] * 60]
    sizes = spark.createDataFrame(docs, "source string, size long, turn long")
    for share in (0.1, 0.7, 1.5, 1.99):
        totals = mixing.share_out(mixing.rotating_weights(mixing.source_totals(sizes)), share)
        plan = {r.source: r for r in mixing.thresholds(sizes, totals, bits, level).collect()}
        for source, row in plan.items():
            own = [(t, s) for o, s, t in docs if o == source]
            rest = row.target - row.passes * row.source_size
            taken = sum(s for t, s in own if t <= row.threshold)
            at_edge = [s for t, s in own if t == row.edge]
            assert row.edge is None or (row.edge > row.threshold and 0 <= row.edge_rows <= len(at_edge))
            taken += sum(at_edge[: row.edge_rows or 0])
            sums = [0, *itertools.accumulate(s for _, s in sorted(own))]
            assert abs(taken - rest) == pytest.approx(min(abs(x - rest) for x in sums))


def test_mix_of_odd_documents(spark):
    docs = documents(spark, ODD)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    counts = {(r.doc_id, r.text): r["count"] for r in mixed.groupBy("doc_id", "text").count().collect()}
    originals = {(r.doc_id, r.text): r["count"] for r in docs.groupBy("doc_id", "text").count().collect()}
    assert all(n <= 2 * originals[k] for k, n in counts.items())
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.mix(docs).collect()))
    assert mixing.mix(documents(spark, [])).count() == 0


@pytest.mark.parametrize("ids", [[7] * 101, [None] * 101, list(range(50)) + [None] * 51])
def test_equal_rows_do_not_go_together(spark, ids):
    """101 rows of one text and of few ids, next to a source of other texts: the target is met to half a row."""
    same = "word " * 101
    docs = documents(spark, [(i, same, "en", "a") for i in ids] + [(900 + i, f"t{i} " * 30, "en", "b") for i in range(400)])
    sizes = mixing.sized(docs)
    rows = mixing.mixed(sizes, mixing.plan_mix(sizes)).filter("source = 'a'").collect()
    assert len(rows) == 101 and {r.copies for r in rows} <= {0, 1, 2}
    assert abs(sum(r["size"] * r.copies for r in rows) - rows[0].target) <= 101 / 2
    mixed = sorted(map(str, mixing.mix(docs).collect()))
    assert mixed == sorted(map(str, mixing.mix(docs).collect()))
    assert len([r for r in mixed if "source='a'" in r]) == sum(r.copies for r in rows)


def test_sources_come_near_their_targets(spark, folder):
    from prosewell.plans.registry import QUERIES

    rows = QUERIES["op4_source_mix"](spark, folder).collect()
    assert all(r.taken <= 2 * r["size"] for r in rows)
    largest = max(r["size"] for r in rows)
    sources = {}
    for r in rows:
        sources.setdefault((r.source_size, r.target), []).append(r)
    for (_, target), group in sources.items():
        assert abs(sum(r.taken for r in group) - target) <= largest * len(group) / 2
    assert sum(r.taken for r in rows) == pytest.approx(1.5 * sum(r["size"] for r in rows), rel=0.05)
