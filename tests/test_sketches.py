"""Merged sketches against sketches of all and exact counts; multiset differences against counting."""

import bisect
import random
from collections import Counter

import pytest
from prosewell.operators import quality, sketches, temporal
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def daily(spark):
    """Documents of seven days; the words of a day overlap with the next day's."""
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrst"
    word = lambda i: "".join(letters[int(c)] for c in str(i))
    rows = []
    for i in range(2_100):
        day = i % 7
        n = rng.choice([0, 1, 3, 10, 60])
        text = " ".join(word(rng.randrange(day * 2_000, day * 2_000 + 6_000)) for _ in range(n))
        rows.append((i, day, None if i % 50 == 0 else text))
    return rows


def test_merged_days_equal_all_within_the_bounds(spark, daily):
    docs = spark.createDataFrame(daily, "doc_id long, day int, text string").repartition(5)
    by_day = sketches.sketch_profile(docs, "day")
    merged = sketches.read_profile(sketches.merge_profiles(by_day), (0.0, 0.25, 0.5, 0.9, 1.0)).first()
    whole = sketches.read_profile(sketches.merge_profiles(sketches.sketch_profile(docs.withColumn("all", F.lit(1)), "all"))).first()
    texts = [t or "" for _, _, t in daily]
    sizes = sorted(len(t) for t in texts)
    assert (merged.docs, merged.bytes, merged.blank) == (len(daily), sum(sizes), sum(not t for t in texts))
    assert merged.tokens == whole.tokens == sum(len(t.split()) for t in texts)
    for q, size in zip((0.0, 0.25, 0.5, 0.9, 1.0), merged.size_quantiles, strict=True):
        low, high = (f(sizes, size) / len(sizes) for f in (bisect.bisect_left, bisect.bisect_right))
        assert low - sketches.RANK_ERROR <= q <= high + sketches.RANK_ERROR
    words = {w for t in texts for w in t.split()}
    assert merged.distinct_words == pytest.approx(len(words), rel=4 / 2 ** (sketches.LOG_ENTRIES / 2))
    assert whole.distinct_words == pytest.approx(merged.distinct_words, rel=0.02)
    distinct = {t for _, _, t in daily if t is not None}
    assert merged.distinct_texts == pytest.approx(len(distinct), rel=4 * 1.04 / 2 ** (sketches.LOG_CELLS / 2))


def test_stored_profiles_take_new_days(spark, daily, tmp_path):
    """Yesterday's stored sketches and today's give the profile of both, without yesterday's texts."""
    docs = spark.createDataFrame(daily, "doc_id long, day int, text string")
    for day in (0, 1):
        sketches.sketch_profile(docs.filter(f"day = {day}"), "day").write.mode("append").parquet(str(tmp_path / "p"))
    stored = sketches.read_profile(sketches.merge_profiles(spark.read.parquet(str(tmp_path / "p")))).first()
    texts = [t or "" for _, d, t in daily if d < 2]
    assert stored.docs == len(texts) and stored.tokens == sum(len(t.split()) for t in texts)
    assert stored.distinct_words == pytest.approx(len({w for t in texts for w in t.split()}), rel=0.03)


def test_overlap_of_two_days(spark, daily):
    docs = spark.createDataFrame(daily, "doc_id long, day int, text string")
    sides = [sketches.sketch_profile(docs.filter(f"day = {d}"), "day") for d in (0, 2)]
    a, b = ({w for _, day, t in daily if day == d for w in (t or "").split()} for d in (0, 2))
    found = sketches.sketched_overlap(*sides).first()
    for value, exact in zip(found, (len(a & b), len(a - b), len(b - a)), strict=False):
        assert value == pytest.approx(exact, abs=0.03 * len(a | b))
    assert found.jaccard == pytest.approx(len(a & b) / len(a | b), abs=0.03)


def test_profiles_of_nothing(spark):
    docs = spark.createDataFrame([(1, None), (None, "")], "day int, text string")
    found = {r.day: r for r in sketches.read_profile(sketches.sketch_profile(docs, "day")).collect()}
    assert all((r.docs, r.tokens, r.bytes, r.blank, r.distinct_words) == (1, 0, 0, 1, 0) for r in found.values())
    assert found[1].distinct_texts == 0 and found[None].distinct_texts == 1
    assert sketches.sketch_profile(docs.limit(0), "day").count() == 0


def test_multiset_difference_against_counting(spark):
    rng = random.Random(5)
    sides = []
    for n in (300, 260):
        rows = [(rng.choice([None, *range(80)]), rng.choice(["hot"] * 8 + ["x", " x ", "y", "z", None, ""])) for _ in range(n)]
        sides.append(rows)
    a, b = (spark.createDataFrame(rows, "doc_id long, text string") for rows in sides)
    fold = lambda t: " ".join(t.split())
    counts = [Counter(fold(t) for _, t in rows if t is not None) for rows in sides]
    found = {tuple(r)[1:] for r in quality.text_multiplicities(a, b).collect()}
    assert found == {
        (counts[0][t], counts[1][t], (counts[0] & counts[1])[t], (counts[0] - counts[1])[t], (counts[1] - counts[0])[t])
        for t in counts[0] | counts[1]
    }
    rows = quality.multiset_difference(a, b).collect()
    for name, own, other, side in (("a", *counts, sides[0]), ("b", *reversed(counts), sides[1])):
        wanted = []
        for text in own:
            ids = sorted((i is None, i or 0, i) for i, t in side if t is not None and fold(t) == text)
            wanted += [(i, n < min(own[text], other[text])) for n, (*_, i) in enumerate(ids)]
        assert sorted(((r.doc_id, r.matched) for r in rows if r.side == name), key=str) == sorted(wanted, key=str)
    assert quality.multiset_difference(a.limit(0), b.limit(0)).count() == 0


def test_numbers_of_a_hot_key(spark):
    rng = random.Random(6)
    rows = [("hot" if rng.random() < 0.5 else rng.choice("abc"), rng.randrange(40), i) for i in range(700)]
    frame = spark.createDataFrame(rows, "k string, _t long, _tie int")
    found = {(r.k, r._t, r._tie): r._number for r in temporal.numbered(frame, ["k"], 20).collect()}
    for key in ("hot", "a", "b", "c"):
        mine = sorted((t, i) for k, t, i in rows if k == key)
        assert [found[key, t, i] for t, i in mine] == list(range(1, len(mine) + 1))
