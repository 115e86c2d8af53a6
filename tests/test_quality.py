"""Copies and near copies against brute force, and the stream against the batch."""

import itertools
import random
import re

import numpy as np
import pytest
from prosewell.operators import opinion, quality
from prosewell.plans import fixtures as fx
from prosewell.streaming.scoring import score_stream

BASE = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(120)]


def shingles(text, n=5):
    words = re.findall("[a-z]+", text.lower())
    return {" ".join(words[i : i + n]) for i in range(len(words) - n + 1)} or {" ".join(words)}


@pytest.fixture(scope="module")
def texts():
    """A third of the rows are one text with small edits; the rest are unlike each other."""
    out = {}
    for i in range(20):
        words = list(BASE)
        words[5 * i] = "edit" + chr(97 + i)
        out[i] = " ".join(words)
    for i in range(20, 60):
        out[i] = " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{w}" for w in BASE[: 30 + i])
    out[60], out[61], out[62], out[63] = out[25], "  " + out[25].upper(), "one two", "one two"
    out[64] = " . "
    return out


def test_near_duplicates_against_brute_force(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {(r.doc_id, r.leader): r.jaccard for r in quality.near_duplicates(docs, 0.8).collect()}
    sets = {i: shingles(t) for i, t in texts.items() if re.search("[a-z]", t.lower())}
    near = {
        (b, a): len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        for a, b in itertools.combinations(sorted(sets), 2)
    }
    for pair, value in got.items():
        assert near[pair] == pytest.approx(value) and value >= 0.8
    followers = {b for (b, a), v in near.items() if v >= 0.8}
    assert {b for b, _ in got} == followers
    assert len(got) < 2 * len(texts)  # linear, though 190 pairs of the hot group are near


def test_fresh_min_hashes_part_what_the_signature_cannot(spark, texts):
    """With a signature of one min-hash, every further round needs a fresh one."""
    docs = spark.createDataFrame([(i, t) for i, t in texts.items() if i < 30], "doc_id long, text string")
    found = {(r.doc_id, r.leader) for r in quality.near_duplicates(docs, 0.8, bands=1, rows=1).collect()}
    # One band finds fewer pairs, but only near ones, and the rounds come to an end.
    followers = {b for b, _ in found}
    assert followers <= set(range(1, 20)) and len(followers) > 10


def test_null_texts_are_no_copies(spark):
    docs = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "a"), (5, " a")], "doc_id long, text string")
    assert sorted(r.doc_id for r in quality.drop_duplicates(docs).collect()) == [1, 2, 3]
    assert [(r["first"], r.copies) for r in quality.exact_duplicates(docs).collect()] == [(3, 3)]


def test_duplicates(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sets = {r["first"]: r.copies for r in quality.exact_duplicates(docs).collect()}
    assert sets == {25: 2, 62: 2}
    assert quality.drop_duplicates(docs).count() == len(texts) - 2
    assert [r.doc_id for r in quality.blank_documents(docs).collect()] == [64]


def test_stream_resumes_and_equals_the_batch(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    lexicon = fx.opinion_lexicon(spark)
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    docs.filter("doc_id % 2 = 0").write.parquet(source)
    first = score_stream(spark, source, "doc_id bigint, text string", lexicon, target)
    assert first.count() == docs.filter("doc_id % 2 = 0").count()
    docs.filter("doc_id % 2 = 1").write.mode("append").parquet(source)
    both = score_stream(spark, source, "doc_id bigint, text string", lexicon, target, files_per_batch=2)
    batch = opinion.classify_polarity(opinion.count_polarity(docs, lexicon))
    assert sorted(both.select(batch.columns).collect()) == sorted(batch.collect())


@pytest.mark.parametrize("limit", [opinion.INLINE_WORDS, 3])
def test_stream_after_a_batch_that_was_killed(spark, folder, tmp_path, monkeypatch, limit):
    """Files of a batch that never was committed are not seen, and the batch is written once more; with sets and with a join."""
    import glob
    import os

    monkeypatch.setattr(opinion.inline_words, "__defaults__", (limit,))
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(docs.limit(3)).unionByName(docs.limit(1).selectExpr("NULL AS doc_id", "CAST(NULL AS string) AS text"))
    lexicon = fx.opinion_lexicon(spark)
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    args = spark, source, "doc_id bigint, text string", lexicon, target
    assert score_stream(*args).count() == 0
    os.makedirs(source)
    assert score_stream(*args).count() == 0
    docs.repartition(4).write.mode("append").parquet(source)
    first = score_stream(*args, files_per_batch=2)
    batch = opinion.classify_polarity(opinion.count_polarity(docs, lexicon))
    wanted = sorted(batch.select(first.columns).collect(), key=str)
    assert sorted(first.collect(), key=str) == wanted
    whole = spark.read.parquet(f"{target}/rows").count()
    # Take back the last batch's commit, as if the driver had died between writing and committing.
    os.remove(max(glob.glob(f"{target}/progress/commits/[0-9]*"), key=os.path.getmtime))
    for crc in glob.glob(f"{target}/progress/commits/.*.crc") + glob.glob(f"{target}/rows/_spark_metadata/.*.crc"):
        os.remove(crc)
    os.remove(max(glob.glob(f"{target}/rows/_spark_metadata/[0-9]*"), key=os.path.getmtime))
    assert spark.read.parquet(f"{target}/rows").count() < whole
    again = score_stream(*args, files_per_batch=2)
    assert sorted(again.collect(), key=str) == wanted
    assert sorted(score_stream(*args).collect(), key=str) == wanted


def test_md5_shingles_and_min_hashes_equal_plain_ones(spark):
    """Hashes made in numpy equal those of the library and of the plan, also beyond one block of MD5; values at the ends of the field too."""
    rng = random.Random(3)
    words = ["a", "It's", "é", "K", "of", "w" * 11, "x" * 60, "ß1y", "longerword"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(150)] + ["", "...", "a b c d e"]
    docs = spark.createDataFrame([*enumerate(texts), (999, None)], "doc_id long, text string")
    plain = quality.shingle_sets(docs, hashed=lambda g: quality.md5_number(g))
    fast = quality.shingle_sets(docs, hashed=quality.md5_number)
    assert "MapInArrow" in fast._jdf.queryExecution().toString()
    assert {r.doc_id: r.shingles for r in fast.collect()} == {r.doc_id: r.shingles for r in plain.collect()}
    p = quality.PRIME
    pairs = [*quality.permutations(36), (1, 0), (p - 1, p - 1)]
    a, b = (np.array([x[i] for x in pairs], dtype=np.int64)[:, None] for i in (0, 1))
    for x in (np.array([0, 1, p - 1]), np.array([p - 1]), np.array([rng.randrange(p) for _ in range(3000)])):
        assert quality._least(x, a, b).tolist() == [min((int(k) * int(v) + int(m)) % p for v in x) for k, m in pairs]


def test_near_copies_keep_no_shingles_of_unlike_texts(spark, texts, monkeypatch):
    """The texts' shingles are not stored; those of documents that share a bucket are made once more."""
    made = []
    plain = quality.shingle_sets
    monkeypatch.setattr(quality, "shingle_sets", lambda docs, *rest: made.append(docs.count()) or plain(docs, *rest))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = quality.near_duplicates(docs, hashed=quality.md5_number).collect()
    assert len(found) >= 21 and len(made) == 1 and 20 <= made[0] < 30


def test_last_rounds_equal_rounds_over_the_cluster(spark, folder, texts, monkeypatch):
    """Rounds in one task find the pairs that rounds by joins find, with fresh min-hashes too."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    few = spark.createDataFrame([(str(i), t) for i, t in texts.items()], "doc_id string, text string")
    cases = [(docs, {"hashed": quality.md5_number}), (few, {"bands": 2, "rows": 1})]
    found = [sorted(quality.near_duplicates(d, **k).collect()) for d, k in cases]
    monkeypatch.setattr(quality, "LAST_SHINGLES", 0)
    assert found == [sorted(quality.near_duplicates(d, **k).collect()) for d, k in cases] and min(map(len, found)) > 10


def test_min_hashes_of_many_sets_at_once(monkeypatch):
    """Sets that end within a block, at its end or blocks later have the least values that plain numbers give."""
    rng = np.random.default_rng(5)
    sizes = [1, 7, 8, 1, 1, 40, 3, 8, 11]
    values = rng.integers(0, 1 << 60, sum(sizes))
    values[:3] = quality.PRIME, 2 * quality.PRIME - 1, 0
    begins = np.cumsum(sizes) - sizes
    pairs = [*quality.permutations(5), (1, 0), (quality.PRIME - 1, quality.PRIME - 1)]
    wanted = [[min((a * int(v) + b) % quality.PRIME for v in values[i : i + n]) for i, n in zip(begins, sizes)] for a, b in pairs]
    for block in (8, 1 << 14):
        monkeypatch.setattr(quality, "BLOCK", block)
        assert quality.min_hashes_of(values, begins, pairs).tolist() == wanted
