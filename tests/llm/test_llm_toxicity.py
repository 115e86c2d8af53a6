import zlib

import numpy as np
import pytest
from tables import ODD, documents

from prosewell.llm import toxicity as tx


def sets(rng, n, toxic):
    out = []
    for _ in range(n):
        words = {spelled(rng.integers(3_000)) for _ in range(60)}
        words |= {"scorn" + spelled(rng.integers(400)) for _ in range(2)} if rng.random() < toxic else set()
        out.append(words)
    return out


def spelled(n):
    return "".join(chr(97 + int(d)) for d in f"{n:04d}")[::-1] * 2


def slots(rows):
    return [tx.text_slots(" ".join(r)).astype(np.int64) for r in rows]


def test_unlabelled_toxic_texts_do_not_spoil_it():
    rng = np.random.default_rng(0)
    model = tx.fit(slots(sets(rng, 200, 1)), slots(sets(rng, 2_000, 0.2)), 0.2)
    known = tx._Weighted(model.weights)
    toxic = [tx.score_text(" ".join(r), model, known) for r in sets(rng, 200, 1)]
    clean = [tx.score_text(" ".join(r), model, known) for r in sets(rng, 200, 0)]
    assert 0 < len(model.weights) <= 30
    assert np.mean(np.array(toxic) >= 0.3) > 0.95 and np.mean(np.array(clean) >= 0.3) < 0.05


def test_chance_words_get_no_weight():
    rng = np.random.default_rng(1)
    model = tx.fit(slots(sets(rng, 40, 0)), slots(sets(rng, 700, 0)), 0.1)
    assert not model.weights


def test_odd_documents(spark):
    docs = documents(spark, ODD)
    for rows in ([], [(5, 0, 1)], [(3, 0, 1), (8, 1, 0), (None, 1, 1), (4, None, None)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        found = tx.scores(docs, tx.train(docs, labels)).collect()
        assert len(found) == len(ODD)
        for r in found:
            assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
            held = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2
            assert r.held_out == held
    none = documents(spark, [])
    assert tx.scores(none, tx.train(none, labels)).count() == 0


def test_held_out_labels_are_not_learnt(spark):
    docs = documents(spark, [(i, f"plain text of {'awful' if i % 3 == 0 else 'nice'} words", "en", "a") for i in range(200)])
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    right = [(i, 1, int(i % 3 == 0)) for i in range(200) if not held(i)]
    wrong = [(i, 1, 1) for i in range(200) if held(i)]
    kinds = "doc_id long, quality int, toxic int"
    a = tx.train(docs, spark.createDataFrame(right, kinds))
    b = tx.train(docs, spark.createDataFrame(right + wrong, kinds))
    assert a == b and a.weights


def test_held_out_accuracy(spark):
    import os

    from prosewell.plans.registry import QUERIES

    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip(f"no test tables at {folder}")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op5_pu_toxicity"](spark, folder).collect()
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = [p for y, p in held if y], [p for y, p in held if not y]
    assert np.mean(toxic) > 0.75 and np.mean(clean) < 0.03


def test_slots_are_counted_in_all_texts(spark):
    """An insult that the sampled positives hold too seldom, or not at all, is found by the counts over all texts."""
    rng = np.random.default_rng(3)
    word = lambda n: "w" + spelled(int(n))
    texts = [" ".join(word(n) for n in rng.integers(300, size=30)) for _ in range(2_400)]
    toxic = [i for i in range(2_400) if i % 4 == 0]
    for i in toxic:
        texts[i] += " scornful" if i % 40 else " qvxzj"
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(2_400)], "doc_id long, quality int, toxic int")
    model = tx.train(docs, labels, positives=12, unlabelled=60)
    assert set(tx.slots_of(b"qvxzj")) & set(model.weights)
    assert tx.score_text(texts[1] + " qvxzj", model) > tx.score_text(texts[1], model)


def test_more_than_512_slots_keep_a_weight():
    insults = ["".join(chr(97 + d) for d in (i // 26, i % 26, 25 - i // 26, 7)) for i in range(600)]
    positive = [tx.text_slots(w).astype(np.int64) for w in insults for _ in range(60)]
    clean = [tx.text_slots(f"word{chr(97 + i % 26)}").astype(np.int64) for i in range(60_000)]
    assert len(tx.fit(positive, clean, 0.3, rounds=2).weights) >= 590
