"""Lexicons above the bound for sets in the plan: the join form gives the same rows, and one of 100,000 synsets gives those of a loop."""

import random
import re

import __spark_entry__ as entry
import pytest
from oracle import differences, duck
from prosewell.operators import joins, opinion, senses

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
NAMES = sorted(n for n in ORACLE if n.startswith(("E5", "E7", "E8", "E9", "D1_", "D2_", "D10_")))


@pytest.mark.parametrize("name", NAMES)
def test_joins_equal_sets(spark, folder, monkeypatch, name):
    monkeypatch.setattr(joins.inline_values, "__defaults__", (1,))
    monkeypatch.setattr(opinion.inline_words, "__defaults__", (1,))
    assert differences(spark, duck(folder), QUERIES[name], ORACLE[name], folder) == []


def test_a_hundred_thousand_synsets(spark, folder):
    """Simplified Lesk over the documents' own words, beyond every bound for what is written into a plan, against a loop."""
    rng = random.Random(2)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").limit(60)
    texts = {r.doc_id: re.findall("[a-z]+", (r.text or "").lower()) for r in docs.collect()}
    vocabulary = sorted({w for words in texts.values() for w in words})
    rows = []
    for i in range(100_000):
        lemma = rng.choice(vocabulary) if i % 3 else f"unseen{i}"
        gloss = " ".join(rng.choices(vocabulary, k=6))
        rows.append((lemma, "nvar"[i % 4], i // 4 % 9 + 1, f"{i:08d}", round(rng.random(), 3), 0.25, gloss))
    schema = "lemma string, pos_tag string, sense_no int, synset_id string, pos_score double, neg_score double, gloss string"
    table = spark.createDataFrame(rows, schema).repartition(8)
    stops = spark.createDataFrame([(vocabulary[0],), (vocabulary[1],)], "word string")
    contexts = senses.target_contexts(docs, table, 4, "text", "doc_id")
    inventory = senses.sense_inventory(table, stops)
    found = senses.disambiguate(contexts, inventory).collect()

    by_lemma = {}
    for lemma, tag, number, synset, *_, gloss in rows:
        by_lemma.setdefault(lemma, []).append((number, tag, synset, set(gloss.split()) - set(vocabulary[:2])))
    wanted = {}
    for doc_id, words in texts.items():
        for i, word in enumerate(words):
            if word in by_lemma:
                near = set(words[max(0, i - 4) : i] + words[i + 1 : i + 5])
                best = min(sorted(by_lemma[word], key=lambda s: s[:3]), key=lambda s: -len(s[3] & near))
                wanted[doc_id, i, word] = best[2], len(best[3] & near)
    assert len(wanted) > 5_000
    offset = min(r.pos for r in found)
    got = {(r.doc_id, r.pos - offset, r.token): (r.synset_id, r.overlap) for r in found}
    assert got == wanted
