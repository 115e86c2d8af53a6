"""Tokens, lexicons, opinion and senses on hand-made texts."""

import collections
import math

import pytest
from prosewell.operators import opinion, senses, terms
from prosewell.plans import fixtures as fx
from prosewell.sources.lexicons import read_opinion_lexicon, read_sense_lexicon


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_tokens_and_counts(spark):
    d = docs(spark, "It's a dog, a DOG!", "", None, "...")
    assert [r.token for r in terms.tokenize(d).orderBy("doc_id", "pos").collect()] == "it s a dog a dog".split()
    assert [r.token for r in terms.tokenize(d, apostrophe=True).collect()] == "it's a dog a dog".split()
    counted = {(r.doc_id, r.token): r.tf for r in terms.term_counts(d).collect()}
    assert counted == {(0, "it"): 1, (0, "s"): 1, (0, "a"): 2, (0, "dog"): 2}
    assert {(r.doc_id, r.token): r.tf for r in terms.count_tokens(terms.tokenize(d)).collect()} == counted
    stats = {r.doc_id: (r.tokens, r.distinct_tokens, r.mean_length) for r in terms.doc_stats(d).collect()}
    assert stats == {0: (6, 4, 11 / 6), 1: (0, 0, None), 2: (0, 0, None), 3: (0, 0, None)}


def test_ngrams_of_short_texts(spark):
    d = docs(spark, "a b c", "a b", "")
    assert [(r.doc_id, r.pos, r.ngram) for r in terms.ngrams(d, 3).collect()] == [(0, 0, "a b c")]


def test_tf_idf_formula(spark):
    tf = terms.term_counts(docs(spark, "a a b", "a", "c"))
    got = {(r.doc_id, r.token): r.tf_idf for r in terms.tf_idf(tf, terms.doc_freq(tf), 3).collect()}
    assert got[0, "a"] == pytest.approx(2 * math.log(4 / 3))
    assert got[2, "c"] == pytest.approx(math.log(2))


def test_lemmas(spark):
    tokens = terms.tokenize(docs(spark, "dogs churches parties hoping hopped men was glasses runs xyzs"))
    vocabulary = fx.word_table(spark, ["dog", "church", "party", "hope", "glass", "run", "man"])
    got = {r.token: r.lemma for r in terms.lemmatize(tokens, vocabulary, fx.exception_table(spark)).collect()}
    assert got == {
        "dogs": "dog", "churches": "church", "parties": "party", "hoping": "hope", "hopped": "hopped",
        "men": "man", "was": "be", "glasses": "glass", "runs": "run", "xyzs": "xyzs",
    }


def test_lexicon_files(spark, tmp_path):
    (tmp_path / "pos").write_text("; comment\n\nGood\nfine\nodd\n")
    (tmp_path / "neg").write_text(";\nbad\r\nodd\nbad\n")
    got = read_opinion_lexicon(spark, str(tmp_path / "pos"), str(tmp_path / "neg"))
    assert {(r.word, r.polarity) for r in got.collect()} == {("good", 1), ("fine", 1), ("bad", -1), ("odd", 0)}
    (tmp_path / "swn").write_text(fx.SENSE_FILE)
    table = read_sense_lexicon(spark, str(tmp_path / "swn"))
    rows = {(r.pos, r.synset_id): r for r in table.collect()}
    assert len(rows) == len(fx.SENSE_ROWS)
    assert rows["r", "00000001"].gloss.endswith('for it; "by the best"')
    assert rows["r", "00000001"].obj_score == pytest.approx(0.375)


def test_negation_window(spark):
    lexicon = spark.createDataFrame([("good", 1), ("bad", -1)], "word string, polarity int")
    d = docs(spark, "not a very good", "not at all very good", "isn't bad", "good not")
    hits = opinion.negate(d, lexicon, ["not", "isn't"], 3).collect()
    assert {r.doc_id: (r.negated, r.polarity) for r in hits} == {
        0: (True, -1), 1: (False, 1), 2: (True, 1), 3: (False, 1),
    }


def test_polarity_keeps_documents_without_hits(spark):
    lexicon = spark.createDataFrame([("good", 1), ("bad", -1)], "word string, polarity int")
    d = docs(spark, "good bad good. bad! bad? fine", "nothing", "", None)
    scored = opinion.classify_polarity(opinion.count_polarity(d, lexicon))
    got = {r.doc_id: (r.tokens, r.pos, r.neg, r["class"]) for r in scored.collect()}
    assert got == {0: (6, 2, 3, "negative"), 1: (1, 0, 0, "neutral"), 2: (0, 0, 0, "neutral"), 3: (0, 0, 0, "neutral")}
    majority = opinion.sentence_majority(opinion.sentence_polarity(d, lexicon)).collect()
    assert {r.doc_id: (r.sentences, r.pos_sentences, r.neg_sentences) for r in majority}[0] == (4, 1, 2)


def test_lexicon_use_matches_a_plain_count(spark, folder):
    d = spark.read.parquet(f"{folder}/documents.parquet")
    counts = collections.Counter(w for r in d.collect() for w in __import__("re").findall("[a-z]+", r.text.lower()))
    use = {r.word: r.hits for r in opinion.lexicon_use(terms.tokenize(d), fx.opinion_lexicon(spark)).collect()}
    assert use == {w: counts[w] for w in use} and sum(use.values()) > 0


def test_disambiguation_follows_the_context(spark):
    synsets = spark.createDataFrame(
        [
            ("n", "1", 0.0, 0.0, "bank#1", "an institution that keeps money"),
            ("n", "2", 0.25, 0.5, "bank#2", "sloping land beside a river"),
        ],
        "pos string, synset_id string, pos_score double, neg_score double, terms string, gloss string",
    )
    table = senses.explode_senses(synsets)
    inventory = senses.sense_inventory(table, fx.word_table(spark, fx.STOP_WORDS))
    d = docs(spark, "the bank of the river", "money in the bank", "a bank", "bank river money money")
    chosen = senses.disambiguate(senses.target_contexts(d, table, 5), inventory).collect()
    assert {r.doc_id: (r.sense_no, r.overlap) for r in chosen} == {0: (2, 1), 1: (1, 1), 2: (1, 0), 3: (1, 1)}


def test_longest_phrase_wins(spark):
    rows = [("n", "1", 0.0, 0.0, "new_york#1 york_city#1 new_york_city#1", "x")]
    schema = "pos string, synset_id string, pos_score double, neg_score double, terms string, gloss string"
    table = senses.explode_senses(spark.createDataFrame(rows, schema))
    d = docs(spark, "in new york city", "new york", "new york york city", "city of new")
    got = senses.spot_phrases(d, table).orderBy("doc_id", "pos").collect()
    assert [(r.doc_id, r.pos, r.phrase) for r in got] == [
        (0, 1, "new york city"), (1, 0, "new york"), (2, 0, "new york"), (2, 2, "york city"),
    ]


def test_small_and_large_lexicons_score_alike(spark, folder, monkeypatch):
    d = spark.read.parquet(f"{folder}/documents.parquet")
    lexicon = fx.opinion_lexicon(spark)

    def results():
        return [
            sorted(opinion.count_polarity(d, lexicon).collect()),
            sorted(opinion.sentence_polarity(d, lexicon).collect()),
            sorted(opinion.negate(d, lexicon, fx.NEGATORS, 3).collect()),
        ]

    small = results()
    monkeypatch.setattr(opinion, "inline_words", lambda lexicon: None)
    assert results() == small and all(small)


def test_repeated_lexicon_words_and_keys_count_alike(spark, monkeypatch):
    rows = [("good", 1), ("good", 1), ("bad", -1), ("odd", 1), ("odd", -1)]
    lexicon = spark.createDataFrame(rows, "word string, polarity int")
    d = spark.createDataFrame([(1, "good good bad odd"), (1, "good"), (2, None), (3, "none")], "doc_id int, text string")
    small = sorted(map(tuple, opinion.count_polarity(d, lexicon).collect()))
    assert small == [(1, 1, 1, 0, 1), (1, 4, 3, 2, 1), (2, 0, 0, 0, 0), (3, 1, 0, 0, 0)]
    hits = sorted(opinion.negate(d, lexicon, ["not"], 3).collect())
    monkeypatch.setattr(opinion, "inline_words", lambda lexicon: None)
    assert sorted(map(tuple, opinion.count_polarity(d, lexicon).collect())) == small
    assert sorted(opinion.negate(d, lexicon, ["not"], 3).collect()) == hits


def test_synsets_are_known_by_part_of_speech_and_id(spark):
    rows = [("a", "00001740", 0.5, 0.0, "able#1", "having strength"), ("v", "00001740", 0.0, 0.0, "breathe#1", "draw air into lungs"),
            ("a", "2", 0.0, 0.5, "able#2", "big")]
    schema = "pos string, synset_id string, pos_score double, neg_score double, terms string, gloss string"
    table = senses.explode_senses(spark.createDataFrame(rows, schema))
    stops = spark.createDataFrame([("the",)], "word string")
    words = {(r.pos_tag, r.word) for r in senses.gloss_words(table, stops).collect()}
    assert ("a", "air") not in words and ("v", "air") in words
    d = docs(spark, "able air lungs big")
    chosen = senses.disambiguate(senses.target_contexts(d, table, 5), senses.sense_inventory(table, stops)).collect()
    assert [(r.sense_no, r.overlap) for r in chosen] == [(2, 1)]


def test_few_and_many_targets_give_the_same_contexts(spark, folder, monkeypatch):
    d = spark.read.parquet(f"{folder}/documents.parquet")
    table = senses.explode_senses(fx.sense_lexicon(spark))

    def results():
        return [
            sorted(senses.target_contexts(d, table, 3).collect()),
            sorted(senses.spot_phrases(d, table).collect()),
        ]

    few = results()
    monkeypatch.setattr(senses, "inline_values", lambda df: None)
    assert results() == few and all(few)
