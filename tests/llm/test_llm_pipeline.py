import numpy as np
import pytest
from tables import ODD, documents

import corpus_pipeline as cp
from prosewell.llm import simhash


@pytest.fixture(scope="module")
def kept(spark, folder):
    """What each stage kept, in turn."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in cp.STAGES:
        out.append((name, stage(spark, out[-1][1], folder).cache()))
    return dict(out)


def test_stages(kept):
    names = [n for n, _ in cp.STAGES]
    assert names == ["quality_classifier", "quality_rules", "simhash_near_dedup", "source_mix", "sentencepiece"]
    for name in names[:-1]:
        assert kept[name].columns == kept["documents"].columns
    ids = {n: {r.doc_id for r in df.select("doc_id").collect()} for n, df in kept.items()}
    for before, after in zip(["documents", *names], names, strict=False):
        assert ids[after] <= ids[before]


def test_quality_stages_keep_good_documents(spark, folder, kept):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    left = {r.doc_id for r in kept["quality_rules"].select("doc_id").collect()}
    good = [d in left for d, q in labels.items() if q == 1]
    bad = [d in left for d, q in labels.items() if q == 0]
    assert np.mean(good) > 0.95 and (not bad or np.mean(bad) < 0.2)


def test_one_document_of_each_group_is_left(kept):
    before = simhash.near_copies(kept["quality_rules"]).collect()
    left = sorted(r.doc_id for r in kept["simhash_near_dedup"].select("doc_id").collect())
    assert left == sorted({r.component_id for r in before})


def test_run_equals_the_stages(spark, folder, kept):
    found = sorted((r.doc_id, r.n_ids) for r in cp.run(spark, folder).collect())
    assert found == sorted((r.doc_id, r.n_ids) for r in kept["sentencepiece"].collect())
    assert len(found) == kept["source_mix"].count()


def test_odd_documents(spark, folder):
    for rows in (ODD, []):
        docs = documents(spark, rows)
        for name, stage in cp.STAGES:
            out = stage(spark, docs, folder)
            assert out.columns == (["doc_id", "n_ids", "ids"] if name == "sentencepiece" else docs.columns)
            assert out.count() <= 2 * len(rows)
