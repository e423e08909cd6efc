"""The corpus pipeline: decisions of every stage, awkward rows, empty tables."""

import os

import pytest

import corpus_pipeline as cp
from affinity.session import shared_dir

from .helpers import awkward, documents, prose
from .test_classifiers import _corpus

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark):
    """A folder with planted junk, near copies, shared passages and leaks."""
    root = shared_dir(spark, "pipeline-test")
    rows, labels = _corpus(200, 8)
    item = prose(4000, 40)
    passage = prose(4100, 70)
    rows += [(1000, f"{prose(4200, 50)} {item} {prose(4201, 50)}"), (1001, prose(4300, 90)), (1002, prose(4300, 90)),
             (1003, prose(4300, 90) + " tail"), (1004, f"{prose(4400, 60)} {passage} {prose(4401, 60)}"),
             (1005, f"{prose(4500, 60)} {passage} {prose(4501, 60)}"), (1006, prose(4600, 100))]
    rows += [(2000 + k if i is not None else None, t) for k, (i, t, *_) in enumerate(awkward(77))]
    documents(spark, rows).write.parquet(os.path.join(root, "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(os.path.join(root, "labels.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(os.path.join(root, "benchmark.parquet"))
    return root, dict(rows), {i: q for i, q, _ in labels}


def test_stages_keep_the_contract_and_take_effect(spark, corpus):
    root, texts, good = corpus
    docs = spark.read.parquet(f"{root}/documents.parquet")
    seen = []
    for name, stage in cp.STAGES:
        docs = cp.saved(stage(spark, docs, root), "t")
        seen.append(docs)
        if name != "packing":
            assert docs.columns == COLUMNS
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in seen]
    junk = {i for i, q in good.items() if not q}
    assert len(junk & ids[0]) <= len(junk) * 0.05 and len(ids[0] & (set(good) - junk)) >= len(set(good) - junk) * 0.98
    assert {1001, 1002, 1003, 1006} <= ids[0]
    assert 1001 in ids[1] and not {1002, 1003} & ids[1] and 1006 in ids[1]
    left = {r.doc_id: r for r in seen[2].collect()}
    passage = prose(4100, 70)
    assert passage[5:-5] not in left[1004].text and prose(4400, 60) in left[1004].text
    assert left[1004].n_chars == len(left[1004].text) and left[1006].text == texts[1006]
    assert 1000 not in ids[3] and ids[3] == ids[2] - {1000}
    assert ids[4] == ids[3]


def test_run_returns_the_last_stage(spark, corpus):
    out = cp.run(spark, corpus[0])
    assert out.count() > 0 and {"doc_id", "bin_id", "n_tokens"} <= set(out.columns)
    assert [f for _, f in cp.STAGES] == [cp.quality_stage, cp.near_duplicate_stage, cp.repeated_passage_stage,
                                         cp.decontamination_stage, cp.packing_stage]


def test_empty_documents(spark, corpus):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet").where("false")
    for _, stage in cp.STAGES:
        docs = cp.saved(stage(spark, docs, corpus[0]), "t")
        assert docs.count() == 0


def test_a_repeated_id_with_other_texts_loses_only_near_duplicates(spark):
    a, b, c = prose(1, 80), prose(2, 80), prose(3, 80)
    rows = [(1, a), (5, b), (5, a + " tail"), (6, b + " tail"), (7, c), (7, prose(4, 80)), (7, c), (None, c), (None, c)]
    kept = cp.near_duplicate_stage(spark, documents(spark, rows), "").select("doc_id", "text").collect()
    want = [(1, a), (5, b), (7, c), (7, prose(4, 80)), (None, c), (None, c)]
    assert sorted(map(repr, map(tuple, kept))) == sorted(map(repr, want))
