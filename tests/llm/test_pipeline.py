"""The pipeline stage by stage, on the smallest tables and on odd rows."""

import collections

import pytest

import corpus_pipeline
from tests.llm.test_operators import DOCS, ODD, brute_components


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    root, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{folder}/documents.parquet"), {}
    out["documents"] = docs
    for name, function in corpus_pipeline.STAGES:
        function(spark, docs, folder).write.parquet(str(root / name))
        docs = out[name] = spark.read.parquet(str(root / name))
    return out


def test_stages_hand_on_the_columns_of_documents(stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for name in names[:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_classifiers_keep_clean_documents(spark, folder, stages):
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    ids = lambda name: {r.doc_id for r in stages[name].select("doc_id").collect()}
    good, clean = ids("quality classifier"), ids("toxicity")
    assert clean <= good <= ids("documents")
    fine = [i for i, label in labels.items() if label[0] == 1]
    assert sum(i in good for i in fine) >= 0.95 * len(fine)
    fine = [i for i in good if labels.get(i, (1, 1))[1] == 0]
    assert sum(i in clean for i in fine) >= 0.95 * len(fine)


def test_one_document_of_each_group_stays(stages):
    before = [(r.doc_id, r.text) for r in stages["toxicity"].collect()]
    wanted = {r[2] for r in brute_components(before, 5, 80)}
    assert {r.doc_id for r in stages["n-gram Jaccard join"].collect()} == wanted


def test_mixture_repeats_whole_documents_only(stages):
    before = {(r.doc_id, r.text, r.source) for r in stages["n-gram Jaccard join"].collect()}
    after = collections.Counter((r.doc_id, r.text, r.source) for r in stages["mixing sources to target weights"].collect())
    assert set(after) == before and max(after.values()) <= 2
    assert stages["byte-level BPE encoding and decoding"].count() == sum(after.values())


def test_run_gives_the_last_stage(spark, folder, stages):
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, folder).collect())
    assert got == sorted(tuple(r) for r in stages["byte-level BPE encoding and decoding"].collect())


def test_stages_on_odd_rows_clashing_columns_and_empty_tables(spark, folder):
    odd = spark.createDataFrame(ODD, DOCS).selectExpr("*", "1 as score", "2 as _tokens", "3 as grp", "4 as component_id", "5 as features")
    for docs in (odd, odd.limit(0)):
        for name, function in corpus_pipeline.STAGES:
            out = function(spark, docs, folder)
            assert name.startswith("byte") or out.columns == docs.columns
            assert out.count() >= 0
    kept = corpus_pipeline.drop_near_copies(spark, odd, folder).collect()
    assert sorted((r.doc_id for r in kept), key=repr) == sorted([1, 2, 3, 4, 6, None, 7, 8, 9], key=repr)


def test_near_copies_are_judged_row_by_row(spark, folder):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(30)) for x in "abcd")
    rows = [(3, a), (5, a), (5, b), (7, b), (5, c), (None, d), (None, d), (None, d), (8, c), (9, ""), (9, ""), (9, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, folder).collect()), key=repr)
    assert kept == sorted([(3, a), (5, b), (5, c), (None, d), (9, ""), (9, None)], key=repr)
