"""The pipeline: its order, its columns, and every stage against brute force on its own input."""

import pytest
from conftest_llm import frame
from test_brute_force import brute_components

import corpus_pipeline as P

SMALL = "/root/testdata/sf0.001"


def test_order_of_stages():
    assert [n for n, _ in P.STAGES] == ["language id", "n-gram jaccard join", "benchmark decontamination", "pii", "source mix"]


def test_stages_one_by_one(spark):
    from lifetide.llm import decontam, langid, mixing, pii
    from lifetide.llm.common import stage
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    result = docs
    for name, step in P.STAGES:
        before = {r["doc_id"]: r for r in result.collect()}
        out = step(spark, result, SMALL)
        after = {r["doc_id"]: r for r in out.collect()}
        if name != "source mix":
            assert out.columns == docs.columns
        if name == "language id":
            seen = langid.identify(result, langid.fit(langid.fold(result))).collect()
            assert set(after) == {r["doc_id"] for r in seen if r["lang_pred"] != "und" and r["score"] >= langid.MIN_SCORE}
            assert len(after) >= 0.98 * len(before)
        elif name == "n-gram jaccard join":
            comps = brute_components([(k, r["text"]) for k, r in before.items()])
            assert set(after) == {k for k, (_, c) in comps.items() if k == c} and len(after) < len(before)
        elif name == "benchmark decontamination":
            gone = {r["doc_id"] for r in decontam.contaminated(result, bench).collect()}
            assert gone and set(after) == set(before) - gone
        elif name == "pii":
            assert {k: r["text"] for k, r in after.items()} == {r["doc_id"]: r["text"] for r in pii.pseudonymise(result).collect()}
            assert all(r["n_chars"] == len(r["text"]) for r in after.values())
        else:
            assert sorted(after.values()) == sorted(mixing.mix(result).collect())
        result = stage(out, "test")
    assert sorted(P.run(spark, SMALL).collect()) == sorted(after.values())


@pytest.mark.parametrize("rows", [[], [(1, None), (None, None), (2, "")]])
def test_empty_and_null_documents(spark, rows):
    docs = frame(spark, rows)
    for _, step in P.STAGES:
        docs = step(spark, docs, SMALL)
    assert docs.collect() == []
