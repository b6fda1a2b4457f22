"""Every operator on odd rows: nulls, empty and very long texts, ties, repeated rows, empty tables, clashing extra columns."""

import pytest
from conftest_llm import ODD, frame

from pyspark.sql import functions as F


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("score", F.lit("x"))


def operators(spark):
    from lifetide.llm import decontam, fingerprints, jaccard, langid, licenses, mixing, pii, quality, spans, toxicity, variants
    labels = labels_of(spark, [(i, i % 2, (i + 1) % 2) for i in range(9)] + [(None, 1, 0), (3, None, None), (6, 1, 0)])
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "one two three four five six seven eight nine"), (None, "a b c d e f g h i")],
                                  "item_id long, text string").withColumn("doc_id", F.lit(5))
    return {
        "jaccard": lambda d: jaccard.join(d), "jaccard_keep": lambda d: jaccard.keep_one(d),
        "quality": lambda d: quality.quality_of_documents(d, labels), "licenses": lambda d: licenses.scan(d),
        "spans": lambda d: spans.dedup_spans(d), "pii": lambda d: pii.pseudonymise(d),
        "fingerprints": lambda d: fingerprints.fingerprint_documents(d), "toxicity": lambda d: toxicity.toxicity_of_documents(d, labels),
        "decontam": lambda d: decontam.contaminated(d, bench), "decontam_clean": lambda d: decontam.clean(d, bench),
        "langid": lambda d: langid.language_of_documents(d), "langid_keep": lambda d: langid.keep(d, langid.fit(langid.fold(d))),
        "mixing": lambda d: mixing.mix(d), "variants": lambda d: variants.spelling_variants(d),
    }


NAMES = ["jaccard", "jaccard_keep", "quality", "licenses", "spans", "pii", "fingerprints", "toxicity", "decontam", "decontam_clean",
         "langid", "langid_keep", "mixing", "variants"]
ROW_FOR_ROW = {"jaccard", "quality", "licenses", "spans", "pii", "fingerprints", "toxicity", "langid", "mixing"}


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, name):
    df = frame(spark, ODD, extra=True)
    out = operators(spark)[name](df)
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    rows = out.collect()
    if name in ROW_FOR_ROW:
        assert len(rows) == len(ODD)
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in ODD)
    if name in ("jaccard_keep", "decontam_clean", "langid_keep"):
        assert out.columns == df.columns


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, name):
    assert operators(spark)[name](frame(spark, [])).collect() == []


def test_defined_results(spark):
    df = frame(spark, ODD)
    ops = operators(spark)
    j = {r["doc_id"]: r for r in ops["jaccard"](df).collect()}
    assert [j[i]["n_shingles"] for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert [j[i]["component_id"] for i in (1, 2, 3, 4, 6, 7)] == [1, 2, 3, 4, 6, 6]
    assert sorted(str(r["doc_id"]) for r in ops["jaccard_keep"](df).collect()).count("6") == 1
    lang = {r["doc_id"]: r for r in ops["langid"](df).collect()}
    assert [(lang[i]["lang_pred"], lang[i]["score"]) for i in (1, 2, 3)] == [("und", 0.0)] * 3
    fp = {r["doc_id"]: r for r in ops["fingerprints"](df).collect()}
    assert fp[1]["fingerprint"] == fp[2]["fingerprint"] == "3::" and fp[2]["near_next"] == 1.0
    assert fp[6]["fingerprint"] == fp[7]["fingerprint"] and fp[7]["near_next"] == 1.0
    mixed = {r["doc_id"]: r for r in ops["mixing"](df).collect()}
    assert mixed[1]["size"] == 0 and mixed[1]["taken"] == 0
    pii = [r for r in ops["pii"](df).collect() if r["doc_id"] == 1][0]
    assert pii["text"] is None and pii["n_found"] == 0
    cut = {r["doc_id"]: r for r in ops["spans"](df).collect()}
    assert cut[1]["text"] is None and cut[7]["n_sentences"] == 2
