"""Held-out accuracy of the three models, and what they learn from."""

import random

import numpy as np
import pytest
from conftest_llm import frame

from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    from lifetide.llm.queries import QUERIES
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")

    def run(name):
        return QUERIES[name](spark, DATA).join(labels, "doc_id", "left").join(docs, "doc_id").toPandas()
    return run


def test_language(scored):
    r = scored("op9_language_id")
    assert len(r) == 1000 and r.score.between(0, 1).all()
    held = r[r.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97


def test_quality(scored):
    r = scored("op2_quality_gam")
    assert len(r) == 1000 and r.score.between(0, 1).all() and ((r.score >= 0.3) == (r.predicted == 1)).all()
    held = r[r.held_out & r.quality.notna()]
    assert (held.quality == held.predicted).mean() > 0.93


def test_toxicity_of_unseen_misspellings(spark):
    """Words never seen, but close to toxic ones, are caught; others are not."""
    import pyarrow as pa

    from lifetide.llm.toxicity import Model
    rnd = random.Random(2)
    plain = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(3, 9))) for _ in range(400)]
    bad = ["stupidness", "worthlessly", "disgustingly", "idiotism"]

    def text(extra):
        words = [rnd.choice(plain) for _ in range(60)]
        for w in extra:
            words.insert(rnd.randrange(60), w)
        return " ".join(words)
    train = [(text(rnd.sample(bad, 2)), 1) for _ in range(60)] + [(text([]), 0) for _ in range(240)]
    model = Model(pa.array([t for t, _ in train], pa.large_string()), np.array([y for _, y in train]))
    for w in ("stupidnes", "wworthlessly", "disgustinglyy", "idiotizm"):
        assert model.score(pa.array([text([w, w])], pa.large_string()))[0] > 0.7, w
    clean = model.score(pa.array([text([]) for _ in range(50)], pa.large_string()))
    assert (clean < 0.7).mean() > 0.95


def test_toxicity(scored):
    r = scored("op7_toxicity")
    assert len(r) == 1000 and ((r.score >= 0.7) == (r.predicted == 1)).all()
    held = r[r.held_out & r.toxic.notna()]
    assert (held.toxic == held.predicted).mean() > 0.9


def test_scores_do_not_depend_on_held_out_labels(spark):
    from lifetide.llm.quality import quality_of_documents
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    hidden = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("yy")})
    a = sorted(quality_of_documents(docs, labels).collect())
    assert a == sorted(quality_of_documents(hidden, turned).collect())


def test_scores_do_not_depend_on_batches():
    """A text scores the same alone and among others."""
    import pyarrow as pa

    from lifetide.llm import langid, quality, toxicity
    texts = ["Der Hund und die Katze.", "the cat and the dog", "", "x", "le chat est idiot!!", "a | b | c", "..."] * 3
    arr = pa.array(texts, pa.large_string())
    y = np.array([0, 1, 0, 1, 1, 0, 0] * 3)
    tox = toxicity.Model(arr, y)
    lang = langid.Model(["de", "en", "fr"], langid._frequencies(arr), np.array([0, 1, 2, 0, 2, 1, 1] * 3))
    together = (quality.figures(arr), tox.score(arr), lang.predict(arr))
    for i in range(len(texts)):
        one = arr.slice(i, 1)
        assert np.allclose(quality.figures(one)[0], together[0][i])
        assert np.isclose(tox.score(one)[0], together[1][i])
        assert lang.predict(one)[0][0] == together[2][0][i] and np.isclose(lang.predict(one)[1][0], together[2][1][i])


def test_model_tables_are_additive(spark):
    from lifetide.llm.quality import FIGURES, Model
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(FIGURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(int)      # only the pair tells
    m = Model(x, y)
    assert ((m.score(x) > 0.5) == y).mean() > 0.95
    assert (0, 1) in [(j, k) for j, k, _ in m.pairs]


def test_unknown_languages_and_families(spark):
    from lifetide.llm.langid import fit, keep, family_of
    assert family_of("pt-BR") == "romance" and family_of("xx") != family_of("yy")
    rows = [(i, "der die das und nicht " * 5, "de") for i in range(20)] + [(i, "the and of with this " * 5, "en") for i in range(20, 40)]
    model = fit(frame(spark, rows))
    kept = {r["doc_id"] for r in keep(frame(spark, rows + [(99, "1234 5678 !!"), (98, None)]), model).collect()}
    assert kept == set(range(40))


def test_language_fit_holds_the_sample_once(spark):
    """Fitting holds the features once and blocks of them on the driver, and gives the model of plain numbers."""
    import tracemalloc

    import pyarrow as pa

    from lifetide.llm import langid
    words = {"de": "der die das und nicht ein Haus", "en": "the and of with this a house", "fr": "le la les et une maison"}
    rows = [(i, f"{w} {i * 7919 % 1000} {w[i % 9:]}", k) for i in range(600) for j, (k, w) in enumerate(words.items()) if i % 3 == j]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langid.fit(docs)
    tracemalloc.start()
    try:
        model = langid.fit(docs)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 2.5 * len(rows) * 4 * (1 << langid.BITS)
    # the same model from features held as plain numbers
    texts = pa.array([t for _, t, _ in rows], pa.large_string())
    freq = (langid._frequencies(texts) * 1000).astype(np.float16).astype(np.float32) / 1000
    plain = langid.Model(sorted(words), freq, np.array([sorted(words).index(k) for _, _, k in rows]))
    assert plain.langs == model.langs and np.array_equal(plain.table, model.table) and np.array_equal(plain.bias, model.bias)
