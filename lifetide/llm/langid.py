"""Hierarchical language identification (operator 9).

The family of a text is predicted first (one linear SVM per family against the
rest); within the family, one linear SVM for every pair of its languages votes.
Features are relative frequencies of hashed character n-grams (1 to 3) inside
words, lower case, letters only, over the whole text.  Because the features
are means over n-grams, scoring a text is a table look-up per n-gram and one
sum: nothing grows with the vocabulary.

Models are fitted on the driver from a bounded sample (``PER_LANGUAGE`` labelled
documents of each language); everything else runs over all rows.

Defined results: a null text or one without a letter is ``und`` with score 0;
so is every text if there is nothing to learn from; a language outside the
fixed families is a family of its own; repeated rows get equal predictions;
empty tables give empty results; extra columns are ignored (``identify`` and
``keep`` keep them, but for those named like its results).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from lifetide.llm.common import codes_of, columns_but, crc_mod, flat, free_name, grams, pieces, stage

BITS = 12
PER_LANGUAGE = 600
MIN_SCORE = 0.3            # keep(): below this, a text is in none of the known languages
UNKNOWN = "und"
ROUNDS = 100
PENALTY = 1e-4

# Language families.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "semitic": ("ar", "he", "mt"),
    "indic": ("hi", "bn", "mr", "ur", "ne", "gu", "pa"),
}


def family_of(lang: str) -> str:
    base = lang.lower().replace("_", "-").split("-")[0]
    return next((f for f, members in FAMILIES.items() if base in members), f"only {base}")


# ------------------------------------------------------------------ features
def _frequencies(texts) -> np.ndarray:
    """Relative n-gram frequencies, one row for each text."""
    codes, starts = codes_of(texts)
    doc = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(codes))))
    counts = np.zeros(len(starts) << BITS, np.float32)
    for _, bucket, ok in grams(codes, 1, 3, BITS):
        at = np.flatnonzero(ok)
        counts += np.bincount((doc[at] << BITS) + bucket[at], minlength=len(counts))
    counts = counts.reshape(len(starts), 1 << BITS)
    return counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)


def _margins(texts, table: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Margins of every linear model (columns of ``table``) for every text, and its number of n-grams."""
    codes, starts = codes_of(texts)
    sums = np.zeros((len(starts), table.shape[1]))
    total = np.zeros(len(starts))
    for _, bucket, ok in grams(codes, 1, 3, BITS):
        own = starts[starts < len(bucket)]      # texts too short for this n have no such n-grams
        total[:len(own)] += np.add.reduceat(ok.astype(np.float32), own)
        for k in range(table.shape[1]):
            sums[:len(own), k] += np.add.reduceat(np.where(ok, table[:, k][bucket], 0), own)
    return sums / np.maximum(total, 1)[:, None] + bias, total


# ------------------------------------------------------------------ training
def _blocks(n: int, width: int) -> list[slice]:
    """Even parts of n rows (or columns) of ``width`` numbers, each of one to two million numbers (or all)."""
    edges = np.linspace(0, n, max(1, n * width >> 20) + 1).astype(int).tolist()
    return [slice(lo, hi) for lo, hi in zip(edges, edges[1:], strict=False)]


def _product(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """x @ w in blocks of rows: a wider type of ``w`` is taken by one block at a time, not by a copy of all of ``x``."""
    return np.concatenate([x[rows] @ w for rows in _blocks(*x.shape)])


def _transposed_product(x: np.ndarray, v: np.ndarray) -> np.ndarray:
    """x.T @ v in blocks of columns, likewise."""
    turned = np.ascontiguousarray if v.dtype == x.dtype else np.asarray
    return np.concatenate([turned(x[:, cols].astype(v.dtype).T) @ v for cols in _blocks(*x.T.shape)])


def _svm(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linear SVMs with squared hinge loss, one for each column of ``y`` (+1, -1; 0: not in this problem).

    Accelerated gradient descent on all columns at once.
    """
    used = (y != 0).astype(np.float32)
    n = np.maximum(used.sum(axis=0), 1)
    # both sides of a problem weigh the same
    pos = np.maximum((y > 0).sum(axis=0), 1)
    neg = np.maximum((y < 0).sum(axis=0), 1)
    weight = np.where(y > 0, n / (2 * pos), n / (2 * neg)).astype(np.float32) * used / n
    w = np.zeros((x.shape[1], y.shape[1]), np.float32)
    b = np.zeros(y.shape[1], np.float32)
    probe = np.random.default_rng(0).normal(size=x.shape[1]).astype(np.float32)
    for _ in range(12):
        probe = _transposed_product(x, x @ probe)
        probe /= np.linalg.norm(probe) + 1e-12
    norm = float(np.square(x @ probe).sum()) + len(x)
    step = 1.0 / (2 * norm * float(weight.max()) + PENALTY)
    wy, by, t = w.copy(), b.copy(), 1.0
    for _ in range(ROUNDS):
        slack = np.maximum(0, 1 - y * (_product(x, wy) + by)) * weight * y
        w2, b2 = wy + step * (2 * _transposed_product(x, slack) - PENALTY * wy), by + step * 2 * slack.sum(axis=0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        wy, by = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    return w, b


class Model:
    """Families, language pairs and one look-up table with a column for each linear model."""

    def __init__(self, langs: list[str], x: np.ndarray, y: np.ndarray, reuse: bool = False):
        """langs: all languages, sorted; x: frequencies (``reuse``: they may be scaled in place, which holds them once); y: index of the language of each row."""
        self.langs = langs
        self.families = sorted({family_of(v) for v in langs})
        self.family = np.array([self.families.index(family_of(v)) for v in langs], np.int64)
        self.pairs = [(i, j) for i in range(len(langs)) for j in range(i + 1, len(langs)) if self.family[i] == self.family[j]]
        columns = []
        if len(self.families) > 1:
            columns += [np.where(self.family[y] == f, 1, -1) for f in range(len(self.families))]
        columns += [np.where(y == i, 1, np.where(y == j, -1, 0)) for i, j in self.pairs]
        self.table, self.bias = np.zeros((1 << BITS, 0), np.float32), np.zeros(0)
        if columns:
            scale = 1 / np.sqrt(x.mean(axis=0) + 1e-6)
            w, self.bias = _svm(np.multiply(x, scale, out=x if reuse else None), np.stack(columns, axis=1).astype(np.float32))
            self.table = np.ascontiguousarray((w * scale[:, None]).astype(np.float32))

    def predict(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language (-1: none) and score of every text of an Arrow array."""
        if not self.langs:
            return np.full(len(texts), -1), np.zeros(len(texts))
        margin, total = _margins(texts, self.table, self.bias)
        sure = np.ones(len(texts))
        family = np.zeros(len(texts), np.int64)
        n = len(self.families)
        if n > 1:
            by_rank = np.sort(margin[:, :n], axis=1)
            family, sure = margin[:, :n].argmax(axis=1), _logistic(by_rank[:, -1] - by_rank[:, -2])
        votes = np.where(self.family[None, :] == family[:, None], 0.0, -1e9)
        weakest = np.full((len(texts), len(self.langs)), np.inf)
        for k, (i, j) in enumerate(self.pairs):
            m = margin[:, n * (n > 1) + k]
            votes[:, i] += np.tanh(m) + (m >= 0)       # a vote; margins break ties
            votes[:, j] += np.tanh(-m) + (m < 0)
            weakest[:, i], weakest[:, j] = np.minimum(weakest[:, i], m), np.minimum(weakest[:, j], -m)
        best = votes.argmax(axis=1)
        low = weakest[np.arange(len(texts)), best]
        score = sure * np.where(np.isinf(low), 1.0, _logistic(2 * np.where(np.isinf(low), 0, low)))
        none = total == 0
        return np.where(none, -1, best), np.where(none, 0.0, score)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(2 * x, -40, 40)))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on about ``per_language`` documents of each language of ``docs`` (text, lang, doc_id)."""
    docs = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # staged, so that Spark knows its size (one row per language) and the texts do not move
    counts = stage(docs.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed("lang", "_lang"), "language-counts")
    cells = 1 << 30
    sample = (docs.join(counts, F.col("lang") == F.col("_lang"), "inner")
              .filter(F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(cells)) < F.lit(float(cells * per_language)) / F.col("_n")))

    @arrow_udf("binary")
    def features(texts: pa.Array) -> pa.Array:
        rows = [r for part in pieces(flat(texts)) for r in (_frequencies(part) * 1000).astype(np.float16)]
        return pa.array([zlib.compress(r.tobytes(), 1) for r in rows], pa.binary())

    got = sample.select("lang", "doc_id", features("text").alias("x")).orderBy("doc_id", "lang").collect()
    langs = sorted({r["lang"] for r in got})
    y = np.array([langs.index(r["lang"]) for r in got], np.int64)
    # unpacked one by one: the driver holds the sample as numbers once
    x = np.empty((len(got), 1 << BITS), np.float32)
    for row, packed in zip(x, got, strict=True):
        np.divide(np.frombuffer(zlib.decompress(packed["x"]), np.float16), 1000, out=row, dtype=np.float32)
    del got
    return Model(langs, x, y, reuse=True)


def predictor(model: Model) -> Callable:
    """Column function text -> struct(lang_pred, score)."""
    @arrow_udf("lang_pred string, score double")
    def run(texts: pa.Array) -> pa.Array:
        best, score = [np.zeros(0, np.int64)], [np.zeros(0)]
        for part in pieces(flat(texts)):
            b, s = model.predict(part)
            best.append(b)
            score.append(s)
        names = np.array([*model.langs, UNKNOWN], dtype=object)
        return pa.StructArray.from_arrays([pa.array(names[np.concatenate(best)], pa.string()), pa.array(np.concatenate(score), pa.float64())],
                                          names=["lang_pred", "score"])
    return run


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score."""
    found = free_name(docs, "_found")
    return (docs.withColumn(found, predictor(model)(F.coalesce("text", F.lit(""))))
            .withColumns({"lang_pred": F.col(f"{found}.lang_pred"), "score": F.col(f"{found}.score")}).drop(found))


def fold(docs: DataFrame) -> DataFrame:
    """The rows that models may learn from."""
    return docs.filter(crc_mod(4) != 2)


def language_of_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learns from the rows of ``fold``."""
    model = fit(fold(docs))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", (crc_mod(4) == 2).alias("held_out"), "lang_pred", "score")


def keep(docs: DataFrame, model: Model, min_score: float = MIN_SCORE) -> DataFrame:
    """Documents whose language is recognised; the rest are rejected."""
    run = predictor(model)
    found = free_name(docs, "_found")
    marked = docs.withColumn(found, run(F.coalesce("text", F.lit(""))))
    return (marked.filter((F.col(f"{found}.lang_pred") != UNKNOWN) & (F.col(f"{found}.score") >= min_score))
            .select(*columns_but(docs)))
