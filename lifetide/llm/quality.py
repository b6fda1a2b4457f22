"""Quality classifier: an additive model with pairwise interactions (operator 2).

About twenty figures of every whole text (lengths, shares of character classes,
repetition) are cut into bins.  The model is a look-up table per figure and one
per chosen pair of figures; a text's score is the logistic of the sum of its
bins.  The tables are learned by cyclic boosting: round after round, a shallow
tree of one figure (or of one pair) is fitted to the gradient and added, at a
small learning rate, to that figure's table.  Pairs are those whose best
two-figure tree lowers the loss most once the single figures are fitted.

Learns on the driver from about ``MAX_LABELLED`` labelled rows; figures and
scores are computed for all rows.

Defined results: null and empty texts have all figures 0 and get a score like
any other; without both classes among the labels every score is the share of
class 1 (0.5 without labels); rows with a null label are not learned from;
repeated rows get equal scores; empty tables give empty results; extra columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from lifetide.llm.common import bounded_sample, crc_mod, flat, mix, pieces, words_of

MAX_LABELLED = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 8
ROUNDS = 200
PAIR_ROUNDS = 60
RATE = 0.1
THRESHOLD = 0.3

FIGURES = ("words", "word_length", "upper", "digit", "mark", "exclaim", "bar", "stop", "feed", "wide", "letter", "distinct",
           "repeat", "distinct_three", "line_length", "line_distinct", "marked_end", "long_word", "single", "upper_word", "run")

# ----------------------------------------------------------------- figures
_CLASS = np.zeros(256, np.uint8)
for _class, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#$%&*+/<=>@\\^_`{}~[]", b"!?", b"|", b".,;:", b"\n",
                                 b"abcdefghijklmnopqrstuvwxyz"), start=1):
    _CLASS[list(_bytes)] = _class
_CLASS[128:] = 9


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over the ranges first[i]..first[i + 1]."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[first[1:]] - total[first[:-1]]


def _distinct(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """How many distinct hashes each owner has."""
    _, at = np.unique(mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    return np.bincount(owner[at], minlength=n).astype(np.float64)


def figures(texts) -> np.ndarray:
    """One row of FIGURES for every text of an Arrow array."""
    from lifetide.llm.common import PolyHash, pack

    data, offsets = pack(texts)
    n = len(texts)
    _, start, end, hashes, first = words_of(texts)
    size = np.maximum(np.diff(offsets) - 1, 1).astype(np.float64)
    kind = _CLASS[data]
    share = {c: _per_text(kind == c, offsets) / size for c in range(1, 10)}
    share[7] = np.maximum(share[7] - 1 / size, 0)          # the line feed that pack() adds
    n_words = np.diff(first).astype(np.float64)
    words = np.maximum(n_words, 1)
    owner = np.repeat(np.arange(n), np.diff(first))
    length = (end - start).astype(np.float64)
    same = np.zeros(len(start), bool)
    if len(start) > 1:
        same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    three = owner3 = np.zeros(0, np.uint64)
    if len(start) > 2:
        three = mix(hashes[:-2] * np.uint64(3) + hashes[1:-1] * np.uint64(5) + hashes[2:] * np.uint64(7))
        inside = owner[:-2] == owner[2:]
        three, owner3 = three[inside], owner[:-2][inside]
    n_three = np.maximum(n_words - 2, 1)
    # lines: ranges between line feeds (pack() ends every text with one)
    feeds = np.flatnonzero(data == 10)
    line_start = np.concatenate([[0], feeds[:-1] + 1]) if len(feeds) else feeds
    solid = feeds > line_start
    line_start, line_end = line_start[solid], feeds[solid]
    line_owner = np.searchsorted(offsets, line_start, side="right") - 1
    n_lines = np.bincount(line_owner, minlength=n).astype(np.float64)
    lines = np.maximum(n_lines, 1)
    last, head = kind[np.maximum(end, 1) - 1] if len(end) else kind[:0], kind[start]
    second = kind[np.minimum(start + 1, np.maximum(end, 1) - 1)] if len(start) else kind[:0]
    # the longest run of one repeated word
    at = np.arange(len(start))
    begin = np.maximum.accumulate(np.where(same, 0, at)) if len(at) else at
    run = np.zeros(n)
    np.maximum.at(run, owner, (at - begin + 1).astype(np.float64))
    out = {
        "words": np.log1p(n_words), "word_length": _per_text(length, first) / words, "upper": share[1], "digit": share[2],
        "mark": share[3], "exclaim": share[4], "bar": share[5], "stop": share[6], "feed": share[7], "wide": share[9],
        "letter": share[1] + share[8] + share[9], "distinct": _distinct(hashes, owner, n) / words, "repeat": _per_text(same, first) / words,
        "distinct_three": _distinct(three, owner3.astype(np.int64), n) / n_three, "line_length": np.log1p(size / lines),
        "line_distinct": (_distinct(PolyHash(data).ranges(line_start, line_end), line_owner, n) / lines),
        "marked_end": _per_text((last >= 3) & (last <= 5), first) / words, "long_word": _per_text(length > 20, first) / words,
        "single": _per_text(length == 1, first) / words, "upper_word": _per_text((head == 1) & (second == 1) & (length > 1), first) / words,
        "run": np.log1p(run),
    }
    return np.stack([out[f] for f in FIGURES], axis=1)


@arrow_udf("array<double>")
def figures_of(texts: pa.Array) -> pa.Array:
    rows = [r for part in pieces(flat(texts)) for r in figures(part)]
    return pa.array(rows, pa.list_(pa.float64()))


# ------------------------------------------------------------------- model
def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int, float, float]:
    """Best split of a row of bins by gradient and hessian sums: gain, bins on the left, values left and right."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl ** 2 / (hl + 1) + gr ** 2 / (hr + 1)
    if not len(gain):
        v = g.sum() / (h.sum() + 1)
        return g.sum() ** 2 / (h.sum() + 1), len(g), v, v
    k = int(gain.argmax())
    return float(gain[k]), k + 1, float(gl[k] / (hl[k] + 1)), float(gr[k] / (hr[k] + 1))


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values of a tree of ``depth`` cuts over one row of bins."""
    _, k, left, right = _cut(g, h)
    out = np.empty(len(g))
    if depth > 1 and 0 < k < len(g):
        out[:k], out[k:] = _tree(g[:k], h[:k], depth - 1), _tree(g[k:], h[k:], depth - 1)
    else:
        out[:k], out[k:] = left, right
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best tree that cuts the rows of a table, then the columns of either side; its gain and its values."""
    best, table = -1.0, np.zeros_like(g)
    for k in range(1, len(g)):
        halves = [_cut(g[part].sum(axis=0), h[part].sum(axis=0)) for part in (slice(0, k), slice(k, None))]
        if (gain := halves[0][0] + halves[1][0]) > best:
            best = gain
            for part, (_, c, left, right) in zip((slice(0, k), slice(k, None)), halves, strict=True):
                table[part, :c], table[part, c:] = left, right
    return best, table


class Model:
    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.edges = [_edges(x[:, j], BINS) if len(x) else np.zeros(0) for j in range(len(FIGURES))]
        self.coarse = [_edges(x[:, j], PAIR_BINS) if len(x) else np.zeros(0) for j in range(len(FIGURES))]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
        self.bias = float(np.log(rate / (1 - rate)))
        if len(y) and 0 < y.mean() < 1:
            self._boost(x, y.astype(np.float64))

    def _boost(self, x: np.ndarray, y: np.ndarray) -> None:
        bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]
        coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.coarse)]
        z = np.full(len(y), self.bias)

        def sums(at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-z))
            return np.bincount(at, y - p, n), np.bincount(at, p * (1 - p), n)

        for _ in range(ROUNDS):
            for j, table in enumerate(self.tables):
                step = RATE * _tree(*sums(bins[j], len(table)))
                table += step
                z += step[bins[j]]
        found = []
        for j in range(len(FIGURES)):
            for k in range(j + 1, len(FIGURES)):
                shape = (len(self.coarse[j]) + 1, len(self.coarse[k]) + 1)
                if min(shape) > 1:
                    g, h = sums(coarse[j] * shape[1] + coarse[k], shape[0] * shape[1])
                    found.append((_pair_tree(g.reshape(shape), h.reshape(shape))[0], j, k, shape))
        for _, j, k, shape in sorted(found, key=lambda f: (-f[0], f[1], f[2]))[:PAIRS]:
            self.pairs.append((j, k, np.zeros(shape)))
        for _ in range(PAIR_ROUNDS):
            for j, k, table in self.pairs:
                at = coarse[j] * table.shape[1] + coarse[k]
                g, h = sums(at, table.size)
                step = RATE * _pair_tree(g.reshape(table.shape), h.reshape(table.shape))[1]
                table += step
                z += step.ravel()[at]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for j, table in enumerate(self.tables):
            z += table[np.searchsorted(self.edges[j], x[:, j], side="right")]
        for j, k, table in self.pairs:
            z += table[np.searchsorted(self.coarse[j], x[:, j], side="right"), np.searchsorted(self.coarse[k], x[:, k], side="right")]
        return 1 / (1 + np.exp(-z))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_labelled: int = MAX_LABELLED) -> Model:
    """Fit on about ``max_labelled`` rows of ``labels`` (doc_id, 0/1) and their texts."""
    known = labels.filter(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("_y"))
    sample = bounded_sample(known, "doc_id", max_labelled).withColumnRenamed("doc_id", "_id")
    got = (docs.select("doc_id", "text").join(sample, F.col("doc_id") == F.col("_id"), "inner")
           .select("doc_id", "_y", figures_of(F.coalesce("text", F.lit(""))).alias("x")).orderBy("doc_id", "_y", "x").collect())
    x = np.array([r["x"] for r in got]).reshape(len(got), len(FIGURES))
    return Model(x, np.array([r["_y"] for r in got]))


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score and predicted."""
    @arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([np.zeros(0), *(model.score(figures(part)) for part in pieces(flat(texts)))]), pa.float64())

    return (docs.withColumn("score", run(F.coalesce("text", F.lit(""))))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def quality_of_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; learns from labels whose id's crc32 mod 5 is not 0."""
    model = fit(docs, labels.filter(crc_mod(5) != 0))
    return scored(docs.select("doc_id", "text"), model).select(
        "doc_id", (crc_mod(5) == 0).alias("held_out"), "score", "predicted")
