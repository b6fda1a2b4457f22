"""Toxicity classifier: subword-bag embeddings and a linear softmax (operator 7).

A token's bag holds its hashed character n-grams (3 to 5, with the blanks
around it) and the token itself, so an unseen misspelling or inflection shares
most of its vectors with words seen.  A bag of ``WINDOW`` consecutive tokens is
averaged into one vector and a linear softmax tells clean from toxic.  A text
is as toxic as its windows under softmax attention, so a few words count in a
long text.  Embeddings and softmax are trained jointly, in numpy, from the
labels of whole texts (Adam on the full batch of a bounded sample).

The softmax is linear, so for scoring every vector folds into one number
(its margin), and a text costs a table look-up per n-gram.

Learns on the driver from about ``MAX_CLEAN`` and ``MAX_TOXIC`` labelled rows of the
two classes, weighted back to their shares; scores are for all rows.

Defined results: a text without a token (null, empty, only signs) gets the
margin of an empty bag (the bias); without both classes among the labels every
score is the share of class 1 (0 without labels); rows with a null label are not learned
from; repeated rows get equal scores; empty tables give empty results; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from lifetide.llm.common import BLANK, bounded_sample, codes_of, crc_mod, flat, grams, mix, pieces

MAX_CLEAN, MAX_TOXIC = 3_000, 2_000      # labelled rows of each class to learn from
BITS = 16                  # buckets of n-grams; as many for tokens
DIM = 16
WINDOW = 3
TRAIN_BYTES = 300_000      # of texts cut into n-grams at a time
EPOCHS = 60
RATE = 0.05
PENALTY = 1e-5
THRESHOLD = 0.7


def _tokens(codes: np.ndarray, starts: np.ndarray):
    """Starts and ends of the tokens and the text each belongs to."""
    solid = codes != BLANK
    edge = np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return begin, end, np.searchsorted(starts, begin, side="right") - 1


def _token_hash(codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every token, from prefix sums of hashed (place, code) pairs relative to its start."""
    place = np.arange(len(codes)) - np.repeat(np.append(0, begin), np.diff(np.concatenate([[0], begin, [len(codes)]])))
    h = mix(codes.astype(np.uint64) * np.uint64(0x10001) + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h, dtype=np.uint64)])
    return mix(total[end] - total[begin])


def _subwords(codes: np.ndarray, begin: np.ndarray, hashes: np.ndarray):
    """(token, bucket) of every member of every token's bag: its n-grams, then the token itself."""
    token = np.searchsorted(begin, np.arange(len(codes)), side="right") - 1
    owners, buckets = [], []
    for _, bucket, ok in grams(codes, 3, 5, BITS):
        # an n-gram that starts with the blank before a token belongs to that token
        at = np.flatnonzero(ok)
        own = token[at] + (codes[at] == BLANK)
        fine = (own >= 0) & (own < len(begin))
        owners.append(own[fine])
        buckets.append(bucket[at[fine]].astype(np.int64))
    owners.append(np.arange(len(begin)))
    buckets.append((hashes >> np.uint64(64 - BITS)).astype(np.int64) + (1 << BITS))
    return np.concatenate(owners), np.concatenate(buckets)


def _windows(owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First token of every window, and the text of every window."""
    first = np.searchsorted(owner, np.arange(n + 1))
    place = np.arange(len(owner)) - first[owner] if len(owner) else owner
    at = np.flatnonzero(place % WINDOW == 0)
    return at, owner[at]


def _attend(z: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Softmax attention of the windows of each text (``text`` ascending): weights, and margin of each text."""
    top = np.full(n, -np.inf)
    np.maximum.at(top, text, z)
    e = np.exp(z - top[text])
    a = e / np.bincount(text, e, n)[text]
    return a, np.bincount(text, a * z, n)


class Model:
    def __init__(self, texts, y: np.ndarray, share: float | None = None, seed: int = 11):
        """texts: Arrow string array; y: 0/1; share: of class 1 where the sample was drawn (that of the sample if None)."""
        n = len(y)
        self.margin = np.zeros(2 << BITS, np.float32)
        share = y.mean() if share is None and n else share
        rate = float(np.clip(share, 1e-4, 1 - 1e-4)) if n else 1e-9
        self.bias = float(np.log(rate / (1 - rate)))
        if n and 0 < y.mean() < 1:
            weight = np.where(y == 1, rate / y.mean(), (1 - rate) / (1 - y.mean()))
            self._train(texts, y.astype(np.float64), weight / n, np.random.default_rng(seed))

    def _train(self, texts, y: np.ndarray, of_text: np.ndarray, rng) -> None:
        n = len(y)
        # distinct tokens of the sample with their bags; every text as a list of token numbers
        seen: dict[int, int] = {}
        ids, owners, bag_token, bag_bucket, base = [], [], [], [], 0
        for part in pieces(texts, size=TRAIN_BYTES):
            codes, starts = codes_of(part, digits=True)
            begin, end, own = _tokens(codes, starts)
            h = _token_hash(codes, begin, end)
            uniq, first, inverse = np.unique(h, return_index=True, return_inverse=True)
            known = len(seen)
            number = np.fromiter((seen.setdefault(v, len(seen)) for v in uniq.tolist()), np.int32, len(uniq))
            ids.append(number[inverse])
            owners.append((own + base).astype(np.int32))
            # bags of the tokens that are new
            tok, bucket = _subwords(codes, begin, h)
            fresh = np.zeros(len(begin), bool)
            fresh[first[number >= known]] = True
            at = fresh[tok]
            bag_token.append(ids[-1][tok[at]])
            bag_bucket.append(bucket[at].astype(np.int32))
            base += len(part)
        n_tokens = len(seen)
        del seen
        ids, owner, bag_token, bag_bucket = (np.concatenate(v) for v in (ids, owners, bag_token, bag_bucket))
        size = np.bincount(bag_token, minlength=n_tokens).astype(np.float64)
        at, text = _windows(owner, n)
        if not len(at):
            return
        window_of = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(ids))))
        weight = np.add.reduceat(size[ids], at)

        vectors = rng.normal(0, 0.1, (2 << BITS, DIM)).astype(np.float32)
        out = rng.normal(0, 0.1, (2, DIM)).astype(np.float32)
        bias = np.array([0.0, self.bias])
        moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (vectors, out, bias)]
        for epoch in range(1, EPOCHS + 1):
            direction = out[1] - out[0]
            margin = vectors @ direction
            of_token = np.bincount(bag_token, margin[bag_bucket], n_tokens)
            z = np.add.reduceat(of_token[ids], at) / weight + (bias[1] - bias[0])
            a, score = _attend(z, text, n)
            has = np.bincount(text, minlength=n) > 0
            score = np.where(has, score, bias[1] - bias[0])
            err = (1 / (1 + np.exp(-score)) - y) * of_text
            g_window = err[text] * a / weight
            g_token = np.bincount(ids, g_window[window_of], n_tokens)
            g_bucket = np.bincount(bag_bucket, g_token[bag_token], 2 << BITS).astype(np.float32)
            g_out = g_bucket @ vectors
            grads = (np.outer(g_bucket, direction) + PENALTY * vectors, np.stack([-g_out, g_out]) + PENALTY * out,
                     np.array([-err.sum(), err.sum()]))
            for param, grad, (m, v) in zip((vectors, out, bias), grads, moments, strict=True):
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                param -= RATE * (m / (1 - 0.9 ** epoch)) / (np.sqrt(v / (1 - 0.99 ** epoch)) + 1e-9)
        touched = np.bincount(bag_bucket, minlength=2 << BITS) > 0
        # buckets that no training word has carry only their random start: no evidence
        self.margin = np.where(touched, vectors @ (out[1] - out[0]), 0).astype(np.float32)
        self.bias = float(bias[1] - bias[0])

    def score(self, texts) -> np.ndarray:
        n = len(texts)
        codes, starts = codes_of(texts, digits=True)
        begin, end, owner = _tokens(codes, starts)
        if not len(begin):
            return np.full(n, 1 / (1 + np.exp(-self.bias)))
        # margins and bag sizes by position, an n-gram counted where its token starts or goes on
        value, count = np.zeros(len(codes) + 1), np.zeros(len(codes) + 1)
        for _, bucket, ok in grams(codes, 3, 5, BITS):
            value[:len(bucket)] += np.where(ok, self.margin[bucket], 0)
            count[:len(bucket)] += ok
        own = (_token_hash(codes, begin, end) >> np.uint64(64 - BITS)).astype(np.int64) + (1 << BITS)
        value[begin] += self.margin[own]
        count[begin] += 1
        at, text = _windows(owner, n)
        # a window reaches from the blank before its first token to the blank before the next window
        z = np.add.reduceat(value, begin[at] - 1) / np.add.reduceat(count, begin[at] - 1) + self.bias
        _, score = _attend(z, text, n)
        has = np.bincount(text, minlength=n) > 0
        return 1 / (1 + np.exp(-np.clip(np.where(has, score, self.bias), -60, 60)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_clean: int = MAX_CLEAN, max_toxic: int = MAX_TOXIC) -> Model:
    """Fit on about so many rows of either class of ``labels`` (doc_id, 0/1) and their texts."""
    known = labels.filter(F.col(label).isin(0, 1)).select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y"))
    share = known.agg(F.avg("_y")).first()[0]
    sample = bounded_sample(known.filter("_y = 0"), "_id", max_clean).union(bounded_sample(known.filter("_y = 1"), "_id", max_toxic))
    got = (docs.select("doc_id", "text").join(sample, F.col("doc_id") == F.col("_id"), "inner")
           .select("doc_id", "_y", "text").orderBy("doc_id", "_y", "text").toArrow())
    y = got.column("_y").to_numpy()
    return Model(flat(got.column("text")).cast(pa.large_string()), y, share)


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)      # 512 KB, whatever the data

    @arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([np.zeros(0), *(shared.value.score(part) for part in pieces(flat(texts)))]), pa.float64())

    return (docs.withColumn("score", run(F.coalesce("text", F.lit(""))))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def toxicity_of_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; learns from labels whose id's crc32 mod 3 is not 1."""
    model = fit(docs, labels.filter(crc_mod(3) != 1))
    return scored(docs.select("doc_id", "text"), model).select(
        "doc_id", (crc_mod(3) == 1).alias("held_out"), "score", "predicted")
