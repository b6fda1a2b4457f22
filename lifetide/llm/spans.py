"""Substring dedup by sliding sentence spans (operator 4).

From every sentence of every text a run of consecutive sentences starts: the
shortest run of at least ``MIN_SENTENCES`` sentences and ``MIN_WORDS`` words (a
sentence of ``LONG_SENTENCE`` words is a run by itself).  Runs are hashed over
their words (A-Z lower-cased, blanks ignored) and met globally by hash.  Of
equal runs, the first by (doc_id, hash of the text, position) stays; the sentences that any other
one covers are removed from their texts.

Only two hashes, an id and two small numbers per sentence are shuffled.  Equal runs
are counted by a partial aggregate, so a run that a third of all documents hold
is one row per map task; the join that finds its other places is one that
Spark can split.  Texts move once, to meet what is to be cut out of them.

Defined results: null and empty texts stay as they are, with 0 sentences; a
text of too few words has no run and keeps all; a copy of an earlier text loses
all its sentences that lie in runs; rows equal in doc_id and text count as one
document (they do not remove each other), rows of one doc_id (or of none) with
different texts are documents of their own; empty tables give empty results; extra
columns pass through (those named like the two counts are replaced).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from lifetide.llm.common import _P, _PINV, _powers, columns_but, flat, free_name, mix, pack, pieces, stage, text_or_empty, words_of

MIN_SENTENCES = 2
MIN_WORDS = 16
LONG_SENTENCE = 40
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?")] = True


def _sentences(texts):
    """Word starts (bytes), word hashes, first word of every sentence, text of every sentence, first word of every text."""
    data, start, end, hashes, first = words_of(texts)
    n_words = len(start)
    opens = np.zeros(n_words, bool)
    if n_words:
        opens[first[:-1][first[:-1] < n_words]] = True
        opens[1:] |= _ENDS[data[end[:-1] - 1]]
        feeds = np.concatenate([[0], np.cumsum(data == 10)])
        opens[1:] |= feeds[start[1:]] > feeds[end[:-1]]
    sentence = np.flatnonzero(opens)
    return start, hashes, sentence, np.searchsorted(first, sentence, side="right") - 1, first


def _runs(hashes: np.ndarray, sentence: np.ndarray, owner: np.ndarray, first: np.ndarray):
    """For the sentences a run starts from: which they are, how many sentences it has, its hash."""
    n = len(sentence)
    bound = np.append(sentence, len(hashes))
    at = np.arange(n)
    own_words = bound[1:] - sentence
    stop = np.searchsorted(bound, sentence + MIN_WORDS, side="left")        # first bound with enough words before it
    stop = np.maximum(stop, at + MIN_SENTENCES)
    stop = np.where(own_words >= LONG_SENTENCE, at + 1, stop)
    last_of_text = np.searchsorted(owner, owner, side="right")              # first sentence of the next text
    ok = stop <= last_of_text
    at, stop = at[ok], stop[ok]
    lo, hi = bound[at], bound[stop]
    acc = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes) * _powers(len(hashes), _P)[:len(hashes)], dtype=np.uint64)])
    h = mix((acc[hi] - acc[lo]) * _powers(len(hashes) + 1, _PINV)[lo] + (hi - lo).astype(np.uint64))
    return at, stop - at, h


RUN = pa.struct([("pos", pa.int32()), ("len", pa.int32()), ("h", pa.int64())])


@arrow_udf("array<struct<pos:int,len:int,h:bigint>>")
def runs_of(texts: pa.Array) -> pa.Array:
    out = []
    for part in pieces(flat(texts)):
        _, hashes, sentence, owner, first = _sentences(part)
        at, length, h = _runs(hashes, sentence, owner, first)
        text = owner[at]
        pos = at - np.searchsorted(owner, text)
        ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(part)))]).astype(np.int32)
        rows = pa.StructArray.from_arrays([pa.array(pos.astype(np.int32)), pa.array(length.astype(np.int32)), pa.array(h.view(np.int64))],
                                          fields=list(RUN))
        out.append(pa.ListArray.from_arrays(pa.array(ends), rows))
    return pa.concat_arrays(out) if out else pa.array([], pa.list_(RUN))


@arrow_udf("text string, n_sentences long, n_removed long")
def without(texts: pa.Array, cuts: pa.Array) -> pa.Array:
    """Texts without the sentences covered by runs ``cuts`` (position * 2^32 + length, or null)."""
    texts, cuts = flat(texts), flat(cuts)
    kept, total, removed, base = [], [], [], 0
    for part in pieces(texts):
        data, offsets = pack(part)
        start, _, sentence, owner, _ = _sentences(part)
        first = np.searchsorted(owner, np.arange(len(part) + 1))
        begin = start[sentence]
        for i, text in enumerate(part):
            n = int(first[i + 1] - first[i])
            cut = cuts[base + i].as_py()
            total.append(n)
            if not cut:
                kept.append(text.as_py())
                removed.append(0)
                continue
            gone = np.zeros(n + 1, np.int64)
            runs = np.array(cut, np.int64)
            pos = runs >> 32
            np.add.at(gone, pos, 1)
            np.add.at(gone, pos + (runs & 0xFFFFFFFF), -1)
            gone = np.cumsum(gone)[:n] > 0
            raw = data[offsets[i]:offsets[i + 1] - 1].tobytes()
            marks = np.append(begin[first[i]:first[i + 1]] - offsets[i], len(raw))
            head = raw[:marks[0]]
            kept.append((head + b"".join(raw[marks[s]:marks[s + 1]] for s in np.flatnonzero(~gone))).decode("utf-8"))
            removed.append(int(gone.sum()))
        base += len(part)
    return pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64())],
                                      names=["text", "n_sentences", "n_removed"])


def _text_key():
    """Tells the rows of one doc_id apart."""
    return F.xxhash64(text_or_empty())


def repeated_runs(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the text), pos, len of every run that equals an earlier one."""
    runs = stage(docs.select("doc_id", _text_key().alias("key"), F.explode(runs_of(text_or_empty())).alias("r"))
                 .select("doc_id", "key", "r.*"), "span-runs")
    place = F.struct("doc_id", "key", "pos")
    firsts = (runs.groupBy("h").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1).select(F.col("h").alias("_h"), "first"))
    return (runs.join(firsts, F.col("h") == F.col("_h"), "inner")
            .filter(~place.eqNullSafe(F.col("first"))).select("doc_id", "key", "pos", "len"))


def dedup_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with cleaned texts, n_sentences and n_removed."""
    owner, key, cut, new = (free_name(docs, n) for n in ("_owner", "_key", "_cut", "_new"))
    cuts = (repeated_runs(docs).groupBy(F.col("doc_id").alias(owner), F.col("key").alias(key))
            .agg(F.collect_set(F.col("pos").cast("long") * F.lit(1 << 32) + F.col("len")).alias(cut)))
    joined = docs.join(cuts, F.col("doc_id").eqNullSafe(F.col(owner)) & (_text_key() == F.col(key)), "left")
    out = joined.withColumn(new, without(text_or_empty(), F.col(cut)))
    cols = [F.when(F.col("text").isNotNull(), F.col(f"{new}.text")).alias("text") if c == "`text`" else F.col(c)
            for c in columns_but(docs, "n_sentences", "n_removed")]
    return out.select(*cols, f"{new}.n_sentences", f"{new}.n_removed")
