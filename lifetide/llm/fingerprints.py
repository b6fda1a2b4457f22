"""Document fingerprints by context-triggered piecewise hashing (operator 6).

A rolling hash of the last seven bytes ends a chunk wherever it is -1 modulo the
block size 3 * 2^k; every chunk gives one base-64 character of its hash.  An
edit changes the characters of the chunks it touches and no others, since the
boundaries depend on seven bytes of context only.  k is the smallest for which
about 64 chunks cover the text, lowered until there are at least 32; a fingerprint
is ``block size:signature:signature at twice the block size``.

Two fingerprints compare where they have a block size in common: signatures
without four characters in a row in common are unlike (0), others score
1 - d / (sum of lengths), d being the edit distance by insertions and deletions.

The next document of the query (descending doc_id, after the last the first) is
found without a global window: documents are cut into ranges of ids (bounds by a
range partitioning of the ids alone), and each range also gets the first document of the range that
follows it.  One shuffle moves every text once; each range is then streamed in
order, with only two batches in memory.

Defined results: a null text counts as empty; its fingerprint is ``3::``, which
is like another empty one (1) and unlike all else (0); rows of one doc_id are
ordered by text, rows without one come last, by the hash of their text; a single document is its own next;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifetide.llm.common import PolyHash, text_or_empty

CHUNKS = 64                # characters of the first signature; half as many in the second
CONTEXT = 7                # bytes of the rolling hash
COMMON = 4                 # characters in a row that like signatures share
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
RANGES_PER_PARTITION = 4
ROWS_PER_RANGE = 10_000    # so many rows without an id are one range
_GAP = b"\0" * CONTEXT
_ROLL = (PolyHash.TABLE >> np.uint64(32)).astype(np.uint32)
_ROLL[0] = 0               # the gap between texts adds nothing


# ------------------------------------------------------------ fingerprints
def _levels(data: np.ndarray) -> np.ndarray:
    """For every byte the largest k for which a chunk ends there at block size 3 * 2^k; -1: at none."""
    values = _ROLL[data]
    h = values.copy()
    for j in range(1, CONTEXT):
        h[j:] += values[:-j] * np.uint32(pow(0x01000193, j, 1 << 32))
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    v = h + np.uint32(1)
    low = (v & (~v + np.uint32(1))).astype(np.float64)
    return np.where((v % 3 == 0) & (v > 0), np.log2(np.maximum(low, 1)), -1).astype(np.int8)


def fingerprints(texts: list[bytes]) -> list[str]:
    """The fingerprint of every text (UTF-8)."""
    if not texts:
        return []
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(_GAP.join(texts) + _GAP, np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes + CONTEXT)[:-1]])
    level = _levels(data)
    ends = np.flatnonzero(level >= 0)                     # last bytes of chunks at the smallest block size
    owner = np.searchsorted(starts, ends, side="right") - 1
    inside = ends < (starts + sizes)[owner]
    ends, owner, of = ends[inside], owner[inside], level[ends[inside]]
    n, top = len(texts), int(max(0, of.max(initial=0))) + 2
    # how many chunks a text has at each level: those that end, and a rest
    at_least = np.bincount(owner * top + np.minimum(of, top - 1), minlength=n * top).reshape(n, top)[:, ::-1].cumsum(axis=1)[:, ::-1]
    k = np.ceil(np.log2(np.maximum(sizes / (3 * CHUNKS), 1))).astype(np.int64)
    for _ in range(64):
        few = (k > 0) & (np.where(k < top, at_least[np.arange(n), np.minimum(k, top - 1)], 0) + 1 < CHUNKS // 2)
        if not few.any():
            break
        k -= few
    hashes = PolyHash(data)
    first = _signatures(hashes, ends, owner, of, k, starts, sizes, CHUNKS)
    second = _signatures(hashes, ends, owner, of, k + 1, starts, sizes, CHUNKS // 2)
    return [f"{3 << int(b)}:{s}:{t}" for b, s, t in zip(k, first, second, strict=True)]


def _signatures(hashes: PolyHash, ends, owner, of, k, starts, sizes, most: int) -> list[str]:
    n = len(sizes)
    use = of >= k[owner]
    ends, owner = ends[use], owner[use]
    first = np.searchsorted(owner, np.arange(n + 1))
    place = np.arange(len(owner)) - first[owner]
    fits = place < most - 1                               # the last character takes all that is left
    ends, owner = ends[fits], owner[fits]
    first = np.searchsorted(owner, np.arange(n + 1))
    count = np.diff(first)
    last = np.where(count > 0, ends[np.maximum(first[1:], 1) - 1] + 1 if len(ends) else 0, starts)
    rest = starts + sizes > last
    # chunks of all texts in order: those that end at a boundary, then the rest of the text
    total = np.concatenate([[0], np.cumsum(count + rest)])
    chunk_end = np.empty(total[-1], np.int64)
    chunk_end[np.arange(len(ends)) + np.concatenate([[0], np.cumsum(rest)])[owner] if len(ends) else []] = ends + 1
    chunk_end[total[1:][rest] - 1] = (starts + sizes)[rest]
    chunk_start = np.empty_like(chunk_end)
    chunk_start[1:] = chunk_end[:-1]
    has = total[1:] > total[:-1]
    chunk_start[total[:-1][has]] = starts[has]
    chars = ALPHABET[(hashes.ranges(chunk_start, chunk_end) >> np.uint64(58)).astype(np.int64)].tobytes().decode("ascii")
    return [chars[total[i]:total[i + 1]] for i in range(n)]


# ---------------------------------------------------------------- likeness
_LONG_RUN = re.compile(r"(.)\1{3,}")
_CODE = np.full(256, 64, np.uint8)
_CODE[ALPHABET] = np.arange(64)


def _scores(a: list[str], b: list[str]) -> np.ndarray:
    """Likeness of pairs of signatures of at most 64 characters, all pairs at once (bit-parallel common subsequence)."""
    a, b = [_LONG_RUN.sub(r"\1\1\1", s) for s in a], [_LONG_RUN.sub(r"\1\1\1", s) for s in b]
    n = len(a)
    la, lb = np.array([len(s) for s in a]), np.array([len(s) for s in b])
    if not n:
        return np.zeros(0)
    rows = np.arange(n)
    codes = [_CODE[np.frombuffer("".join(s.ljust(CHUNKS, ".") for s in side).encode(), np.uint8)].reshape(n, CHUNKS) for side in (a, b)]
    masks = np.zeros((n, 65), np.uint64)                 # where each character stands in a
    for i in range(CHUNKS):
        masks[rows, codes[0][:, i]] |= np.uint64(1) << np.uint64(i)
    masks[:, 64] = 0
    free = np.full(n, ~np.uint64(0))
    shorter = np.minimum(la, lb)
    need = np.minimum(COMMON, np.where(shorter > 1, np.maximum(1, shorter // 2), shorter))
    runs = [np.full(n, ~np.uint64(0))]
    shared = need == 0
    for j in range(CHUNKS):
        m = masks[rows, codes[1][:, j]]
        free = (free + (free & m)) | (free & ~m)
        # runs[r]: ends in a of common runs of r characters that end here
        runs = [np.full(n, ~np.uint64(0)), *[m & (r << np.uint64(1) if i else ~np.uint64(0)) for i, r in enumerate(runs[:COMMON])]]
        for r in range(1, len(runs)):
            shared |= (need == r) & (runs[r] != 0)
    common = np.bitwise_count(~free).astype(np.int64)
    total = np.maximum(la + lb, 1)
    score = np.where(shared & (la > 0) & (lb > 0), 2 * common / total, 0.0)
    return np.where(np.array([x == y for x, y in zip(a, b, strict=True)]), 1.0, score)


def likeness(a: list[str], b: list[str]) -> np.ndarray:
    """Likeness (0 to 1) of pairs of fingerprints, at the block sizes that both have."""
    pa_, pb = [s.split(":") for s in a], [s.split(":") for s in b]
    sa, sb = np.array([int(p[0]) for p in pa_], np.int64), np.array([int(p[0]) for p in pb], np.int64)
    out = np.zeros(len(a))
    for at, i, j in ((sa == sb, 1, 1), (sa == sb, 2, 2), (sa == 2 * sb, 1, 2), (2 * sa == sb, 2, 1)):
        where = np.flatnonzero(at)
        both = [(pa_[w][i], pb[w][j]) for w in where]
        # an empty second signature says nothing
        score = _scores([x for x, _ in both], [y for _, y in both])
        empty = np.array([not x and not y for x, y in both], bool)
        out[where] = np.maximum(out[where], np.where(empty & (i + j != 2), 0.0, score))
    return np.where(np.array([x == y for x, y in zip(a, b, strict=True)], bool), 1.0, out)


# ------------------------------------------------------------------- query
def _bounds(values: DataFrame, ranges: int) -> list[float]:
    """Where ``ranges`` ranges of the numbers ``v`` begin: the tops of a range partitioning of them, one number per range."""
    if ranges < 2:
        return []
    parts = values.repartitionByRange(ranges, "v").groupBy(F.spark_partition_id().alias("p")).agg(F.max("v").cast("double").alias("top"))
    return sorted({r["top"] for r in parts.collect()})[:-1]


def _range_of(bounds: list[float]):
    """A column: the range of number ``_v`` (as a double)."""
    from pyspark.ml.feature import Bucketizer

    if not bounds:
        return lambda df: df.withColumn("_part", F.lit(0))
    # a bound is the top of its range, so the next one begins just above it
    splits = [float("-inf"), *sorted({float(np.nextafter(b, np.inf)) for b in bounds}), float("inf")]
    return lambda df: (Bucketizer(splits=splits, inputCol="_r", outputCol="_b").transform(df.withColumn("_r", F.col("_v").cast("double")))
                       .withColumn("_part", F.col("_b").cast("int")).drop("_b", "_r"))


def with_follower(docs: DataFrame, ranges: int) -> DataFrame:
    """doc_id, text, _v, _part, _halo: every row in its range, and the first row of the range that follows.

    Ranges are of ids, and of hashes of the text for rows without an id (which come
    after all ids), so neither is one task's work.  The ranges' bounds and tops (a
    few numbers per range) go through the driver; no text and no per-row value does.
    """
    docs = docs.select("doc_id", text_or_empty().alias("text"))
    docs = docs.withColumn("_v", F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")))
    named, nameless = F.col("doc_id").isNotNull(), F.col("doc_id").isNull()
    n_nameless = docs.filter(nameless).count()
    below = _bounds(docs.filter(nameless).select(F.col("_v").alias("v")), ranges if n_nameless > ROWS_PER_RANGE else 1)
    above = _bounds(docs.filter(named).select(F.col("_v").alias("v")), ranges)
    # rows without an id have the lowest ranges: the order is from the highest range down
    cut = _range_of(above)(docs.filter(named)).withColumn("_part", F.col("_part") + F.lit(len(below) + 1))
    if n_nameless:
        cut = _range_of(below)(docs.filter(nameless)).unionByName(cut)
    tops = sorted(((r["_part"], r["top"]) for r in cut.groupBy("_part").agg(F.max("_v").alias("top")).collect()), reverse=True)
    # the first row of a range follows the last row of the range above; the first of all follows the last of all
    rows = [(part, top, tops[i - 1][0]) for i, (part, top) in enumerate(tops)]
    after = docs.sparkSession.createDataFrame(rows, "_p int, _top long, _to int")     # one row per range: bounded by their number
    own = F.struct(F.col("_part"), F.lit(False).alias("_halo"))
    also = F.struct(F.col("_to").alias("_part"), F.lit(True).alias("_halo"))
    spread = (cut.join(F.broadcast(after), F.col("_part") == F.col("_p"), "inner")
              .withColumn("_place", F.explode(F.when(F.col("_v") == F.col("_top"), F.array(own, also)).otherwise(F.array(own)))))
    return spread.select("doc_id", "text", "_v", "_place._part", "_place._halo")


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _compare(batches):
    """Rows in order (part, own before halo): each own row with the row that follows it."""
    held: tuple | None = None                             # the row whose follower is not known yet

    def results(rows: list[tuple]) -> pa.RecordBatch:
        """rows: (part, halo, doc_id, text); all but the last get a result, if their own."""
        texts = [r[3] for r in rows]
        prints = fingerprints([t.encode("utf-8", "replace") for t in texts])
        own = [i for i in range(len(rows) - 1) if not rows[i][1]]
        edited = []
        for i in own:
            cut = len(texts[i]) // 3
            edited.append((texts[i][:len(texts[i]) - cut] + texts[i + 1][:cut]).encode("utf-8", "replace"))
        new = fingerprints(edited)
        old = [prints[i] for i in own]
        return pa.RecordBatch.from_arrays([
            pa.array([rows[i][2] for i in own], pa.int64()), pa.array([len(texts[i]) for i in own], pa.int64()),
            pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()), pa.array(old, pa.string()), pa.array(new, pa.string()),
            pa.array(likeness(old, new), pa.float64()), pa.array(likeness(old, [prints[i + 1] for i in own]), pa.float64())],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    for batch in batches:
        part, halo, ids = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("_part", "_halo", "doc_id"))
        texts = batch.column(batch.schema.get_field_index("text"))
        lo = 0
        while lo < batch.num_rows:
            hi, size = lo, 0
            while hi < batch.num_rows and (hi == lo or (hi - lo < 512 and size < 2_000_000)):
                size += len(texts[hi].as_buffer())
                hi += 1
            rows = list(zip(part[lo:hi], halo[lo:hi], ids[lo:hi], texts.slice(lo, hi - lo).to_pylist(), strict=True))
            rows = [held, *rows] if held else rows
            yield results(rows)
            held, lo = rows[-1], hi


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like they and the next document's are."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = with_follower(docs, partitions * RANGES_PER_PARTITION)
    ordered = (placed.repartition(partitions, "_part")
               .sortWithinPartitions("_part", "_halo", F.col("_v").desc(), "text"))
    return ordered.drop("_v").mapInArrow(_compare, SCHEMA)
