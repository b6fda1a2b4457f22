"""Exact top-k inner products by MaxScore (operator 11).

Every component x of a vector becomes floor(256 * x).  The dimensions are the
terms: the posting list of a term is its column, one weight per vector.  Within
a tile of vectors a term's contribution to a query is at most
``max(q * largest weight, q * smallest weight)``.  A query orders its terms by that
bound; the longest run of smallest ones whose bounds add up to less than the
threshold (its k-th best score so far) is non-essential.  A tile whose bounds all
together stay below the threshold is skipped.  Else the essential postings are
traversed, and a vector goes on to the non-essential terms, largest bound first,
only while its partial score and the bounds that are left can still reach the
threshold.  Scores are integers below 2^24 or 2^53 and so are exact as floats;
larger ones are computed with Python's integers.

Queries are dealt into blocks and vectors into shards of bounded size, and every
block meets every shard in one task (a cell), so no task and no driver holds
either side whole.  A cell returns its k best per query; the cells of a query are
merged by rank.  Rows are dealt by hash, with a salt on the vectors, so copies of
one vector do not meet in one cell.

Defined results: vectors that are null or hold null, NaN or infinite components
take no part; vectors of different length are compared as if the shorter one
ended in zeros (so an empty vector scores 0 with all); equal rows count once;
rows with the query's vec_id are its own and no candidates; several vectors of one
vec_id are one query, whose best scores are returned; rows without vec_id are
candidates, after the others in ties, but no queries; scores beyond 64 bits count
as the largest or smallest long; empty tables give empty results; extra columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE = 256
TOP = 5
EVERY = 50                 # queries: rows whose vec_id this divides
CELL = 1 << 22             # components of a shard, and of a block
TILE = 1 << 18             # components of a tile
PROBED = 8                 # non-essential terms probed at a time
LEAST_SHARD = 1024         # vectors; smaller tables make fewer cells than there are cores
LEAST, MOST = -2**63, 2**63 - 1

PARTIAL = "query_id long, vec_id long, score long"
_PARTIAL = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def prepared(vectors: DataFrame, id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """(id, vec) of the rows that take part; floats stay floats."""
    kind = vectors.schema[col].dataType.elementType
    vec = F.col(col) if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col(col).cast("array<double>")
    return vectors.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).filter(usable(F.col("vec")))


# ------------------------------------------------------------------ one cell
class _Side:
    """Vectors of one side of a cell, shortest first: ids, and integer weights as float64."""

    def __init__(self, table: pa.Table):
        vec, ids = table["vec"].combine_chunks(), table["id"].combine_chunks()
        offsets = vec.offsets.to_numpy().astype(np.int64)
        size = np.diff(offsets)
        self.order = np.argsort(size, kind="stable")
        self.size, self.begin = size[self.order], offsets[:-1][self.order]
        self.weights = np.floor(vec.values.to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
        self.null = ids.is_null().to_numpy(zero_copy_only=False)[self.order]
        self.ids = ids.fill_null(0).to_numpy()[self.order]

    def tiles(self, cells: int):
        """Slices of about ``cells`` components (or one vector)."""
        lo, n = 0, len(self.size)
        while lo < n:
            fits = np.arange(1, n - lo + 1) * np.maximum(self.size[lo:], 1)
            up = lo + max(1, int(np.searchsorted(fits, cells, side="right")))
            yield lo, up
            lo = up

    def matrix(self, lo: int, up: int) -> np.ndarray:
        """One row per vector, zeros after its end."""
        size, width = self.size[lo:up], int(self.size[up - 1])
        out = np.zeros((up - lo, width))
        place = np.arange(width)[None, :] < size[:, None]
        out[place] = self.weights[(self.begin[lo:up, None] + np.arange(width)[None, :])[place]]
        return out


class _Best:
    """The k best (score, id) of one query so far."""

    __slots__ = ("k", "rows")

    def __init__(self, k: int):
        self.k, self.rows = k, []

    @property
    def threshold(self):
        full = len(self.rows) == self.k and self.rows[-1][0] > LEAST
        return self.rows[-1][0] if full else None

    def add(self, scores, null, ids):
        """Ranks what is found with what is there; equal rows count once."""
        if scores.dtype == object:
            scores = np.array([min(max(s, LEAST), MOST) for s in scores], object)
        if len(scores) > self.k:
            order = np.lexsort((ids, null, -scores))
            s, m, i = scores[order], null[order], ids[order]
            new = np.ones(len(order), bool)
            new[1:] = (s[1:] != s[:-1]) | (m[1:] != m[:-1]) | (i[1:] != i[:-1])
            pick = np.flatnonzero(new)[:self.k]
            scores, null, ids = s[pick], m[pick], i[pick]
        rows = {*self.rows, *((int(s), bool(m), int(i)) for s, m, i in zip(scores, null, ids, strict=True))}
        self.rows = sorted(rows, key=lambda r: (-r[0], r[1], r[2]))[:self.k]


def exact_type(q: np.ndarray, v: np.ndarray):
    """The smallest type in which all inner products, and parts of them, are exact."""
    a, b = (float(np.abs(x).max()) if x.size else 0.0 for x in (q, v))
    most = max(a * b * max(1, q.shape[1]), a, b)
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else object


def _whole(x: np.ndarray) -> np.ndarray:
    out = np.empty(x.shape, object)
    out[...] = [[int(v) for v in row] for row in x]
    return out


def max_score(q: np.ndarray, bounds: np.ndarray, order: np.ndarray, sums: np.ndarray, postings: np.ndarray, threshold):
    """Places and scores of the vectors of a tile that reach ``threshold``.

    ``order``: the query's terms by bound, ``sums``: running sums of those bounds.
    """
    below = int(np.searchsorted(np.maximum.accumulate(sums), threshold, side="left"))
    if below == len(order):
        return None                             # no vector of the tile can
    essential, left = order[below:], sums[below - 1] if below else 0
    score = q[essential] @ postings[essential]
    at = np.flatnonzero(score + left >= threshold)
    score = score[at]
    while below and len(at):
        step = PROBED if len(at) > 32 else below
        terms = order[max(0, below - step):below]
        score = score + q[terms] @ postings[np.ix_(terms, at)]
        below = max(0, below - step)
        left = sums[below - 1] if below else 0
        live = score + left >= threshold
        at, score = at[live], score[live]
    return at, score


def search_cell(queries: pa.Table, vectors: pa.Table, k: int) -> pa.Table:
    """The k best vectors of a shard for every query of a block."""
    if not queries.num_rows or not vectors.num_rows:
        return _PARTIAL.empty_table()
    asked, there = _Side(queries), _Side(vectors)
    best = [_Best(k) for _ in asked.ids]
    for q_lo, q_up in asked.tiles(TILE):
        all_q = asked.matrix(q_lo, q_up)
        for lo, up in there.tiles(TILE):
            v, q = there.matrix(lo, up), all_q
            width = min(v.shape[1], q.shape[1])         # beyond it one side is zero
            v, q = v[:, :width], q[:, :width]
            kind = exact_type(q, v)
            q, postings = (_whole(q), _whole(v.T)) if kind is object else (q.astype(kind), np.ascontiguousarray(v.T.astype(kind)))
            null, ids = there.null[lo:up], there.ids[lo:up]
            if width:
                bounds = np.maximum(q * postings.max(axis=1), q * postings.min(axis=1))
                order = np.argsort(bounds, axis=1, kind="stable")
                sums = np.cumsum(np.take_along_axis(bounds, order, axis=1), axis=1)
            for i in range(q_up - q_lo):
                mine = best[q_lo + i]
                theta = mine.threshold
                if theta is None or not width:
                    score = q[i] @ postings if width else np.zeros(up - lo)
                    at = np.flatnonzero((ids != asked.ids[q_lo + i]) | null)
                    score = score[at]
                else:
                    found = max_score(q[i], bounds[i], order[i], sums[i], postings, theta)
                    if found is None:
                        continue
                    at, score = found
                    other = (ids[at] != asked.ids[q_lo + i]) | null[at]
                    at, score = at[other], score[other]
                if len(at):
                    mine.add(score, null[at], ids[at])
    rows = [(int(i), None if m else j, s) for i, b in zip(asked.ids, best, strict=True) for s, m, j in b.rows]
    return pa.table([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], schema=_PARTIAL)


# ------------------------------------------------------------------ all cells
def search(vectors: DataFrame, queries: DataFrame, k: int = TOP, cell: int = CELL) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of ``vectors`` for every row of ``queries`` (both: id, vec)."""
    spark = vectors.sparkSession
    queries = queries.filter(F.col("id").isNotNull()).dropDuplicates(["id", "vec"])
    counts = vectors.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("vec")).alias("c")).first()
    asked = queries.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("vec")).alias("c")).first()
    blocks = max(1, -(-int((asked["c"] or 0) + asked["n"]) // cell))
    shards = max(1, -(-int((counts["c"] or 0) + counts["n"]) // cell),
                 min(4 * spark.sparkContext.defaultParallelism, -(-counts["n"] // LEAST_SHARD)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    ask = (queries.withColumn("_block", F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)).cast("int"))
           .select("id", "vec", "_block", every(shards).alias("_shard")))
    salted = F.xxhash64(F.coalesce("id", F.lit(0)), F.monotonically_increasing_id())
    have = (vectors.withColumn("_shard", F.pmod(salted, F.lit(shards)).cast("int"))
            .select("id", "vec", "_shard", every(blocks).alias("_block")))

    def one(_key, left: pa.Table, right: pa.Table) -> pa.Table:
        return search_cell(left, right, k)

    part = ask.groupBy("_block", "_shard").cogroup(have.groupBy("_block", "_shard")).applyInArrow(one, PARTIAL)
    # shards of a query meet: k rows of each
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return (part.repartition("query_id").dropDuplicates(["query_id", "vec_id", "score"])
            .withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def search_vectors(vectors: DataFrame, every: int = EVERY, k: int = TOP) -> DataFrame:
    """The ``k`` best of all rows for every row whose vec_id ``every`` divides."""
    all_rows = prepared(vectors)
    return search(all_rows, all_rows.filter(F.col("id") % every == 0), k)
