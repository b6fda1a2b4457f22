"""N-gram Jaccard join in size-banded tiles with bitmap signatures (operator 1).

Sets of 5-word shingles; two texts link when 100 * |A n B| >= 80 * |A u B|.
Exact: no link between different texts is lost, and none is made up.

1. A sketch over all texts counts shingles by hash cell.  It orders shingles
   rarest first; any common order keeps the join exact, this one keeps
   boilerplate out of the prefixes.
2. Every text gives its set's size, a 128-bit key (equal sets are one class from
   here on), a bitmap and the prefix: the first n - ceil(0.8 n) + 1 shingles,
   of which two linked sets share one.
3. A tile is a prefix shingle and a size band: the sets of that band (own) and
   of the band below (guests) that have the shingle.  Linked sets share a tile.
   Tiles with the same members are one tile.
4. In a tile, bit counts bound every overlap from above; sets with a pair that
   passes are brought together with their texts and intersected exactly, the
   most promising pairs first, but for pairs that are already joined.  Only
   links that join two components leave a task.  This is done twice: first
   every set in its largest tile only, so groups of near copies become few
   components at the cost of one row per set; then every set in all tiles that
   still hold several components, for the pairs not looked at before.
5. Components of the exact links; copies get their class's component.

What grows: prefixes are shuffled as (shingle, set) rows, bitmaps and texts
only for sets that share a tile.  Tiles over ``BLOCK`` sets are dealt in blocks.

Defined results: null, empty and blank texts have n_shingles 0 and are their own
component; repeated rows and copies link; a class of null ids only has a null
component; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from lifetide.llm.common import columns_but, flat, free_name, mix, pieces, release, stage
from lifetide.llm.components import components
from lifetide.llm.shingles import CELL_BITS, bitmap, bitmap_bits, cells, fold, needed, overlap_bound, prefix_length, rank, shingle_hashes

PERCENT = 80
BLOCK = 1024               # sets of one tile that are compared in one piece ...
BLOCK_SHINGLES = 2_000_000 # ... and about how many shingles they have in all
PARTS = 3                  # the prefixes are shuffled a part at a time, which bounds the disk that holds them
CELLS_PER_ROW = 1024
_BAND = 1.2501             # a little over 100 / 80: linked sizes differ by one band at most


# ------------------------------------------------------------------- sketch
def _count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << CELL_BITS, np.int64)
    for batch in batches:
        for part in pieces(batch.column(0)):
            hashes, _ = shingle_hashes(part)
            total += np.bincount(cells(hashes), minlength=len(total))
    rows = total.reshape(-1, CELLS_PER_ROW)
    used = np.flatnonzero(rows.any(axis=1))
    # 32 bits suffice for one task's counts
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array([rows[i].astype(np.int32).tobytes() for i in used], pa.binary())],
                                     names=["chunk", "counts"])


def _add_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total[chunk] = total.get(chunk, 0) + np.frombuffer(counts, np.int32).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
                                     names=["chunk", "counts"])


def levels(docs: DataFrame) -> np.ndarray:
    """Half-octave of the count of every cell: 256 KB, whatever the data."""
    rows = 1 << CELL_BITS >> CELLS_PER_ROW.bit_length() - 1
    schema = "chunk int, counts binary"
    counted = docs.select(F.coalesce("text", F.lit(""))).mapInArrow(_count_cells, schema)
    total = np.zeros((rows, CELLS_PER_ROW), np.int64)
    for row in counted.repartition(min(rows, 64), "chunk").mapInArrow(_add_cells, schema).collect():
        total[row["chunk"]] = np.frombuffer(row["counts"], np.int64)
    return np.minimum(63, 2 * np.log2(np.maximum(total.ravel(), 1))).astype(np.uint8)


# --------------------------------------------------------------- signatures
SIGNATURE = pa.struct([("n", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("bits", pa.binary()), ("prefix", pa.list_(pa.int64()))])


def _set_key(hashes: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums over well-mixed members, as signed numbers."""
    both = np.array([mix(hashes).sum(dtype=np.uint64), mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)])
    return tuple(int(v) for v in both.view(np.int64))


def _signature_udf(level: np.ndarray, percent: int):
    @arrow_udf("n long, k1 long, k2 long, bits binary, prefix array<bigint>")
    def run(texts: pa.Array) -> pa.Array:
        rows = []
        for part in pieces(flat(texts)):
            hashes, bound = shingle_hashes(part)
            for i in range(len(part)):
                own = np.unique(hashes[bound[i]:bound[i + 1]])
                n = len(own)
                if not n:
                    rows.append({"n": 0, "k1": None, "k2": None, "bits": None, "prefix": None})
                    continue
                k1, k2 = _set_key(own)
                bits = prefix = None
                if 100 * n >= percent * (n + 1):          # else only an equal set is alike enough
                    m = prefix_length(n, percent)
                    bits = bitmap(own, bitmap_bits(n)).tobytes()
                    order = rank(own, level)
                    first = np.argpartition(order, m - 1)[:m]
                    prefix = own[first[np.argsort(order[first])]].view(np.int64)
                rows.append({"n": n, "k1": k1, "k2": k2, "bits": bits, "prefix": prefix})
        return pa.array(rows, SIGNATURE)
    return run


@arrow_udf("long")
def set_key_of(texts: pa.Array) -> pa.Array:
    out = []
    for part in pieces(flat(texts)):
        hashes, bound = shingle_hashes(part)
        for i in range(len(part)):
            own = np.unique(hashes[bound[i]:bound[i + 1]])
            out.append(_set_key(own)[0] if len(own) else None)
    return pa.array(out, pa.int64())


def signatures(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_key (a hash that tells the rows of one doc_id apart), n, k1, k2, bits, prefix of every document (staged)."""
    run = _signature_udf(levels(docs), percent)
    return stage(docs.select("doc_id", F.xxhash64("text").alias("text_key"), run(F.coalesce("text", F.lit(""))).alias("s"))
                 .select("doc_id", "text_key", "s.*"), "signatures")


# -------------------------------------------------------------------- tiles
def tile_members(sigs: DataFrame, percent: int, block: int) -> DataFrame:
    """Every set in every different tile: tile, size and blocks (of the tile), own, node, n, cell and cell_own (its home), at_home (staged).

    All tables here grow with the corpus, so none is offered for broadcast.
    """
    # reach: if this shingle is the first that two sets share, no partner larger than this overlaps enough
    tokens = (sigs.filter("prefix is not null").select(F.col("k1").alias("node"), "n", F.posexplode("prefix").alias("i", "token"))
              .select("token", "node", F.col("n").cast("int").alias("n"),
                      F.floor((100 + percent) * (F.col("n") - F.col("i")) / percent - F.col("n")).cast("int").alias("reach")))
    # both shuffles of the prefixes hold a part of the shingles at a time; their files go before the next part's come
    parts = []
    for part in range(PARTS):
        mine = tokens.filter(F.pmod("token", F.lit(PARTS)) == part)
        twice = (mine.groupBy(F.col("token").alias("t")).agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("low"))
                 .filter("c > 1").select("t", "low"))
        parts.append(stage(mine.join(twice.hint("merge"), F.col("token") == F.col("t"), "inner").filter("reach >= low")
                           .select("token", "node", "n", "reach").distinct(), "shared"))
    shared = functools.reduce(DataFrame.union, parts)
    # shingles with the same sets are one tile: one shingle of each different group; of two sets, the smaller must reach the larger
    groups = (shared.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("node")).alias("x1"),
                                          F.bit_xor(F.xxhash64("node", F.lit(3))).alias("x2"),
                                          F.min(F.struct("n", "reach")).alias("least"), F.max("n").alias("high"))
              .filter("c > 2 or (c = 2 and least.reach >= high)").groupBy("x1", "x2", "c").agg(F.min("token").alias("t")).select("t"))
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(_BAND))).cast("int")
    placed = stage(shared.join(groups.hint("merge"), F.col("token") == F.col("t"), "inner").withColumn("band", band)
                   .select("token", "node", "n", F.explode(F.array(F.struct(F.col("band").alias("band"), F.lit(True).alias("own")),
                                                                   F.struct((F.col("band") + 1).alias("band"), F.lit(False).alias("own")))).alias("p"))
                   .select(F.xxhash64("token", "p.band").alias("tile"), "p.own", "node", "n"), "placed")
    release(*parts)
    # a tile of long texts is dealt in smaller blocks
    rows = F.least(F.lit(block), F.greatest(F.lit(16), F.lit(BLOCK_SHINGLES) / F.avg("n")))
    tiles = (placed.groupBy("tile").agg(F.count(F.lit(1)).alias("size"), F.count_if("own").alias("n_own"), rows.alias("rows"),
                                        F.min(F.when(F.col("own"), F.col("n"))).alias("low"), F.max(F.when(~F.col("own"), F.col("n"))).alias("high"))
             .filter(f"size > 1 and (n_own > 1 or (n_own = 1 and 100 * high >= {percent} * low))").select(F.col("tile").alias("t"), "size", F.ceil(F.col("size") / F.col("rows")).cast("int").alias("blocks")))
    members = placed.join(tiles.hint("merge"), F.col("tile") == F.col("t"), "inner").select("tile", "size", "blocks", "own", "node", "n")
    members = stage(members, "tiles")
    release(placed)
    # a set's home is its largest tile (one block of it); pairs of one home are looked at there
    homes = members.groupBy(F.col("node").alias("h")).agg(F.max(F.struct("size", "tile", "blocks", "own")).alias("home"))
    cell = F.xxhash64("home.tile", F.pmod(F.xxhash64("node"), F.col("home.blocks")))
    homed = stage(members.join(homes.hint("merge"), F.col("node") == F.col("h"), "inner")
                  .select("tile", "size", "blocks", "own", "node", "n", cell.alias("cell"), F.col("home.own").alias("cell_own"),
                          (F.col("tile") == F.col("home.tile")).alias("at_home")), "members")
    release(members)
    return homed


def node_bits(sigs: DataFrame, members: DataFrame, classes: DataFrame) -> DataFrame:
    """(b_node, bits) of every set in a tile (staged)."""
    nodes = representatives(members.filter("at_home").select("node"), classes)
    return stage(sigs.select("doc_id", "k1", "bits").join(nodes, F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("k1") == F.col("_node")), "inner")
                 .groupBy(F.col("_node").alias("b_node")).agg(F.first("bits").alias("bits")), "node-bits")


def representatives(nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """(_node, rep) of distinct nodes."""
    return nodes.select(F.col("node").alias("_node")).distinct().join(classes, F.col("_node") == F.col("k1"), "inner").select("_node", "rep")


def _words(maps: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Bitmaps of one common length (the shortest), as rows of 64-bit words."""
    least = min(len(m) for m in maps)
    out = np.empty((len(maps), least), np.uint8)
    for length in {len(m) for m in maps}:
        at = [i for i, m in enumerate(maps) if len(m) == length]
        part = np.frombuffer(b"".join(maps[i] for i in at), np.uint8).reshape(len(at), length)
        while part.shape[1] > least:
            part = fold(part)
        out[at] = part
    return np.ascontiguousarray(out).view(np.uint64)


def _passing(g: Group, maps: np.ndarray, percent: int, rows: slice, cols: slice) -> np.ndarray:
    """Weight (bound of the overlap by size) of each pair rows x cols; -1 where it cannot link or need not be looked at."""
    bound = overlap_bound(maps[rows], g.n[rows], maps[cols], g.n[cols])
    low, high = np.minimum(g.n[rows][:, None], g.n[cols][None, :]), np.maximum(g.n[rows][:, None], g.n[cols][None, :])
    ok = (bound >= needed(g.n[rows][:, None], g.n[cols][None, :], percent)) & (100 * low >= percent * high)
    ok &= (g.own[rows][:, None] | g.own[cols][None, :]) & (g.comp[rows][:, None] != g.comp[cols][None, :])
    # both of one home, where all pairs but those of two guests were looked at
    ok &= ~(g.seen & (g.cell[rows][:, None] == g.cell[cols][None, :]) & (g.cell_own[rows][:, None] | g.cell_own[cols][None, :]))
    return np.where(ok, 1000 * bound // np.maximum(high, 1), -1)


_FIELDS = (("tile", "long", pa.int64()), ("i", "int", pa.int32()), ("j", "int", pa.int32()), ("seen", "boolean", pa.bool_()),
           ("side", "int", pa.int32()), ("own", "boolean", pa.bool_()), ("node", "long", pa.int64()), ("n", "int", pa.int32()),
           ("comp", "long", pa.int64()), ("cell", "long", pa.int64()), ("cell_own", "boolean", pa.bool_()), ("bits", "binary", pa.binary()))
_COLUMNS = [name for name, _, _ in _FIELDS]
_LINKS = "a long, b long"


class Group:
    """The sets of one block of a tile (i = j), or of two: columns as arrays."""

    def __init__(self, rows: list[tuple]):
        columns = dict(zip([*_COLUMNS, "text"], zip(*rows, strict=True)))
        self.rows, self.seen, self.bits, self.text = rows, bool(rows[0][3]), list(columns["bits"]), columns.get("text")
        self.side, self.node, self.n, self.comp, self.cell = (np.array(columns[c], np.int64) for c in ("side", "node", "n", "comp", "cell"))
        self.own, self.cell_own = (np.array(columns[c], bool) for c in ("own", "cell_own"))

    def pairs(self, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs (rows a, b) that pass, with their weight; of a group of two blocks those across them."""
        left, right, weights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(self.n) > 1 and (self.comp != self.comp[0]).any():
            maps = _words(self.bits, self.n)
            alone = (self.side == self.side[0]).all()
            for lo in range(0, len(self.n), 256):
                weight = _passing(self, maps, percent, slice(lo, lo + 256), slice(0, len(self.n)))
                a, b = np.nonzero(weight >= 0)
                fits = (a + lo < b) if alone else (self.side[a + lo] < self.side[b])
                left.append(a[fits] + lo)
                right.append(b[fits])
                weights.append(weight[a[fits], b[fits]])
        return np.concatenate(left), np.concatenate(right), np.concatenate(weights)


def _groups(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[Group]:
    """Runs of rows with equal (tile, i, j) of sorted batches."""
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (*_COLUMNS, *more)), strict=True)
    for _, group in groupby(rows(), key=lambda r: r[:3]):
        yield Group(list(group))


def _with_open_pair(percent: int):
    """The rows of every group that have a pair which passes the bound."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches):
            a, b, _ = g.pairs(percent)
            if len(a):
                kept = [(*g.rows[r][:-1], None) for r in np.unique(np.concatenate([a, b])).tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, _, kind) in zip(zip(*kept, strict=True), _FIELDS, strict=True)],
                                                 names=_COLUMNS)
    return run


def _links_between(percent: int):
    """Exact links that join two components of a group; pairs that are joined already are not looked at."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, "text"):
            sets: list[np.ndarray] = []
            for piece in pieces(pa.array(g.text, pa.large_string())):
                hashes, bound = shingle_hashes(piece)
                sets += [np.unique(hashes[bound[k]:bound[k + 1]]) for k in range(len(piece))]
            g.bits = [bitmap(s, bitmap_bits(len(s))).tobytes() for s in sets]
            a, b, weight = g.pairs(percent)
            root = {c: c for c in set(g.comp.tolist())}

            def find(c: int, root=root) -> int:
                while root[c] != c:
                    root[c] = c = root[root[c]]
                return c
            left, right = [], []
            for k in np.argsort(-weight, kind="stable").tolist():
                x, y = int(a[k]), int(b[k])
                cx, cy = find(int(g.comp[x])), find(int(g.comp[y]))
                if cx != cy and _linked(sets[x], sets[y], percent):
                    root[max(cx, cy)] = min(cx, cy)
                    left.append(int(g.node[x]))
                    right.append(int(g.node[y]))
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])
    return run


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact intersection of two sorted sets."""
    place = np.minimum(np.searchsorted(a, b), len(a) - 1)
    common = int((a[place] == b).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _dealt(rows: DataFrame, *more: str) -> DataFrame:
    """Rows together and in order by (tile, i, j)."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select(*_COLUMNS, *more).repartition(n, "tile", "i", "j").sortWithinPartitions("tile", "i", "j", "node")


def _exact(rows: DataFrame, bits: DataFrame, texts: Texts, percent: int) -> DataFrame:
    """Exact links between components of rows dealt as (tile, i, j) (staged)."""
    rows = rows.join(bits.hint("merge"), F.col("node") == F.col("b_node"), "inner")
    # the rows that go on leave their bitmaps behind: they are made again from the texts
    kinds = ", ".join(f"{name} {kind}" for name, kind, _ in _FIELDS)
    open_rows = stage(_dealt(rows).mapInArrow(_with_open_pair(percent), kinds), "open-rows")
    reps = texts.representing(open_rows.select("node"))
    with_text = open_rows.join(texts.of(reps), F.col("node") == F.col("t_node"), "inner")
    links = stage(_dealt(with_text, "text").mapInArrow(_links_between(percent), _LINKS), "links")
    release(open_rows, reps)
    return links


def links_at_home(members: DataFrame, bits: DataFrame, texts: Texts, percent: int) -> DataFrame:
    """Links from every set's home only: each set is one row."""
    zero, home = F.lit(0), members.filter("at_home")
    rows = home.select(F.col("cell").alias("tile"), zero.alias("i"), zero.alias("j"), F.lit(False).alias("seen"), zero.alias("side"), "own", "node", "n",
                       F.col("node").alias("comp"), "cell", "cell_own")
    return _exact(rows, bits, texts, percent)


def links_elsewhere(members: DataFrame, comps: DataFrame | None, bits: DataFrame, texts: Texts, percent: int) -> DataFrame:
    """Links between components from all tiles that hold several, for pairs not of one home."""
    rows = members.drop("at_home")
    if comps is None:
        rows = rows.withColumn("comp", F.col("node"))
    else:
        label = comps.select(F.col("node").alias("l_node"), "root")
        rows = (rows.join(label.hint("merge"), F.col("node") == F.col("l_node"), "left")
                .withColumn("comp", F.coalesce("root", "node")).drop("l_node", "root"))
    labelled = rows = stage(rows, "labelled")
    mixed = (rows.groupBy(F.col("tile").alias("m_tile")).agg(F.min("comp").alias("c_lo"), F.max("comp").alias("c_hi"), F.min("cell").alias("h_lo"),
                                                            F.max("cell").alias("h_hi"), F.bool_and("cell_own").alias("all_own"))
             .filter("c_lo <> c_hi and (h_lo <> h_hi or not all_own)").select("m_tile"))
    rows = rows.join(mixed.hint("merge"), F.col("tile") == F.col("m_tile"), "left_semi")
    rows = _blocks_that_meet(rows)
    links = _exact(rows, bits, texts, percent)
    release(labelled)
    return links


def _blocks_that_meet(rows: DataFrame) -> DataFrame:
    """Rows once per pair of blocks (i <= j) that they take part in.

    Sets of a tile's largest component need not meet each other, so it has blocks
    of its own: the others' blocks meet all blocks, its blocks meet those only.  A
    tile of N sets with m others makes about N * m / block + m * N / block rows.
    """
    # the largest component of tiles of several blocks (with one block, all meet in it)
    large = (rows.filter("blocks > 1").groupBy("tile", "comp").agg(F.count(F.lit(1)).alias("c"))
             .groupBy(F.col("tile").alias("c_tile")).agg(F.max(F.struct("c", "comp")).alias("most")))
    rows = rows.join(large.hint("merge"), F.col("tile") == F.col("c_tile"), "left")
    per_block = F.ceil(F.col("size") / F.col("blocks"))
    many = F.coalesce("most.c", F.lit(0))
    rows = (rows.withColumn("_own", F.when(F.col("blocks") == 1, 1).otherwise(F.ceil((F.col("size") - many) / per_block)).cast("int"))
            .withColumn("_most", F.when(F.col("blocks") == 1, 0).otherwise(F.ceil(many / per_block)).cast("int"))
            .withColumn("_apart", F.coalesce(F.col("comp") == F.col("most.comp"), F.lit(False))))
    h = F.xxhash64("node")
    side = F.when(F.col("_apart"), F.col("_own") + F.pmod(h, F.greatest("_most", F.lit(1)))).otherwise(F.pmod(h, F.greatest("_own", F.lit(1))))
    meets = F.when(F.col("_apart"), F.col("_own")).otherwise(F.col("_own") + F.col("_most"))
    return (rows.withColumn("side", side.cast("int")).withColumn("_o", F.explode(F.sequence(F.lit(0), meets - 1)))
            .withColumns({"i": F.least("side", "_o"), "j": F.greatest("side", "_o"), "seen": F.lit(True)})
            .drop("_o", "_own", "_most", "_apart", "most", "c_tile", "blocks", "size"))


# ------------------------------------------------------------- exact checks
class Texts:
    """Texts of nodes, from the documents that represent them."""

    def __init__(self, docs: DataFrame, classes: DataFrame):
        self.docs, self.classes = docs, classes
        # an id that stands for two different sets (or a null one) needs a look at the text itself
        ids = classes.groupBy("rep").agg(F.count(F.lit(1)).alias("n"))
        self.repeated = not ids.filter("rep is null or n > 1").isEmpty() or self._rows_repeat()

    def _rows_repeat(self) -> bool:
        return not self.docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()

    def representing(self, nodes: DataFrame) -> DataFrame:
        """Who represents the given nodes (staged)."""
        return stage(representatives(nodes, self.classes), "text-nodes")

    def of(self, reps: DataFrame) -> DataFrame:
        """(t_node, text) of the nodes that ``reps`` represent."""
        found = self.docs.join(reps, F.col("doc_id").eqNullSafe(F.col("rep")), "inner").select(F.col("_node").alias("t_node"), "text")
        if self.repeated:
            found = found.withColumn("_k", set_key_of("text")).filter("_k = t_node").drop("_k").dropDuplicates(["t_node"])
        return found


# --------------------------------------------------------------------- join
def _first(doc_id: str, text_key: str):
    """The smallest id with its text; rows without an id come last."""
    return F.min(F.struct(F.col(doc_id).isNull(), F.col(doc_id).alias("id"), F.col(text_key).alias("key"))).alias("first")


def join(docs: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    return (_joined(docs, percent, block)
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))


def _joined(docs: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """doc_id, text_key, n of every document; component_id and component_key are those of the first row of its component (none if n is 0)."""
    docs = docs.select("doc_id", "text")
    sigs = signatures(docs, percent)
    classes = stage(sigs.filter("n > 0").groupBy("k1", "k2").agg(_first("doc_id", "text_key"))
                    .select("k1", "k2", F.col("first.id").alias("rep"), F.col("first.key").alias("rep_key")), "classes")
    members = tile_members(sigs, percent, block)
    bits = node_bits(sigs, members, classes)
    texts = Texts(docs, classes)
    # from here on only the keys of the signatures have readers
    whole, sigs = sigs, stage(sigs.select("doc_id", "text_key", "n", "k1", "k2"), "keys")
    release(whole)
    found = links_at_home(members, bits, texts, percent)
    comps = None if found.isEmpty() else components(found)
    release(found)
    last = links_elsewhere(members, comps, bits, texts, percent)
    release(members, bits)
    if not last.isEmpty():
        known = last if comps is None else last.union(comps.select(F.col("node").alias("a"), F.col("root").alias("b")))
        comps = components(known)
    release(last)

    if comps is not None:
        linked = comps.join(classes, F.col("node") == F.col("k1"), "inner").select("k1", "k2", "root", "rep", "rep_key")
        low = linked.groupBy(F.col("root").alias("r")).agg(_first("rep", "rep_key"))
        named = linked.join(low, F.col("root") == F.col("r"), "inner").select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), "first")
        classes = (classes.join(named, (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")), "left")
                   .select("k1", "k2", F.when(F.col("first").isNull(), F.col("rep")).otherwise(F.col("first.id")).alias("component_id"),
                           F.coalesce("first.key", "rep_key").alias("component_key")))
    else:
        classes = classes.withColumnsRenamed({"rep": "component_id", "rep_key": "component_key"})
    named = classes.select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), "component_id", "component_key")
    return (sigs.select("doc_id", "text_key", "n", "k1", "k2").join(named, (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")), "left")
            .select("doc_id", "text_key", "n", "component_id", "component_key"))


def keep_one(docs: DataFrame, **params) -> DataFrame:
    """One document of each component (that of the smallest doc_id); all columns.  Of rows equal in doc_id and text one stays."""
    ids = stage(_joined(docs, **params), "jaccard-components")
    key, of = free_name(docs, "_id"), free_name(docs, "_text_key")
    again = F.col("doc_id").eqNullSafe(F.col(key)) & (F.xxhash64("text") == F.col(of))
    keys = ids.select(F.col("doc_id").alias(key), F.col("text_key").alias(of), "n", "component_id", "component_key")
    first = F.col(key).eqNullSafe(F.col("component_id")) & (F.col(of) == F.col("component_key"))
    gone = keys.filter((F.col("n") > 0) & ~first).select(key, of).distinct()
    kept = docs.join(gone, again, "left_anti")
    twice = stage(keys.groupBy(key, of).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select(key, of), "repeated-ids")
    if not twice.isEmpty():
        kept = kept.join(twice, again, "left_anti").union(kept.join(twice, again, "left_semi").dropDuplicates(["doc_id", "text"]))
    return kept.select(*columns_but(docs))
