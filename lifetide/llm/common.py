"""Shared helpers: reading tables, staging results, packing texts for numpy.

Whitespace is the fixed set space, tab, LF, VT, FF, CR; a word is a maximal
run of other characters.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifetide.session import checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
#: Spark's own switch: shuffle files go when the query that wrote them has ended
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """``<base>/<name>.parquet``; read anew each time, so that files added later are seen."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but keeps the columns compressed and
    prunable.  Once written, the shuffle files of the job have no reader and go
    (``CLEAN_SHUFFLES``).  ``release`` drops the table after its last reader; what
    is left goes with the application.
    """
    spark = df.sparkSession
    root = checkpoint_dir(spark).rstrip("/") + f"/llm-{spark.sparkContext.applicationId}"
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    path = f"{root}/{what}-{uuid.uuid4().hex[:12]}"
    before = spark.conf.get(CLEAN_SHUFFLES, "false")
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def release(*staged: DataFrame) -> None:
    """Delete staged tables whose readers have all been staged themselves."""
    for df in staged:
        spark = df.sparkSession
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.staged_path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores, so that no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def columns_but(df: DataFrame, *names: str) -> list[str]:
    """Columns of ``df`` that do not clash with result columns ``names`` (those are replaced), quoted."""
    return [f"`{c}`" for c in df.columns if c.lower() not in names]


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


# ------------------------------------------------------------- numpy side
_M = (1 << 64) - 1
_P = 0x9E3779B97F4A7C15 | 1          # odd, so invertible modulo 2^64
_PINV = pow(_P, -1, 1 << 64)


def _byte_table() -> np.ndarray:
    """A fixed odd-looking 64-bit value for every byte (splitmix64 of the byte)."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: spreads every input bit over 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int, base: int) -> np.ndarray:
    out = np.empty(max(n, 1), dtype=np.uint64)
    out[0] = 1
    if n > 1:
        out[1:] = np.uint64(base)
        np.multiply.accumulate(out, out=out)
    return out


class PolyHash:
    """Hashes of byte ranges of one buffer by prefix sums of ``T[b] * P^i`` (mod 2^64).

    Two equal byte strings at any two places get equal hashes, so all words of
    a batch are hashed at once without a Python loop.
    """

    TABLE = _byte_table()
    _fwd = _powers(1, _P)
    _inv = _powers(1, _PINV)

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(PolyHash._fwd) < n:
            PolyHash._fwd, PolyHash._inv = _powers(n * 5 // 4, _P), _powers(n * 5 // 4, _PINV)
        acc = np.empty(n, dtype=np.uint64)
        acc[0] = 0
        np.cumsum(PolyHash.TABLE[data] * PolyHash._fwd[:n - 1], out=acc[1:])
        self._acc = acc

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._acc[end] - self._acc[start]) * PolyHash._inv[start] + (end - start).astype(np.uint64))


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def pack(texts) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string array, one line feed after each text, and the offsets of the texts (n + 1)."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    nothing, feed = pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string())
    joined = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.large_string()), ""), nothing, feed)
    _, offsets, data = joined.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(joined) + 1, joined.offset * 8)
    return np.frombuffer(data, np.uint8, offsets[-1] - offsets[0], offsets[0]), offsets - offsets[0]


def words_of(texts):
    """All words of a batch: bytes (A-Z lower-cased), word starts, word ends, word hashes, first word of each text (n + 1)."""
    data, offsets = pack(texts)
    data = _LOWER[data]
    solid = ~_IS_SPACE[data]
    edge = np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return data, start, end, PolyHash(data).ranges(start, end), np.searchsorted(start, offsets)


def pieces(texts, rows: int = 512, size: int = 1_000_000):
    """Slices of an Arrow string array of at most ``rows`` texts and about ``size`` bytes (or one text):
    numpy's memory stays bounded whatever the length of the texts."""
    lens = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    lo = total = 0
    for i, n in enumerate(lens):
        if i > lo and (total + n > size or i - lo >= rows):
            yield texts.slice(lo, i - lo)
            lo, total = i, 0
        total += int(n)
    if lo < len(texts):
        yield texts.slice(lo)


def flat(column):
    """One array of a column that may come in chunks."""
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


# ------------------------------------------------- letters and character n-grams
BLANK = 32


def _kept(digits: bool) -> np.ndarray:
    """Which code points count as part of a token (letters; digits too if asked)."""
    return np.fromiter((chr(i).isalpha() or (digits and chr(i).isdigit()) for i in range(0x30000)), dtype=bool, count=0x30000)


_KEPT: dict[bool, np.ndarray] = {}


def codes_of(texts, digits: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of a batch, every run of others as one blank, and the start of each text.

    Every text starts with a blank, so its tokens have a blank on both sides.
    """
    if digits not in _KEPT:
        _KEPT[digits] = _kept(digits)
    kept = _KEPT[digits]
    texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    data, _ = pack(texts)
    codes = np.frombuffer(b"\n\0\0\0" + data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    begins = np.concatenate([[0], np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1)])
    codes = np.where(kept[np.minimum(codes, len(kept) - 1)], codes, np.uint32(BLANK))
    blank = codes == BLANK
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    keep[begins] = True
    return codes[keep], np.concatenate([[0], np.cumsum(keep)])[begins[:-1]].astype(np.int64)


def grams(codes: np.ndarray, low: int, high: int, bits: int):
    """For n = low..high the buckets of the n-grams at every position, and which positions hold one
    (blanks only as its first or last character)."""
    n_codes = len(codes)
    h = np.zeros(n_codes, np.uint32)
    ok = np.ones(n_codes, bool)
    solid = codes != BLANK
    for n in range(1, high + 1):
        span = n_codes - n + 1
        if span <= 0:
            break
        h = h[:span] * np.uint32(0x01000193) + codes[n - 1:] + np.uint32(n)
        if n > 2:
            ok = ok[:span] & solid[n - 2:n - 2 + span]
        elif n == 2:
            ok = solid[:-1] | solid[1:]
        if n >= low:
            g = (h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1)
            yield n, g >> np.uint32(32 - bits), (solid if n == 1 else ok)


def bounded_sample(df: DataFrame, key: str, cap: int) -> DataFrame:
    """About ``cap`` rows of ``df`` (all, if it has no more), chosen by a hash of ``key``."""
    n = df.count()
    if n <= cap:
        return df
    cells = 1 << 30
    return df.filter(F.pmod(F.xxhash64(F.lit(7), key), F.lit(cells)) < int(cells * cap / n))


def crc_mod(m: int, key: str = "doc_id"):
    """crc32 of the id as text, modulo ``m`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % m
