"""Spelling variants by dynamic programming over sorted lists (operator 13).

Words are counted over all documents (``count_words``).  Two words are near if
one inserted, deleted or replaced code point turns one into the other.  Near
words are found by scanning sorted lists: the banded row of the edit matrix of a
prefix is computed once for all words that share it (adjacent LCPs say how far
that is), and a range of words is skipped as soon as the row of its shared
prefix holds nothing below two edits.

No task sees the whole vocabulary.  A pair whose shorter word has ``l`` code
points and whose longest common prefix has ``p`` of them agrees left of ``p`` and
right of it, so all words go into lists by (l, window of p, prefix left of the
window, suffix right of it): at first two windows, the halves of the word.  Every
pair belongs to exactly one list (the window that holds its ``p``).  A list of
more than ``HOT`` words is not scanned: its words go to the lists of the two
halves of its window, again and again, down to windows of one position, whose
lists hold at most 116 + 116^2 words (the alphabet has 116 letters).  That is
exact and bounds every task's memory whatever the vocabulary.

All words consist of A-Z, a-z and U+00C0-U+00FF, so they travel as Latin-1
bytes, one per code point, and sort by code point.

Defined results: null and empty texts and texts without letters hold no words; a
null doc_id counts as the empty text in ``<doc_id>:<run>``; repeated rows count
again; empty tables give empty results; extra columns are ignored.  A run of any
length is one word.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifetide.llm.common import flat, pack, pieces, stage

MIN_LETTERS = 5
MIN_COUNT = 3
DAMAGE = 97                # a run whose hash this divides loses a code point
RATIO = 2                  # a form occurs at least so many times as often
HOT = 50_000               # words of a list that one task scans
CHUNK = 20_000             # words scanned at once
CELLS = 8_000_000          # bytes of words scanned at once (or one list)
KEPT_WORDS = 400_000       # distinct words that a task holds while counting


# ------------------------------------------------------------------ counting
def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & np.uint32(1), (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


CRC = _crc_table()


def crc_of_runs(state: np.ndarray, codes: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of runs of Latin-1 ``codes`` in UTF-8, each continuing the crc32 ``state``."""
    out = np.empty(len(start), np.uint32)
    long = np.flatnonzero(size > 64)
    for i in long:
        out[i] = zlib.crc32(codes[start[i]:start[i] + size[i]].tobytes().decode("latin-1").encode(), int(state[i]))
    order = np.flatnonzero(size <= 64)
    order = order[np.argsort(-size[order], kind="stable")]
    crc, at, left = ~state[order], start[order], size[order]
    active = len(order)
    for j in range(int(left[0]) if active else 0):
        active = int(np.searchsorted(-left, -j, side="left"))       # runs of more than j code points
        c, s = codes[at[:active] + j].astype(np.uint32), crc[:active]
        wide = np.flatnonzero(c > 127)
        if len(wide):
            w = s[wide]
            s[wide] = CRC[(w ^ np.uint32(0xC3)) & np.uint32(255)] ^ (w >> np.uint32(8))
            c[wide] -= np.uint32(0x40)
        crc[:active] = CRC[(s ^ c) & np.uint32(255)] ^ (s >> np.uint32(8))
    out[order] = ~crc
    return out


def _letters() -> np.ndarray:
    """What every code point below 0x101 becomes: A-Z lower-cased, other letters as they are, all else 0."""
    t = np.zeros(0x101, np.uint8)
    t[65:91] = np.arange(97, 123)
    t[97:123] = np.arange(97, 123)
    t[0xC0:0x100] = np.arange(0xC0, 0x100)
    return t


LETTERS = _letters()


def words_of_texts(ids, texts, min_letters: int = MIN_LETTERS, damage: int = DAMAGE) -> pa.Array:
    """Every occurrence of a word of a batch, damage done, as Latin-1 bytes."""
    data, _ = pack(texts)
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    low = LETTERS[np.minimum(codes, 0x100)]
    letter = low > 0
    edge = np.diff(np.concatenate([[False], letter, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    enough = end - start >= min_letters
    start, size = start[enough], (end - start)[enough]
    ends = np.cumsum(pc.utf8_length(pc.fill_null(texts.cast(pa.large_string()), "")).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    owner = np.searchsorted(ends, start, side="right")
    prefix = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids.to_pylist()], np.uint32)
    h = crc_of_runs(prefix[owner], low, start, size) if len(start) else np.zeros(0, np.uint32)
    hit = h % np.uint32(damage) == 0
    keep = size - hit >= min_letters
    start, size, h, hit = start[keep], size[keep], h[keep], hit[keep]
    # the letters of all words in a row, but the deleted ones
    begin = np.cumsum(size) - size
    at = np.repeat(start - begin, size) + np.arange(int(size.sum()))
    gone = (begin + (h.astype(np.int64) % np.maximum(size, 1)))[hit]
    letters = np.delete(low[at], gone) if len(gone) else low[at]
    offsets = np.concatenate([[0], np.cumsum(size - hit)]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(letters.tobytes())])


def _sum(parts: list[pa.Table]) -> pa.Table:
    merged = pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")])
    return pa.table({"word": merged["word"], "n": merged["n_sum"]})


def _count(batches):
    """Occurrences of every word of a partition, added up before they leave the task."""
    parts, held, merged = [], 0, 0
    for batch in batches:
        for ids, texts in _sliced(batch):
            counts = pc.value_counts(words_of_texts(ids, texts))
            parts.append(pa.table({"word": counts.field("values"), "n": counts.field("counts")}))
            held += len(counts)
        if held > 2 * merged + KEPT_WORDS // 4:
            parts = [_sum(parts)]
            held = merged = parts[0].num_rows
            if merged > KEPT_WORDS:
                yield from _counted(parts[0])
                parts, held, merged = [], 0, 0
    if parts:
        yield from _counted(_sum(parts))


def _sliced(batch):
    texts, ids, lo = flat(batch.column("text")), flat(batch.column("doc_id")), 0
    for part in pieces(texts):
        yield ids.slice(lo, len(part)), part
        lo += len(part)


def _counted(table: pa.Table):
    return pa.table({"word": table["word"].cast(pa.binary()), "n": table["n"]}).to_batches(max_chunksize=50_000)


def count_words(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word as Latin-1 bytes, n) of every word that occurs at least ``min_count`` times."""
    counted = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(_count, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# ---------------------------------------------------------------- near words
def _matrix(words, size: np.ndarray) -> np.ndarray:
    """One row of bytes per word, zeros after its end (two at least)."""
    out = np.zeros((len(size), int(size.max()) + 2), np.uint8)
    out[np.repeat(np.arange(len(size)), size), _places(size)] = np.frombuffer(b"".join(words), np.uint8)
    return out


def _places(size: np.ndarray) -> np.ndarray:
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)


def _common(rows: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Length of the common prefix of every two rows (differing ones)."""
    return np.argmax(rows != other, axis=1)


def scan(letters: np.ndarray, size: np.ndarray, first: np.ndarray, asked: np.ndarray):
    """Pairs (place asked, place found) of words at one edit, within sorted lists.

    ``letters``: words as rows, sorted within their list; ``first``: first place of
    every list, and the number of words; ``asked``: places of the words to look up.
    A range of words with a common prefix is one entry of the frontier, with the
    places ``row`` of the edit matrix that lie in the band.  One step takes every
    range to the ranges of its next letter.
    """
    n = len(size)
    lcp = np.full(n + 1, -1, np.int64)          # with the word before; -1 at the first of a list
    if n > 1:
        lcp[1:n] = _common(letters[1:], letters[:-1])
    lcp[first] = -1
    by_lcp = np.argsort(lcp, kind="stable")
    level = np.searchsorted(lcp[by_lcp], np.arange(letters.shape[1] + 1))
    owner = np.searchsorted(first, asked, side="right") - 1
    q, lo, hi = asked, first[owner], first[owner + 1]
    # distances of the prefix (of d letters) to the first d - 1, d, d + 1 letters of the word asked; 2 stands for more
    a, b, c = np.full(len(q), 2, np.int8), np.zeros(len(q), np.int8), np.ones(len(q), np.int8)
    pairs = []
    for d in range(letters.shape[1] - 1):
        if not len(q):
            break
        # a word that ends here is the first of its range
        ended = size[lo] == d
        if ended.any():
            e = np.flatnonzero(ended)
            over = size[q[e]] - d
            dist = np.select([over == -1, over == 0, over == 1], [a[e], b[e], c[e]], 2)
            near = e[dist == 1]
            pairs.append((q[near], lo[near]))
            lo = lo + ended
            left = np.flatnonzero(lo < hi)
            q, lo, hi, a, b, c = q[left], lo[left], hi[left], a[left], b[left], c[left]
        # ranges of the next letter: cut where neighbours share no more than d letters
        cuts = by_lcp[level[d]:level[d + 1]]
        s0, s1 = np.searchsorted(cuts, lo, side="right"), np.searchsorted(cuts, hi, side="left")
        count = s1 - s0 + 1
        of = np.repeat(np.arange(len(q)), count)
        j = _places(count)
        bounds = np.concatenate([cuts, [0]])
        here = s0[of] + j
        lo = np.where(j == 0, lo[of], bounds[here - 1])
        hi = np.where(j == count[of] - 1, hi[of], bounds[np.minimum(here, len(cuts))])
        q, a, b, c = q[of], a[of], b[of], c[of]
        x, mine = letters[lo, d], size[q]
        back = letters[q, d - 1] if d else np.zeros(len(q), np.uint8)
        a2 = np.minimum(a + (x != back), b + 1)
        b2 = np.where(mine > d, np.minimum(np.minimum(b + (x != letters[q, d]), c + 1), a2 + 1), 2)
        ahead = letters[q, np.minimum(d + 1, letters.shape[1] - 1)]
        c2 = np.where(mine > d + 1, np.minimum(c + (x != ahead), b2 + 1), 2)
        a2 = np.where(mine >= d, a2, 2)
        live = np.flatnonzero(np.minimum(np.minimum(a2, b2), c2) <= 1)
        q, lo, hi = q[live], lo[live], hi[live]
        a, b, c = (np.minimum(v[live], 2).astype(np.int8) for v in (a2, b2, c2))
    if not pairs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([p for p, _ in pairs]), np.concatenate([p for _, p in pairs])


def _near_in_lists(words: list, n: np.ndarray, l: np.ndarray, low: np.ndarray, high: np.ndarray, first: np.ndarray):  # noqa: E741
    """For the words of some lists: near words found, and the best of them."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    letters = _matrix(words, size)
    mine, found = [], []
    asked = np.flatnonzero(size == l)           # the shorter word of a pair, or either of two equally long
    for k in range(0, len(asked), CHUNK):
        p, v = scan(letters, size, first, asked[k:k + CHUNK])
        # a pair counts in the list whose window holds its longest common prefix
        at = _common(letters[p], letters[v]) if len(p) else p
        p, v = p[(at >= low[p]) & (at < high[p])], v[(at >= low[p]) & (at < high[p])]
        both = size[v] > size[p]
        mine += [p, v[both]]
        found += [v, p[both]]
    mine, found = np.concatenate(mine or [np.zeros(0, np.int64)]), np.concatenate(found or [np.zeros(0, np.int64)])
    order = np.lexsort((letters_rank(words, found), -n[found], mine))
    mine, found = mine[order], found[order]
    begin = np.flatnonzero(np.diff(mine, prepend=-1))
    near = np.diff(np.append(begin, len(mine)))
    return mine[begin], near, found[begin]


def letters_rank(words: list, at: np.ndarray) -> np.ndarray:
    """Places ``at`` by the code points of their words."""
    there, inverse = np.unique(at, return_inverse=True)
    order = sorted(range(len(there)), key=lambda i: words[there[i]])
    rank = np.empty(len(there), np.int64)
    rank[order] = np.arange(len(there))
    return rank[inverse]


FOUND = "word binary, n long, l int, low int, high int, n_near long, form_n long, form binary"
_FOUND = pa.schema([("word", pa.binary()), ("n", pa.int64()), ("l", pa.int32()), ("low", pa.int32()), ("high", pa.int32()),
                    ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.binary())])


def _none(n: int, kind) -> pa.Array:
    return pa.nulls(n, kind)


def _scan_lists(batches, hot: int):
    """Near words of sorted lists; the words of lists over ``hot`` come back with their window, unscanned."""
    names = ("l", "low", "high", "key")
    held, rows = [], 0
    too_long = None                             # the list that is being passed on

    def again(t: pa.Table):
        m = t.num_rows
        for b in pa.table([t["word"], t["n"], t["l"], t["low"], t["high"], _none(m, pa.int64()), _none(m, pa.int64()), _none(m, pa.binary())],
                          schema=_FOUND).to_batches(max_chunksize=50_000):
            yield b

    def done(t: pa.Table, first: np.ndarray):
        size = np.diff(first)
        some = np.repeat(size > 1, size)
        if not some.any():
            return
        t = t.filter(pa.array(some))
        first = np.concatenate([[0], np.cumsum(size[size > 1])])
        l, low, high, n = (t[c].to_numpy().astype(np.int64) for c in ("l", "low", "high", "n"))  # noqa: E741
        # as many lists at once as fit, by their longest word
        lo = 0
        while lo < len(first) - 1:
            fits = (first[lo + 1:] - first[lo]) * (l[first[lo + 1:] - 1] + 3)
            up = lo + max(1, int(np.searchsorted(fits, CELLS, side="right")))
            part = slice(first[lo], first[up])
            words = t["word"].slice(first[lo], first[up] - first[lo]).to_pylist()
            mine, near, best = _near_in_lists(words, n[part], l[part], low[part], high[part], first[lo:up + 1] - first[lo])
            m = len(mine)
            if m:
                yield pa.record_batch([pa.array([words[i] for i in mine], pa.binary()), _none(m, pa.int64()), _none(m, pa.int32()),
                                       _none(m, pa.int32()), _none(m, pa.int32()), pa.array(near.astype(np.int64)),
                                       pa.array(n[part][best]), pa.array([words[i] for i in best], pa.binary())], schema=_FOUND)
            lo = up

    def starts(t: pa.Table) -> np.ndarray:
        cols = [t[c].to_numpy() for c in names]
        new = np.ones(t.num_rows, bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
        return np.flatnonzero(new)

    for batch in batches:
        t = pa.Table.from_batches([batch])
        if too_long is not None:
            same = np.logical_and.reduce([t[c].to_numpy() == v for c, v in zip(names, too_long, strict=True)])
            m = t.num_rows if same.all() else int(np.argmin(same))
            yield from again(t.slice(0, m))
            t = t.slice(m)
            if not t.num_rows:
                continue
            too_long = None
        held.append(t)
        rows += t.num_rows
        if rows < CHUNK:
            continue
        t = pa.concat_tables(held).combine_chunks()
        at = starts(t)
        last = int(at[-1])                      # the last list may go on
        if last:
            yield from done(t.slice(0, last), at)
            t = t.slice(last)
        if t.num_rows > hot:
            too_long = tuple(t[c][0].as_py() for c in names)
            yield from again(t)
            t = t.slice(0, 0)
        held, rows = ([t], t.num_rows) if t.num_rows else ([], 0)
    if rows:
        t = pa.concat_tables(held).combine_chunks()
        at = starts(t)
        last = int(at[-1])
        if t.num_rows - last > hot:
            yield from again(t.slice(last))
            t, at = t.slice(0, last), at[:-1]
        if t.num_rows:
            yield from done(t, np.append(at, t.num_rows))


def _lists(rows: DataFrame, windows) -> DataFrame:
    """``rows`` (word, n, l, ...) once per window, with the key of the list."""
    out = rows.select("word", "n", "l", F.explode(windows).alias("_w")).select("word", "n", "l", "_w.low", "_w.high")
    size, tail = F.length("word"), F.greatest(F.col("l") - F.col("high"), F.lit(0))
    out = out.withColumn("key", F.xxhash64(F.substring(F.col("word"), F.lit(1), F.col("low")), F.substring(F.col("word"), size - tail + 1, tail)))
    return out.repartition("key", "l", "low").sortWithinPartitions("l", "low", "high", "key", "word")


def _window(low, high):
    return F.struct(low.cast("int").alias("low"), high.cast("int").alias("high"))


def near_words(words: DataFrame, hot: int = HOT) -> DataFrame:
    """(word, n_near, form_n, form) of every word that has near words: how many, and the one of largest n (ties: smallest)."""
    l, half = F.col("l"), F.floor(F.col("l") / 2)  # noqa: E741
    # a word meets the words of its own length and those one longer (l: its own), and those one shorter
    rows = (words.withColumn("l", F.explode(F.array(F.length("word"), F.length("word") - 1))).filter(l >= F.lit(MIN_LETTERS)))
    lists = _lists(rows, F.array(_window(F.lit(0), half), _window(half, l + 1)))
    found = None
    while True:
        out = stage(lists.mapInArrow(lambda it: _scan_lists(it, hot), FOUND), "near-words")
        part = out.filter("l is null").select("word", "n_near", "form_n", "form")
        found = part if found is None else found.union(part)
        long = out.filter("l is not null").select("word", "n", "l", "low", "high")
        if long.isEmpty():
            break
        mid = F.floor((F.col("low") + F.col("high")) / 2)
        halves = F.array(_window(F.col("low"), mid), _window(mid, F.col("high")))
        lists = _lists(long, F.filter(halves, lambda w: w["low"] < w["high"]))
    best = F.min(F.struct((-F.col("form_n")).alias("m"), "form"))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_b"))
            .select("word", "n_near", (-F.col("_b.m")).alias("form_n"), F.col("_b.form").alias("form")))


# --------------------------------------------------------------- forms, roots
def roots_of(forms: DataFrame, hops: int) -> DataFrame:
    """(word, root) of every row of ``forms`` (word, form): forms followed to the last, at most ``hops`` of them.

    Every round doubles how far a word has come.
    """
    roots = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(hops, 1))))):
        ahead = roots.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        roots = stage(roots.join(ahead, F.col("root") == F.col("_at"), "left").select("word", F.coalesce("_next", "root").alias("root")), "roots")
    return roots


def group_words(words: DataFrame, hot: int = HOT, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (word as Latin-1 bytes, n)."""
    near = near_words(words, hot)
    good = F.col("form_n") >= F.col("n") * ratio
    joined = stage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(good, F.col("form")).alias("form"), F.when(good, F.col("form_n")).alias("form_n")), "forms")
    most = joined.agg(F.max("form_n")).first()[0]
    if most is not None:
        # n at least doubles with every form
        least = joined.filter("form is not null").agg(F.min("n")).first()[0]
        hops = int(math.log(most / least) / math.log(ratio) + 1e-9) + 1 if least else 64
        roots = roots_of(joined.filter("form is not null").select("word", "form"), hops)
    else:
        roots = joined.filter("form is not null").select("word", F.col("form").alias("root"))
    shown = lambda c: F.decode(F.col(c), "ISO-8859-1")
    return (joined.join(roots.withColumnRenamed("word", "_word"), F.col("word") == F.col("_word"), "left")
            .select(shown("word").alias("word"), shown("form").alias("form"),
                    F.coalesce(shown("root"), shown("word")).alias("root"), "n", "n_near", "form_n"))


def spelling_variants(docs: DataFrame, min_count: int = MIN_COUNT, hot: int = HOT) -> DataFrame:
    """The words of all texts and their spelling groups."""
    return group_words(stage(count_words(docs, min_count), "words"), hot)
