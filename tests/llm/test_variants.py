"""Spelling variants against plain Python."""

import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import LONG, ODD, frame

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows):
    counts = collections.Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def brute(counts):
    holes, near = collections.defaultdict(set), collections.defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            holes[i, w[:i] + w[i + 1:]].add(w)
    for (_, rest), words in holes.items():
        for w in words:
            near[w] |= words - {w}
            if rest in counts:
                near[w].add(rest)
                near[rest].add(w)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v)) if near[w] else None
        form[w] = best if best is not None and counts[best] >= 2 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {w: (form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()}


def found(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def corpus(seed, texts=120):
    """Words at chains of edits from each other, accents, capitals, signs between."""
    rnd = random.Random(seed)
    letters = "abcdeéß÷Éz"
    words = ["".join(rnd.choice(letters) for _ in range(rnd.choice((4, 5, 6, 7, 9, 14, 30, 70)))) for _ in range(60)]
    for _ in range(400):
        w = rnd.choice(words)
        i = rnd.randrange(len(w) + 1)
        words.append(rnd.choice((w[:i] + rnd.choice(letters) + w[i:], w[:i] + w[i + 1:], w[:i] + rnd.choice(letters) + w[i + 1:])))
    weights = [rnd.choice((1, 2, 4, 8, 30)) for _ in words]
    return [(i if i % 50 else None, "".join(
        rnd.choice((w, w, w.title(), w.upper())) + rnd.choice((" ", ", ", "1", "-", "\n", "ж", "𝔘"))
        for w in rnd.choices(words, weights, k=rnd.randrange(1, 150)))) for i in range(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_variants(spark, seed):
    from lifetide.llm.variants import spelling_variants
    rows = corpus(seed)
    assert found(spelling_variants(frame(spark, rows, extra=True))) == brute(brute_counts(rows))


@pytest.mark.parametrize("hot", [1, 40])
def test_long_lists_are_split(spark, hot):
    """Lists over the limit go to lists of half their window, down to one position, and lose no pair."""
    from lifetide.llm.variants import group_words
    rnd = random.Random(3)
    counts = {"".join(rnd.choice("abc") for _ in range(rnd.choice((5, 6, 7, 8)))): rnd.randrange(3, 400) for _ in range(2500)}
    words = spark.createDataFrame([(bytearray(w.encode("latin-1")), n) for w, n in counts.items()], "word binary, n long")
    assert found(group_words(words, hot=hot)) == brute(counts)


def test_common_prefixes_and_suffixes(spark):
    from lifetide.llm.variants import group_words
    rnd = random.Random(4)
    middles = ["".join(rnd.choice("xyz") for _ in range(rnd.choice((2, 3, 4)))) for _ in range(80)]
    counts = {}
    for m in middles:
        for w in ("aaaaaaaaaaaaaaaaaaaa" + m, m + "bbbbbbbbbbbbbbbbbbbb", "aaaaaaaaaa" + m + "bbbbbbbbbb", "a" * (len(m) * 50)):
            counts[w] = rnd.randrange(3, 60)
    words = spark.createDataFrame([(bytearray(w.encode("latin-1")), n) for w, n in counts.items()], "word binary, n long")
    assert found(group_words(words, hot=20)) == brute(counts)


def test_odd_texts(spark):
    from lifetide.llm.variants import spelling_variants
    rows = [(i, t) for i, t in ODD] * 3 + [(70, "A" * 100_000 + " Ünïcödé"), (71, "a" * 100_000), (72, "a" * 100_000), (73, None)]
    got = found(spelling_variants(frame(spark, rows, extra=True)))
    assert got == brute(brute_counts(rows)) and "a" * 100_000 in got
    assert found(spelling_variants(frame(spark, []))) == {}
    assert found(spelling_variants(frame(spark, [(1, None), (2, ""), (3, "ab abc 12345")]))) == {}


def test_crc_of_runs():
    from lifetide.llm.variants import crc_of_runs
    runs = ["a", "abcde", "éàÿ", "x" * 64, "ü" * 65, "long" * 50, "ß÷Ø"]
    codes = np.frombuffer("".join(runs).encode("latin-1"), np.uint8)
    size = np.array([len(r) for r in runs])
    state = np.array([zlib.crc32(f"{i}:".encode()) for i in range(len(runs))], np.uint32)
    got = crc_of_runs(state, codes, np.cumsum(size) - size, size)
    assert got.tolist() == [zlib.crc32(f"{i}:{r}".encode()) for i, r in enumerate(runs)]


def test_counts_leave_in_parts(monkeypatch):
    """A task that holds too many words passes on what it has."""
    from lifetide.llm import variants
    monkeypatch.setattr(variants, "KEPT_WORDS", 50)
    rows = corpus(6)
    batches = [pa.record_batch({"doc_id": pa.array([str(i) if i is not None else None]), "text": pa.array([t])}) for i, t in rows]
    total = collections.Counter()
    for b in variants._count(iter(batches)):
        for w, n in zip(b["word"].to_pylist(), b["n"].to_pylist(), strict=True):
            total[w.decode("latin-1")] += n
    assert {w: n for w, n in total.items() if n >= 3} == brute_counts(rows)


def test_long_text_has_words():
    assert RUN.findall(LONG)
