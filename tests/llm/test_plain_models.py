"""Scores of the three models recomputed in plain Python, text by text (operators 2, 7, 9)."""

import math
import random
import re
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

DATA = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ODD = ["", " ", "x", "A", "...", "\n\n", "a\n\nb\na\n", "NO NO NO! $5|x", "Straße ÄÖ ß", "日本語 テキスト", "ab " * 300, "z" * 3000, "1 22 3b", "ǅ İ ﬁ"]


def texts_of(spark, n=60):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(n).collect()
    return [r["text"] for r in rows if r["text"] is not None] + ODD


def arrow(texts):
    return pa.array(texts, pa.large_string())


def logistic(x):
    return 1 / (1 + math.exp(-x))


# ------------------------------------------------------------- operator 2
def plain_figures(text):
    from lifetide.llm import quality
    data = text.encode()
    size = max(len(data), 1)
    kinds = {"upper": rb"[A-Z]", "digit": rb"[0-9]", "mark": rb"[#$%&*+/<=>@\\^_`{}~\[\]]", "exclaim": rb"[!?]", "bar": rb"\|",
             "stop": rb"[.,;:]", "feed": rb"\n", "wide": rb"[\x80-\xff]", "letter": rb"[A-Za-z\x80-\xff]"}
    out = {name: len(re.findall(kind, data)) / size for name, kind in kinds.items()}
    raw = WORD.findall(data)
    words = [w.lower() for w in raw]       # bytes: A-Z only
    n = max(len(words), 1)
    threes = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    lines = [line for line in data.split(b"\n") if line]
    run = longest = 0
    for i, w in enumerate(words):
        run = run + 1 if i and words[i - 1] == w else 1
        longest = max(longest, run)
    out |= {
        "words": math.log1p(len(words)), "word_length": sum(map(len, words)) / n, "distinct": len(set(words)) / n,
        "repeat": sum(a == b for a, b in zip(words, words[1:])) / n, "distinct_three": len(set(threes)) / max(len(words) - 2, 1),
        "line_length": math.log1p(size / max(len(lines), 1)), "line_distinct": len(set(lines)) / max(len(lines), 1),
        "marked_end": sum(bool(re.search(rb"[#$%&*+/<=>@\\^_`{}~\[\]!?|]\Z", w)) for w in raw) / n,
        "long_word": sum(len(w) > 20 for w in words) / n, "single": sum(len(w) == 1 for w in words) / n,
        "upper_word": sum(bool(re.match(rb"[A-Z][A-Z]", w)) for w in raw) / n, "run": math.log1p(longest),
    }
    return [out[f] for f in quality.FIGURES]


def test_quality_scores(spark):
    from lifetide.llm import quality
    texts = texts_of(spark)
    rnd = random.Random(4)
    y = np.array([rnd.randrange(2) for _ in texts])
    plain = [plain_figures(t) for t in texts]
    assert np.allclose(quality.figures(arrow(texts)), plain, rtol=1e-9, atol=1e-12)
    model = quality.Model(np.array(plain), y)
    assert model.pairs
    got = model.score(quality.figures(arrow(texts)))
    for x, score in zip(quality.figures(arrow(texts)).tolist(), got):
        z = model.bias + sum(t[bisect_right(e.tolist(), v)] for t, e, v in zip(model.tables, model.edges, x))
        z += sum(t[bisect_right(model.coarse[j].tolist(), x[j])][bisect_right(model.coarse[k].tolist(), x[k])] for j, k, t in model.pairs)
        assert score == pytest.approx(logistic(z), rel=1e-9)


# ---------------------------------------------------------- operators 7, 9
def tokens(text, digits):
    """Runs of letters (and digits) of the lower-cased text, as code points."""
    kept = "".join(c if c.isalpha() or (digits and c.isdigit()) else " " for c in text.lower())
    return [[ord(c) for c in t] for t in kept.split(" ") if t]


def bucket(codes, bits):
    h = 0
    for n, c in enumerate(codes, 1):
        h = (h * 0x01000193 + c + n) % 2**32
    return (((h ^ h >> 15) * 0x9E3779B1) % 2**32) >> (32 - bits)


def spread64(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
    return x ^ x >> 31


def grams_of(token, low, high):
    """The n-grams of a token between two blanks, the blanks by themselves left out."""
    padded = [32, *token, 32]
    return [padded[i:i + n] for n in range(low, high + 1) for i in range(len(padded) - n + 1) if n > 1 or padded[i] != 32]


def test_toxicity_scores(spark):
    from lifetide.llm import toxicity
    texts = texts_of(spark)
    rnd = random.Random(5)
    y = np.array([rnd.randrange(2) for _ in texts])
    model = toxicity.Model(arrow(texts), y)
    assert np.count_nonzero(model.margin) > 100

    def bag(token):
        total = sum(spread64((c * 0x10001 + i * 0x9E3779B97F4A7C15) % 2**64) for i, c in enumerate(token)) % 2**64
        own = (spread64(total) >> (64 - toxicity.BITS)) + (1 << toxicity.BITS)
        return [bucket(g, toxicity.BITS) for g in grams_of(token, 3, 5)] + [own]

    for text, score in zip(texts, model.score(arrow(texts))):
        bags = [bag(t) for t in tokens(text, digits=True)]
        margins = []
        for i in range(0, len(bags), toxicity.WINDOW):
            members = [b for one in bags[i:i + toxicity.WINDOW] for b in one]
            margins.append(sum(float(model.margin[b]) for b in members) / len(members) + model.bias)
        if margins:
            weights = [math.exp(m - max(margins)) for m in margins]
            want = sum(w * m for w, m in zip(weights, margins)) / sum(weights)
        else:
            want = model.bias
        assert score == pytest.approx(logistic(want), rel=1e-6, abs=1e-9), text[:40]


def test_language_scores(spark):
    from lifetide.llm import langid
    texts = texts_of(spark)
    langs = ["de", "en", "es", "fr", "ru"]          # two families of two, one of one
    rnd = random.Random(6)
    y = np.array([rnd.randrange(len(langs)) for _ in texts])
    freq = langid._frequencies(arrow(texts))
    model = langid.Model(langs, freq, y)
    best, score = model.predict(arrow(texts))
    families = sorted({langid.family_of(v) for v in langs})
    for i, text in enumerate(texts):
        grams = [bucket(g, langid.BITS) for t in tokens(text, digits=False) for g in grams_of(t, 1, 3)]
        counts = Counter(grams)
        assert np.allclose(freq[i], [counts[b] / max(len(grams), 1) for b in range(1 << langid.BITS)], rtol=1e-5)
        if not grams:
            assert best[i] == -1 and score[i] == 0
            continue
        margins = [float(b) + sum(float(model.table[g, k]) for g in grams) / len(grams) for k, b in enumerate(model.bias)]
        ranked = sorted(range(len(families)), key=lambda f: -margins[f])
        sure = logistic(2 * (margins[ranked[0]] - margins[ranked[1]]))
        members = [v for v in langs if langid.family_of(v) == families[ranked[0]]]
        votes, weakest = dict.fromkeys(members, 0.0), dict.fromkeys(members, math.inf)
        for (a, b), m in zip(model.pairs, margins[len(families):]):
            for v, side in ((langs[a], m), (langs[b], -m)):
                if v in votes:
                    votes[v] += math.tanh(side) + (side >= 0 if v == langs[a] else side > 0)
                    weakest[v] = min(weakest[v], side)
        want = max(members, key=lambda v: votes[v])
        assert langs[best[i]] == want, text[:40]
        assert score[i] == pytest.approx(sure * (logistic(4 * weakest[want]) if len(members) > 1 else 1.0), rel=1e-4)
