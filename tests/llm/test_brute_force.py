"""Jaccard join, sentence spans and fingerprints against plain Python."""

import hashlib
import itertools
import random
import re

import pytest
from conftest_llm import frame

from pyspark.sql import functions as F

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed: int, groups: int = 14, copies: int = 9):
    """Groups of texts with ever more words changed, exact copies, tiny texts and shared passages."""
    rnd = random.Random(seed)
    vocab = [f"v{i}" for i in range(400)]
    passage = " ".join(rnd.choice(vocab) for _ in range(60))
    rows = []
    for _ in range(groups):
        base = [rnd.choice(vocab) for _ in range(rnd.choice((4, 5, 6, 9, 30, 80, 160)))]
        for c in range(copies):
            words = list(base)
            for _ in range(rnd.randrange(0, 1 + c // 2)):
                words[rnd.randrange(len(words))] = rnd.choice(vocab)
            if c == 4:
                words = words[:-1]
            text = " ".join(w + rnd.choice(("", "", "", ".", "!\n")) if c else w for w in words)
            rows.append(text.upper() if c == 3 else text + ("\n" + passage + "." if c == 5 else ""))
    rnd.shuffle(rows)
    return list(enumerate(rows, 1))


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    sets = {k: shingles(t) for k, t in rows}
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in sets}


@pytest.mark.parametrize("seed,block", [(1, 1024), (2, 3)])
def test_jaccard_join(spark, seed, block):
    from lifetide.llm.jaccard import join
    rows = corpus(seed)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in join(frame(spark, rows), block=block).collect()}
    assert got == brute_components(rows)


def test_jaccard_of_four_and_five_shingles(spark):
    """The smallest sets that link without being equal: 4 of 5."""
    from lifetide.llm.jaccard import join
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g h i"), (3, "a b c d e f g")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in join(frame(spark, rows)).collect()}
    assert got == {1: (4, 1), 2: (5, 1), 3: (3, 3)}


def test_bitmap_bound_holds():
    import numpy as np

    from lifetide.llm.jaccard import _words
    from lifetide.llm.shingles import bitmap, bitmap_bits, overlap_bound
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 700).astype(np.uint64)
    sets = [np.unique(rng.choice(pool, rng.integers(5, 400))) for _ in range(40)]
    n = np.array([len(s) for s in sets])
    maps = _words([bitmap(s, bitmap_bits(len(s))).tobytes() for s in sets], n)
    bound = overlap_bound(maps, n, maps, n)
    for i, j in itertools.product(range(40), repeat=2):
        assert bound[i, j] >= len(np.intersect1d(sets[i], sets[j]))


def brute_spans(rows, sentences=2, least=16, long=40):
    def cut(text):
        words = [(m.start(), m.group().translate(LOWER), m.end()) for m in WORD.finditer(text)]
        out = []
        for i, (s, w, _) in enumerate(words):
            if i == 0 or words[i - 1][1][-1] in ".!?" or "\n" in text[words[i - 1][2]:s]:
                out.append((s, []))
            out[-1][1].append(w)
        return out
    first, result = {}, {}
    for k, text in sorted(rows):
        sents, gone = cut(text), set()
        for i in range(len(sents)):
            run, j = [], i
            while j < len(sents) and not (j - i >= sentences and len(run) >= least) and not (j - i == 1 and len(run) >= long):
                run += sents[j][1]
                j += 1
            if (j - i >= sentences and len(run) >= least) or (j - i == 1 and len(run) >= long):
                if first.setdefault(tuple(run), (k, i)) != (k, i):
                    gone |= set(range(i, j))
        ends = [s for s, _ in sents[1:]] + [len(text)]
        kept = text[:sents[0][0]] + "".join(text[sents[i][0]:ends[i]] for i in range(len(sents)) if i not in gone) if sents else text
        result[k] = (kept, len(sents), len(gone))
    return result


def test_sentence_spans(spark):
    from lifetide.llm.spans import dedup_spans
    rows = corpus(5) + [(900, " Leading blanks. ünïcode dash — here. " * 9), (901, "x. " * 50)]
    got = {r["doc_id"]: (r["text"], r["n_sentences"], r["n_removed"]) for r in dedup_spans(frame(spark, rows)).collect()}
    assert got == brute_spans(rows)
    assert any(n for _, _, n in got.values())


def test_passage_of_fifty_words_is_cut(spark):
    from lifetide.llm.spans import dedup_spans
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(7))
    passage = " ".join(" ".join(word() for _ in range(13)) + "." for _ in range(4))
    rows = [(i, " ".join(word() for _ in range(40)) + " " + passage + " " + " ".join(word() for _ in range(40))) for i in range(1, 7)]
    got = {r["doc_id"]: r for r in dedup_spans(frame(spark, rows)).collect()}
    assert got[1]["n_removed"] == 0 and all(got[i]["n_removed"] >= 3 for i in range(2, 7))


def test_followers_and_likeness(spark):
    from lifetide.llm.fingerprints import fingerprint_documents
    rows = corpus(6) + [(500, ""), (501, "ß" * 100), (502, "short")]
    got = {r["doc_id"]: r for r in fingerprint_documents(frame(spark, rows)).collect()}
    order = sorted(rows, reverse=True)
    for i, (k, text) in enumerate(order):
        other, cut = order[(i + 1) % len(order)][1], len(text) // 3
        edited = text[:len(text) - cut] + other[:cut]
        assert got[k]["n_chars"] == len(text)
        assert got[k]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[k]["near_edited"] <= 1 and 0 <= got[k]["near_next"] <= 1
        if text == other:
            assert got[k]["near_next"] == 1 and got[k]["fingerprint"] == got[order[i + 1][0]]["fingerprint"]
    prints = {}
    for k, text in rows:
        assert prints.setdefault(text, got[k]["fingerprint"]) == got[k]["fingerprint"]


def test_signature_likeness_is_indel_similarity():
    from lifetide.llm.fingerprints import _scores
    rnd = random.Random(4)
    pairs = []
    for _ in range(60):
        a = "".join(rnd.choice("ABCDEFG") for _ in range(rnd.randrange(5, 65)))
        b = a[:rnd.randrange(len(a))] + "".join(rnd.choice("ABCDEFG") for _ in range(rnd.randrange(0, 20)))
        pairs.append((re.sub(r"(.)\1{3,}", r"\1\1\1", a), re.sub(r"(.)\1{3,}", r"\1\1\1", b[:64])))

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
            row = new
        return row[-1]
    got = _scores([a for a, _ in pairs], [b for _, b in pairs])
    for (a, b), s in zip(pairs, got):
        need = max(1, min(4, min(len(a), len(b)) // 2)) if a and b else 0
        alike = bool(need) and any(a[i:i + need] in b for i in range(len(a) - need + 1))
        assert abs(s - (2 * lcs(a, b) / (len(a) + len(b)) if alike else 0)) < 1e-12


def test_components_of_paths_and_hubs(spark):
    from lifetide.llm.components import components
    rnd = random.Random(9)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 40)] + [(900, 901), (901, 900), (950, 950)]
    rnd.shuffle(links)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in range(500, 540)}, 900: 900, 901: 900}


def small_tree(seed):
    rnd = random.Random(seed)
    n = rnd.randrange(6, 9)
    label = rnd.sample(range(1, 100), n)
    return [(label[i], label[i - 1] if seed % 2 else label[rnd.randrange(i)]) for i in range(1, n)]


@pytest.mark.parametrize("links", [[(5, 4), (4, 3), (3, 2), (5, 1)], *(small_tree(seed) for seed in (4, 13, 25, 28, 29, 30))])
def test_components_of_a_single_small_tree(spark, links):
    """Every tree is the only component: nothing else keeps the rounds going."""
    from lifetide.llm.components import components
    got = sorted(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    nodes = {n for link in links for n in link}
    assert got == sorted((n, min(nodes)) for n in nodes)


def passage(name, n=9):
    return " ".join(f"{name} word{i} of sentence{i} here." for i in range(n))


def test_spans_of_rows_that_share_an_id(spark):
    """Cuts of one row do not reach other rows of its id, or other rows without one."""
    from lifetide.llm.spans import dedup_spans
    a, b, c = passage("alpha"), passage("beta"), passage("gamma", 8)
    rows = [(1, a), (None, "Short."), (None, b + " " + c), (None, ""), (None, None), (2, a + " " + c), (2, b), (2, "Tiny one. Two.")]
    got = [(r["doc_id"], r["text"], r["n_sentences"], r["n_removed"]) for r in dedup_spans(frame(spark, rows)).collect()]
    assert len(got) == len(rows)
    # ids in order, rows without one first: every passage stays where it comes first
    want = [(1, a, 9, 0), (None, "Short.", 1, 0), (None, b + " " + c, 17, 0), (None, "", 0, 0), (None, None, 0, 0),
            (2, "", 17, 17), (2, "", 9, 9), (2, "Tiny one. Two.", 2, 0)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_equal_rows_share_their_cuts(spark):
    from lifetide.llm.spans import dedup_spans
    a, b = passage("alpha"), passage("beta")
    rows = [(1, a), (2, a + " " + b), (2, a + " " + b)]
    got = sorted((r["doc_id"], r["text"], r["n_removed"]) for r in dedup_spans(frame(spark, rows)).collect())
    assert got == [(1, a, 0), (2, b, 9), (2, b, 9)]


def test_keep_one_decides_by_row(spark):
    """Rows without an id, and rows of one id, are told apart by their texts."""
    from lifetide.llm.jaccard import keep_one
    text = [" ".join(f"t{k}w{i}" for i in range(30)) for k in range(6)]
    rows = [(1, text[0]), (None, text[0]), (None, text[1]), (None, text[1]), (None, text[2]), (None, None), (None, ""),
            (7, text[3]), (7, text[4]), (7, text[4]), (7, text[4].upper()), (8, text[4]), (9, text[5]), (9, text[0] + " more"), (3, text[5] + " end")]
    got = sorted(((r["doc_id"], r["text"]) for r in keep_one(frame(spark, rows, extra=True)).collect()), key=repr)
    seven = [r for r in got if r[0] == 7 and r[1].lower() == text[4]]
    assert len(seven) == 1
    want = [(1, text[0]), (None, text[1]), (None, text[2]), (None, None), (None, ""), (7, text[3]), *seven, (3, text[5] + " end")]
    assert got == sorted(want, key=repr)


def test_blocks_of_a_mixed_tile(spark):
    """Sets of the largest component do not meet each other; every other pair meets in exactly one group."""
    import collections

    from lifetide.llm.jaccard import _blocks_that_meet
    # tile, node, component: a large component with few others, two even halves, all apart, one block
    rows = [(1, i, 0 if i < 960 else i) for i in range(1000)] + [(2, i, i % 2) for i in range(200)] + [(3, i, i) for i in range(60)] + [(4, i, i % 3) for i in range(9)]
    sizes, blocks = {1: 1000, 2: 200, 3: 60, 4: 9}, {1: 10, 2: 4, 3: 3, 4: 1}
    df = spark.createDataFrame([(t, sizes[t], blocks[t], n, c) for t, n, c in rows], "tile long, size long, blocks int, node long, comp long")
    groups = collections.defaultdict(lambda: collections.defaultdict(list))
    for r in _blocks_that_meet(df).collect():
        groups[r["tile"], r["i"], r["j"]][r["side"]].append((r["node"], r["comp"]))
    met = collections.Counter()
    for (tile, i, j), sides in groups.items():
        pairs = itertools.combinations(sides[i], 2) if i == j else itertools.product(sides[i], sides[j])
        met.update((tile, *sorted((a[0], b[0]))) for a, b in pairs if a[1] != b[1])
    for tile in sizes:
        nodes = [(n, c) for t, n, c in rows if t == tile]
        assert all(met[tile, a[0], b[0]] == 1 for a, b in itertools.combinations(nodes, 2) if a[1] != b[1])
    assert sum(len(s) for (t, _, _), g in groups.items() if t == 1 for s in g.values()) < 2 * 1000


def test_followers_of_rows_without_an_id(spark, monkeypatch):
    """Many rows without an id are cut into ranges by the hash of their text; every row has one follower."""
    from lifetide.llm import fingerprints
    monkeypatch.setattr(fingerprints, "ROWS_PER_RANGE", 10)
    rows = [(None, f"text {i % 90} " * (i % 7)) for i in range(150)] + [(i * 7, f"numbered {i}") for i in range(40)] + [(70, "again"), (2**62, "far"), (-5, "below")]
    df = frame(spark, rows).withColumn("v", F.xxhash64(F.coalesce("text", F.lit(""))))
    order = sorted(((r["doc_id"] is None, -(r["v"] if r["doc_id"] is None else r["doc_id"]), r["text"]) for r in df.collect()))
    want = sorted((text[:len(text) - len(text) // 3] + order[(i + 1) % len(order)][2][:len(text) // 3]) for i, (_, _, text) in enumerate(order))
    got = fingerprints.fingerprint_documents(frame(spark, rows)).collect()
    assert sorted(r["edited_sha256"] for r in got) == sorted(hashlib.sha256(t.encode()).hexdigest() for t in want)
