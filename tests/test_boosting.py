"""Leaf-wise boosting against a plain-Python booster, and its properties (M2)."""

import bisect
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lifetide.operators import boosting as B

SETTINGS = B.Settings(leaves=9, rounds=4, patience=4, min_rows=15, max_bins=16, feature_share=0.7)


def planted(n, seed=5):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = r.random() * 10, float(r.randrange(6)), r.gauss(0, 1)
        y = 40 * (a > 6) * (b >= 3) + 7 * b - 3 * abs(c) + r.random()
        rows.append((None if i % 97 == 0 else a, b, float("nan") if i % 89 == 0 else c, round(y, 2), i % 5 == 0))
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(planted(2000), "a double, b double, c double, label double, is_validation boolean").cache()


def plain(rows, model, s):
    """The same booster, one row and one split at a time: every open leaf is scanned anew."""
    k = len(model.features)

    def bin_(x, f):
        return 0 if x is None or x != x else bisect.bisect_left(list(model.bounds[f]), (x - model.mean[f]) / model.std[f])

    bins = [[bin_(row[f], f) for f in range(k)] for row in rows]
    train = [i for i, row in enumerate(rows) if not row[4]]
    resid = [row[3] - model.base for row in rows]
    trees = []
    for number in range(s.rounds):
        drawn = sorted(random.Random(f"{s.seed}:{number}").sample(range(k), max(1, round(k * s.feature_share))))
        unit = B.unit_of(max(abs(resid[i]) for i in train), len(train))
        g = [round(x / unit) for x in resid]

        def split(members):
            best, n, total = None, len(members), sum(g[i] for i in members)
            for f in drawn:
                for cut in sorted({bins[i][f] for i in members})[:-1]:
                    left = [i for i in members if bins[i][f] <= cut]
                    nl, gl = len(left), float(sum(g[i] for i in left))
                    if nl < s.min_rows or n - nl < s.min_rows:
                        continue
                    gr = float(total) - gl
                    gain = gl * gl / nl + gr * gr / (n - nl) - float(total) * float(total) / n
                    if gain > 0 and (best is None or gain > best[0]):
                        best = (gain, f, cut)
            return best

        # leaves: path -> (training members, best split); a path is the list of tests passed
        leaves = {(): (train, split(train))}
        while len(leaves) < s.leaves:
            able = [p for p, (_, b) in leaves.items() if b]
            if not able:
                break
            p = max(able, key=lambda q: leaves[q][1][0])
            members, (_, f, cut) = leaves.pop(p)
            for side in (False, True):
                part = [i for i in members if (bins[i][f] > cut) == side]
                leaves[(*p, (f, cut, side))] = (part, split(part))
        values = {p: s.rate * unit * float(sum(g[i] for i in m)) / len(m) for p, (m, _) in leaves.items()}
        for i in range(len(rows)):
            p = next(p for p in values if all((bins[i][f] > cut) == side for f, cut, side in p))
            resid[i] -= values[p]
        trees.append(values)
    return trees, resid


def paths(tree):
    out, todo = {}, [(0, ())]
    while todo:
        node, p = todo.pop()
        if tree.feature[node] == B.LEAF:
            out[p] = tree.value[node]
        else:
            f, cut = tree.feature[node], tree.cut[node]
            todo += [(tree.left[node] + i, (*p, (f, cut, bool(i)))) for i in (0, 1)]
    return out


def test_equals_a_plain_booster(spark, frame):
    model = B.fit(frame, ["a", "b", "c"], settings=SETTINGS)
    rows = planted(2000)
    want, resid = plain(rows, model, SETTINGS)
    assert len(model.trees) == SETTINGS.rounds and len(model.errors) == SETTINGS.rounds
    for tree, leaves in zip(model.trees, want):
        got = paths(tree)
        assert set(got) == set(leaves) and len(got) == SETTINGS.leaves
        assert all(got[p] == pytest.approx(v, rel=1e-12, abs=1e-12) for p, v in leaves.items())
    held = [x * x for x, row in zip(resid, rows) if row[4]]
    assert model.errors[-1] == pytest.approx((sum(held) / len(held)) ** 0.5, rel=1e-9)
    scored = model.transform(frame, "p").agg(F.sum(F.abs(F.col("label") - F.col("p")))).first()[0]
    assert scored == pytest.approx(sum(abs(x) for x in resid), rel=1e-9)


def test_partitions_do_not_change_the_trees(spark, frame):
    s = B.Settings(leaves=9, rounds=2, max_bins=16)
    a, b = B.fit(frame, ["a", "b", "c"], settings=s), B.fit(frame.repartition(7), ["a", "b", "c"], settings=s)
    assert a.trees == b.trees


def test_cells_do_not_grow_with_the_rows(spark):
    """What a level brings to the driver is nodes x features x bins, whatever the rows."""
    shapes = []
    for n in (300, 3000):
        ids = np.arange(n)
        block = ((ids % 8).astype(np.int16)[None, :], np.zeros(n, bool), ids.astype(float))
        cells = B.histograms(spark.sparkContext.parallelize([block, block], 2), B.Tree(), [0], 1, 8, 1.0)
        assert cells[0, 0, :, 0].sum() == 2 * n and cells[0, 0, :, 1].sum() == n * (n - 1)
        shapes.append(cells.shape)
    assert shapes == [(1, 1, 8, 2)] * 2


def test_stops_after_idle_rounds_and_keeps_the_best(spark):
    """Labels that the features say nothing of: the validation error soon rises."""
    r = random.Random(3)
    rows = [(r.random(), r.random() * 100, i % 5 == 0) for i in range(400)]
    noise = spark.createDataFrame(rows, "x double, label double, is_validation boolean")
    s = B.Settings(leaves=8, rate=0.5, rounds=30, patience=3, min_rows=5)
    model = B.fit(noise, ["x"], settings=s)
    assert len(model.errors) < s.rounds and len(model.trees) <= len(model.errors) - s.patience


def test_odd_frames(spark):
    schema = "x double, label double, is_validation boolean"
    empty = spark.createDataFrame([], schema)
    model = B.fit(empty, ["x"])
    assert model.trees == [] and model.transform(spark.createDataFrame([(1.0, 0.0, False)], schema), "p").first().p == 0.0
    same = spark.createDataFrame([(None, 4.0, False)] * 50, schema)
    model = B.fit(same, ["x"])
    assert model.trees == [] and model.transform(same, "p").first().p == 4.0
