"""Hard-negative mining against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelforge.llm import hard_negatives as hard

KIND = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=10, anchor=lambda i: i % 100 == 0):
    usable = {(i, tuple(math.floor(256 * float(np.float32(x))) for x in v), label) for i, v, label in rows if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a in usable:
        if not anchor(a[0]):
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[1], b[1])), b[0], b[2]) for b in usable if b != a)
        for s, p, _ in [x for x in scored if x[2] == a[2]][:positives]:
            inside = [x for x in scored if x[2] != a[2] and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives]
            out += [(a[0], p, k, n, -s, -t) for k, (t, n, _) in enumerate(inside, 1)]
    return sorted(out)


def told(frame, **kw):
    return sorted(map(tuple, hard.mine(hard.usable(frame), F.col("id") % 100 == 0, **kw).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def vectors(seed, n, width, spread):
    r = random.Random(seed)
    centres = [[r.gauss(0, 0.1) for _ in range(width)] for _ in range(6)]
    return [(i, [c + r.gauss(0, spread) for c in centres[i % 6]], r.randrange(4)) for i in range(n)]


@pytest.mark.parametrize(("seed", "n", "width", "spread", "sample"), [(1, 900, 16, 0.05, 4096), (2, 700, 7, 0.2, 40)])
def test_equals_brute_force(spark, monkeypatch, seed, n, width, spread, sample):
    rows = vectors(seed, n, width, spread)
    assert told(spark.createDataFrame(rows, KIND), sample=sample) == brute(rows)


def test_copies_ties_and_odd_rows(spark):
    r = random.Random(3)
    rows = [(i, r.choice([[0.5, 0.25], [0.25, 0.25], [0.1, 0.4], [0.3]]), i % 3) for i in range(800)]  # a few vectors, a third of each label
    rows += [(900, None, 1), (1000, [0.5, None], 1), (1001, [0.5, 0.5], None), (None, [0.5, 0.5], 1), (1100, [float("nan"), 0.1], 1), (1200, [float("inf"), 0.1], 1), (1300, [], 2), (1301, [-0.5, -0.5], 2), (1302, [0.0, 0.0], 0)]
    rows += [(0, rows[0][1], 0), (5, rows[5][1], 2)]  # repeated
    frame = spark.createDataFrame(rows, KIND).select("*", *(F.lit(n).alias(n) for n in "key id anchor vector low high least place".split()))
    assert told(frame) == brute(rows)
    assert told(frame.limit(0)) == [] and told(frame.where("vec_id = 100")) == [] and told(frame.where("vec_id = 7")) == []


def test_bounds_hold_and_filter():
    r = np.random.default_rng(4)
    own = np.floor(256 * r.normal(0, 0.125, (3000, 32)))
    books = hard.fit(own[:1000])
    codes, missed = hard.code(own, books)
    tables, exact = hard._Tables(own[:50], books), own[:50] @ own.T
    about = tables.all(codes)
    x, y = np.nonzero(np.ones_like(about, bool))
    flat, n = about.reshape(-1), []
    for level in range(hard.LEVELS):
        flat = flat + tables.more(level, x, codes[y]) if level else flat
        slack = hard._slack(flat, tables.norms[x], missed[y, level])
        assert (np.abs(flat - exact.reshape(-1)) <= slack).all()
        n.append((flat + slack >= np.sort((flat - slack).reshape(about.shape), axis=1)[:, -10][x]).sum())
    assert n[0] > n[1] > n[2] >= 500 and n[2] < 1000  # what is left to be scored exactly, of 150,000 pairs
    window = hard._Window(np.full(50, -np.inf), np.full(50, np.inf), 10)
    low = (flat - slack).reshape(about.shape)
    for at in range(0, 3000, 500):
        window.add(x[y // 500 == at // 500], *((flat + k * slack)[y // 500 == at // 500] for k in (-1, 1)))
    assert np.allclose(window.floor, np.sort(low, axis=1)[:, -10])
