"""Mined negatives against all scores."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from stratum.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, score int"


def brute(rows, every=100, positives=5, negatives=5, least=80):
    usable = [
        (i, [max(-(1 << 24), min(1 << 24, math.floor(256 * float(np.float32(x))))) for x in v], label)
        for i, v, label, *_ in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, (i, v, label) in enumerate(usable):
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w, strict=False)), j, k) for m, (j, w, k) in enumerate(usable) if m != n]
        for s, j, _ in sorted(x for x in scored if x[2] == label)[:positives]:
            window = sorted(x for x in scored if x[2] != label and least * -s <= 100 * -x[0] <= 100 * -s)[:negatives]
            out += [(i, j, r, k, -s, -t) for r, (t, k, _) in enumerate(window, 1)]
    return Counter(out)


def mined(spark, rows, **more):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)
    out = hard_negatives.mined(table, **more)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert [t for _, t in out.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    return Counter(tuple(r) for r in out.collect())


def vectors(n, width=20, labels=4, seed=1):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(0, 1, (labels, width))
    return [(i, [float(np.float32(x)) for x in rnd.normal(0, 0.7, width) + 0.7 * centres[i % labels]], int(rnd.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("block", [4, 4096])
def test_equals_all_scores(spark, block):
    rows = vectors(600)
    assert mined(spark, rows, every=20, block=block) == brute(rows, 20)


def test_edges(spark):
    rows = vectors(150, 6, 3)
    hot = rows[10][1]
    rows += [(1000 + i, hot, 0) for i in range(200)]  # one very common vector
    rows += [
        (None, hot, 0), (2001, None, 0), (2002, hot, None), (2003, [None, *hot[1:]], 0), (2004, [math.nan, *hot[1:]], 0),
        (2005, [math.inf, *hot[1:]], 1), (2006, [], 1), (2007, hot[:3], 1), (2008, hot + [1.0], 1), (2010, [3e38] * 6, 2),
        (2020, [0.0] * 6, 1), (100, hot, 2), (100, hot, 2), (0, hot, 7), (3000, [], 1), (3010, [-1e30] * 6, 2),
    ]
    assert mined(spark, rows, every=10) == brute(rows, 10)


def test_few_positives_none_and_empty(spark):
    assert mined(spark, []) == Counter()
    rows = [(0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, [0.8, 0.0], 2), (3, [-1.0, 0.0], 2), (100, [1.0, 1.0], 3)]
    assert mined(spark, rows) == brute(rows) != Counter()


def test_lists_leave_out_what_norms_cover():
    rnd = np.random.default_rng(5)
    x = rnd.integers(-200, 200, (400, 32))
    q = rnd.integers(-200, 200, (7, 32)).astype(float)
    norms = hard_negatives._norms(q)
    for part in (0.9, 0.4, 0.0):
        least = np.ceil(part * norms[:, -1] * np.sqrt(np.square(x).sum(1)).mean()).astype(np.int64)
        index = hard_negatives.Index(x, float((least / norms[:, -1]).min()))
        assert (index.left_out.sum() > 0) == (part > 0)
        anchor, row, score = index.matches(q, norms, least)
        full = (q @ x.T).astype(np.int64)
        assert {(a, r): s for a, r, s in zip(anchor, row, score, strict=True)} == {
            (a, r): full[a, r] for a, r in zip(*np.nonzero(full >= least[:, None]), strict=True)
        }
