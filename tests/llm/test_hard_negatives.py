"""Hard negatives against brute force over all pairs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from ledgerloom.llm import hard_negatives as H
from ledgerloom.llm.common import Scratch

ROWS = "vec_id long, embedding array<float>, label int"


def brute(rows):
    held = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        held.append((i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in v]))
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for n, (i, label, q) in enumerate(held):
        if i is None or i % 50:
            continue
        others = [(score(q, x), j, lab) for m, (j, lab, x) in enumerate(held) if m != n]
        for p, pid, _ in sorted((o for o in others if o[2] == label), key=order)[:5]:
            fits = sorted((o for o in others if o[2] != label and 50 * p <= 100 * o[0] <= 95 * p), key=order)[:3]
            out += [(i, pid, rank, nid, p, s) for rank, (s, nid, _) in enumerate(fits, 1)]
    return sorted(out, key=str)


def check(spark, rows):
    assert sorted(map(tuple, H.hard_negatives(spark, spark.createDataFrame(rows, ROWS)).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    rng = random.Random(4)
    centre = [[rng.gauss(0, 0.4) for _ in range(6)] for _ in range(9)]
    rows = [(i, [x + rng.gauss(0, 0.1) for x in rng.choice(centre)], rng.randrange(4)) for i in range(700)]
    rows += [(1000 + i, centre[0], rng.randrange(3)) for i in range(300)]  # one vector, many ties
    if small:
        monkeypatch.setattr(H, "BIN_ROWS", 37)
    check(spark, rows)


def test_odd_rows(spark):
    v = [0.5, 0.25]
    rows = [(0, v, 1), (0, v, 1), (0, v, 2), (50, v, 3), (None, v, 3), (None, v, 1), (7, v, 1), (None, [0.4, 0.25], 2), (100, [0.4], 1), (150, [], 1), (200, [-0.5, -0.25], 1)]
    rows += [(1, None, 1), (2, v, None), (3, [None, 0.1], 1), (4, [float("nan"), 0.1], 1), (5, [float("inf"), 0.1], 1), (8, [0.45, 0.2], 1), (9, [0.45, 0.2], 2), (10, [0.4, 0.2], 2), (11, [300.0, -2.0], 1), (12, [250.0, 1.5], 2)]
    check(spark, rows)
    for rest in ([], [(50, v, 1)], [(1, v, 1), (2, v, 2)], [(50, [], 1), (51, [], 1), (52, [], 2)]):
        check(spark, rest)
    named = spark.createDataFrame([(50, v, 1, 2, 3), (51, v, 1, 2, 3), (52, [0.4, 0.25], 2, 2, 3)], "vec_id long, embedding array<float>, label int, q int, `a.b` int")
    assert len(H.hard_negatives(spark, named).collect()) == 1


def test_products_are_exact():
    rng = np.random.default_rng(0)
    for most in (200, 10**6, 10**8):
        a, b = rng.integers(-most, most, (5, 7)), rng.integers(-most, most, (6, 7))
        assert (H.products(a, b) == a @ b.T).all()
    with pytest.raises(ArithmeticError):
        H.products(np.array([[1 << 33]]), np.array([[1 << 33]]))


def test_bounds_hold_and_lists_are_skipped(spark):
    """Every row's score lies within its list's bounds, and distant lists are not visited."""
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(12, 8)) * 2
    rows = [(i, (centre[i % 12] + rng.normal(size=8) * 0.02).tolist(), int(rng.integers(3))) for i in range(600)]
    scratch = Scratch(spark, "t")
    taking = scratch.cut(H.prepared(spark.createDataFrame(rows, ROWS)).selectExpr("*", "monotonically_increasing_id() AS uid"), "rows")
    index = H.Search(scratch, taking)
    lists, _ = index.lists.value
    held = index.rows.toPandas()
    q = np.stack(held.q)
    least, most = lists.bounds(q[:50])
    scores = q[:50] @ q.T
    at = held.list.to_numpy()
    assert (scores >= least[:, at]).all() and (scores <= most[:, at]).all()
    kth = np.sort(scores, 1)[:, -6:-5]
    floor = np.maximum(kth, 1)
    assert H._wanted(lists, q[:50], floor, np.full_like(floor, H.LAST - 1), np.full_like(floor, H.FIRST + 1), False).mean() < 0.5
