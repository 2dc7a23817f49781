"""Hard negatives against all pairs in plain Python, Strassen's products against plain ones."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import hard_negatives as hard

SCHEMA = "vec_id long, embedding array<float>, label int"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 64, 200), (50, 33, 71), (96, 128, 64), (0, 5, 4), (4, 0, 6)])
def test_products(shape):
    m, k, n = shape
    pick = np.random.default_rng(m + k + n)
    a, b = pick.integers(-(2**27), 2**27, (m, k)), pick.integers(-(2**27), 2**27, (k, n))
    assert (hard.strassen(a, b, 4) == a @ b).all()


def test_sums_that_wrap_on_the_way_and_scores_beyond_a_long():
    a = np.full((40, 40), 2**30 + 1)
    assert (hard.strassen(a, np.eye(40, dtype=np.int64), 2) == a).all()
    far = hard.scores_of(np.array([[1e30, 1.0], [2.0**40, 3.0]]), np.array([[1.0, 5.0], [-1e30, 0.0], [2.0**22, 0.0]]))
    top, low = 2**63 - 1, -(2**63)
    assert far.tolist() == [[top, low, top], [2**40 + 15, low, 2**62]]


def mined(rows, settings, is_anchor):
    q = {}
    for n, (i, v, label) in enumerate(rows):
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q[n] = (i, [math.floor(settings.scale * float(np.float32(x))) for x in v], label)
    out = []
    for a, va, la in q.values():
        if not is_anchor(a):
            continue
        scored = [(-sum(x * y for x, y in zip(va, vc)), c, lc) for c, vc, lc in q.values()]
        positives = sorted((s, c) for s, c, lc in scored if lc == la and c != a)[: settings.positives]
        for ps, p in positives:
            fits = sorted(
                (s, c) for s, c, lc in scored
                if lc != la and settings.from_percent * -ps <= 100 * -s <= settings.to_percent * -ps
            )
            out += [(a, p, r, c, -ps, -s) for r, (s, c) in enumerate(fits[: settings.negatives], 1)]
    return sorted(out)


def check(spark, rows, settings=hard.Settings(), every=5):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for n, name in enumerate(("key", "id", "vector", "row", "column", "rank", "positives", "is_anchor")):
        df = df.withColumn(name, F.lit(n))
    got = hard.mine(df, F.col("vec_id") % every == 0, settings).select(*NAMES).collect()
    want = mined(rows, settings, lambda i: i % every == 0)
    assert sorted(map(tuple, got)) == want
    return want


def vectors(n, seed, dims=6, labels=4, grid=None):
    pick = random.Random(seed)
    draw = (lambda: pick.choice(grid)) if grid else (lambda: pick.gauss(0.3, 0.4))
    return [(i, [draw() for _ in range(dims)], pick.randrange(labels)) for i in range(n)]


def test_against_all_pairs(spark):
    assert check(spark, vectors(300, 1))


def test_ties(spark):
    """Few different vectors: nearly all scores are equal."""
    assert check(spark, vectors(200, 2, dims=3, grid=[0.0, 0.5, 1.0]))


def test_wide_windows_and_small_heaps(spark):
    check(spark, vectors(150, 3), hard.Settings(positives=2, negatives=9, from_percent=-50, to_percent=130))


def test_many_tiles(spark, monkeypatch):
    for name, value in (("ANCHOR_ROWS", 7), ("CANDIDATE_ROWS", 30), ("_PIECE_ANCHORS", 3), ("_PIECE_CANDIDATES", 11)):
        monkeypatch.setattr(hard, name, value)
    assert check(spark, vectors(250, 4), every=3)


def test_one_label_and_repeated_rows(spark):
    assert check(spark, [(i, v, 0) for i, v, _ in vectors(60, 5)]) == []
    rows = [(1, [0.5, 0.5], 1)] * 40 + [(2, [0.4, 0.6], 2)] * 40 + [(5, [0.5, 0.4], 1)] * 3
    assert check(spark, rows)


def test_odd_rows(spark):
    rows = vectors(80, 6) + [
        (None, [1.0] * 6, 1), (1000, None, 1), (1005, [1.0] * 6, None), (1010, [1.0, None, 0.0, 0.0, 0.0, 0.0], 2),
        (1015, [float("nan")] * 6, 2), (1020, [float("inf")] * 6, 2), (1025, [], 1), (1030, [0.9, 0.9], 1), (-5, [1.0] * 6, 3),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, hard.mine(df, F.col("vec_id") % 5 == 0).select(*NAMES).collect()))
    assert got == mined(rows, hard.Settings(), lambda i: i % 5 == 0) and any(r[0] == 1030 for r in got)
    assert hard.mine(df.filter("vec_id IS NULL"), F.col("vec_id") % 5 == 0).count() == 0
    assert hard.mine(df.filter("vec_id = 1"), F.col("vec_id") % 5 == 0).count() == 0
