"""Prefix scans and regressions side by side."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from arborline.functions import running
from arborline.operators import analysis, cellsums, clusters


@pytest.mark.parametrize("rows_a_range", [500_000, 40])
def test_totals_below(spark, monkeypatch, rows_a_range):
    """One group of most rows among many small ones, null keys, and values with gaps."""
    monkeypatch.setattr(running, "RANGE_ROWS", rows_a_range)
    monkeypatch.setattr(running, "LEAST_ROWS", 30)
    r = random.Random(1)
    rows = [("hot", x, r.choice([None, r.randint(-9, 9)]), r.uniform(-1, 1)) for x in range(900)] + [(g, x, r.randint(0, 9), 0.5) for g in ["a", "b", None, *map(str, range(60))] for x in range(r.randint(1, 6))]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, x int, n int, v double").repartition(5)
    got = running.totals_below(df, ["g"], "x", ["n", "v"]).collect()
    assert len(got) == len(rows)
    for row in got:
        before = [q for q in rows if q[0] == row.g and q[1] < row.x]
        assert row.n__below == sum(q[2] or 0 for q in before) and row.v__below == pytest.approx(sum(q[3] for q in before), abs=1e-9)
    whole = running.totals_below(df.withColumn("o", F.struct("g", "x")), [], "o", ["n"])
    assert sorted(x.n__below for x in whole.where("g is null").collect())[0] == 0
    assert running.totals_below(df.limit(0), ["g"], "x", ["n"]).count() == 0


def test_ties_get_places_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(running, "RANGE_ROWS", 10)
    df = spark.createDataFrame([(1,)] * 50, "x int").withColumn("one", F.lit(1))
    assert sorted(r.one__below for r in running.totals_below(df, [], "x", ["one"]).collect()) == list(range(50))


def fitted(x, y, penalty=1.0):
    w = b = 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-(w * x + b)))
        g = np.array([((p - y) * x).sum() + penalty * w, (p - y).sum()])
        h = np.array([[(p * (1 - p) * x * x).sum() + penalty, (p * (1 - p) * x).sum()], [(p * (1 - p) * x).sum(), (p * (1 - p)).sum()]])
        step = np.linalg.solve(h, g)
        w, b = w - step[0], b - step[1]
    return w, b


def test_regressions_side_by_side_equal_separate_ones(spark):
    r = np.random.default_rng(3)
    rows = []
    for scope, n, shift, scale in (("a", 90, 0.0, 1.0), ("b", 47, 2.0, 0.3), ("c", 33, -1.0, 2.0), ("far", 40, 1e6, 1.0), (None, 30, 0.0, 1.0)):
        for i in range(n):
            y = bool(r.random() < 0.35)
            rows.append((scope, f"{scope}-{i}", float(r.normal(shift + scale * y, scale)), y))
    rows += [("one class", f"o{i}", float(i), True) for i in range(20)] + [("few", f"f{i}", float(i), i == 0) for i in range(12)] + [("tiny", f"t{i}", float(i), i % 2 == 0) for i in range(6)] + [("a", "gap", None, True), ("a", "gap2", 1.0, None)]
    df = spark.createDataFrame(rows, "s string, k string, x double, y boolean").repartition(4)
    dealt = analysis.dealt_folds(df.where("x is not null and y is not null").select("s", "k", "x", F.col("y").cast("double").alias("y")), "k", 5, ["s"]).collect()
    own = {q.k: q.fold for q in dealt}
    for s in {q.s for q in dealt}:
        for y in (0.0, 1.0):
            sizes = [sum(q.fold == f for q in dealt if q.s == s and q.y == y) for f in range(5)]
            assert max(sizes) - min(sizes) <= 1
        sizes = [sum(q.fold == f for q in dealt if q.s == s) for f in range(5)]
        assert max(sizes) - min(sizes) <= 1
    got = {q.k: q.score for q in analysis.cross_validated_scores(df, "k", "x", "y", scopes=["s"]).collect()}
    assert set(got) == {k for s, k, x, y in rows if s in ("a", "b", "c", "far", None) and None not in (x, y)}
    for s in ("a", "b", "c", "far", None):
        mine = [q for q in dealt if q.s == s]
        centre = np.mean([q.x for q in mine])
        for f in range(5):
            train = [q for q in mine if q.fold != f]
            w, b = fitted(np.array([q.x - centre for q in train]), np.array([q.y for q in train]))
            for q in mine:
                if own[q.k] == f:
                    assert got[q.k] == pytest.approx(1 / (1 + math.exp(-(w * (q.x - centre) + b))), abs=1e-7)


def test_regressions_of_separable_rows_settle(spark):
    df = spark.createDataFrame([(str(i), 1000.0 * (i - 50), i >= 50) for i in range(100)], "k string, x double, y boolean")
    scores = analysis.cross_validated_scores(df, "k", "x", "y")
    assert analysis.auc(scores, "score", "y").first().auc > 0.99
    assert analysis.cross_validated_scores(df.limit(0), "k", "x", "y").count() == 0


@pytest.mark.parametrize("error", [0.0, 0.02, 0.2])
def test_silhouettes_by_cells_keep_their_bound(spark, monkeypatch, error):
    monkeypatch.setattr(cellsums, "LEAF_POINTS", 4)
    monkeypatch.setattr(cellsums, "BLOCK_POINTS", 7)
    r = np.random.default_rng(9)
    rows = [(g, i, int(c), *map(float, x)) for g, n in ((1, 150), (2, 40), (None, 9)) for i, (c, x) in enumerate(zip(r.integers(0, 3, n), r.normal(0, 1, (n, 2)) * r.choice([0.1, 1, 5], (n, 1))))]
    rows += [(3, i, 0, 1.0, 2.0) for i in range(20)] + [(3, 100, 1, 1.0, 2.0), (4, 1, 0, 0.0, 0.0), (4, 2, 1, 1.0, 0.0), (5, 1, 0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "g int, k int, c int, a double, b double").repartition(3)
    exact = {(x.g, x.k): x.silhouette for x in clusters.silhouette(df, "k", ["a", "b"], "c", ["g"]).collect()}
    got = {(x.g, x.k): x.silhouette for x in clusters.silhouette(df, "k", ["a", "b"], "c", ["g"], error).collect()}
    assert got.keys() == exact.keys()
    assert all((got[k] is None) == (exact[k] is None) and (exact[k] is None or abs(got[k] - exact[k]) <= error + 1e-9) for k in exact)


def test_cells_spare_most_comparisons():
    r = np.random.default_rng(2)
    n, levels = 100_000, 6
    x = r.normal(0, 1, (n, 2))
    low, side = x.min(axis=0), np.ptp(x, axis=0)
    cells = np.minimum(((x - low) / side * 2**levels).astype(int), 2**levels - 1)
    up, at, size = np.unique(cells, axis=0, return_inverse=True, return_counts=True)
    mean = np.stack([np.bincount(at.ravel(), x[:, k]) for k in (0, 1)], axis=1) / size[:, None]
    v = np.bincount(at.ravel(), ((x - mean[at.ravel()]) ** 2).sum(axis=1)) / size
    tree = cellsums.Tree(up, np.zeros(len(up), int), size.astype(float), mean, v, levels, side)
    edge = side / 2**levels
    held = {tuple(c): s for c, s in zip(up.tolist(), size.tolist())}
    compared = 0
    for q, s in held.items():
        start = low + np.array(q) * edge
        far, near = tree.split(start, start + edge, 0.05)
        compared += s * (len(far) + sum(held[tuple(c.tolist())] for c, _ in near))
        assert sum(f[1] for f in far) + sum(held[tuple(c.tolist())] for c, _ in near) == n
    assert compared < n * n / 10
