"""Interval and spatial joins against all pairs."""

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from arborline.functions import cells
from arborline.operators import intervals, spatial


@pytest.fixture(params=[None, 40])
def dense(request, monkeypatch):
    """Plain cells, and cells that are dealt above 40 rows."""
    if request.param:
        monkeypatch.setattr(cells, "DENSE_ROWS", request.param)
    return request.param


def test_intervals_are_all_pairs(spark, dense):
    r = random.Random(1)
    rows = [(i, r.choice(["a", "b", None]), r.choice([None, float(r.randint(-50, 5000)), r.uniform(-50, 5000)])) for i in range(300)] + [(i, "a", 77.0) for i in range(1000, 1100)]
    windows = [(i, r.choice(["a", "a", "b", None]), s, s + r.choice([0.0, -3.0, 1e-9, 0.5, 3.0, 40.0, 900.0, 6000.0])) for i, s in enumerate(float(r.randint(-40, 5000)) for _ in range(2000))]
    windows += [(2001, "a", None, 5.0), (2002, "a", 1.0, None), (2003, "a", 70.0, 80.0), (2003, "a", 70.0, 80.0), (2004, "a", float("-inf"), 1e9)]
    points = spark.createDataFrame(rows, "id int, g string, t double").repartition(3)
    spans = spark.createDataFrame(windows, "w int, g string, start double, end double")
    want = sorted((i, w) for i, g, t in rows for w, h, s, e in windows if g is not None and g == h and None not in (t, s, e) and s <= t < e and s > float("-inf"))
    got = sorted((x.id, x.w) for x in intervals.interval_join(points, "t", spans, ["g"]).collect())
    assert got == want and len(got) > 5_000
    every = sorted((i, w) for i, g, t in rows for w, h, s, e in windows if None not in (t, s, e) and s <= t < e and s > float("-inf"))
    assert sorted((x.id, x.w) for x in intervals.interval_join(points.drop("g"), "t", spans.drop("g")).collect()) == every
    assert intervals.interval_join(points, "t", spans.limit(0), ["g"]).count() == 0 == intervals.interval_join(points.limit(0), "t", spans, ["g"]).count()
    with pytest.raises(ValueError):
        intervals.interval_join(points, "t", spans)


def test_intervals_of_dates_and_large_numbers(spark):
    day = datetime.date(2024, 1, 1)
    rows = spark.createDataFrame([(i, day + datetime.timedelta(i)) for i in range(60)], "i int, d date")
    spans = spark.createDataFrame([(w, day + datetime.timedelta(w), day + datetime.timedelta(w + 10 * w % 31)) for w in range(50)], "w int, start date, end date")
    got = {(r.i, r.w) for r in intervals.interval_join(rows, "d", spans).collect()}
    assert got == {(i, w) for i in range(60) for w in range(50) if w <= i < w + 10 * w % 31}
    big = 1 << 62
    numbers = spark.createDataFrame([(big + i,) for i in range(5)], "t long")
    ends = spark.createDataFrame([(big + 1, big + 3)], "start long, end long")
    assert sorted(r.t - big for r in intervals.interval_join(numbers, "t", ends).collect()) == [1, 2]


def test_meetings_join_by_equality(spark):
    rows, spans = spark.range(1000).select(F.col("id").cast("double").alias("t")), spark.range(3000).select(F.col("id").cast("double").alias("start"), (F.col("id") * 1.5 + 1).alias("end"))
    square = F.array(F.array(*[F.array(F.lit(float(x)), F.lit(float(y))) for x, y in ((0, 0), (9, 0), (9, 9), (0, 9))]))
    shapes = spark.range(3).select("id", square.alias("rings"))
    for df in (intervals.interval_join(rows, "t", spans), spatial.points_in_polygons(rows.withColumn("u", F.col("t")), "t", "u", shapes, "id")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


@pytest.mark.parametrize("many, few", [(3000, 1500), (40, 60_000)])
def test_tasks_follow_the_pairs_that_meet(spark, monkeypatch, many, few):
    """Small tables with many pairs in few cells are not one task's, whichever side is the larger."""
    monkeypatch.setattr(cells, "PART_PAIRS", 200_000)
    rows = spark.range(0, many, 1, 1).select((F.col("id") % 50 / 10.0).alias("t"), "id")
    spans = spark.range(0, few, 1, 1).select(F.lit(0.0).alias("start"), F.lit(5.0).alias("end"), F.col("id").alias("w"))
    found = intervals.interval_join(rows, "t", spans).groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id", "w").alias("d")).collect()
    assert sum(r.n for r in found) == sum(r.d for r in found) == many * few
    assert max(r.n for r in found) <= 0.5 * many * few


def holds(rings, x, y):
    odd = False
    for ring in rings:
        for a, b in zip(ring, ring[1:] + ring[:1]):
            (x1, y1), (x2, y2) = (a, b) if a[1] <= b[1] else (b, a)
            odd ^= y1 <= y < y2 and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
    return odd


def star(r, x, y, size, n):
    import math

    return [[x + math.cos(6.283 * k / n) * size * (f := r.uniform(0.3, 1)), y + math.sin(6.283 * k / n) * size * f] for k in range(n)]


def test_points_in_polygons_are_all_pairs(spark, dense):
    r = random.Random(2)
    polygons = []
    for i in range(40):
        x, y, size = r.uniform(-100, 100), r.uniform(-100, 100), 2 ** r.uniform(-3, 7)
        outer = star(r, x, y, size, r.randint(3, 30))
        polygons.append((i, [outer + outer[:1], star(r, x, y, size * 0.3, 5)][: r.randint(1, 2)]))
    # a chessboard of squares that share edges, a ring in two parts, and what has no area
    polygons += [(100 + 4 * a + b, [[[10.0 * a, 10.0 * b], [10.0 * a + 10, 10.0 * b], [10.0 * a + 10, 10.0 * b + 10], [10.0 * a, 10.0 * b + 10]]]) for a in range(4) for b in range(4)]
    polygons += [(200, [[[0.0, 0.0], [5.0, 5.0]]]), (201, []), (203, [[[1.0, 1.0], [2.0, 1.0], [3.0, 1.0]]]), (204, [[[0.0, 0.0], [1.0, 0.0], [0.0, 1.0]], [[50.0, 50.0], [51.0, 50.0], [50.0, 51.0]]])]
    points = [(i, r.uniform(-120, 120), r.uniform(-120, 120)) for i in range(600)] + [(1000 + i, 10.0 * (i % 5), 5.0 * (i // 5)) for i in range(45)] + [(2000, 3.3, 3.3)] * 60
    df = spark.createDataFrame([*points, (3000, None, 1.0), (3001, float("nan"), 1.0), (3002, float("inf"), 1.0)], "p int, x double, y double").repartition(3)
    shapes = spark.createDataFrame([*polygons, (202, None), (205, [[[float("nan"), 0.0], [1.0, 0.0], [0.0, 1.0]]]), (206, [[None, [1.0, 0.0], [0.0, 1.0], [0.0, 0.0]], None])], "k int, rings array<array<array<double>>>")
    got = sorted((q.p, q.k) for q in spatial.points_in_polygons(df, "x", "y", shapes, "k").collect() if q.k < 205)
    want = sorted((p, k) for p, x, y in points for k, rings in polygons if holds([g for g in rings if len(g) > 2], x, y))
    assert got == want and len(want) > 150
    # on the chessboard a point lies in exactly one square, on edges and corners too
    on_board = [p for p, x, y in points if 0 <= x < 40 and 0 <= y < 40]
    assert all(sum(100 <= k < 116 for q, k in set(got) if q == p) == 1 for p in on_board)
    with pytest.raises(ValueError):
        spatial.points_in_polygons(df, "x", "y", shapes, "x")


def test_regions_and_geojson(spark):
    text = {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]]}
    several = {"type": "MultiPolygon", "coordinates": [text["coordinates"], [[[10, 10], [12, 10], [10, 12], [10, 10]]]]}
    rows = [(1, json.dumps(text)), (2, json.dumps(several)), (3, json.dumps({"type": "Point", "coordinates": [1, 1]})), (4, None), (5, "no json")]
    shapes = spark.createDataFrame(rows, "k int, geometry string").select("k", spatial.rings_of(F.col("geometry")).alias("rings"))
    points = spark.createDataFrame([(0.5, 0.5, 1.0), (1.5, 1.5, 2.0), (10.5, 10.5, 4.0), (3.0, 3.0, 3.0)], "x double, y double, v double")
    assert sorted((r.k, r["mean"], r["median"]) for r in spatial.reduce_regions(points, "x", "y", "v", shapes, "k").collect()) == [(1, 2.0, 2.0), (2, pytest.approx(8 / 3), 3.0)]
    square = lambda x, y, s: [[[x, y], [x + s, y], [x + s, y + s], [x, y + s]]]
    region = text["coordinates"]
    cases = [(square(5.0, 5.0, 1.0), False), (square(4.0, 4.0, 1.0), True), (square(-1.0, -1.0, 9.0), True), (square(1.2, 1.2, 0.5), False), (square(3.0, 3.0, 0.5), True), (square(1.5, 1.5, 1.0), True), (square(-2.0, 1.0, 3.0), True), ([], False), (None, False)]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, rings array<array<array<double>>>")
    assert {r.i for r in df.where(spatial.intersects(F.col("rings"), region)).collect()} == {i for i, (_, want) in enumerate(cases) if want}


def test_border_cells_are_tested_by_compiled_code(spark, monkeypatch):
    """Cells of few edges are compared without an array's lambda, which Spark interprets a pair; cells of more edges are added, and both give all pairs."""
    r = random.Random(7)
    points = [(i, r.uniform(-9, 9), r.uniform(-9, 9)) for i in range(400)]
    shapes = [(i, [star(r, r.uniform(-5, 5), r.uniform(-5, 5), 5.0, 9)]) for i in range(12)]
    df, polygons = spark.createDataFrame(points, "p int, x double, y double"), spark.createDataFrame(shapes, "k int, rings array<array<array<double>>>")
    want = sorted((p, k) for p, x, y in points for k, rings in shapes if holds(rings, x, y))
    for slots in (40, 2):
        monkeypatch.setattr(spatial, "SLOTS", slots, raising=False)
        found = spatial.points_in_polygons(df, "x", "y", polygons, "k")
        assert sorted((q.p, q.k) for q in found.collect()) == want
        assert ("lambda" in found._jdf.queryExecution().executedPlan().toString()) == (slots == 2)


def test_regions_are_reduced_without_their_pairs(spark, monkeypatch):
    """Means, medians and deviations of all pairs, of which no table is made; repeated points and null values count as before."""
    import statistics

    r = random.Random(8)
    points = [(float(r.randint(-9, 9)), r.uniform(-9, 9), r.choice([None, 0.0, 0.5, 2.0, r.random()])) for _ in range(300)] * 2
    shapes = [(i, [star(r, r.uniform(-5, 5), r.uniform(-5, 5), 5.0, 9)]) for i in range(10)]
    df, polygons = spark.createDataFrame(points, "x double, y double, v double"), spark.createDataFrame(shapes, "k int, rings array<array<array<double>>>")
    monkeypatch.setattr(spatial, "points_in_polygons", None)
    got = {q.k: (q["mean"], q["median"], q["sd"]) for q in spatial.reduce_regions(df, "x", "y", "v", polygons, "k").collect()}
    for k, rings in shapes:
        held = [v for x, y, v in points if holds(rings, x, y) and v is not None]
        assert got[k] == pytest.approx((statistics.mean(held), statistics.median(held), statistics.pstdev(held)), abs=1e-12)


def test_level_edges_within_cells(spark):
    """A cell that only a level edge crosses is not wholly inside, nor is one to whose right the number of edges changes."""
    square = [[0.3, 0.3], [10.3, 0.3], [10.3, 10.3], [0.3, 10.3]]
    steps = [[20.0, 0.0], [29.7, 0.0], [29.7, 4.3], [24.1, 4.3], [24.1, 9.9], [20.0, 9.9]]
    shapes = [(1, [square]), (2, [steps]), (3, [square, [[2.2, 2.2], [8.2, 2.2], [8.2, 7.7], [2.2, 7.7]]])]
    points = [(31 * i + j, i * 1.01 - 0.1, j * 0.37 - 0.1) for i in range(31) for j in range(31)]
    df, polygons = spark.createDataFrame(points, "p int, x double, y double"), spark.createDataFrame(shapes, "k int, rings array<array<array<double>>>")
    want = sorted((p, k) for p, x, y in points for k, rings in shapes if holds(rings, x, y))
    assert sorted((q.p, q.k) for q in spatial.points_in_polygons(df, "x", "y", polygons, "k").collect()) == want
    counts = {k: sum(q == k for _, q in want) for k, _ in shapes}
    sums = spatial.reduce_regions(df.withColumn("v", F.lit(1.0)), "x", "y", "v", polygons, "k").collect()
    assert {q.k for q in sums} == set(counts) and all(q["mean"] == 1.0 and q["sd"] == 0.0 for q in sums)


def test_pairs_are_elements_of_arrays(spark, monkeypatch):
    """Points meet arrays of polygons in the join, of some PACK_ROWS at most; compiled code runs through their elements."""
    r = random.Random(9)
    points = [(i, r.uniform(-9, 9), r.uniform(-9, 9)) for i in range(300)]
    shapes = [(i, [star(r, r.uniform(-5, 5), r.uniform(-5, 5), 5.0, 9)]) for i in range(60)]
    df, polygons = spark.createDataFrame(points, "p int, x double, y double"), spark.createDataFrame(shapes, "k int, rings array<array<array<double>>>")
    want = sorted((p, k) for p, x, y in points for k, rings in shapes if holds(rings, x, y))
    monkeypatch.setattr(cells, "FEW_PAIRS", 0)
    for rows in (4096, 5):
        monkeypatch.setattr(cells, "PACK_ROWS", rows, raising=False)
        found = spatial.points_in_polygons(df, "x", "y", polygons, "k")
        assert sorted((q.p, q.k) for q in found.collect()) == want
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate explode(few__" in plan and "collect_list" in plan and "lambda" not in plan


def test_polygons_are_covered_by_all_cores(spark):
    """A small file of polygons is one task's when it is read; their cells are not made there."""
    shapes = spark.range(0, 400, 1, 1).select("id", F.array(F.array(*[F.array(F.col("id") + F.lit(x), F.lit(y)) for x, y in ((0.0, 0.0), (3.0, 0.1), (1.0, 2.5))])).alias("rings"))
    rows = spatial._shaped(shapes, "id", "rings").groupBy(F.spark_partition_id()).count().collect()
    assert len(rows) >= 4 and max(r["count"] for r in rows) <= 200 and sum(r["count"] for r in rows) == 400


def test_rows_are_copied_for_few_lengths(spark, monkeypatch):
    """Windows of many lengths share buckets, so that rows are not copied for each power of two; what is dealt out is a few times the input."""
    met = []
    monkeypatch.setattr(intervals, "meet", lambda many, few, *rest: met.append((many.count(), few.count())) or cells.meet(many, few, *rest))
    rows = spark.range(2000).select((F.col("id") * 0.36).alias("t"), "id")
    spans = spark.range(600).select((F.col("id") * 1.1).alias("start"), (F.col("id") * 1.1 + F.col("id") % 120 + 1).alias("end"), F.col("id").alias("w"))
    assert intervals.interval_join(rows, "t", spans).count() == sum(w * 1.1 <= t * 0.36 < w * 1.1 + w % 120 + 1 for t in range(2000) for w in range(600))
    [(many, few)] = met
    assert many <= 2 * 2000 and few <= 6 * 600
