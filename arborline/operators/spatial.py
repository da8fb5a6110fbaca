"""Points in polygons and footprints that meet a region, exact, in column expressions.

A polygon is an array of rings, each an array of [x, y]; a point is inside if a ray from it crosses the rings' edges an odd number of times, so holes and several
parts need nothing of their own. Edges are half-open and always computed from their lower end: of polygons that share an edge exactly one has a point on it.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborline.checkpoints import checkpointed
from arborline.functions.cells import ROW_PAIRS, at_level, chosen, fitted_levels, level_of, meet
from arborline.operators.pixels import zonal_counts

#: A polygon's longer side has up to 2^FINENESS cells.
FINENESS = 4
#: Edges of a cell up to which they are columns that compiled code tests, in a narrow table and a wide one (much more code the JVM does not compile); cells of more are tested by their array.
FEW_SLOTS, SLOTS = 3, 12
#: What a cell of a polygon costs, in points that are tested.
CELL_TESTS = 600


def rings_of(geometry: Column) -> Column:
    """The rings of a GeoJSON Polygon or MultiPolygon in text; null for anything else."""
    kind, coordinates = F.get_json_object(geometry, "$.type"), F.get_json_object(geometry, "$.coordinates")
    several = F.flatten(F.from_json(coordinates, "array<array<array<array<double>>>>"))
    return F.when(kind == "Polygon", F.from_json(coordinates, "array<array<array<double>>>")).when(kind == "MultiPolygon", several)


def edges_of(rings: Column) -> Column:
    """The edges (x1, y1, x2, y2) of all rings, closed or not, each from its lower end up; those that can't be crossed, as they are level, are left out."""

    def of(ring: Column) -> Column:
        following = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, F.lit(1), F.lit(1)))
        return F.zip_with(ring, following, lambda a, b: F.struct(F.least(a[1], b[1]).alias("y1"), F.greatest(a[1], b[1]).alias("y2"), F.when(a[1] <= b[1], a[0]).otherwise(b[0]).alias("x1"), F.when(a[1] <= b[1], b[0]).otherwise(a[0]).alias("x2")))

    proper = F.filter(F.coalesce(rings, F.array().cast("array<array<array<double>>>")), lambda r: F.coalesce(F.size(r) >= 3, F.lit(False)))
    finite = lambda *values: F.greatest(*[F.coalesce(F.abs(v), F.lit(float("inf"))) for v in values]) < float("inf")
    return F.filter(F.flatten(F.transform(proper, of)), lambda e: finite(e["x1"], e["x2"], e["y1"], e["y2"]) & (e["y1"] < e["y2"]))


def _crosses(e: Column, x: Column, y: Column) -> Column:
    """Whether the ray from (x, y) to the right crosses the edge."""
    return (e["y1"] <= y) & (e["y2"] > y) & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])


def inside(x: Column, y: Column, edges: Column) -> Column:
    return F.size(F.filter(edges, lambda e: _crosses(e, x, y))) % 2 == 1


def _shaped(polygons: DataFrame, key: str, rings: str) -> DataFrame:
    """(key, all__, x0__, x1__, y0__, y1__, own__): edges, box and the level that fits its longer side, of polygons that have edges, over all cores."""
    low, high = (lambda e: F.least(e["x1"], e["x2"])), (lambda e: F.greatest(e["x1"], e["x2"]))
    spread = polygons.select(F.col(key), F.col(rings).alias("rings__")).repartition(3 * polygons.sparkSession.sparkContext.defaultParallelism)
    edged = spread.select(F.col(key), edges_of(F.col("rings__")).alias("all__")).where(F.size("all__") > 0)
    ends = [F.array_min(F.transform("all__", low)), F.array_max(F.transform("all__", high)), F.array_min(F.transform("all__", lambda e: e["y1"])), F.array_max(F.transform("all__", lambda e: e["y2"]))]
    boxed = edged.withColumns(dict(zip(("x0__", "x1__", "y0__", "y1__"), ends)))
    extent = F.greatest(F.col("x1__") - F.col("x0__"), F.col("y1__") - F.col("y0__"))
    furthest = F.greatest(*[F.abs(f"{a}{i}__") for a in "xy" for i in (0, 1)])
    # cells are not finer than doubles of this size can tell
    return checkpointed(boxed.withColumn("own__", level_of(F.greatest(extent, furthest * F.lit(2.0**-48)))))


def _levels(shaped: DataFrame, points: DataFrame, px: Column, py: Column) -> dict[int, int]:
    """Levels of cells for polygons of each own level: points are copied for each, polygons have a row a cell, and a point in a cell on a border is tested."""
    sizes = {r[0]: r[1] for r in shaped.groupBy("own__").agg(F.count(F.lit(1))).collect()}
    n, *ends = points.agg(F.count(F.lit(1)), F.min(px), F.max(px), F.min(py), F.max(py)).first()
    sides = [max(ends[i + 1] - ends[i], 0.0) if n else 0.0 for i in (0, 2)]

    def cost(own: int, level: int) -> float:
        extent, side = 0.75 * 2.0**own, 2.0**level
        dense = n / (max(sides[0], side) * max(sides[1], side))
        return sizes[own] * (CELL_TESTS * (extent / side + 1) ** 2 + 4 * (extent + side) * side * dense)

    return fitted_levels(sizes, FINENESS, cost, ROW_PAIRS * n)


def cover(shaped: DataFrame, key: str, levels: dict[int, int]) -> DataFrame:
    """(key, level__, ix__, iy__, odd__, edges__): the cells that a polygon's inside can touch.

    A point of the cell is inside if it crosses an odd number of edges__, or an even one where odd__ is set. edges__ are those that reach the cell; edges to its right are in
    odd__, and where their number changes at a height within the cell, one edge from there up stands for them. They are null for a cell wholly inside.
    """
    low, high = (lambda e: F.least(e["x1"], e["x2"])), (lambda e: F.greatest(e["x1"], e["x2"]))
    side = F.pow(F.lit(2.0), F.col("level__"))
    levelled = shaped.withColumn("level__", chosen(F.col("own__"), levels))
    lines = levelled.withColumn("iy__", F.explode(F.sequence(at_level(F.col("y0__"), F.col("level__")), at_level(F.col("y1__"), F.col("level__")))))
    y = F.col("iy__") * side
    line = lines.select(key, "level__", "iy__", F.filter("all__", lambda e: (e["y2"] > y) & (e["y1"] < y + side)).alias("line__"))
    numbers = F.sequence(at_level(F.array_min(F.transform("line__", low)), F.col("level__")), at_level(F.array_max(F.transform("line__", high)), F.col("level__")))
    cells = line.withColumn("ix__", F.explode(numbers))
    x = F.col("ix__") * side
    # crossings are rounded, so that edges beside the cell's sides count as reaching it
    left, right = x - side / F.lit(1024.0), x + side + side / F.lit(1024.0)
    parted = cells.select(key, "level__", "ix__", "iy__", F.filter("line__", lambda e: (high(e) >= left) & (low(e) <= right)).alias("near__"), F.filter("line__", lambda e: low(e) > right).alias("right__"))
    ended = parted.withColumn("ends__", F.filter(F.flatten(F.transform("right__", lambda e: F.array(e["y1"], e["y2"]))), lambda h: (h > y) & (h < y + side)))
    odd = F.size(F.filter("right__", lambda e: (e["y1"] <= y) & (e["y2"] > y))) % 2 == 1
    changes = F.filter(F.array_distinct("ends__"), lambda h: F.size(F.filter("ends__", lambda g: g == h)) % 2 == 1)
    far = F.lit(sys.float_info.max)
    edges = F.concat("near__", F.transform(changes, lambda h: F.struct(h.alias("y1"), F.lit(math.inf).alias("y2"), far.alias("x1"), far.alias("x2"))))
    # an array of one, as a condition on columns would have them computed twice
    one = F.filter(F.array(F.struct(odd.alias("odd__"), edges.alias("edges__"))), lambda c: c["odd__"] | (F.size(c["edges__"]) > 0))
    kept = ended.select(key, "level__", "ix__", "iy__", F.explode(one).alias("cell__"))
    return kept.select(key, "level__", "ix__", "iy__", "cell__.odd__", F.when(F.size("cell__.edges__") > 0, F.col("cell__.edges__")).alias("edges__"))


def _place(df: DataFrame) -> list[str]:
    """The columns of a cell; a level that all share is none, as a constant key would have both sides dealt out twice."""
    return [c for c in ("level__", "ix__", "iy__") if c in df.columns]


def _slotted(cells: DataFrame, slots: int) -> DataFrame:
    """Cells of up to so many edges, as columns without nulls; empty places hold an edge that no ray crosses."""
    columns = []
    for i in range(slots):
        e = F.get("edges__", F.lit(i))
        for part, empty in (("y1", math.inf), ("y2", -math.inf), ("x1", 0.0), ("x2", 0.0)):
            columns.append(F.coalesce(e[part], F.lit(empty)).alias(f"{part}__{i}"))
    return cells.select(*[c for c in cells.columns if c not in ("edges__", "odd__")], F.coalesce("odd__", F.lit(False)).alias("odd__"), *columns)


def _held(placed: DataFrame, x: Column, y: Column, cells: DataFrame, kept: Sequence[str]) -> DataFrame:
    """The columns kept of placed points and the cells that hold them; cells are checkpointed."""
    size, on, found = F.coalesce(F.size("edges__"), F.lit(0)), _place(cells), []
    sizes = {r[0] for r in cells.select(size).distinct().collect()}
    counted = checkpointed(placed.groupBy(*on).agg(F.count(F.lit(1)).alias("n__")))
    bounds = [-1, 0, min(FEW_SLOTS, SLOTS), SLOTS]
    for least, slots in zip(bounds, bounds[1:]):
        if any(least < n <= slots for n in sizes):
            held = F.col("odd__")
            for i in range(slots):
                held = held != _crosses({part: F.col(f"{part}__{i}") for part in ("x1", "x2", "y1", "y2")}, x, y)
            some = cells.where((size > least) & (size <= slots))
            # whole cells are their keys alone
            met = meet(placed, _slotted(some, slots) if slots else some.drop("edges__", "odd__"), on, counted)
            found.append((met.where(held) if slots else met).select(*kept))
    if any(n > SLOTS for n in sizes):
        met = meet(placed, cells.where(size > SLOTS), on, counted)
        found.append(met.where(inside(x, y, F.col("edges__")) != F.col("odd__")).select(*kept))
    return reduce(DataFrame.union, found) if found else meet(placed, cells, on, counted).select(*kept)


def _located(points: DataFrame, x: str, y: str, polygons: DataFrame, key: str, rings: str) -> tuple[DataFrame, Column, Column, DataFrame]:
    """(points with a finite place, once for each level of cells in use, with their cell; their place as doubles; the polygons' cells, checkpointed)."""
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    there = points.where(px.isNotNull() & py.isNotNull() & ~F.isnan(px) & ~F.isnan(py) & (F.abs(px) < float("inf")) & (F.abs(py) < float("inf")))
    shaped = _shaped(polygons, key, rings)
    levels = _levels(shaped, there, px, py)
    used = sorted(set(levels.values()))
    each = F.array(*[F.struct(F.lit(v).alias("level__"), at_level(px, v).alias("ix__"), at_level(py, v).alias("iy__")) for v in used]) if used else F.array().cast("array<struct<level__:int,ix__:bigint,iy__:bigint>>")
    placed, cells = there.withColumn("at__", F.explode(each)).select(*points.columns, "at__.*"), checkpointed(cover(shaped, key, levels))
    alike = ["level__"] if len(used) == 1 else []
    return placed.drop(*alike), px, py, cells.drop(*alike)


def points_in_polygons(points: DataFrame, x: str, y: str, polygons: DataFrame, key: str, rings: str = "rings") -> DataFrame:
    """points with the key of each polygon they lie in: a row a pair.

    Points and polygons meet by equality on cells; points of cells on a border are tested by ray casting, against the edges that matter there. Cases: points with a
    null or non-finite place lie nowhere; polygons without area, or null, hold nothing; repeated points and polygons each match; polygons may
    overlap; a point is tried once for each size of cell in use, which are few powers of two, and each class of cells by their edges; cells with many pairs are dealt into parts.
    """
    if key in points.columns:
        raise ValueError(f"rename {key}: both sides have it")
    placed, px, py, cells = _located(points, x, y, polygons, key, rings)
    return _held(placed, px, py, cells, [*points.columns, key])


def reduce_regions(points: DataFrame, x: str, y: str, value: str, polygons: DataFrame, key: str, rings: str = "rings") -> DataFrame:
    """(key, mean, median, sd) of the values of the points in each polygon; polygons without a point are left out.

    Points of one place and value are tested once, and in cells wholly inside only the cell's counts by value meet the polygons: pairs are no rows. What is kept is a count a polygon and value.
    """
    counted = points.select(F.col(x).cast("double").alias("x__"), F.col(y).cast("double").alias("y__"), F.col(value).alias("v__")).groupBy("x__", "y__", "v__").agg(F.count(F.lit(1)).alias("w__"))
    placed, px, py, cells = _located(checkpointed(counted), "x__", "y__", polygons, key, rings)
    border = _held(placed, px, py, cells.where("edges__ is not null"), [key, "v__", "w__"])
    whole = cells.where("edges__ is null").drop("edges__", "odd__")
    inner = meet(placed.groupBy(*_place(cells), "v__").agg(F.sum("w__").alias("w__")), whole, _place(cells)).select(key, "v__", "w__")
    found = border.union(inner).groupBy(key, "v__").agg(F.sum("w__").alias("w__"))
    return zonal_counts(checkpointed(found), key, "v__", "w__")


def _sides(a: Column, b: Column, p: Column) -> Column:
    return (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])


def _meet(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Whether the segments ab and cd have a point in common."""
    apart = lambda i: (F.greatest(a[i], b[i]) < F.least(c[i], d[i])) | (F.greatest(c[i], d[i]) < F.least(a[i], b[i]))
    return ~(apart(0) | apart(1)) & (_sides(a, b, c) * _sides(a, b, d) <= 0) & (_sides(c, d, a) * _sides(c, d, b) <= 0)


def _segments(ring: Column) -> Column:
    following = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, F.lit(1), F.lit(1)))
    return F.zip_with(ring, following, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def intersects(rings: Column, region: Sequence[Sequence[Sequence[float]]]) -> Column:
    """Whether a footprint has a point in common with a region given as its rings: their borders meet, or one holds the other. A null footprint does not.

    The region is a literal, such as a county's outline; to match tables with tables use points_in_polygons.
    """
    outline = F.array(*[F.array(*[F.array(*[F.lit(float(v)) for v in p]) for p in ring]) for ring in region])
    segments = F.flatten(F.transform(outline, _segments))
    own = F.filter(rings, lambda r: F.size(r) >= 3)
    borders = F.exists(F.flatten(F.transform(own, _segments)), lambda s: F.exists(segments, lambda t: _meet(s["a"], s["b"], t["a"], t["b"])))
    first = region[0][0]
    held = F.exists(own, lambda r: inside(r[0][0], r[0][1], edges_of(outline))) | inside(F.lit(float(first[0])), F.lit(float(first[1])), edges_of(rings))
    return F.coalesce(borders | held, F.lit(False))
