"""Sums of Euclidean distances to the members of clusters, of many points, by a tree of cells: whole cells where a bound on the error allows, points elsewhere.

A cell of a cluster with n members, mean c and mean squared distance v from it stands for its members at a point x further from c than the cell's diagonal r: the
sum of distances is n |x - c| or up to v / (2 (|x - c| - r)^2) of itself more, as the distance is convex and its curvature is at most one over itself. So with a relative error e
allowed, a cell will do if v <= 2 e (|x - c| - r)^2; a cell that will not is opened, down to leaves, whose points are compared one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborline.checkpoints import checkpointed

#: Points of a leaf, about; points of a block, at most, about; and nodes of all trees, which are broadcast: of more points leaves hold more.
LEAF_POINTS, BLOCK_POINTS, MOST_NODES = 32, 2048, 200_000


def _levels(n: int, groups: int, dimensions: int) -> int:
    """How often the root is halved in every dimension: so that leaves hold LEAF_POINTS on the whole, or the trees have MOST_NODES."""
    leaves = min(max(1.0, n / LEAF_POINTS), MOST_NODES / 4)
    return int(max(0, np.ceil(np.log2(max(1.0, leaves / max(1, groups))) / dimensions)))


class Tree:
    """The nodes of one group by level, each level sorted by its cells: (cell, cluster, n, mean, mean square about it), in units of the root's sides."""

    def __init__(self, cells: np.ndarray, cluster: np.ndarray, n: np.ndarray, mean: np.ndarray, v: np.ndarray, levels: int, sides: np.ndarray) -> None:
        self.levels, self.sides = levels, sides
        self.nodes = []
        for level in range(levels, -1, -1):
            self.nodes.insert(0, (cells, cluster, n, mean, v))
            if level:
                keys = np.concatenate([cells >> 1, cluster[:, None]], axis=1)
                up, at = np.unique(keys, axis=0, return_inverse=True)
                total = np.bincount(at.ravel(), n, len(up))
                center = np.stack([np.bincount(at.ravel(), n * mean[:, k], len(up)) for k in range(mean.shape[1])], axis=1) / total[:, None]
                about = v + ((mean - center[at.ravel()]) ** 2).sum(axis=1)
                cells, cluster, n, mean, v = up[:, :-1], up[:, -1], total, center, np.bincount(at.ravel(), n * about, len(up)) / total

    def split(self, low: np.ndarray, high: np.ndarray, error: float) -> tuple[list[tuple[int, float, np.ndarray]], list[tuple[np.ndarray, int]]]:
        """For points in a box: (cluster, n, mean) of nodes that will do, and (cell, cluster) of leaves that won't; each member of the tree is in one of them."""
        far, near = [], []
        pick = np.arange(len(self.nodes[0][1]))
        for level, (cells, cluster, n, mean, v) in enumerate(self.nodes):
            away = np.sqrt((np.maximum(0.0, np.maximum(low - mean[pick], mean[pick] - high)) ** 2).sum(axis=1)) - np.sqrt((self.sides**2).sum()) / 2**level
            will = (away > 0) & (v[pick] <= 2 * error * away**2)
            far += [(int(cluster[i]), float(n[i]), mean[i]) for i in pick[will]]
            rest = pick[~will]
            if level == self.levels:
                near += [(cells[i], int(cluster[i])) for i in rest]
                break
            below = self.nodes[level + 1]
            parents = {(*map(int, cells[i]), int(cluster[i])) for i in rest}
            keys = np.concatenate([below[0] >> 1, below[1][:, None]], axis=1)
            pick = np.flatnonzero([tuple(k) in parents for k in keys.tolist()])
            if not len(pick):
                break
        return far, near


def distance_sums(placed: DataFrame, dimensions: int, error: float) -> DataFrame:
    """(r, g, c, c2, total) of points (r, g, c, x): the sum of distances to each cluster c2 of the group g, within the relative error. r is a number of the point's own.

    The trees' nodes, MOST_NODES at most on the whole, are broadcast; a leaf's points meet the points of near leaves only. At error 0 only cells of equal points stand for them.
    """
    spark = placed.sparkSession
    axes = range(dimensions)
    points = checkpointed(placed.select("r", "g", "c", *[F.col("x")[k].alias(f"x{k}") for k in axes]))
    boxes = points.groupBy("g").agg(F.count(F.lit(1)).alias("size"), *[f(f"x{k}").alias(f"{name}{k}") for k in axes for f, name in ((F.min, "a"), (F.max, "b"))])
    total, groups = boxes.agg(F.sum("size"), F.count(F.lit(1))).first()
    schema = "r long, g long, c long, c2 long, total double"
    if not total:
        return spark.createDataFrame([], schema)
    levels = _levels(total, groups, dimensions)
    unit = lambda k: F.coalesce(F.try_divide(F.col(f"x{k}") - F.col(f"a{k}"), F.col(f"b{k}") - F.col(f"a{k}")), F.lit(0.0))
    cell = [F.least(F.floor(unit(k) * F.lit(float(1 << levels))), F.lit((1 << levels) - 1)).cast("long").alias(f"q{k}") for k in axes]
    celled = checkpointed(points.join(boxes, "g").select("r", "g", "c", *[f"x{k}" for k in axes], *cell))
    names = [f"q{k}" for k in axes]
    away = [*(f"o{n}" for n in names), "oc"]
    leaves = celled.groupBy("g", *names, "c").agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"x{k}").alias(f"m{k}") for k in axes], sum((F.var_pop(f"x{k}") for k in axes[1:]), F.var_pop("x0")).alias("v"))
    known = leaves.toPandas()
    sides = {row.g: np.array([[row[f"a{k}"], row[f"b{k}"]] for k in axes]) for row in boxes.collect()}
    trees = {g: Tree(p[names].to_numpy(np.int64), p["c"].to_numpy(np.int64), p["n"].to_numpy(float), p[[f"m{k}" for k in axes]].to_numpy(float), p["v"].to_numpy(float), levels, sides[g][:, 1] - sides[g][:, 0]) for g, p in known.groupby("g")}
    shared = spark.sparkContext.broadcast((trees, {g: (x[:, 0], (x[:, 1] - x[:, 0]) / 2**levels) for g, x in sides.items()}))

    def split(key: tuple) -> tuple[list, list]:
        """What stands for the tree's clusters at the points of a leaf."""
        trees, boxes = shared.value
        start, edge = boxes[key[0]]
        low = start + np.array(key[1:]) * edge
        hair = 1e-9 * (edge + np.abs(low) + np.abs(start))  # for what rounding may put beside the leaf
        return trees[key[0]].split(low - hair, low + edge + hair, error)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, list] = {}
        for batch in batches:
            for key, rows in batch.to_pandas().groupby(["g", *names]):
                if key not in seen:
                    seen[key] = split(key)[0]
                by: dict[int, list] = {}
                for c2, n, mean in seen[key]:
                    by.setdefault(c2, []).append((n, mean))
                x = rows[[f"x{k}" for k in axes]].to_numpy(float)
                for c2, nodes in by.items():
                    sums = np.zeros(len(x))
                    for n, mean in nodes:
                        sums += n * np.sqrt(((x - mean) ** 2).sum(axis=1))
                    yield pa.record_batch([pa.array(rows["r"].to_numpy()), pa.array(rows["g"].to_numpy()), pa.array(rows["c"].to_numpy()), pa.array(np.full(len(x), c2)), pa.array(sums)], names=["r", "g", "c", "c2", "total"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(*key, *cell.tolist(), c2) for key in zip(*(batch.column(i).to_pylist() for i in range(1 + dimensions))) for cell, c2 in split(key)[1]]
            if rows:
                yield pa.record_batch([pa.array(v) for v in zip(*rows)], names=["g", *names, *away])

    far_sums = celled.mapInArrow(whole, schema)
    cells = checkpointed(celled.groupBy("g", *names).agg(F.count(F.lit(1)).alias("n")))
    pairs = cells.select("g", *names).repartition("g", *names).mapInArrow(meet, ", ".join(f"{n} long" for n in ("g", *names, *away)))
    others = leaves.select("g", *[F.col(n).alias(a) for n, a in zip((*names, "c"), away)], F.col("n").alias("on"))
    meeting = checkpointed(pairs.join(cells, ["g", *names]).join(others, ["g", *away])).withColumn("pair", F.monotonically_increasing_id())
    blocks = lambda c: F.ceil(F.col(c) / F.lit(BLOCK_POINTS)).cast("int")
    own = lambda c: F.pmod(F.xxhash64("r"), blocks(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), blocks(c) - 1))
    axis = [f"x{k}" for k in axes]
    # each block of a leaf meets each block of a near leaf
    left = celled.join(meeting.select("pair", "g", *names, "n", "on"), ["g", *names]).withColumns({"i": own("n"), "mine": F.lit(True)}).withColumn("j", every("on"))
    right = celled.withColumnsRenamed(dict(zip((*names, "c"), away))).join(meeting.select("pair", "g", *away, "n", "on"), ["g", *away]).withColumn("c", F.col(away[-1])).withColumns({"j": own("on"), "mine": F.lit(False)}).withColumn("i", every("n"))
    shown = ["pair", "i", "j", "mine", "r", "g", "c", *axis]

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        mine, theirs = part[part["mine"]], part[~part["mine"]]
        x, y = (p[[f"x{k}" for k in axes]].to_numpy(float) for p in (mine, theirs))
        found, member = np.unique(theirs["c"].to_numpy(), return_inverse=True)
        one_hot = np.eye(len(found))[member]
        sums = np.concatenate([np.sqrt(((x[s : s + 256, None, :] - y[None, :, :]) ** 2).sum(axis=2)) @ one_hot for s in range(0, len(x), 256)] or [np.zeros((0, len(found)))])
        k = len(found)
        return pd.DataFrame({"r": np.repeat(mine["r"].to_numpy(), k), "g": np.repeat(mine["g"].to_numpy(), k), "c": np.repeat(mine["c"].to_numpy(), k), "c2": np.tile(found, len(x)), "total": sums.ravel()})

    near_sums = left.select(*shown).union(right.select(*shown)).groupBy("pair", "i", "j").applyInPandas(compare, schema)
    return far_sums.union(near_sums).groupBy("r", "g", "c", "c2").agg(F.sum("total").alias("total"))
