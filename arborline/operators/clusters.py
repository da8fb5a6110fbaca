"""Cluster models: k-means and diagonal Gaussian mixtures, the choice of K, silhouettes, labels and assignment to frozen centres."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborline.checkpoints import checkpointed
from arborline.functions import scalars as S
from arborline.functions.quantiles import exact_quantiles
from arborline.functions.running import totals_below
from arborline.functions.scalars import num
from arborline.operators.cellsums import distance_sums

#: Names of clusters by rising cover score, for two and three clusters; fixed values.
LABELS = {
    "short": {2: ("NoCover", "Cover"), 3: ("NoCover", "Baseline", "Cover")},
    "likely": {2: ("Likely Not Cover Cropping", "Likely Cover Cropping"), 3: ("Likely Not Cover Cropping", "Likely Baseline", "Likely Cover Cropping")},
}
AGE_LABELS = {2: ("Young", "Old"), 3: ("Young", "Middle", "Old")}
#: Points of a block; pairs of blocks are compared by numpy. Groups of more than MANY_BLOCKS have blocks four times as large, so that fewer rows of sums are moved.
SILHOUETTE_CELL, MANY_BLOCKS = 2048, 32
#: Rows of a batch that fits pass to numpy, and choices of K whose silhouettes share their distances.
BATCH_ROWS, SHARED_CHOICES = 2048, 3
#: Restarts of the two kinds of fits, and the distinct rows up to which they start on all of them; of larger tables rounds of oversampling give the rows to start on.
KMEANS_STARTS, MIXTURE_STARTS, START_ROWS = 50, 5, 10_000
#: Rounds of oversampling, and the rows that each is expected to draw for every cluster.
SEED_ROUNDS, SEED_ROWS = 5, 20


@dataclass(frozen=True)
class Model:
    """centers by cluster number; variances and weights of a mixture; score: inertia, or the log-likelihood."""

    k: int
    centers: list[list[float]]
    score: float
    variances: list[list[float]] | None = None
    weights: list[float] | None = None


def _few(data: DataFrame, columns: Sequence[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to n distinct rows, those of smallest hash, and how often each occurs."""
    rows = data.groupBy(*columns).agg(F.count(F.lit(1)).alias("n__")).orderBy(F.xxhash64(*columns)).limit(n).collect()
    values = np.array([tuple(r) for r in rows], float).reshape(-1, len(columns) + 1)
    return values[:, :-1], values[:, -1]


def _square(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((x[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)


def _passed(data: DataFrame, columns: Sequence[str], work, schema: str) -> DataFrame:
    """work(rows as a matrix, their hashes) -> columns of the schema, batch by batch."""
    names = [c.split()[0] for c in schema.split(", ")]
    d = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                x = np.stack([part.column(i).to_numpy() for i in range(d)], axis=1).astype(float)
                yield pa.record_batch([pa.array(c) for c in work(x, part.column(d).to_numpy())], names=names)

    return data.select(*columns, F.xxhash64(*columns).alias("h__")).mapInArrow(run, schema)


def _sample(data: DataFrame, columns: Sequence[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Weighted rows to start on: of a table of up to START_ROWS distinct rows all; else those that rounds of k-means|| draw from the whole table, each with the rows nearest to it.

    A round draws every row on its own with a chance in proportion to its squared distance from the rows drawn so far (Bahmani et al., 2012), so that far groups are found
    however few rows they have. The driver gets some SEED_ROWS x k rows a round.
    """
    x, w = _few(data, columns, START_ROWS + 1)
    if len(x) <= START_ROWS:
        return x, w
    drawn = x[:1]
    for round_ in range(SEED_ROUNDS):
        near = lambda x, h, c=drawn: (np.array([_square(x, c).min(axis=1).sum()]),)
        cost = _passed(data, columns, near, "cost double").agg(F.sum("cost")).first()[0] or 0.0
        if cost <= 0:
            break
        share = SEED_ROWS * k / cost

        def draw(x: np.ndarray, h: np.ndarray, c=drawn, share=share, salt=np.uint64(0x9E3779B97F4A7C15 * (2 * round_ + 1) % (1 << 64))) -> list[np.ndarray]:
            u = h.view(np.uint64) * salt
            u = (u ^ (u >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            u = (u ^ (u >> np.uint64(29))).astype(float) / 2.0**64
            found = np.unique(x[u < share * _square(x, c).min(axis=1)], axis=0)
            return [found[:, i] for i in range(found.shape[1])]

        names = [f"x{i}" for i in range(len(columns))]
        found = _passed(data, columns, draw, ", ".join(f"{n} double" for n in names)).distinct().orderBy(*names).collect()
        drawn = np.unique(np.concatenate([drawn, np.array([tuple(r) for r in found], float).reshape(-1, len(columns))]), axis=0)

    def count(x: np.ndarray, h: np.ndarray) -> list[np.ndarray]:
        at, n = np.unique(_square(x, drawn).argmin(axis=1), return_counts=True)
        return [at, n]

    counts = {r.i: r.n for r in _passed(data, columns, count, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()}
    return drawn, np.array([counts.get(i, 0) for i in range(len(drawn))], float)


def _nearest_sums(x: np.ndarray, w: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By cluster: weight, sums about the centre, cost."""
    square = ((x[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)
    near = square.argmin(axis=1)
    sums = np.stack([np.bincount(near, w * (x[:, k] - centers[near, k]), len(centers)) for k in range(x.shape[1])], axis=1)
    return np.bincount(near, w, len(centers)), sums, np.bincount(near, w * square.min(axis=1), len(centers))


def _starts(x: np.ndarray, w: np.ndarray, k: int, restarts: int, rounds: int = 100) -> np.ndarray:
    """(restart, cluster, dimension): k-means++ draws from weighted rows, fitted on them."""
    if not len(x):
        raise ValueError("there is no row with all columns to fit clusters on")
    out = np.zeros((restarts, k, x.shape[1]))
    for s in range(restarts):
        rng = np.random.default_rng(s)
        chosen = [x[rng.choice(len(x), p=w / w.sum())]]
        while len(chosen) < k:
            d = w * ((x[:, None, :] - np.array(chosen)[None, :, :]) ** 2).sum(axis=2).min(axis=1)
            chosen.append(x[rng.choice(len(x), p=d / d.sum())] if d.sum() > 0 else x[rng.integers(len(x))])
        out[s] = chosen
        for _ in range(rounds):
            n, sums, _ = _nearest_sums(x, w, out[s])
            step = sums / np.maximum(n, 1)[:, None]
            out[s] += step
            if (step**2).sum() < 1e-18:
                break
    return out


def _columns_of(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(i).to_numpy() for i in range(batch.num_columns)], axis=1).astype(float)


def _lloyd_sums(data: DataFrame, columns: Sequence[str], centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all restarts in one pass: (rows, sums about the centres) by restart and cluster, and costs by restart."""
    d = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cost = np.zeros(centers.shape[:2]), np.zeros(centers.shape), np.zeros(centers.shape[:2])
        for batch in batches:
            x = _columns_of(batch)
            for r, c in enumerate(centers):
                for total, more in zip((n, sums, cost), _nearest_sums(x, np.ones(len(x)), c)):
                    total[r] += more
        at = np.indices(n.shape).reshape(2, -1)
        yield pa.record_batch([pa.array(at[0]), pa.array(at[1]), pa.array(n.ravel()), pa.array(cost.ravel()), *(pa.array(sums[:, :, k].ravel()) for k in range(d))], names=["r", "k", "n", "cost", *(f"s{k}" for k in range(d))])

    parts = data.select(*columns).mapInArrow(run, "r long, k long, n double, cost double, " + ", ".join(f"s{k} double" for k in range(d)))
    rows = parts.groupBy("r", "k").agg(*[F.sum(c).alias(c) for c in ("n", "cost", *(f"s{k}" for k in range(d)))]).collect()
    n, sums, cost = np.zeros(centers.shape[:2]), np.zeros(centers.shape), np.zeros(len(centers))
    for row in rows:
        n[row.r, row.k] = row.n
        cost[row.r] += row.cost
        sums[row.r, row.k] = row[4:]
    return n, sums, cost


def _lloyd(data: DataFrame, columns: Sequence[str], k: int, restarts: int, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """(centres of every restart, their costs), fitted on all rows. An empty cluster keeps its centre."""
    centers = _starts(*_sample(data, columns, k), k, restarts)
    for _ in range(rounds):
        n, sums, cost = _lloyd_sums(data, columns, centers)
        step = sums / np.maximum(n, 1)[:, :, None]
        if (step**2).sum(axis=(1, 2)).max() < 1e-18:
            break
        centers = centers + step
    return centers, cost


def _spread(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows with all columns, on all cores: a fit passes over them many times, and their bytes are too few to be split by."""
    return df.select(*columns).dropna().repartition(df.sparkSession.sparkContext.defaultParallelism)


def kmeans(df: DataFrame, columns: Sequence[str], k: int, restarts: int = KMEANS_STARTS) -> Model:
    """The best of many fits on rows with all columns, run side by side: a round of all of them is one pass and one aggregation."""
    data = _spread(df, columns).cache()
    try:
        centers, cost = _lloyd(data, columns, k, restarts)
        best = int(cost.argmin())
        return Model(k, centers[best].tolist(), float(cost[best]))
    finally:
        data.unpersist()


def _log_densities(columns: Sequence[str], model: Model) -> list[Column]:
    out = []
    for c, v, w in zip(model.centers, model.variances, model.weights):
        total = num(math.log(max(w, 1e-300)))
        for name, mean, var in zip(columns, c, v):
            total = total - num(0.5) * ((F.col(name) - num(mean)) * (F.col(name) - num(mean)) / num(var) + num(math.log(2 * math.pi * var)))
        out.append(total)
    return out


def posteriors(columns: Sequence[str], model: Model) -> tuple[Column, Column]:
    """(an array of each cluster's probability, the row's log-likelihood) under a mixture."""
    logs = F.array(*_log_densities(columns, model))
    top = F.array_max(logs)
    total = F.aggregate(logs, num(0), lambda a, x: a + F.exp(x - top))
    return F.transform(logs, lambda x: F.exp(x - top) / total), top + F.log(total)


def _moments(x: np.ndarray, w: np.ndarray, model: Model, hard: bool) -> tuple[np.ndarray, float]:
    """(by cluster: mass, sums about the centre, squares about it; the log-likelihood). hard: rows belong to the nearest centre wholly."""
    away = x[:, None, :] - np.array(model.centers)[None, :, :]
    likely = 0.0
    if hard:
        p = np.eye(model.k)[(away**2).sum(axis=2).argmin(axis=1)]
    else:
        var = np.array(model.variances)
        logs = np.log(np.maximum(model.weights, 1e-300)) - 0.5 * (away**2 / var + np.log(2 * math.pi * var)).sum(axis=2)
        top = logs.max(axis=1, keepdims=True)
        p = np.exp(logs - top)
        total = p.sum(axis=1, keepdims=True)
        p, likely = p / total, float((w * (top + np.log(total))[:, 0]).sum())
    p = p * w[:, None]
    return np.concatenate([p[:, :, None], p[:, :, None] * away, p[:, :, None] * away**2], axis=2).sum(axis=0), likely


def _stepped(model: Model, moments: np.ndarray, floor: float) -> Model:
    d = len(model.centers[0])
    mass = np.maximum(moments[:, :1], 1e-12)
    step = moments[:, 1 : 1 + d] / mass
    spread = np.maximum(moments[:, 1 + d :] / mass - step**2, 0.0) + floor
    return Model(model.k, (np.array(model.centers) + step).tolist(), model.score, spread.tolist(), (mass[:, 0] / moments[:, 0].sum()).tolist())


def _mixture_sums(data: DataFrame, columns: Sequence[str], models: list[Model]) -> tuple[np.ndarray, np.ndarray]:
    """Moments and log-likelihoods of all models in one pass."""
    k, width = models[0].k, 1 + 2 * len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, likely = np.zeros((len(models), k, width)), np.zeros(len(models))
        for batch in batches:
            x = _columns_of(batch)
            for r, m in enumerate(models):
                more, ll = _moments(x, np.ones(len(x)), m, hard=False)
                out[r], likely[r] = out[r] + more, likely[r] + ll
        at = np.indices(out.shape[:2]).reshape(2, -1)
        values = out.reshape(-1, width)
        yield pa.record_batch([pa.array(at[0]), pa.array(at[1]), pa.array(likely[at[0]]), *(pa.array(values[:, c]) for c in range(width))], names=["r", "k", "ll", *(f"s{c}" for c in range(width))])

    names = [f"s{c}" for c in range(width)]
    parts = data.select(*columns).mapInArrow(run, "r long, k long, ll double, " + ", ".join(f"{c} double" for c in names))
    out, likely = np.zeros((len(models), k, width)), np.zeros(len(models))
    for row in parts.groupBy("r", "k").agg(*[F.sum(c).alias(c) for c in ("ll", *names)]).collect():
        out[row.r, row.k], likely[row.r] = row[3:], row.ll
    return out, likely


def gaussian_mixture(df: DataFrame, columns: Sequence[str], k: int, restarts: int = MIXTURE_STARTS, rounds: int = 100, floor: float = 1e-6) -> Model:
    """The likeliest of several diagonal mixtures, each from a k-means fit of its own: fitted on the sample first, then on all rows side by side.

    Moments are taken about the last round's centres, so that large values don't cancel. A variance has ``floor`` added.
    """
    data = _spread(df, columns).cache()
    try:
        x, w = _sample(data, columns, k)
        models = []
        for c in _starts(x, w, k, restarts):
            model = Model(k, c.tolist(), -math.inf, [[1.0] * len(columns)] * k, [1.0 / k] * k)
            last = -math.inf
            for round_ in range(rounds):
                moments, likely = _moments(x, w, model, hard=not round_)
                if round_ and likely - last < 1e-9 * abs(likely):
                    break
                last = likely if round_ else last
                model = _stepped(model, moments, floor)
            models.append(model)
        last = np.full(restarts, -math.inf)
        for _ in range(rounds):
            moments, likely = _mixture_sums(data, columns, models)
            models = [Model(m.k, m.centers, float(ll), m.variances, m.weights) for m, ll in zip(models, likely)]
            if (likely - last).max() < 1e-6 * abs(likely).max():
                break
            last = likely
            models = [_stepped(m, part, floor) for m, part in zip(models, moments)]
        return max(models, key=lambda m: m.score)
    finally:
        data.unpersist()


def information_criteria(model: Model, n: int, dimensions: int) -> tuple[float, float]:
    """(BIC, AIC) of a diagonal mixture."""
    p = model.k * 2 * dimensions + model.k - 1
    return -2 * model.score + p * math.log(n), -2 * model.score + 2 * p


@dataclass(frozen=True)
class Choice:
    """The chosen model, and each K's scores: (K, silhouette, bic, aic), with nulls for what was not asked."""

    model: Model
    scores: list[tuple[int, float | None, float | None, float | None]]

    def score(self, k: int) -> float:
        return next(s if s is not None else b for kk, s, b, _ in self.scores if kk == k)


def choose_k(df: DataFrame, columns: Sequence[str], ks: Sequence[int], select: str = "silhouette", method: str = "kmeans", error: float | None = None) -> Choice:
    """The model of the K with the highest silhouette (ties: the smaller K), or with the lowest BIC, which always means a mixture."""
    if select not in ("silhouette", "bic") or method not in ("kmeans", "gmm"):
        raise ValueError(f"unknown choice {select!r} of {method!r}")
    rows = checkpointed(df.select(*columns).dropna().withColumn("row__", F.monotonically_increasing_id()))
    n = rows.count()
    fits: dict[int, tuple[Model, float]] = {}
    scores = []
    wanted = sorted(k for k in set(ks) if k < n)
    if select == "bic":
        for k in wanted:
            model = gaussian_mixture(rows, columns, k)
            bic, aic = information_criteria(model, n, len(columns))
            fits[k] = (model, -bic)
            scores.append((k, None, bic, aic))
    else:
        models = {k: gaussian_mixture(rows, columns, k) if method == "gmm" else kmeans(rows, columns, k) for k in wanted}
        for at in range(0, len(wanted), SHARED_CHOICES):
            own, names = rows, {}
            for k in wanted[at : at + SHARED_CHOICES]:
                names[k] = f"cluster_{k}__"
                placed = mixture_assign(own, columns, models[k]) if method == "gmm" else nearest(own, columns, models[k].centers)
                own = placed.select("row__", *columns, *[c for c in names.values() if c in placed.columns], F.col("cluster").alias(names[k]))
            for k, mean in zip(names, mean_silhouettes(own, "row__", columns, list(names.values()), error)):
                fits[k] = (models[k], -1.0 if mean is None else mean)
                scores.append((k, mean, None, None))
    if not fits:
        raise ValueError("no K is below the number of rows: ask for less quality, or add data")
    return Choice(fits[max(fits, key=lambda k: (fits[k][1], -k))][0], scores)


def nearest(df: DataFrame, columns: Sequence[str], centers: Sequence[Sequence[float]], confidence: float = 0.6, far: float = 1.5) -> DataFrame:
    """Add cluster (0-based; ties to the lower), d1, d2, best_soft and uncertain (1 or 0) by distance over the columns that are there.

    A row without any column gets cluster 0, no softness, and is uncertain.
    """
    each = [F.struct(F.coalesce(S.distance([F.col(c) for c in columns], [num(x) for x in center]), num(math.inf)).alias("d"), F.lit(i).alias("i")) for i, center in enumerate(centers)]
    out = df.withColumn("near__", F.array_sort(F.array(*each)))
    d1 = F.col("near__")[0]["d"]
    d2 = F.col("near__")[1]["d"] if len(centers) > 1 else num(math.inf)
    out = out.withColumns({"cluster": F.col("near__")[0]["i"], "d1": d1, "d2": d2})
    out = out.withColumn("best_soft", F.when(F.col("d1") < num(math.inf), F.coalesce(S.soft_confidence(F.col("d1"), F.col("d2")), num(1))))
    unsure = F.coalesce(F.col("best_soft") < confidence, F.lit(True)) | (F.col("d1") > far)
    return out.withColumn("uncertain", unsure.cast("int")).drop("near__")


def mixture_assign(df: DataFrame, columns: Sequence[str], model: Model, confidence: float = 0.6, far: float = 1.5) -> DataFrame:
    """As nearest, but rows with all columns go by the mixture's probabilities."""
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull()
    p, _ = posteriors(columns, model)
    out = nearest(df, columns, model.centers, confidence, far).withColumn("p__", F.when(whole, p))
    soft = F.array_max("p__")
    return out.withColumns({
        "cluster": F.when(whole, F.array_position("p__", soft).cast("int") - 1).otherwise(F.col("cluster")),
        "best_soft": F.when(whole, soft).otherwise(F.col("best_soft")),
        "uncertain": F.when(whole, (soft < confidence).cast("int")).otherwise(F.col("uncertain")),
    }).drop("p__")


def silhouette(df: DataFrame, key: str, columns: Sequence[str], cluster: str, within: Sequence[str] = (), error: float | None = None) -> DataFrame:
    """(within, key, cluster, silhouette) of every row with all columns, by Euclidean distance inside the groups of ``within``.

    A lone member gets 0; a group of one cluster gets null. cluster is a whole number. In one dimension sums of distances come of running totals. In
    more, a group's points are dealt into blocks of SILHOUETTE_CELL, each pair of blocks is compared by numpy, and sums of distances
    by cluster are added up: the comparisons go with the square of a group, rows moved with its square over a block's size. With an ``error`` (of up to 1)
    cells of points stand for their members where that changes no silhouette by more: then the comparisons grow far slower than the square.
    """
    names = [f"w{i}" for i in range(len(within))]
    points, placed = _placed(df, key, columns, F.col(cluster).cast("long"), within)
    found = _scores(_distance_sums(placed, columns, error), placed.groupBy("g", "c").agg(F.count(F.lit(1)).alias("n")))
    return points.join(found, "r").select(*[F.col(n).alias(w) for w, n in zip(within, names)], F.col("key").alias(key), F.col("c").cast("int").alias(cluster), "silhouette")


def _placed(df: DataFrame, key: str, columns: Sequence[str], cluster: Column, within: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(points with within as w0, w1, ..., key, c, x and a number r; the same as r, g, size, c, x, g being the group's number)."""
    names = [f"w{i}" for i in range(len(within))]
    named = df.select(*[F.col(w).alias(n) for w, n in zip(within, names)], F.col(key).alias("key"), cluster.alias("c"), F.array(*[F.col(x).cast("double") for x in columns]).alias("x"))
    # the checkpoint fixes rows and their order, so each reading numbers them alike
    points = checkpointed(named.where(F.col("c").isNotNull() & F.forall("x", lambda v: v.isNotNull()))).withColumn("r", F.monotonically_increasing_id())
    groups = checkpointed(points.groupBy(*names).agg(F.count(F.lit(1)).alias("size"))).withColumn("g", F.monotonically_increasing_id())
    on = F.lit(True)
    for n in names:
        on = on & points[n].eqNullSafe(groups[n])
    return points, points.join(groups, on).select("r", "g", "size", "c", "x")


def _distance_sums(placed: DataFrame, columns: Sequence[str], error: float | None) -> DataFrame:
    """(r, g, c, c2, total) of placed points."""
    if len(columns) == 1:
        return _line_sums(placed, placed.select("c").distinct())
    # sums within a share e are means within e, and (b - a) / max(a, b) within 2 e / (1 - e)
    return _block_sums(placed, len(columns)) if error is None else distance_sums(placed, len(columns), error / (2 + error))


def _scores(sums: DataFrame, sizes: DataFrame) -> DataFrame:
    """(r, silhouette) from the sums of distances (r, g, c, c2, total) and the clusters' sizes (g, c, n)."""
    means = sums.join(sizes.withColumnRenamed("c", "c2"), ["g", "c2"]).withColumn("m", F.try_divide("total", F.when(F.col("c") == F.col("c2"), F.col("n") - 1).otherwise(F.col("n"))))
    own, other = F.max(F.when((F.col("c") == F.col("c2")) & (F.col("n") > 1), F.col("m"))).alias("a"), F.min(F.when(F.col("c") != F.col("c2"), F.col("m"))).alias("b")
    s = F.when(F.col("b").isNull(), None).when(F.col("a").isNull(), num(0)).otherwise(F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), num(0)))
    return means.groupBy("r").agg(own, other).select("r", s.alias("silhouette"))


def _line_sums(placed: DataFrame, sizes: DataFrame) -> DataFrame:
    """(r, g, c, c2, total): sums of distances to each cluster of the group, of points on a line: sum |x - y| from the points below x and their sum."""
    at = checkpointed(placed.select("r", "g", "c", F.col("x")[0].alias("v")))
    names = [r[0] for r in sizes.select("c").distinct().orderBy("c").collect()]  # a model's clusters: a handful
    per = at.groupBy("g", "v").agg(*[F.count_if(F.col("c") == c).alias(f"n{i}") for i, c in enumerate(names)])
    per = per.withColumns({f"s{i}": F.col(f"n{i}") * F.col("v") for i in range(len(names))})
    values = [f"{a}{i}" for i in range(len(names)) for a in "ns"]
    all_ = per.groupBy("g").agg(*[F.sum(v).alias(f"{v}__all") for v in values])
    run = totals_below(per, ["g"], "v", values).join(all_, "g")
    total = lambda i: F.col("v") * F.col(f"n{i}__below") - F.col(f"s{i}__below") + (F.col(f"s{i}__all") - F.col(f"s{i}__below") - F.col(f"s{i}")) - F.col("v") * (F.col(f"n{i}__all") - F.col(f"n{i}__below") - F.col(f"n{i}"))
    each = F.array(*[F.struct(F.lit(c).cast("long").alias("c2"), total(i).alias("total")) for i, c in enumerate(names)])
    return at.join(run.select("g", "v", each.alias("each")), ["g", "v"]).select("r", "g", "c", F.explode("each").alias("e")).select("r", "g", "c", "e.*")


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances of two small tables of points, dimension by dimension in place."""
    out = np.subtract.outer(a[:, 0], b[:, 0])
    out *= out
    for k in range(1, a.shape[1]):
        more = np.subtract.outer(a[:, k], b[:, k])
        more *= more
        out += more
    return np.sqrt(out, out=out)


def _pair_sums(a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, rows: int = 256, columns: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """(sums of distances of a's points by b's clusters, of b's by a's); of_a and of_b hold a 1 at each point's cluster. Each distance is taken once, in tiles that a core's cache holds."""
    to_b, to_a = np.zeros((len(a), of_b.shape[1])), np.zeros((len(b), of_a.shape[1]))
    for s in range(0, len(a), rows):
        for t in range(0, len(b), columns):
            d = _distances(a[s : s + rows], b[t : t + columns])
            to_b[s : s + rows] += d @ of_b[t : t + columns]
            to_a[t : t + columns] += d.T @ of_a[s : s + rows]
    return to_b, to_a


def _block_sums(placed: DataFrame, dimensions: int) -> DataFrame:
    """(r, g, c, c2, total): sums of distances to each cluster of the group, by pairs of blocks, on as many tasks as there are pairs of blocks for."""
    block_rows = F.when(F.col("size") > SILHOUETTE_CELL * MANY_BLOCKS, F.lit(4 * SILHOUETTE_CELL)).otherwise(F.lit(SILHOUETTE_CELL))
    blocks = F.ceil(F.col("size") / block_rows).cast("int")
    block = F.pmod(F.xxhash64("r"), blocks).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(F.least(o, block).alias("i"), F.greatest(o, block).alias("j")))
    axis = [f"x{k}" for k in range(dimensions)]
    # by its bytes, on which Spark would go, a small table's square is one task's
    most = placed.groupBy("g").agg(F.max(blocks.cast("double") * (blocks + 1) / F.lit(2.0)).alias("n")).agg(F.sum("n")).first()[0] or 1.0
    tasks = int(min(most, 12 * placed.sparkSession.sparkContext.defaultParallelism))
    dealt = placed.select("r", "g", "c", *[F.col("x")[k].alias(x) for k, x in enumerate(axis)], block.alias("block"), F.explode(pairs).alias("pair")).select("g", "pair.i", "pair.j", "block", "r", "c", *axis)

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        x, r, c = part[axis].to_numpy(float), part["r"].to_numpy(), part["c"].to_numpy()
        first = part["block"].to_numpy() == part["i"].iloc[0]
        names, member = np.unique(c, return_inverse=True)
        one_hot = np.eye(len(names))[member]
        if part["i"].iloc[0] == part["j"].iloc[0]:
            sides = [(first, _pair_sums(x, x, one_hot[:, :0], one_hot)[0])]
        else:
            sides = list(zip((first, ~first), _pair_sums(x[first], x[~first], one_hot[first], one_hot[~first])))
        out = [pd.DataFrame({"r": np.repeat(r[mine], len(names)), "c": np.repeat(c[mine], len(names)), "c2": np.tile(names, int(mine.sum())), "total": total.ravel()}) for mine, total in sides]
        return pd.concat(out).assign(g=part["g"].iloc[0])[["r", "g", "c", "c2", "total"]]

    found = dealt.repartition(tasks, "g", "i", "j").groupBy("g", "i", "j").applyInPandas(compare, "r long, g long, c long, c2 long, total double")
    return found.groupBy("r", "g", "c", "c2").agg(F.sum("total").alias("total"))


def mean_silhouette(df: DataFrame, key: str, columns: Sequence[str], cluster: str, error: float | None = None) -> float | None:
    """The mean silhouette; null with one cluster."""
    return silhouette(df, key, columns, cluster, error=error).agg(F.avg("silhouette")).first()[0]


def mean_silhouettes(df: DataFrame, key: str, columns: Sequence[str], clusters: Sequence[str], error: float | None = None) -> list[float | None]:
    """The mean silhouette of each of several cluster columns of the same rows, whose clusters are below 1000: distances are summed once, by all columns' clusters together."""
    together = sum((F.col(c).cast("long") * F.lit(1000**i) for i, c in enumerate(clusters[1:], 1)), F.col(clusters[0]).cast("long"))
    _, placed = _placed(df, key, columns, together)
    sums = checkpointed(_distance_sums(placed, columns, error))
    out = []
    for i in range(len(clusters)):
        own = lambda c, i=i: F.pmod(F.floor(F.col(c) / F.lit(1000**i)), F.lit(1000)).cast("long").alias(c)
        each = sums.groupBy("r", "g", own("c"), own("c2")).agg(F.sum("total").alias("total"))
        sizes = placed.groupBy("g", own("c")).agg(F.count(F.lit(1)).alias("n"))
        out.append(_scores(each, sizes).agg(F.avg("silhouette")).first()[0])
    return out


def label_map(centers: Sequence[Sequence[float]], schema: str = "likely") -> dict[int, str]:
    """Names of clusters of (slope, level) centres by their cover score."""
    order = sorted(range(len(centers)), key=lambda i: centers[i][0] + 0.8 * centers[i][1])
    names = LABELS[schema].get(len(centers), tuple(f"Cluster{r}" for r in range(len(centers))))
    return {i: names[r] for r, i in enumerate(order)}


def age_labels(centers: Sequence[float]) -> dict[int, str]:
    """Names of one-dimensional clusters by their centres."""
    order = sorted(range(len(centers)), key=lambda i: centers[i])
    names = AGE_LABELS.get(len(centers), tuple(f"CMI_{r}" for r in range(len(centers))))
    return {i: names[r] for r, i in enumerate(order)}


def labelled(df: DataFrame, labels: dict[int, str], cluster: str = "cluster", out: str = "label") -> DataFrame:
    name = F.lit(None).cast("string")
    for i, text in labels.items():
        name = F.when(F.col(cluster) == i, text).otherwise(name)
    return df.withColumn(out, name)


def softness(df: DataFrame, soft: str = "best_soft") -> DataFrame:
    """Fill best_soft: held to 0..1 with the median for gaps; without such a column from silhouette, else from the cover score's place between its 5th and 95th percentile."""
    if soft in df.columns:
        if df.where(F.col(soft).isNull()).isEmpty():
            return df.withColumn(soft, S.clip01(F.col(soft)))
        middle = F.broadcast(exact_quantiles(df.select(S.clip01(F.col(soft)).alias("s")), [], ["s"], [0.5]))
        return df.crossJoin(middle).withColumn(soft, F.coalesce(S.clip01(F.col(soft)), F.col("s__q")[0])).drop("s__q")
    if "silhouette" in df.columns:
        return df.withColumn(soft, (F.col("silhouette") + num(1)) / num(2))
    score = df.withColumn("s__", S.cover_score(F.col("z_slope_Intensity"), F.col("z_level_Intensity_t5")))
    ends = F.broadcast(exact_quantiles(score.select("s__"), [], ["s__"], [0.05, 0.95]).withColumnRenamed("s____q", "q__"))
    place = F.when(F.col("q__")[1] - F.col("q__")[0] > 1e-9, S.clip01((F.col("s__") - F.col("q__")[0]) / (F.col("q__")[1] - F.col("q__")[0])))
    return score.crossJoin(ends).withColumn(soft, F.coalesce(place, num(0))).drop("s__", "q__")
