"""Exact interpolated quantiles by group, of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborline.checkpoints import checkpointed

_ACCURACY = 10_000
#: Groups of up to so many rows are ranked in one task each, by Spark's percentile; if any is larger, brackets are used.
SMALL_GROUP = 200_000
#: Brackets (a group's of a column) up to which they are broadcast; more are joined, and groups dealt into so many parts.
MOST_BRACKETS, GROUP_PARTS = 10_000, 16


def group_quantiles(df: DataFrame, keys: Sequence[str], columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """One row a group: the keys and, for each column, ``<column>__q``, an array of its quantiles at probs.

    Spark's percentile holds a group's distinct values in one task; fit for groups of up to some million rows.
    """
    want = F.array(*[F.lit(float(p)) for p in probs])
    return df.groupBy(*keys).agg(*[F.percentile(c, want).alias(f"{c}__q") for c in columns])


def _ranked(df: DataFrame, keys: Sequence[str], columns: Sequence[str], probs: Sequence[float], side: float) -> DataFrame:
    """(keys, <column>__q, held__): quantiles by brackets that reach ``side`` ranks to each side; held__ says whether every bracket held its rank."""
    at = [f(p) for p in probs for f in (lambda p: max(0.0, p - side), lambda p: min(1.0, p + side))]
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in columns])
    long = df.select(*keys, F.explode(pairs).alias("cv")).select(*keys, "cv.c", "cv.v").where("v is not null")
    brackets = long.groupBy(*keys, "c").agg(F.percentile_approx("v", at, _ACCURACY).alias("b"), F.count("v").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
    small = F.col("n") <= _ACCURACY  # the bracket has to span a rank on both sides at least; a small group is ranked whole
    ranges = F.array(*[
        F.struct(F.lit(i).alias("i"), F.when(small | F.lit(at[2 * i] <= 0), F.col("least")).otherwise(F.col("b")[2 * i]).alias("lo"), F.when(small | F.lit(at[2 * i + 1] >= 1), F.col("most")).otherwise(F.col("b")[2 * i + 1]).alias("hi"), (F.lit(p) * (F.col("n") - 1)).alias("rank"))
        for i, p in enumerate(probs)
    ])
    on = F.col("l.c") == F.col("r.c")
    for k in keys:
        on = on & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    # a join by the groups' keys alone would bring whole groups to single tasks
    ranged = checkpointed(brackets.withColumn("ranges", ranges))
    if ranged.limit(MOST_BRACKETS + 1).count() <= MOST_BRACKETS:
        left, right = long, F.broadcast(ranged.alias("r"))
    else:
        left = long.withColumn("part", F.pmod(F.xxhash64("v", F.monotonically_increasing_id()), F.lit(GROUP_PARTS)))
        right, on = ranged.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(GROUP_PARTS - 1)))).alias("r"), on & (F.col("l.part") == F.col("r.part"))
    marked = left.alias("l").join(right, on).select("l.*", F.explode("r.ranges").alias("q"))
    value = F.when(F.col("v") >= F.col("q.lo"), F.col("v"))  # null: below the bracket, counted only
    counted = marked.where(F.col("v") <= F.col("q.hi")).groupBy(*keys, "c", F.col("q.i").alias("i"), F.col("q.rank").alias("rank"), value.alias("v")).agg(F.count(F.lit(1)).alias("m"))
    ordered = Window.partitionBy(*keys, "c", "i").orderBy(F.col("v").asc_nulls_first())
    ranked = counted.withColumn("upto", F.sum("m").over(ordered))
    first = lambda rank: F.min(F.when((F.col("upto") > rank) & F.col("v").isNotNull(), F.col("v")))
    below = F.coalesce(F.max(F.when(F.col("v").isNull(), F.col("upto"))), F.lit(0))
    ends = ranked.groupBy(*keys, "c", "i", "rank").agg(first(F.floor("rank")).alias("x"), first(F.ceil("rank")).alias("y"), (below <= F.floor("rank")).alias("low"))
    exact = ends.withColumns({"q": F.col("x") + (F.col("y") - F.col("x")) * (F.col("rank") - F.floor("rank")), "held": F.col("low") & F.col("y").isNotNull()})
    wide = [F.array(*[F.max(F.when((F.col("c") == c) & (F.col("i") == i), F.col("q"))) for i in range(len(probs))]).alias(f"{c}__q") for c in columns]
    return exact.groupBy(*keys).agg(*wide, F.min("held").alias("held__"))


def bracketed_quantiles(df: DataFrame, keys: Sequence[str], columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """What group_quantiles gives, for groups that no task can hold; a group without any value has no row.

    A quantile sketch brackets each wanted rank, with its error's bound on both sides; values below a bracket are only counted, and
    those inside it are counted by value and ranked: some thousandths of a group. Should a bracket not hold its rank, all are made ten times as
    wide. df is read twice and has to give the same values both times: pass a table, or a checkpointed DataFrame.
    """
    probs = [float(p) for p in probs]
    side = 3.0 / _ACCURACY
    while True:
        found = checkpointed(_ranked(df, keys, columns, probs, side))
        if side >= 1 or found.where("not held__").isEmpty():
            return found.drop("held__")
        side = min(1.0, 10 * side)


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """The rows of the largest group, by one aggregation."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def with_quantiles(df: DataFrame, keys: Sequence[str], columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """df with each row's group's quantile arrays, by percentile or by brackets as the largest group asks."""
    if largest_group(df, keys) <= SMALL_GROUP:
        q = group_quantiles(df, keys, columns, probs)
    else:
        df = checkpointed(df)
        q = bracketed_quantiles(df, keys, columns, probs)
    renamed = q.select(*[F.col(k).alias(f"{k}__k") for k in keys], *[f"{c}__q" for c in columns])
    on: Column = F.lit(True)
    for k in keys:
        on = on & df[k].eqNullSafe(F.col(f"{k}__k"))
    return df.join(renamed, on, "left").drop(*[f"{k}__k" for k in keys])


def exact_quantiles(df: DataFrame, keys: Sequence[str], columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """One row a group, by percentile or by brackets as the largest group asks; null arrays for a group without a value."""
    if largest_group(df, keys) <= SMALL_GROUP:
        return group_quantiles(df, keys, columns, probs)
    df = checkpointed(df)
    found = bracketed_quantiles(df, keys, columns, probs)
    if not keys:
        return found
    whole = df.select(*keys).distinct()
    renamed = found.select(*[F.col(k).alias(f"{k}__k") for k in keys], *[f"{c}__q" for c in columns])
    on: Column = F.lit(True)
    for k in keys:
        on = on & whole[k].eqNullSafe(F.col(f"{k}__k"))
    return whole.join(renamed, on, "left").drop(*[f"{k}__k" for k in keys])
