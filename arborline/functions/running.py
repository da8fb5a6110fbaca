"""Running totals of groups of any size, by a distributed prefix scan."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from arborline.checkpoints import checkpointed

#: Rows of a range at most, about; and how few a task may get so that all cores work.
RANGE_ROWS, LEAST_ROWS = 500_000, 5_000


def same_keys(a: DataFrame, b: DataFrame, pairs: dict[str, str]) -> Column:
    """Columns of a equal to columns of b, nulls to nulls."""
    on: Column = F.lit(True)
    for x, y in pairs.items():
        on = on & a[x].eqNullSafe(b[y])
    return on


def totals_below(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """Add ``<value>__below``: the total of a numeric column over the rows of the same keys that come before in ``order``; a null counts as 0.

    Rows are dealt into ranges of (keys, order), whose number follows the rows; each range is one sorted partition. A range's first group may have begun in ranges before:
    of those groups the totals so far, one row a range at most, are broadcast. Then each range is run through once, in place, from there on. So neither a large
    group nor many small ones gather in a task; rows that tie in order come one after another in any, but fixed, order.
    """
    df = checkpointed(df)
    n = df.count()
    parts = max(-(-n // RANGE_ROWS), min(df.sparkSession.sparkContext.defaultParallelism, -(-n // LEAST_ROWS)), 1)
    by = [*[F.col(k) for k in keys], F.col(order)]
    # the checkpoint fixes which rows a range holds, and their order
    ranged = checkpointed(df.repartitionByRange(parts, *by).sortWithinPartitions(*by)).withColumn("range__", F.spark_partition_id())
    kinds = {v: LongType() if df.schema[v].dataType.typeName() in ("byte", "short", "integer", "long") else DoubleType() for v in values}
    sums = ranged.groupBy("range__", *keys).agg(*[F.coalesce(F.sum(F.col(v).cast(kinds[v])), F.lit(0).cast(kinds[v])).alias(v) for v in values])
    before = Window.partitionBy(*keys).orderBy("range__").rowsBetween(Window.unboundedPreceding, -1)
    begun = sums.select(F.col("range__").alias("range__k"), *[F.col(k).alias(f"{k}__k") for k in keys], *[F.sum(v).over(before).alias(f"{v}__from") for v in values], F.count(F.lit(1)).over(before).alias("n__")).where("n__ > 0").drop("n__")
    placed = ranged.join(F.broadcast(begun), same_keys(ranged, begun, {"range__": "range__k"} | {k: f"{k}__k" for k in keys}), "left")
    zero = {v: F.lit(0).cast(kinds[v]) for v in values}
    group = F.xxhash64(*[F.col(k) for k in keys]) if keys else F.lit(0).cast("long")
    fed = placed.select(*df.columns, group.alias("group__"), *[F.coalesce(F.col(v).cast(kinds[v]), zero[v]).alias(f"{v}__own") for v in values], *[F.coalesce(f"{v}__from", zero[v]).alias(f"{v}__from") for v in values])
    width, wanted, names = len(df.columns), len(values), [*df.columns, *(f"{v}__below" for v in values)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, [0] * wanted
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(width).to_numpy()
            begins = np.concatenate([[last is None or own[0] != last], own[1:] != own[:-1]])
            at = np.maximum.accumulate(np.where(begins, np.arange(len(own)), 0))
            out = []
            for i in range(wanted):
                x, start = batch.column(width + 1 + i).to_numpy(), batch.column(width + 1 + wanted + i).to_numpy()
                upto = np.cumsum(x)
                below = upto - x
                base = np.where(begins[at], start[at] - below[at], carried[i])
                out.append(below + base)
                carried[i] = upto[-1] + base[-1]
            last = own[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *map(pa.array, out)], names=names)

    return fed.mapInArrow(run, StructType([*df.schema.fields, *(StructField(f"{v}__below", kinds[v]) for v in values)]))
