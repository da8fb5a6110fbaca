"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arborline.checkpoints import checkpointed, ensure_checkpoint_dir

__all__ = ["checkpointed", "ensure_checkpoint_dir", "fresh", "gapless_rank", "table", "tidy"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the supplied Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


Batches = Iterator[pa.RecordBatch]


def tidy(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """run, giving what it freed back to the system at its task's end: workers are reused, and an executor's limit counts what they hold."""

    def bounded(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return bounded


def fresh(df: DataFrame, base: str) -> str:
    """A column name like base that df does not have, whatever its letter case."""
    taken = {c.lower() for c in df.columns}
    name = f"__{base}"
    while name.lower() in taken:
        name += "_"
    return name


def gapless_rank(df: DataFrame, groups: Sequence[str], bucket: Column, order: Sequence[Column], out: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps and without gathering a group in one task.

    ``bucket`` (a small int from 0) splits every group; rows are ranked inside (group, bucket) and
    moved up by the number of rows in the group's earlier buckets. df is read twice, so it should be a table or
    checkpointed. The offsets, one row a group and bucket, are broadcast: callers
    bound their number. Rows that tie in ``order`` get distinct numbers in any order.
    """
    b, off, n = fresh(df, "bucket"), fresh(df, "off"), fresh(df, "n")
    df = df.withColumn(b, bucket)
    before = Window.partitionBy(*groups).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = df.groupBy(*groups, b).agg(F.count(F.lit(1)).alias(n)).select(*groups, b, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(off))
    inside = Window.partitionBy(*groups, b).orderBy(*order)
    ranked = df.withColumn(out, F.row_number().over(inside).cast("long") - 1)
    return ranked.join(F.broadcast(offsets), [*groups, b]).withColumn(out, F.col(out) + F.col(off)).drop(b, off)
