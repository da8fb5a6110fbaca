"""Whole groups of sorted rows, streamed through Arrow batches without one call of Spark for each group."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from arborline.llm.common import tidy


def _group_starts(batch: pa.Table, keys: int) -> np.ndarray:
    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for k in range(keys):
        values = batch.column(k).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def map_groups(df: DataFrame, keys: list[str], work: Callable[[pa.Table, np.ndarray], pa.Table], schema: str, columns: list[str], parts: int | None = None) -> DataFrame:
    """Call work(rows, starts) on runs of whole groups of ``keys`` (non-null numbers); starts has an end mark.

    Every group must be small enough for one task's memory: callers bound its size. Rows come hashed by the keys and
    sorted; a run is what one Arrow batch completes. parts: into how many partitions, however small, for groups that are dear to work on.
    """
    names = [*keys, *columns]
    width = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([kept, rows]) if kept is not None else rows
            if not rows.num_rows:
                continue
            starts = _group_starts(rows, width)
            if len(starts) > 1:
                whole = rows.slice(0, int(starts[-1])).combine_chunks()
                yield from work(whole, starts).to_batches()
            kept = rows.slice(int(starts[-1]))
        if kept is not None and kept.num_rows:
            yield from work(kept.combine_chunks(), np.array([0, kept.num_rows])).to_batches()

    by = keys if parts is None else [parts, *keys]
    return df.select(*names).repartition(*by).sortWithinPartitions(*keys).mapInArrow(tidy(run), schema)
