"""Features of GeoJSON collections of any size, read in byte ranges by several tasks.

Where a range begins, it can't be seen from its bytes whether that is inside a string, or how deep in the text. So a first pass says of every range what it does to each state in
which it may begin (outside strings, inside one, inside one after a backslash): the state at its end and by how much the depth changes. From range to range that gives
the true states. The few ranges that come back to the top of the text are searched for where the member ``features`` begins and ends; then each range yields the features that begin
in it, and reads on to the end of its last one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborline.sources.documents import opened

SPLIT_BYTES = 64 << 20
#: What is read at a time beyond a range, and before it.
STEP = 1 << 20
OUTSIDE, INSIDE, ESCAPED = 0, 1, 2
_QUOTE, _BACKSLASH = 34, 92
_KEY = re.compile(rb'"features"\s*:\s*\Z')


def structure(data: bytes, state: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(places of brackets outside strings, depth after each from 0 on, state at the end) of a piece of JSON text that begins in a state."""
    if state == ESCAPED:  # the backslash before the piece is put back
        at, depth, end = structure(b"\\" + data, INSIDE)
        return at - 1, depth, end
    b = np.frombuffer(data, np.uint8)
    place = np.arange(len(b))
    back = b == _BACKSLASH
    run = place - np.maximum.accumulate(np.where(back, -1, place)) if len(b) else place
    odd = back & (run % 2 == 1)
    quote = b == _QUOTE
    quote[1:] &= ~odd[:-1]
    upto = np.cumsum(quote) + (state == INSIDE)
    free = (upto - quote) % 2 == 0
    opens, closes = free & ((b == 123) | (b == 91)), free & ((b == 125) | (b == 93))
    at = np.flatnonzero(opens | closes)
    depth = np.cumsum(np.where(opens[at], 1, -1))
    end = state if not len(b) else OUTSIDE if upto[-1] % 2 == 0 else ESCAPED if odd[-1] else INSIDE
    return at, depth, end


def _read(path: str, start: int, n: int) -> bytes:
    fs, inside = opened(path)
    with fs.open_input_file(inside) as f:
        return f.read_at(n, start)


def _over(ranges: DataFrame, work, schema: str, names: list[str]) -> DataFrame:
    """work(row of ranges) -> rows, a range at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for out in work(**row):
                    yield pa.record_batch([pa.array([v]) if v is not None else pa.nulls(1, pa.int64()) for v in out], names=names)

    return ranges.mapInArrow(run, schema)


def _effects(path: str, start: int, size: int) -> Iterator[tuple]:
    data = _read(path, start, size)
    for state in (OUTSIDE, INSIDE, ESCAPED):
        _, depth, end = structure(data, state)
        yield path, start, state, end, int(depth[-1]) if len(depth) else 0, int(depth.min()) if len(depth) else 0


def _members(path: str, start: int, size: int, state: int, depth: int) -> Iterator[tuple]:
    """(path, place, whether the member features begins there) of arrays that begin or end right below the top."""
    data = _read(path, start, size)
    at, below, _ = structure(data, state)
    after = below + depth
    for i in np.flatnonzero((after == 1) | (after == 2)).tolist():
        byte = data[at[i]]
        if byte == 93 and after[i] == 1:
            yield path, start + int(at[i]), 0
        elif byte == 91 and after[i] == 2:
            place, reach = start + int(at[i]), 256
            while True:  # the key may lie in the range before, and blanks may follow it
                before = _read(path, max(0, place - reach), min(reach, place))
                if before.strip() not in (b"", b":") or reach >= place:
                    break
                reach *= 2
            if _KEY.search(before):
                yield path, place, 1


def _features(path: str, start: int, size: int, state: int, depth: int, first: int, last: int) -> Iterator[tuple]:
    """The texts of the objects that begin in the range right below the array from first to last."""
    data = _read(path, start, size)
    base, begun = start, None
    while data:
        at, below, end = structure(data, state)
        after = below + depth
        for i in np.flatnonzero((after == 2) | (after == 3)).tolist():
            place, byte = base + int(at[i]), data[at[i]]
            if byte == 123 and after[i] == 3 and first < place < last and place < start + size:
                begun, held = place, []
            elif byte == 125 and after[i] == 2 and begun is not None:
                held.append(data[max(0, begun - base) : at[i] + 1])
                yield (b"".join(held).decode("utf-8", "replace"),)
                begun = None
        if begun is None:
            return
        held.append(data[max(0, begun - base) :])
        base, state, depth = base + len(data), end, int(after[-1]) if len(after) else depth
        data = _read(path, base, STEP)


def read_features(spark: SparkSession, path: str, properties: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Features of the GeoJSON collections at path (a file, folder or pattern): geometry as JSON text, and the properties (a schema in text).

    Cases: what is no object in ``features`` is skipped; of several members ``features`` the last counts; a file without one, or empty, gives nothing; properties a
    feature lacks are null; a file that is no JSON gives what of it looks like features. The driver gets some numbers a range.
    """
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("total")).where("total > 0")
    begins = F.explode(F.sequence(F.lit(0).cast("long"), F.col("total") - F.lit(1), F.lit(split_bytes).cast("long")))
    ranges = files.select("path", begins.alias("start"), "total").select("path", "start", F.least(F.lit(split_bytes).cast("long"), F.col("total") - F.col("start")).alias("size"))
    listed = ranges.orderBy("path", "start").collect()
    schema = "path string, start long, size long"
    dealt = lambda rows, more="": spark.createDataFrame(rows, schema + more).repartition(max(1, len(rows)), "path", "start")
    told = {}
    if listed:
        effects = _over(dealt([tuple(r) for r in listed]), _effects, "path string, start long, state long, then long, change long, least long", ["path", "start", "state", "then", "change", "least"])
        told = {(r.path, r.start, r.state): (r.then, r.change, r.least) for r in effects.collect()}
    placed, tops, state, depth, last = [], [], OUTSIDE, 0, None
    for r in listed:
        if r.path != last:
            state, depth, last = OUTSIDE, 0, r.path
        then, change, least = told[r.path, r.start, state]
        placed.append((r.path, r.start, r.size, state, depth))
        if depth + least < 2:
            tops.append(placed[-1])
        state, depth = then, depth + change
    members: dict[str, list[tuple[int, int]]] = {}
    if tops:
        found = _over(dealt(tops, ", state long, depth long"), _members, "path string, place long, begins long", ["path", "place", "begins"])
        for r in found.collect():
            members.setdefault(r.path, []).append((r.place, r.begins))
    wanted = []
    for row in placed:
        events = sorted(members.get(row[0], []))
        first = max((p for p, b in events if b), default=None)
        if first is not None:
            end = min((p for p, b in events if not b and p > first), default=1 << 62)
            if row[1] + row[2] > first and row[1] < end:
                wanted.append((*row, first, end))
    kind = f"struct<geometry:string,properties:struct<{properties}>>"
    if wanted:
        texts = _over(dealt(wanted, ", state long, depth long, first long, last long"), _features, "value string", ["value"])
    else:
        texts = spark.createDataFrame([], "value string")
    return texts.select(F.from_json("value", kind).alias("f")).select(F.col("f.geometry").alias("geometry"), "f.properties.*")
