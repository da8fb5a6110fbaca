"""Operator 5: exact top-k inner-product search by distributed histogram selection.

Queries are dealt into blocks of bounded size, and each block is broadcast to the candidates, which stay where they are: vectors are never
shuffled. Every task scores all its candidates against the block by matrix products and counts the scores of each query in bins. The tasks' histograms are added
up, the bin that holds the query's k-th best score of all is found, and the next sweep splits that bin only, until a bin is one score wide: that is
the k-th score. A last sweep hands on the scores from there up, which are ranked. Of its histogram a task hands on what lies at or above its own k-th best, as the k-th best
of all can't lie lower; of ties at the k-th score each task hands on those of smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborline.llm.common import checkpointed, tidy

#: A block's queries, and the bytes of their vectors, at most; how many blocks one job reads the candidates for.
BLOCK_QUERIES, BLOCK_BYTES, JOB_BLOCKS = 4096, 1 << 24, 16
CHUNK = 1024
#: A sweep splits a range into 2^BIN_BITS bins at most, and as many as COUNTERS counters a task allow.
BIN_BITS, COUNTERS = 12, 1 << 21
SALTS = 16


def quantised(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, v): components floor(scale * x), of rows with a key and whole finite vectors."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    rows = df.where(F.col(key).isNotNull() & F.coalesce(finite, F.lit(False)))
    return rows.select(F.col(key).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))).alias("v"))


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products of two blocks of rows."""
    if not q.shape[1]:
        return np.zeros((len(q), len(c)), np.int64)
    bound = int(np.abs(q).max()) * int(np.abs(c).max()) * q.shape[1]
    if bound < 1 << 53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 63:
        return q @ c.T
    raise OverflowError("an inner product may not fit in 64 bits")


@dataclass(frozen=True)
class Block:
    """Queries of one dimension, in order of id: their numbers, ids and vectors."""

    number: np.ndarray
    id: np.ndarray
    v: np.ndarray


def _blocks(rows: pa.Table) -> dict[int, Block]:
    """The queries (q, id, v) by dimension."""
    v = rows.column("v").combine_chunks()
    flat, at = v.values.to_numpy(), v.offsets.to_numpy()
    q, ids, size = rows.column("q").to_numpy(), rows.column("id").to_numpy(), np.diff(at)
    out = {}
    for d in np.unique(size):
        pick = np.flatnonzero(size == d)
        pick = pick[np.argsort(ids[pick], kind="stable")]
        out[int(d)] = Block(q[pick], ids[pick], np.stack([flat[at[i] : at[i] + d] for i in pick]))
    return out


Chunks = Iterator[tuple[Block, np.ndarray, np.ndarray, np.ndarray]]


def _chunks(batches: Iterator[pa.RecordBatch], blocks: dict[int, Block]) -> Chunks:
    """(block, ids, vectors, scores: query x candidate) of all candidates (id, v), piece by piece; only vectors of one length meet."""
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            part = batch.slice(at, CHUNK)
            ids, v = part.column(0).to_numpy(), part.column(1)
            flat, start = v.values.to_numpy(), v.offsets.to_numpy()
            size = np.diff(start)
            for d in np.unique(size):
                if block := blocks.get(int(d)):
                    pick = np.flatnonzero(size == d)
                    vectors = flat[start[pick][:, None] + np.arange(d)]
                    yield block, ids[pick], vectors, _products(block.v, vectors)


@dataclass
class Search:
    """A block of queries (table: q, id, v), by q: the low end of the range that holds the k-th best score, and the how manieth from the top of that range it is."""

    queries: pa.Table
    low: dict[int, int]
    need: dict[int, int]


def _bins(rows: DataFrame, search: Search, k: int, width: int, shift: int) -> DataFrame:
    """(q, bin, n): each task's counts of scores in bins of 2^shift from the low end on, at and above the bin of its own k-th best."""
    shared = rows.sparkSession.sparkContext.broadcast((_blocks(search.queries), search.low))
    bins = -(-width >> shift)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, low = shared.value
        lows = {d: np.array([low[q] for q in b.number.tolist()]) for d, b in blocks.items()}
        counts = {d: np.zeros(len(b.id) * bins, np.int64) for d, b in blocks.items()}
        for block, _, vectors, scores in _chunks(batches, blocks):
            d = vectors.shape[1]
            above = scores - lows[d][:, None]
            row, column = np.nonzero((above >= 0) & (above < width))
            np.add(counts[d], np.bincount(row * bins + (above[row, column] >> shift), minlength=len(counts[d])), out=counts[d])
        for d, block in blocks.items():
            table = counts[d].reshape(-1, bins)
            higher = table[:, ::-1].cumsum(axis=1)[:, ::-1] - table
            # the query's own row may be among the counted, so one more than k
            row, at = np.nonzero((table > 0) & (higher <= k))
            yield pa.record_batch([pa.array(block.number[row]), pa.array(at), pa.array(table[row, at])], names=["q", "bin", "n"])

    return rows.select("id", "v").mapInArrow(tidy(run), "q long, bin long, n long")


def _narrowed(counts: DataFrame, searches: list[Search], own: DataFrame, width: int, shift: int) -> None:
    """Move each search to the bin that holds its k-th best. own: (q, score) of the queries' own rows, which are counted but are no candidates."""
    low = {q: v for s in searches for q, v in s.low.items()}
    state = own.sparkSession.createDataFrame(list(low.items()), "q long, low long")
    step = F.lit(1 << shift).cast("long")
    mine = own.join(F.broadcast(state), "q").where((F.col("score") >= F.col("low")) & (F.col("score") - F.col("low") < F.lit(width)))
    mine = mine.select("q", F.floor((F.col("score") - F.col("low")) / step).cast("long").alias("bin"), F.lit(-1).cast("long").alias("n"))
    need = own.sparkSession.createDataFrame([(q, n) for s in searches for q, n in s.need.items()], "q long, need long")
    added = counts.union(mine).groupBy("q", "bin").agg(F.sum("n").alias("n"))
    down = Window.partitionBy("q").orderBy(F.desc("bin"))
    found = added.withColumn("upto", F.sum("n").over(down)).join(F.broadcast(need), "q").where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
    at = {r.q: (r.bin, r.above) for r in found.select("q", "bin", (F.col("upto") - F.col("n")).alias("above")).collect()}
    for s in searches:
        for q in s.low:
            where, above = at.get(q, (0, 0))  # fewer candidates than are wanted: all are
            s.low[q] += where << shift
            s.need[q] -= above


def _from(rows: DataFrame, search: Search, k: int) -> DataFrame:
    """(q, id, score) of candidates from the k-th score up; of a task's ties at that score the k of smallest id. A query's own row, the one with its id and vector, is none."""
    shared = rows.sparkSession.sparkContext.broadcast((_blocks(search.queries), search.low))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, low = shared.value
        lows = {d: np.array([low[q] for q in b.number.tolist()]) for d, b in blocks.items()}
        ties: dict[int, tuple[np.ndarray, np.ndarray]] = {d: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for d in blocks}
        for block, ids, vectors, scores in _chunks(batches, blocks):
            d, least = vectors.shape[1], lows[vectors.shape[1]][:, None]
            first, last = np.searchsorted(block.id, ids), np.searchsorted(block.id, ids, "right")
            taken = scores >= least
            for c in np.flatnonzero(first < last):
                taken[first[c] + np.flatnonzero((block.v[first[c] : last[c]] == vectors[c]).all(axis=1)), c] = False
            row, column = np.nonzero(taken & (scores > least))
            yield pa.record_batch([pa.array(block.number[row]), pa.array(ids[column]), pa.array(scores[row, column])], names=["q", "id", "score"])
            row, column = np.nonzero(taken & (scores == least))
            row, found = np.concatenate([ties[d][0], row]), np.concatenate([ties[d][1], ids[column]])
            order = np.lexsort((found, row))
            row, found = row[order], found[order]
            keep = np.arange(len(row)) - np.searchsorted(row, row) < k
            ties[d] = row[keep], found[keep]
        for d, (row, found) in ties.items():
            yield pa.record_batch([pa.array(blocks[d].number[row]), pa.array(found), pa.array(lows[d][row])], names=["q", "id", "score"])

    return rows.select("id", "v").mapInArrow(tidy(run), "q long, id long, score long")


def _together(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def select(rows: DataFrame, searches: list[Search], own: DataFrame, k: int, reach: int) -> DataFrame:
    """(q, id, score) of the searches' best candidates, k or more of each where there are so many; no score is above ``reach`` or below -reach."""
    most = max((len(s.low) for s in searches), default=1)
    bits = max(1, min(BIN_BITS, (COUNTERS // max(1, most)).bit_length() - 1))
    width = 2 * reach + 1
    for s in searches:
        s.low, s.need = dict.fromkeys(s.low, -reach), dict.fromkeys(s.need, k)
    shift = max(0, width.bit_length() - bits)
    while True:
        _narrowed(_together([_bins(rows, s, k, width, shift) for s in searches]), searches, own, width, shift)
        if not shift:
            return checkpointed(_together([_from(rows, s, k) for s in searches]))
        width, shift = 1 << shift, max(0, shift - bits)


def top_k(df: DataFrame, key: str, vector: str, is_query: Column, k: int = 10, scale: int = 1024) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): each query row's k best other rows by integer inner product.

    Cases: rows with a null key, a null vector or a null or non-finite component take no part; only vectors of one length are
    compared, and empty ones score 0; a query with fewer than k candidates gets them all; ties go to the smaller key; rows that repeat a key all
    count, as candidates and as queries, and of rows equal in key and vector each is the others' candidate; an empty table gives no
    row; a component or score beyond 64 bits raises; other columns don't matter.
    """
    rows = quantised(df, key, vector, scale)
    asked = quantised(df.where(is_query), key, vector, scale).groupBy("id", "v").agg(F.count(F.lit(1)).alias("m"))
    # the checkpoint fixes rows and their order, so each reading numbers them alike
    queries = checkpointed(asked).withColumn("q", F.monotonically_increasing_id())
    n, longest = queries.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    each = max(1, min(BLOCK_QUERIES, BLOCK_BYTES // (8 * max(1, longest or 1))))
    blocks = -(-n // each)
    dealt = queries.withColumn("block", F.pmod(F.xxhash64("q"), F.lit(max(1, blocks))))
    square = F.aggregate(F.transform("v", lambda x: x * x), F.lit(0).cast("long"), lambda a, x: a + x)
    own = queries.select("q", "id", "m", square.alias("score"))
    copies = F.explode(F.sequence(F.lit(1), F.least(F.col("m") - 1, F.lit(k))))
    scores = own.where("m > 1").select("q", "id", "score", copies).select("q", "id", "score")
    reach = (rows.agg(F.max(square)).first()[0] or 0) if blocks else 0  # by Cauchy and Schwarz
    if reach >= 1 << 62:
        raise OverflowError("an inner product may not fit in 64 bits")
    for first in range(0, blocks, JOB_BLOCKS):
        searches = []
        for b in range(first, min(blocks, first + JOB_BLOCKS)):
            asked = dealt.where(F.col("block") == b).select("q", "id", "v").toArrow()
            numbers = asked.column("q").to_pylist()
            searches.append(Search(asked, dict.fromkeys(numbers, 0), dict.fromkeys(numbers, k)))
        mine = own.select("q", "score").where(F.pmod(F.xxhash64("q"), F.lit(blocks)).between(first, first + len(searches) - 1))
        searches = [s for s in searches if s.low]
        if searches:
            scores = scores.union(select(rows, searches, mine, k, reach))
    best = Window.orderBy(F.desc("score"), "id")
    found = scores.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    found = found.withColumn("r", F.row_number().over(best.partitionBy("q", "salt"))).where(F.col("r") <= k)
    found = found.withColumn("rank", F.row_number().over(best.partitionBy("q"))).where(F.col("rank") <= k)
    named = found.select("q", "rank", F.col("id").alias("vec_id"), "score").join(queries.select("q", F.col("id").alias("query_id"), "m"), "q")
    return named.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("m").cast("int")))).select("query_id", "rank", "vec_id", "score")
