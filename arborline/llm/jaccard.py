"""Operator 2: n-gram Jaccard self-join by chosen paths (Christiani, Pagh and Sivertsen, 2018).

1. Texts with one shingle set are one class; only classes go on.
2. Chosen paths: a class is a row of min-hash values. Each of several runs splits all classes on sampled coordinates' values; a
   bucket with at most ``bucket_limit`` classes is compared at once, a larger one is split again on other coordinates. Compared are
   min-hash rows, with slack under the threshold; a bucket yields a spanning forest of its candidate links, never all its pairs.
3. Candidate links are joined into clusters, and all pairs of a cluster are compared by their whole shingle sets, in
   blocks of bounded size. Numbers of links are added up inside the tasks.

A pair at the threshold takes part in one run with the probability that ``run_recall`` gives; runs repeat until the target. It is
lower for deeper paths, so classes whose buckets are still too large at ``RECKONED_DEPTH`` go through ``deep_runs`` more.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborline.llm.common import checkpointed, fresh, tidy
from arborline.llm.components import components
from arborline.llm.grouped import map_groups
from arborline.llm.words import in_chunks, mix64, shingle_sets

COORDINATES = 128
#: Depth for which every class's number of runs is reckoned, and to which large buckets are split before blocks take over.
RECKONED_DEPTH, MOST_DEPTH = 4, 12
BLOCK_CLASSES, BLOCK_SHINGLES = 256, 4_000_000
_MULTIPLIERS = mix64(np.arange(COORDINATES, dtype=np.uint64), 11) | np.uint64(1)


def run_recall(threshold: float, depth: int) -> float:
    """How likely a pair at the threshold shares a path of this depth.

    A bucket is split on 1 / threshold coordinates on average: one, and at times one more.
    """
    more = 1 / threshold - 1
    q = 1.0
    for _ in range(depth):
        hit = threshold * q
        q = (1 - more) * hit + more * (1 - (1 - hit) ** 2)
    return q


#: Share of the pairs that may be missed which is kept for paths beyond RECKONED_DEPTH, at least.
DEEP_SHARE = 0.1


def runs_for(threshold: float, recall: float) -> int:
    return math.ceil(math.log((1 - DEEP_SHARE) * (1 - recall)) / math.log(1 - run_recall(threshold, RECKONED_DEPTH)))


def deep_runs(threshold: float, recall: float) -> int:
    """Further runs for the classes of buckets that are too large at RECKONED_DEPTH.

    A pair is missed if it shares no path of that depth in any of the first runs, or if both are such classes and share
    no path of MOST_DEPTH in the first runs and these; together that is at most 1 - recall.
    """
    runs = runs_for(threshold, recall)
    spare = (1 - recall) - (1 - run_recall(threshold, RECKONED_DEPTH)) ** runs
    return max(0, math.ceil(math.log(spare) / math.log(1 - run_recall(threshold, MOST_DEPTH))) - runs)


def min_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """A row of COORDINATES unsigned 32-bit min-hash values for each non-empty set."""
    at = np.cumsum([0, *(len(s) for s in sets[:-1])])
    every = np.concatenate(sets)
    out = np.empty((len(sets), COORDINATES), np.uint32)
    for k, m in enumerate(_MULTIPLIERS):
        out[:, k] = np.minimum.reduceat((every * m) >> np.uint64(32), at)
    return out


def set_keys(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit sums that name a set."""
    at = np.cumsum([0, *(len(s) for s in sets[:-1])])
    every = np.concatenate(sets)
    return tuple(np.add.reduceat(mix64(every, salt), at).view(np.int64) for salt in (21, 22))


def coordinates_of(paths: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The first coordinate on which each path's bucket is split, and a second one or -1."""
    h = mix64(paths, 31)
    first = (h % np.uint64(COORDINATES)).astype(np.int64)
    second = (first + 1 + ((h >> np.uint64(8)) % np.uint64(COORDINATES - 1)).astype(np.int64)) % COORDINATES
    lucky = (mix64(paths, 32) >> np.uint64(11)).astype(np.float64) / float(1 << 53) < 1 / threshold - 1
    return first, np.where(lucky, second, -1)


def children(paths: np.ndarray, rows: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(index of the parent row, child path) for rows of min-hash values, each in its path's bucket."""
    at, out = [], []
    for c in coordinates_of(paths, threshold):
        i = np.flatnonzero(c >= 0)
        value = rows[i, c[i]].astype(np.uint64)
        at.append(i)
        out.append(mix64(paths[i] ^ mix64(value + (c[i].astype(np.uint64) << np.uint64(32)), 33), 34))
    return np.concatenate(at), np.concatenate(out)


def sketch(df: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(key, mark, set_a, set_b, n, sig) of every text; mark names the text; a null text has null mark and set_a."""
    kind = df.select(key).schema[0].dataType.simpleString()
    mark = fresh(df.select(key), "mark")
    names = [key, mark, "set_a", "set_b", "n", "sig"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            there = [i for i, t in enumerate(texts) if t is not None]
            whole = [texts[i] for i in there]
            for a, b in in_chunks(whole):
                sets = shingle_sets(whole[a:b], width)
                set_a, set_b = set_keys(sets)
                sig = [r.tobytes() for r in min_hashes(sets)]
                own = [batch.column(c).take(pa.array(there[a:b])) for c in (0, 2)]
                yield pa.record_batch([*own, pa.array(set_a), pa.array(set_b), pa.array([len(s) for s in sets], pa.int64()), pa.array(sig, pa.binary())], names=names)
            if none := [i for i, t in enumerate(texts) if t is None]:
                nulls = [pa.nulls(len(none), t) for t in (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary())]
                yield pa.record_batch([batch.column(0).take(pa.array(none)), *nulls], names=names)

    return df.select(key, text, F.md5(text)).mapInArrow(tidy(run), f"`{key}` {kind}, `{mark}` string, set_a long, set_b long, n long, sig binary")


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, COORDINATES)


def first_paths(classes: DataFrame, runs: range, threshold: float) -> DataFrame:
    """(path, node) of every run's first split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node, rows = batch.column(0).to_numpy(), _matrix(batch.column(1))
            for r in runs:
                at, path = children(np.full(len(node), mix64(np.array([r], np.uint64), 35)[0]), rows, threshold)
                yield pa.record_batch([pa.array(path.view(np.int64)), pa.array(node[at])], names=["path", "node"])

    return classes.select("node", "sig").mapInArrow(tidy(run), "path long, node long")


def next_paths(members: DataFrame, threshold: float) -> DataFrame:
    """(path, node) one level below rows (path, node, sig)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at, path = children(batch.column(0).to_numpy().view(np.uint64), _matrix(batch.column(2)), threshold)
                yield pa.record_batch([pa.array(path.view(np.int64)), pa.array(batch.column(1).to_numpy()[at])], names=["path", "node"])

    return members.select("path", "node", "sig").mapInArrow(tidy(run), "path long, node long")


def _forest(similar: np.ndarray) -> np.ndarray:
    """For a symmetric yes/no matrix, the least index connected to each row."""
    root = np.arange(len(similar))
    while True:
        least = np.where(similar, root[None, :], len(root)).min(axis=1)
        least = np.minimum(root, least)
        least = least[least]
        if (least == root).all():
            return root
        root = least


def _spanning(own: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, (child, parent) row numbers, of the graph of rows that agree in at least ``need`` places.

    Breadth first: a row is compared with the rows not reached yet only, so a group of near copies costs one pass, not all its pairs.
    """
    child, parent = [], []
    left = np.arange(len(own))
    reached: list[int] = []
    while len(left):
        if not reached:
            reached.append(int(left[0]))
            left = left[1:]
        i = reached.pop()
        hit = (own[left] == own[i]).sum(axis=1) >= need
        if hit.any():
            new = left[hit]
            child.append(new), parent.append(np.full(len(new), i))
            reached.extend(new.tolist())
            left = left[~hit]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *child]), np.concatenate([none, *parent])


def candidate_links(buckets: DataFrame, least: float) -> DataFrame:
    """(a, b): a spanning forest of each bucket's classes whose min-hash rows agree in a share of at least ``least``."""
    need = math.ceil(least * COORDINATES)

    def work(rows: pa.Table, starts: np.ndarray) -> pa.Table:
        node, sig = rows.column(1).to_numpy(), _matrix(rows.column(2))
        starts, ends = starts[:-1], starts[1:]
        size = ends - starts
        two = starts[size == 2]
        hit = two[(sig[two] == sig[two + 1]).sum(axis=1) >= need]
        a, b = [node[hit]], [node[hit + 1]]
        for s, e in zip(starts[size > 2], ends[size > 2]):
            child, parent = _spanning(sig[s:e], need)
            a.append(node[s:e][child]), b.append(node[s:e][parent])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    return map_groups(buckets, ["path"], work, "a long, b long", ["node", "sig"])


def blocks_of_bucket(large: DataFrame, limit: int) -> DataFrame:
    """Rows of buckets that stay too large, dealt into pairs of blocks: each pair is a bucket of its own."""
    half = max(1, limit // 2)
    number = F.ceil(F.col("c") / F.lit(half)).cast("int")
    block = F.pmod(F.xxhash64("node"), number).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("number") - 1), lambda x: F.struct(F.least(x, F.col("block")).alias("i"), F.greatest(x, F.col("block")).alias("j")))
    dealt = large.withColumn("number", number).withColumn("block", block).withColumn("pair", F.explode(pairs))
    return dealt.select(F.xxhash64("path", "pair.i", "pair.j").alias("path"), "node")


def _links_of_runs(sigs: DataFrame, runs: range, threshold: float, bucket_limit: int, slack: float) -> tuple[DataFrame, DataFrame | None]:
    """(candidate links of these runs, the nodes of buckets too large at RECKONED_DEPTH or None)."""
    members = checkpointed(first_paths(sigs, runs, threshold))
    links = deep = None
    for depth in range(1, MOST_DEPTH + 1):
        sizes = members.groupBy("path").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        sized = checkpointed(members.join(sizes, "path"))
        small, large = sized.where(F.col("c") <= bucket_limit), sized.where(F.col("c") > bucket_limit)
        found = candidate_links(small.join(sigs, "node"), threshold - slack)
        links = found if links is None else links.union(found)
        if large.isEmpty():
            return links, deep
        if depth == RECKONED_DEPTH:
            deep = checkpointed(large.select("node").distinct())
        if depth < MOST_DEPTH:
            members = checkpointed(next_paths(large.join(sigs, "node"), threshold))
    rest = blocks_of_bucket(large, bucket_limit)
    return links.union(candidate_links(rest.join(sigs, "node"), threshold - slack)), deep


def chosen_path_links(classes: DataFrame, threshold: float, recall: float, bucket_limit: int, slack: float) -> DataFrame:
    """Candidate links (a, b) of all runs over classes (node, sig)."""
    sigs = classes.select("node", "sig")
    runs = runs_for(threshold, recall)
    links, deep = _links_of_runs(sigs, range(runs), threshold, bucket_limit, slack)
    more = deep_runs(threshold, recall)
    if deep is None or not more:
        return links
    again, _ = _links_of_runs(checkpointed(sigs.join(deep, "node", "left_semi")), range(runs, runs + more), threshold, bucket_limit, slack)
    return links.union(again)


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """The numbers of common elements of all pairs of sets, exactly: products of their incidence rows, some columns at a time."""
    n = len(sets)
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    new = np.append(True, every[1:] != every[:-1])
    column = np.cumsum(new) - 1
    often = np.bincount(column) > 1
    keep = often[column]
    owner, column = owner[keep], (np.cumsum(often) - 1)[column[keep]]
    out = np.zeros((n, n), np.float64)
    step = max(64, 4_000_000 // n)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        lo, hi = np.searchsorted(column, [at, at + step])
        x = np.zeros((n, step), np.float32)
        x[owner[lo:hi], column[lo:hi] - at] = 1
        out += x @ x.T
    return out


def verified(blocks: DataFrame, threshold: float) -> DataFrame:
    """(node, parent, links) for each class of each pair of blocks: exact links, and a neighbour in the links' forest or itself.

    Rows: (cluster, i, j, block, node, copies, n, shingles). In a pair of two blocks only links between them count.
    """

    def work(rows: pa.Table, starts: np.ndarray) -> pa.Table:
        i_, j_, block, node, copies, n = (rows.column(c).to_numpy() for c in (1, 2, 3, 4, 5, 6))
        shingles = rows.column(7)
        nodes, parents, links = [], [], []
        for s, e in zip(starts[:-1], starts[1:]):
            _, once = np.unique(node[s:e], return_index=True)
            at = s + once
            sets = [np.frombuffer(shingles[int(k)].as_py(), "<u8") for k in at]
            both = shared_counts(sets)
            size = n[at].astype(np.float64)
            similar = both >= threshold * (size[:, None] + size[None, :] - both) - 1e-9
            np.fill_diagonal(similar, False)
            if i_[s] != j_[s]:
                similar &= block[at][:, None] != block[at][None, :]
            nodes.append(node[at]), links.append(similar @ copies[at]), parents.append(node[at][_forest(similar)])
        return pa.table({"node": np.concatenate(nodes), "parent": np.concatenate(parents), "links": np.concatenate(links).astype(np.int64)})

    return map_groups(blocks, ["cluster", "i", "j"], work, "node long, parent long, links long", ["block", "node", "copies", "n", "shingles"], int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _sets(rows: DataFrame, width: int) -> DataFrame:
    """Add the shingle set to rows (text, set_a, set_b, cluster, blocks, node, copies, n); a text with another set goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in in_chunks(texts):
                sets = shingle_sets(texts[a:b], width)
                set_a, set_b = set_keys(sets)
                part = batch.slice(a, b - a)
                same = np.flatnonzero((set_a == part.column(1).to_numpy()) & (set_b == part.column(2).to_numpy()))
                took = part.take(pa.array(same))
                yield pa.record_batch([*took.columns[3:], pa.array([sets[k].astype("<u8").tobytes() for k in same], pa.binary())], names=["cluster", "blocks", "node", "copies", "n", "shingles"])

    return rows.select("text", "set_a", "set_b", "cluster", "blocks", "node", "copies", "n").mapInArrow(tidy(run), "cluster long, blocks int, node long, copies long, n long, shingles binary")


def _number(key: str) -> Column:
    return F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))


def _linked(df: DataFrame, key: str, text: str, width: int = 5, threshold: float = 0.8, recall: float = 0.999, bucket_limit: int = 4000, slack: float = 0.14) -> tuple[DataFrame, DataFrame]:
    """(the texts' sketches, the classes: set_a, set_b, node, first, root, top, n_links).

    A class's node is a number of its own, whatever its keys. first is the least (number, mark) of the class's texts, top that of all
    classes linked to it; root is their least node.
    """
    sketches = checkpointed(sketch(df, key, text, width))
    mark = sketches.columns[1]
    first = F.min(F.struct(_number(key).alias("number"), F.col(mark).alias("mark"))).alias("first")
    named = checkpointed(sketches.where("set_a is not null").groupBy("set_a", "set_b").agg(first, F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("sig").alias("sig")))
    # the checkpoint fixes rows and their order, so each reading numbers them alike
    classes = named.withColumn("node", F.monotonically_increasing_id())
    links = chosen_path_links(classes, threshold, recall, bucket_limit, slack)
    clusters = checkpointed(components(links))
    sized = clusters.join(classes.drop("sig"), "node")
    totals = sized.groupBy("root").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    wanted = sized.join(totals, "root").select("first.number", "first.mark", "set_a", "set_b", F.col("root").alias("cluster"), "blocks", "node", "copies", "n")
    # one text for each key and mark: repeated rows don't meet a class many times, and a key with many texts is dealt by mark
    texts = df.where(F.col(text).isNotNull()).select(_number(key).alias("number"), F.md5(text).alias("mark"), F.col(text).alias("text")).dropDuplicates(["number", "mark"])
    sets = _sets(texts.join(wanted, ["number", "mark"]), width).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least(x, F.col("block")).alias("i"), F.greatest(x, F.col("block")).alias("j")))
    blocks = sets.withColumn("pair", F.explode(pairs)).select("cluster", "pair.i", "pair.j", "block", "node", "copies", "n", "shingles")
    found = checkpointed(verified(blocks, threshold))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = checkpointed(components(found.select(F.col("node").alias("a"), F.col("parent").alias("b"))))
    tops = roots.join(classes.select("node", "first"), "node").groupBy("root").agg(F.min("first").alias("top"))
    by_class = classes.select("set_a", "set_b", "node", "copies", "first").join(counts, "node", "left").join(roots.join(tops, "root"), "node", "left")
    return sketches, by_class.select(
        "set_a", "set_b", "node", "first", F.coalesce("root", "node").alias("root"), F.coalesce("top", "first").alias("top"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )


def jaccard_join(df: DataFrame, key: str, text: str, width: int = 5, threshold: float = 0.8, recall: float = 0.999, bucket_limit: int = 4000, slack: float = 0.14) -> DataFrame:
    """One row per row of df: key, class_id (the least key it is linked to, over any number of links) and n_links.

    Linked are texts whose sets of ``width``-word shingles have a Jaccard similarity of at least ``threshold``; n_links
    counts the other documents linked directly, copies included. slack: how far under the threshold the share of equal
    min-hash values of a pair may be for it to be compared exactly (0.14 is four standard deviations).

    Cases: key must be a whole number, a null key counts as the least long; a null text is linked to none and is a class of its
    own; a text of fewer words than ``width`` is one shingle; a text without a word is linked to equal texts only; rows that share
    a key are linked by their texts only, so that classes whose least key is the same, null keys' too, have one class_id but each its own
    links; an empty table stays empty; further columns are left out.
    """
    sketches, classes = _linked(df, key, text, width, threshold, recall, bucket_limit, slack)
    rows = sketches.select(key, "set_a", "set_b").join(classes.select("set_a", "set_b", F.col("top.number").alias("class_id"), "n_links"), ["set_a", "set_b"], "left")
    return rows.select(key, F.coalesce("class_id", _number(key)).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def representatives(df: DataFrame, key: str, text: str, width: int = 5, threshold: float = 0.8, **how) -> DataFrame:
    """The rows of df that stand for their classes: of each class of linked texts the one with the least key.

    Cases: those of jaccard_join; one row of a class remains, of different texts under its least key that with the least md5;
    every null text is a class of its own.
    """
    _, classes = _linked(df, key, text, width, threshold, **how)
    number, mark = fresh(df, "node"), fresh(df, "mark")
    kept = classes.where(F.col("top") == F.col("first")).select(F.col("first.number").alias(number), F.col("first.mark").alias(mark))
    # texts are moved once: the semi join's rows come dealt by number and mark already
    there = df.where(F.col(text).isNotNull()).withColumn(number, _number(key)).withColumn(mark, F.md5(text)).dropDuplicates([number, mark]).join(kept, [number, mark], "left_semi")
    return there.select(*df.columns).union(df.where(F.col(text).isNull()))
