"""Operator 3: best-fit packing of token pieces after Martello-Toth dominance reduction.

Pieces have whole lengths from 1 to the capacity, so a packing problem of any size is a histogram of at most
``capacity`` counts. The driver solves that histogram; Spark tokenises, ranks the pieces of each length and
gives every piece its sequence and offset by a join with the solution.
"""

from __future__ import annotations

import bisect
import functools
import json
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborline.llm.common import checkpointed, fresh, gapless_rank, tidy
from arborline.llm.sharding import next_state
from arborline.llm.tokencount import WORD_PATTERN

Pattern = tuple[int, tuple[tuple[int, int], ...]]  # sequences, ((length, pieces of it), ...)


# ---------------------------------------------------------------- tokens


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_encoder(spec: str) -> Callable[[str], np.ndarray]:
    """An encoder of the tokenizer file's ids; texts with a special token's string go to the file's own library, loaded at the first such text.

    A byte-level BPE whose ids follow its merges is run by tiktoken, which gives the same ids faster; any other
    file is run by tokenizers, and so is any text at which tiktoken stops, as at a million blanks on end.
    """

    @functools.cache
    def whole():
        from tokenizers import Tokenizer

        return Tokenizer.from_str(spec)

    slow = lambda text: np.array(whole().encode(text, add_special_tokens=False).ids, "<u4")
    d = json.loads(spec)
    model, special = d["model"], [x["content"] for x in d.get("added_tokens", [])]
    pre = d.get("pre_tokenizer") or {}
    letters = byte_letters()
    ordered = all(model["vocab"].get("".join(m if isinstance(m, list) else m.split(" "))) == 256 + i for i, m in enumerate(model.get("merges", [])))
    plain = model.get("type") == "BPE" and not d.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    if not (plain and ordered and not model.get("end_of_word_suffix")):
        return slow
    import tiktoken

    ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    fast = tiktoken.Encoding("file", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if not any(x in text for x in special):
            try:
                return fast.encode_to_numpy(text)
            except ValueError:
                pass
        return slow(text)

    return encode


def tokenize_pieces(df: DataFrame, key: str, text: str, tokenizer_file: str, capacity: int, end_id: int) -> DataFrame:
    """Cut every document's ids (with end_id last) into pieces of at most ``capacity``.

    Returns key, piece (int from 0), start (ids before it), length and ids (little-endian unsigned 32-bit, binary).
    Only documents longer than the capacity are cut; all their pieces are full but the first, which may be shorter.
    Cases: a null text is empty and gives one piece with end_id alone; texts of any length are read whole, such as have no blank, or
    millions of them, too; repeated rows and null keys are packed like
    any other; an empty table stays empty; columns besides key and text are left out. The tokenizer file is read on the driver and broadcast: a
    vocabulary, whose size doesn't follow the data.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())
    kind = df.select(key).schema[0].dataType
    last = np.array([end_id], "<u4")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        for batch in batches:
            encode = encode or load_encoder(shared.value)
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows, piece, start, length, ids = [], [], [], [], []
                for i, value in enumerate(part.column(1).to_pylist()):
                    got = np.concatenate([encode(value or ""), last])
                    cuts = [0, *range(len(got) % capacity or capacity, len(got), capacity), len(got)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        rows.append(i), piece.append(k), start.append(a), length.append(b - a), ids.append(got[a:b].astype("<u4").tobytes())
                yield pa.record_batch([part.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())], names=[key, "piece", "start", "length", "ids"])

    schema = f"`{key}` {kind.simpleString()}, piece int, start long, length long, ids binary"
    return df.select(key, text).mapInArrow(tidy(cut), schema)


# ---------------------------------------------------------------- the histogram's solution


def reduce_dominated(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Fix, for good, small sets that dominate every other feasible set with the same item (Martello and Toth).

    A set dominates another if the other's items can be shared out so that each share fits into one of its items. For an
    item j with room r = capacity - j the sets tried are {j} if nothing fits, {j, k} with k the largest that fits (k = r
    dominates all; else if no two others fit, or no two sum to more than k), and, if no three others fit,
    {j, k, b} with b the largest that fits beside k, if each pair (s, t) that fits has t <= b or s + t <= k.
    Returns the fixed patterns and the counts that are left.
    """
    left = Counter({k: v for k, v in counts.items() if v > 0})
    fixed: list[Pattern] = []

    def without(*used: int) -> list[int]:
        gone = Counter(used)
        return [x for x in sorted(left) if left[x] > gone[x]]

    def take(*items: int) -> None:
        need = Counter(items)
        times = min(left[x] // n for x, n in need.items())
        for x, n in need.items():
            left[x] -= times * n
            if not left[x]:
                del left[x]
        fixed.append((times, tuple(sorted(need.items(), reverse=True))))

    def below(items: list[int], most: int) -> int | None:
        i = bisect.bisect_right(items, most)
        return items[i - 1] if i else None

    def smallest(n: int, j: int) -> int:
        """The sum of the n smallest items besides one j, or more than any capacity."""
        total = 0
        for x in without(j):
            m = min(n, left[x] - (x == j))
            total, n = total + m * x, n - m
            if not n:
                return total
        return capacity + 1

    def dominating(j: int) -> tuple[int, ...] | None:
        r = capacity - j
        others = without(j)
        k = below(others, r)
        if k is None:
            return (j,)
        if k == r or smallest(2, j) > r:
            return (j, k)
        if smallest(3, j) <= r:
            return None
        pairs = []
        for t in others:
            if 2 * t > r:
                break
            s = below(others, r - t)
            if s > t or left[t] - (t == j) > 1:
                pairs.append((s, t))
        if all(s + t <= k for s, t in pairs):
            return (j, k)
        b = below(without(j, k), r - k)
        if b is not None and all(t <= b or s + t <= k for s, t in pairs):
            return (j, k, b)
        return None

    changed = True
    while changed:
        changed = False
        for j in sorted(left, reverse=True):
            while left[j] and (found := dominating(j)):
                take(*found)
                changed = True
    return fixed, dict(left)


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing on counts: equal items and equal sequences move together, with the same result."""
    open_: dict[int, list[list]] = {}  # room -> [[sequences, {length: pieces}], ...]
    for w in sorted(counts, reverse=True):
        c = counts[w]
        while c:
            room = min((r for r in open_ if r >= w and open_[r]), default=None)
            group = open_[room].pop() if room is not None else [-(-c // (capacity // w)), {}]
            room = capacity if room is None else room
            n, have = group
            each = room // w
            full = min(n, c // each)
            rest = min(c - full * each, each - 1 if full < n else 0)
            for k, q in ((full, each), (1 if rest else 0, rest), (n - full - (1 if rest else 0), 0)):
                if k:
                    open_.setdefault(room - q * w, []).append([k, have | ({w: q} if q else {})])
            c -= full * each + rest
    return [(n, tuple(sorted(have.items(), reverse=True))) for groups in open_.values() for n, have in groups if have]


def solve(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that hold every piece of the histogram once."""
    fixed, left = reduce_dominated(counts, capacity)
    return fixed + best_fit(left, capacity)


# ---------------------------------------------------------------- the operator


#: Rows of one length are ranked in parts of at least so many rows, in so many parts altogether at most (and one a length): a broadcast's bound.
PART_ROWS, MOST_PARTS = 500, 500_000


def scattered(number: Column, seed: int) -> Column:
    """A number in a fixed random order: different numbers get different 64-bit ones."""
    x = next_state(number.cast("long").bitwiseXOR(F.lit(seed).cast("long")))
    return next_state(x.bitwiseXOR(F.shiftrightunsigned(x, 32)))


def pack(pieces: DataFrame, capacity: int, spread: list[str], seed: int = 29) -> DataFrame:
    """Add sequence_id and offset (gapless from 0 in each sequence) to rows with a ``length`` of 1 to capacity.

    sequence_id is unique and random: in its order sequences are shuffled, whatever their pattern. Rows of one length are interchangeable: each gets a rank (``spread`` names the columns that tell rows apart and
    deal them into parts), and the solution's runs of ranks say where it goes. The histogram on the driver and the
    runs have at most ``capacity`` lengths. pieces is read several times: pass a table or a checkpointed DataFrame. Cases: an
    empty table stays empty; rows that tie in ``spread`` are packed like others; a length out of range raises
    ValueError; columns named sequence_id or offset are replaced.
    """
    pieces = pieces.drop("sequence_id", "offset")
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    if any(x is None or not 0 < x <= capacity for x in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    used: Counter = Counter()
    runs, base = [], 0
    for n, have in solve(counts, capacity):
        at = 0
        for w, q in have:
            runs.append((w, used[w], used[w] + n * q, base, q, at))
            used[w] += n * q
            at += w * q
        base += n
    spark = pieces.sparkSession
    solution = spark.createDataFrame(runs, "length long, first long, beyond long, base long, each long, at long")
    each_part = max(PART_ROWS, sum(counts.values()) // MOST_PARTS)
    parts = F.lit([-(-counts.get(w, 1) // each_part) for w in range(1, capacity + 1)])
    part = F.pmod(F.xxhash64(*spread), F.element_at(parts, F.col("length").cast("int"))).cast("int")
    ranked = gapless_rank(pieces, ["length"], part, [F.col(c) for c in spread], "rank_")
    run = F.col("rank_") - F.col("s.first")
    where = (F.col("p.length") == F.col("s.length")) & (F.col("rank_") >= F.col("s.first")) & (F.col("rank_") < F.col("s.beyond"))
    return ranked.alias("p").join(F.broadcast(solution).alias("s"), where).select(
        *[F.col(f"p.`{c}`") for c in pieces.columns],
        scattered(F.col("s.base") + F.floor(run / F.col("s.each")), seed).alias("sequence_id"),
        (F.col("s.at") + F.pmod(run, F.col("s.each")) * F.col("s.length")).cast("long").alias("offset"),
    )


def pack_documents(df: DataFrame, key: str, text: str, tokenizer_file: str, capacity: int = 1024, end_id: int = 2, keep_ids: bool = True) -> DataFrame:
    """Tokenise, cut and pack documents; one row a piece. keep_ids=False keeps ids_crc32 and leaves the ids out.

    Cases: as in tokenize_pieces and pack: a null or empty text is its end mark alone; texts of any length are cut whole; null keys, repeated rows and rows that
    tie are packed like any other; an empty table stays empty; columns besides key and text are left out.
    """
    pieces = tokenize_pieces(df, key, text, tokenizer_file, capacity, end_id).withColumn("ids_crc32", F.crc32("ids"))
    # the task that cut a piece tells equal rows apart, of which there may be many
    task = fresh(pieces, "task")
    pieces = checkpointed((pieces if keep_ids else pieces.drop("ids")).withColumn(task, F.spark_partition_id()))
    return pack(pieces, capacity, [key, "piece", "start", "ids_crc32", task]).drop(task)
