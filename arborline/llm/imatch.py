"""Operator 6: document fingerprints by I-Match with randomised lexicons (Chowdhury et al., 2002; Kolcz and Chowdhury, 2004).

The lexicon is the terms whose document frequency lies in a band. A text's distinct terms that are in it, sorted, are hashed once for each of 144 random
subsets of the lexicon, in 12 levels of twelve that keep one term in 2, in 4, and so on to one in 4096, each drawn for itself. The likeness of two
fingerprints is a share of equal hashes: subsets of many terms tell small edits, those of few terms large ones. A text none of whose terms is in
the lexicon has the hash of all its terms throughout.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborline.llm.common import checkpointed, tidy
from arborline.llm.words import in_chunks, mix64, word_hashes

LEVELS, EACH = 12, 12
SUBSETS = LEVELS * EACH
LEAST_SUBSETS = 8
#: Document shares of the lexicon's terms. The lower one bounds it: it has at most (mean distinct terms of a text) / LOW terms, whatever the number of texts.
LOW, HIGH = 0.002, 0.25
_FLUSH_TERMS = 1 << 20


def distinct_terms(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(term hashes, index of the text): each text's distinct terms, sorted; a text without a word is one term itself."""
    words, at = word_hashes(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(at))
    bare = np.flatnonzero(np.diff(at) == 0)
    if len(bare):
        own = [int.from_bytes(hashlib.blake2b(texts[i].encode("utf-8", "replace"), digest_size=8).digest(), "little") for i in bare]
        words, owner = np.concatenate([words, np.array(own, np.uint64)]), np.concatenate([owner, bare])
    order = np.lexsort((words, owner))
    words, owner = words[order], owner[order]
    new = np.ones(len(words), bool)
    new[1:] = (words[1:] != words[:-1]) | (owner[1:] != owner[:-1])
    return words[new], owner[new]


def _among(terms: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(terms), bool)
    return known[np.minimum(np.searchsorted(known, terms), len(known) - 1)] == terms


def fingerprints(texts: Sequence[str], lexicon: np.ndarray) -> np.ndarray:
    """A row of SUBSETS 16-bit hashes for each text; 0 where a subset keeps none of its terms. lexicon: sorted term hashes."""
    terms, owner = distinct_terms(texts)
    out = np.zeros((len(texts), SUBSETS), np.uint16)
    groups = np.arange(len(texts) + 1)

    def hashed(value: np.ndarray, owner: np.ndarray) -> np.ndarray:
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
        at = np.searchsorted(owner, groups)
        total = upto[at[1:]] - upto[at[:-1]]
        return np.where(at[1:] > at[:-1], mix64(total, 60) % np.uint64(0xFFFF) + np.uint64(1), 0).astype(np.uint16)

    known = _among(terms, lexicon)
    strange = np.bincount(owner[known], minlength=len(texts)) == 0
    if strange.any():
        out[strange] = hashed(mix64(terms, 41), owner)[strange, None]
    terms, owner = terms[known], owner[known]
    value = mix64(terms, 41)
    for r in range(SUBSETS):
        # four 16-bit numbers come of one hash
        draws = draws if r % 4 else mix64(terms, 100 + r // 4)
        inside = (draws >> np.uint64(16 * (r % 4))) & np.uint64(0xFFFF) < np.uint64(0x10000 >> (r // EACH + 1))
        out[~strange, r] = hashed(value[inside], owner[inside])[~strange]
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows of fingerprints: the share of equal hashes among the subsets that keep a term of either, in the best pool of subsets.

    The pools are all subsets, all but the finest level, and so on, as long as LEAST_SUBSETS keep a term: fine subsets differ at the first edit.
    """
    some = (a != 0) | (b != 0)
    upto = lambda x: x.reshape(len(x), LEVELS, -1).sum(axis=2)[:, ::-1].cumsum(axis=1)[:, ::-1]
    same, n = upto((a == b) & some), upto(some)
    share = same / np.maximum(n, 1)
    return np.maximum(share[:, 0], np.where(n >= LEAST_SUBSETS, share, 0).max(axis=1))


def lexicon_of(df: DataFrame, text: str, low: float, high: float) -> np.ndarray:
    """The sorted hashes of terms that between low and high of all texts contain; for the bound of their number see LOW."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            terms, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.record_batch([pa.array(terms.view(np.int64)), pa.array(n)], names=["term", "n"])

        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for a, b in in_chunks(texts):
                held.append(distinct_terms(texts[a:b])[0])
                size += len(held[-1])
                if size > _FLUSH_TERMS:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    total = df.count()
    counts = df.select(text).mapInArrow(tidy(run), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    band = counts.where(F.col("n").between(math.ceil(low * total), math.floor(high * total))).select("term")
    return np.sort(checkpointed(band).toArrow().column(0).to_numpy().view(np.uint64))


def edited(text: str, following: str) -> str:
    """text with its last half replaced by the first code points of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


#: Sampled (key, text hash) pairs for each bucket whose bounds they give.
SAMPLED_EACH = 64
_LEAST_KEY = -(1 << 63)


def _bounds(pairs: DataFrame, n: int, buckets: int) -> list[tuple[int, int]]:
    """Rising pairs (k, h) that part the rows into about ``buckets`` of equal size, from a sample by hash of at most about SAMPLED_EACH x buckets pairs."""
    share = F.xxhash64(F.lit(99), "k", "h") / F.lit(2.0**64) + F.lit(0.5) < F.lit(min(1.0, SAMPLED_EACH * buckets / max(1, n)) + 1e-12)
    sample = sorted((r.k, r.h, r["count"]) for r in pairs.where(share).groupBy("k", "h").count().collect())
    whole, upto, cuts = sum(c for *_, c in sample), 0, []
    for k, h, c in sample:
        if cuts and (k, h) == cuts[-1]:
            continue
        if upto * buckets >= (len(cuts) + 1) * whole:
            cuts.append((k, h))
        upto += c
    return cuts


def _place(k: Column, h: Column, cuts: list[tuple[int, int]]) -> Column:
    """How many of the rising cuts are at or before (k, h), by halving."""
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    padded = cuts + [(2**63 - 1, 2**63 - 1)] * (2 * steps[0] - 1 - len(cuts)) if steps else cuts
    if not steps:
        return F.lit(0)
    ks, hs = F.lit([c[0] for c in padded]), F.lit([c[1] for c in padded])

    def halve(at: Column, step: Column) -> Column:
        to = at + step
        below = (F.element_at(ks, to) < k) | ((F.element_at(ks, to) == k) & (F.element_at(hs, to) <= h))
        return F.when(below & (to <= len(cuts)), to).otherwise(at)

    return F.aggregate(F.lit(steps), F.lit(0), halve)


def with_following(df: DataFrame, key: str, text: str) -> DataFrame:
    """(bucket, tail, key, h, text): rows dealt by ranges of key and text hash into buckets; the row that follows a bucket's last one is added as its tail.

    A bucket is in order when sorted by key descending, then h descending. Texts are moved once, tails are one row a bucket.
    """
    spark = df.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = F.coalesce(F.col(text), F.lit(""))
    k, h = F.coalesce(F.col(key).cast("long"), F.lit(_LEAST_KEY)), F.xxhash64(body)
    cuts = _bounds(df.select(k.alias("k"), h.alias("h")), df.count(), buckets)
    rows = df.select(_place(k, h, cuts).cast("int").alias("bucket"), F.lit(0).alias("tail"), F.col(key).cast("long").alias(key), h.alias("h"), body.alias(text))
    first = rows.groupBy("bucket").agg(F.max(F.struct(F.coalesce(F.col(key), F.lit(_LEAST_KEY)).alias("k"), "h")).alias("f")).orderBy("bucket").collect()
    if not first:
        return rows
    to = {b.bucket: first[i + 1].bucket if i + 1 < len(first) else first[0].bucket for i, b in enumerate(first)}
    asked = spark.createDataFrame([(b.bucket, b.f.k, b.f.h, to[b.bucket]) for b in first], "b int, k long, hh long, dest int")
    same = (F.col("bucket") == F.col("b")) & (F.coalesce(F.col(key), F.lit(_LEAST_KEY)) == F.col("k")) & (F.col("h") == F.col("hh"))
    tails = rows.join(F.broadcast(asked), same).dropDuplicates(["b"]).select(F.col("dest").alias("bucket"), F.lit(1).alias("tail"), key, "h", text)
    return rows.union(tails)


def fingerprint_edits(df: DataFrame, key: str, text: str, low: float = LOW, high: float = HIGH) -> DataFrame:
    """One row a document: its fingerprint, its edited text's, and the likenesses to that and to the next document's.

    Returns key, n_chars, edited_sha256, fingerprint, edited_fingerprint (hex), near_edited, near_next. The next document is that of
    the next smaller key, after the last the first. Cases: a null text is empty; a text without a word has itself as its one
    term; a text of no term in the lexicon is like equal ones only; a null key comes last; rows that share a key are ordered by a hash of their texts, those that share both in any way; texts of any
    length are read whole; a single document follows itself; an empty table stays empty; other columns are left out.
    """
    shared = df.sparkSession.sparkContext.broadcast(lexicon_of(df, text, low, high))

    def rows_of(bodies: list[str], keys: list, follow: list[str]) -> Iterator[pa.RecordBatch]:
        """follow: the texts that follow; bodies[i + 1] for all but the last."""
        for a, b in in_chunks(bodies):
            new = [edited(x, y) for x, y in zip(bodies[a:b], follow[a:b])]
            all_ = fingerprints([*bodies[a:b], *new, follow[b - 1]], shared.value)
            n = b - a
            own, change, after = all_[:n], all_[n : 2 * n], np.concatenate([all_[1:n], all_[2 * n :]])
            sha = [hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in new]
            columns = [pa.array(keys[a:b], pa.int64()), pa.array([len(t) for t in bodies[a:b]], pa.int64()), pa.array(sha), pa.array([r.tobytes().hex() for r in own]), pa.array([r.tobytes().hex() for r in change]), pa.array(likeness(own, change)), pa.array(likeness(own, after))]
            yield pa.record_batch(columns, names=[key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple | None = None  # the last row so far, whose following row is still to come
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                tail, keys, bodies = part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist()
                if kept:
                    tail, keys, bodies = [kept[0], *tail], [kept[1], *keys], [kept[2], *bodies]
                kept = (tail[-1], keys[-1], bodies[-1])
                run_start = 0
                for i in range(len(tail)):
                    last = i == len(tail) - 1
                    if (tail[i] or last) and i > run_start:
                        yield from rows_of(bodies[run_start:i], keys[run_start:i], bodies[run_start + 1 : i + 1])
                    if tail[i]:
                        run_start = i + 1
        # the last row of a partition is a bucket's tail

    dealt = with_following(df, key, text)
    ordered = dealt.repartition("bucket").sortWithinPartitions("bucket", "tail", F.desc_nulls_last(key), F.desc("h"))
    return ordered.select("tail", key, text).mapInArrow(tidy(run), f"`{key}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
