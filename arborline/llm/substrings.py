"""Operator 12: removal of long passages that repeat across documents, on a De Bruijn graph of words.

A run of ``width`` words is an edge of the graph, from its first width - 1 words to its last. An edge that occurs in several documents is repeated,
and belongs to the one with the smallest key; elsewhere its words go. Repeated edges that follow one another compact into paths:

1. A document's edges travel in pieces: consecutive edges whose least gram of a few words (the minimiser, which is a function of the edge alone) is one
   and the same. All occurrences of an edge meet under its minimiser, in pieces that hold its neighbours too, so one shuffle of pieces does for the whole graph and most
   paths are compacted where they meet. A group in which only one document takes part has no repeated edge.
2. Pieces of repeated edges join their documents by their source coordinates (document, place) and compact there into whole paths: a piece that begins at the edge
   where another ends goes on with its path. Coordinates are verified by the edge's hash in the text that they point at.

Hot edges: a hashed sample of documents tells edges and minimisers that make up a large part of all. Each such edge's smallest document is found by an aggregation and
broadcast (at most MOST_HOT entries, by the rule that picks them), so its occurrences are settled where they are read; other edges of hot minimisers travel
one by one under hashes of their own. The sample decides how edges travel, never what is found.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from arborline.llm.common import checkpointed, fresh, tidy
from arborline.llm.grouped import map_groups
from arborline.llm.words import in_chunks, mix64

WIDTH = 13
#: One document in so many is sampled; what is as common there as one in MOST_HOT edges, and occurs LEAST_HOT times, is hot.
SAMPLE, MOST_HOT, LEAST_HOT = 256, 1_000_000, 8
#: Edges of a piece at most, and bytes that tell an edge from others with its minimiser, on which 64 more bits lie.
MOST_EDGES, EDGE_BYTES = 64, 5
#: Bytes hashed at a time.
BLOCK = 1 << 20
NULL_KEY = -(1 << 63)
OUTPUTS = ("n_words", "n_removed", "spans", "kept")
_WORD = np.array([b not in (32, 9, 10, 11, 12, 13) for b in range(256)])
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


class Words:
    """The words of several texts: data, the texts' bytes with a blank after each; starts and ends of words in it; text_at and word_at, where each text begins in data and in the words."""

    def __init__(self, texts: Sequence[str]) -> None:
        raw = [t.encode("utf-8", "replace") for t in texts]
        self.data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
        self.text_at = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])]).astype(np.int64)
        edge = np.diff(_WORD[self.data].astype(np.int8), prepend=np.int8(0))
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.word_at = np.searchsorted(self.starts, self.text_at)

    def hashes(self) -> np.ndarray:
        """Of every word, a function of its bytes alone; in blocks, so that a long text needs little more than its words."""
        out = np.zeros(len(self.starts), np.uint64)
        first = 0
        while first < len(out):
            low = self.starts[first]
            beyond = max(int(np.searchsorted(self.ends, low + BLOCK, "right")), first + 1)
            high = int(self.ends[beyond - 1])
            steps = np.full(high - low, _BASE, np.uint64)
            steps[0] = 1
            power = np.multiply.accumulate(steps)
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((self.data[low:high].astype(np.uint64) + np.uint64(1)) * power, dtype=np.uint64)])
            steps[1:] = _INVERSE
            back = np.multiply.accumulate(steps)
            a, b = self.starts[first:beyond] - low, self.ends[first:beyond] - low
            out[first:beyond] = mix64((total[b] - total[a]) * back[a], 7)
            first = beyond
        return out


def _grams(words: np.ndarray, n: int, salt: int) -> np.ndarray:
    """Hashes of all runs of n words."""
    out = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n):
        out = out * _BASE + words[k : k + len(out)]
    return mix64(out, salt)


def _least(x: np.ndarray, span: int) -> np.ndarray:
    """The least of each run of ``span`` values."""
    n, reach = len(x) - span + 1, 1
    while 2 * reach <= span:
        x = np.minimum(x[:-reach], x[reach:])
        reach *= 2
    return np.minimum(x[:n], x[span - reach :][:n])


def edges(texts: Sequence[str], width: int) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, and of every edge: its text's number, its first word's place in that text, its hash, its minimiser)."""
    words = Words(texts)
    hashes = words.hashes()
    if len(hashes) < width:
        none = np.zeros(0, np.int64)
        return words, none, none, none.astype(np.uint64), none.astype(np.uint64)
    text = np.repeat(np.arange(len(texts)), np.diff(words.word_at))
    n = len(hashes) - width + 1
    at = np.flatnonzero(text[:n] == text[width - 1 :])
    gram = max(1, min(4, width // 3))
    least = _least(_grams(hashes, gram, 8), width - gram + 1)
    return words, text[at], at - words.word_at[text[at]], _grams(hashes, width, 9)[at], least[at]


def _firsts(text: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Which edges are the first of their hash in their text."""
    order = np.lexsort((edge, text))
    a, b = text[order], edge[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])[: len(order)]
    out = np.zeros(len(order), bool)
    out[order] = new  # lexsort is stable, so the first of equals comes first
    return out


def _cuts(*changes: np.ndarray) -> np.ndarray:
    """Where runs begin: the first place, and wherever one of the arrays says so for the place and the one before it."""
    begins = np.ones(len(changes[0]) + 1, bool)
    begins[1:] = np.logical_or.reduce(changes)
    return np.flatnonzero(begins)


def _bytes(edge: np.ndarray) -> np.ndarray:
    """EDGE_BYTES of each edge's hash, in one flat array of bytes."""
    return np.ascontiguousarray(edge.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :EDGE_BYTES].ravel()


_PIECES = ["m", "k", "tp", "w"]
_PIECE_SCHEMA = "m long, k long, tp long, w binary"


def _binary(flat: np.ndarray, sizes: np.ndarray) -> pa.BinaryArray:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes())])


def _batch(m: np.ndarray, k: np.ndarray, tp: np.ndarray, w: pa.BinaryArray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(m.view(np.int64)), pa.array(k), pa.array(tp), w], names=_PIECES)


def _pieces(docs: DataFrame, width: int, hot_grams: np.ndarray, hot_edges: np.ndarray, hot_keys: np.ndarray) -> DataFrame:
    """The pieces (m: minimiser, k: document, tp: its text's 32-bit hash and the place, w: the edges' bytes) of docs (k, th, text).

    An edge that repeats in its text is in it once. What hot edges settle comes as a piece of EDGE_BYTES + 1 bytes: the first edge's, and the number of edges.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, th, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_pylist()
            for a, b in in_chunks(texts):
                _, text, place, edge, gram = edges(texts[a:b], width)
                pick = np.flatnonzero(_firsts(text, edge))
                if not len(pick):
                    continue
                text, place, edge, gram = text[pick], place[pick], edge[pick], gram[pick]
                k, tp = key[a:b][text], (th[a:b][text] << 32) | place
                at = np.minimum(np.searchsorted(hot_edges, edge), max(0, len(hot_edges) - 1))
                known = hot_edges[at] == edge if len(hot_edges) else np.zeros(len(edge), bool)
                gone = known & (k > hot_keys[at]) if len(hot_edges) else known
                if known.any():
                    p = np.flatnonzero(gone)
                    if len(p):
                        cut = _cuts((text[p][1:] != text[p][:-1]) | (place[p][1:] != place[p][:-1] + 1))
                        for out in _settled(k[p], tp[p], edge[p], cut):
                            yield out
                    rest = np.flatnonzero(~known)
                    text, place, edge, gram, k, tp = (x[rest] for x in (text, place, edge, gram, k, tp))
                    if not len(rest):
                        continue
                alone = np.isin(gram, hot_grams) if len(hot_grams) else np.zeros(len(gram), bool)
                gram = np.where(alone, mix64(gram ^ edge, 10), gram)
                cut = _cuts(gram[1:] != gram[:-1], text[1:] != text[:-1], place[1:] != place[:-1] + 1, alone[1:])
                cut = _shortened(cut, len(gram))
                yield _batch(gram[cut], k[cut], tp[cut], _binary(_bytes(edge), EDGE_BYTES * np.diff(np.append(cut, len(gram)))))

    return docs.select("k", "th", "text").mapInArrow(tidy(run), _PIECE_SCHEMA)


def _shortened(cut: np.ndarray, n: int) -> np.ndarray:
    """Begins of runs of MOST_EDGES at most, given those of longer ones."""
    place = np.arange(n) - np.repeat(cut, np.diff(np.append(cut, n)))
    return np.flatnonzero(place % MOST_EDGES == 0)


def _settled(k: np.ndarray, tp: np.ndarray, edge: np.ndarray, cut: np.ndarray) -> Iterator[pa.RecordBatch]:
    cut = _shortened(cut, len(k))
    size = np.diff(np.append(cut, len(k))).astype(np.uint8)
    w = np.concatenate([_bytes(edge[cut]).reshape(-1, EDGE_BYTES), size[:, None]], axis=1)
    yield _batch(mix64(tp[cut].astype(np.uint64), 11), k[cut], tp[cut], _binary(w.ravel(), np.full(len(cut), EDGE_BYTES + 1)))


def _repeated(rows: pa.Table, starts: np.ndarray) -> pa.Table:
    """(k, th, at, what) of the runs of edges, in whole groups of one minimiser, that a document with a smaller key has too; what: the first edge's bytes and the run's length."""
    w = rows.column("w").combine_chunks()
    w = w.chunk(0) if isinstance(w, pa.ChunkedArray) else w
    offsets = np.frombuffer(w.buffers()[1], np.int32)[w.offset : w.offset + len(w) + 1].astype(np.int64)
    flat = np.frombuffer(w.buffers()[2] or b"", np.uint8)
    k, tp = rows.column("k").to_numpy(), rows.column("tp").to_numpy()
    size = np.diff(offsets)
    known = np.flatnonzero(size == EDGE_BYTES + 1)
    out = [(k[known], tp[known], _numbers(flat, offsets[known]), flat[offsets[known] + EDGE_BYTES].astype(np.int64))]
    group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    low, high = np.minimum.reduceat(k, starts[:-1]), np.maximum.reduceat(k, starts[:-1])
    pick = np.flatnonzero((low < high)[group] & (size != EDGE_BYTES + 1))
    if len(pick):
        count = size[pick] // EDGE_BYTES
        row = np.repeat(np.arange(len(pick)), count)
        place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        edge = _numbers(flat, offsets[pick][row] + EDGE_BYTES * place)
        own = k[pick][row]
        order = np.lexsort((edge, group[pick][row]))
        g, e = group[pick][row][order], edge[order]
        first = _cuts((g[1:] != g[:-1]) | (e[1:] != e[:-1]))
        least = np.repeat(np.minimum.reduceat(own[order], first), np.diff(np.append(first, len(order))))
        gone = np.zeros(len(row), bool)
        gone[order] = own[order] > least
        p = np.flatnonzero(gone)
        if len(p):
            cut = _cuts((row[p][1:] != row[p][:-1]) | (place[p][1:] != place[p][:-1] + 1))
            at = p[cut]
            out.append((own[at], tp[pick][row[at]] + place[at], edge[at], np.diff(np.append(cut, len(p)))))
    k, tp, edge, n = (np.concatenate(x) for x in zip(*out))
    return pa.table({"k": k, "th": tp >> 32, "at": tp & 0xFFFFFFFF, "what": edge.astype(np.int64) << 8 | n})


def _numbers(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The edges whose bytes begin at these places, as whole numbers."""
    wide = np.zeros((len(at), 8), np.uint8)
    if len(at):
        wide[:, :EDGE_BYTES] = flat[at[:, None] + np.arange(EDGE_BYTES)]
    return wide.view("<u8")[:, 0]


def _counted(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hot minimisers, hot edges), sorted, by a sample of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in in_chunks(texts):
                _, text, _, edge, gram = edges(texts[a:b], width)
                for kind, values in ((0, gram[_firsts(text, gram)] if len(gram) else gram), (1, edge[_firsts(text, edge)] if len(edge) else edge)):
                    found, n = np.unique(values, return_counts=True)
                    yield pa.record_batch([pa.array(np.full(len(found), kind)), pa.array(found.view(np.int64)), pa.array(n)], names=["kind", "h", "n"])

    counts = docs.where(F.pmod(F.xxhash64("k", "text"), F.lit(SAMPLE)) == 0).select("text").mapInArrow(tidy(run), "kind long, h long, n long")
    counts = checkpointed(counts.groupBy("kind", "h").agg(F.sum("n").alias("n")))
    total = counts.where("kind = 1").agg(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("n") >= max(LEAST_HOT, total // MOST_HOT)).select("kind", "h").collect()
    pick = lambda kind: np.sort(np.array([r.h for r in hot if r.kind == kind], np.int64).view(np.uint64))
    return pick(0), pick(1)


def _smallest_keys(docs: DataFrame, width: int, hot: np.ndarray) -> np.ndarray:
    """The smallest key of a document with each hot edge, by an aggregation over all documents that has a row an edge and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.full(len(hot), (1 << 63) - 1)
        for batch in batches:
            key, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for a, b in in_chunks(texts):
                _, text, _, edge, _ = edges(texts[a:b], width)
                at = np.minimum(np.searchsorted(hot, edge), len(hot) - 1)
                found = hot[at] == edge
                np.minimum.at(least, at[found], key[a:b][text[found]])
        seen = np.flatnonzero(least < (1 << 63) - 1)
        yield pa.record_batch([pa.array(seen), pa.array(least[seen])], names=["i", "k"])

    rows = docs.select("k", "text").mapInArrow(tidy(run), "i long, k long").groupBy("i").agg(F.min("k").alias("k")).collect()
    out = np.full(len(hot), (1 << 63) - 1)
    for i, k in rows:
        out[i] = k
    return out


def repeated_pieces(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(k, th, at, what): the pieces of edges of docs (k, th, text) that a document with a smaller k has too."""
    hot_grams, hot_edges = _counted(docs, width)
    hot_keys = _smallest_keys(docs, width, hot_edges) if len(hot_edges) else np.zeros(0, np.int64)
    return map_groups(_pieces(docs, width, hot_grams, hot_edges, hot_keys), ["m"], _repeated, "k long, th long, at long, what long", ["k", "tp", "w"])


def _shrunk(df: DataFrame, text: str) -> DataFrame:
    """df with its texts compressed for a shuffle, one by one."""
    place = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor()
        for batch in batches:
            made = [None if t is None else small.compress(t.encode()) for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, text, pa.array(made, pa.binary()))

    return df.mapInArrow(run, StructType([StructField(f.name, BinaryType()) if f.name == text else f for f in df.schema.fields]))


def _covered(words: Words, text: np.ndarray, place: np.ndarray, edge: np.ndarray, pieces: list, width: int) -> np.ndarray:
    """Which words lie on a path of repeated edges, by each text's pieces (at, what), which have to point at the edges they say."""
    begins = np.zeros(len(words.starts) + 1, np.int32)
    low, high = np.searchsorted(text, np.arange(len(pieces))), np.searchsorted(text, np.arange(len(pieces)), "right")
    for i, own in enumerate(pieces):
        if own is None or not len(own[0]) or low[i] == high[i]:
            continue
        at, what = own
        mine = edge[low[i] : high[i]]
        right = at < len(mine)
        right[right] = (mine[at[right]] & np.uint64((1 << 8 * EDGE_BYTES) - 1)).astype(np.int64) == what[right] >> 8
        at, n = at[right], what[right] & 0xFF
        gone = np.repeat(at - (np.cumsum(n) - n), n) + np.arange(n.sum())
        gone = np.flatnonzero(np.isin(mine, mine[gone[gone < len(mine)]]))
        first = words.word_at[i] + gone
        np.add.at(begins, first, 1)
        np.add.at(begins, first + width, -1)
    return np.cumsum(begins[:-1]) > 0


def _kept_texts(words: Words, gone: np.ndarray) -> list[bytes]:
    """Each text's words that are not gone, joined by one blank."""
    stay = np.flatnonzero(~gone)
    text = np.searchsorted(words.word_at, stay, "right") - 1
    later = np.concatenate([[False], text[1:] == text[:-1]])[: len(stay)]
    take = np.zeros(len(words.data) + 1, np.int8)
    a, b = words.starts[stay] - later, words.ends[stay]
    np.add.at(take, a, 1)
    np.add.at(take, b, -1)
    take = np.cumsum(take[:-1], dtype=np.int8) > 0
    data = np.where(_WORD[words.data], words.data, np.uint8(32))
    upto = np.concatenate([[0], np.cumsum(take)])[words.text_at]
    whole = data[take].tobytes()
    return [whole[x:y] for x, y in zip(upto, upto[1:])]


def _spans(words: Words, gone: np.ndarray) -> list[list[dict]]:
    """Each text's maximal runs of words that are gone, as places of words."""
    out: list[list[dict]] = [[] for _ in range(len(words.word_at) - 1)]
    p = np.flatnonzero(gone)
    if len(p):
        text = np.searchsorted(words.word_at, p, "right") - 1
        cut = _cuts((p[1:] != p[:-1] + 1) | (text[1:] != text[:-1]))
        for first, last in zip(cut, np.append(cut[1:], len(p)) - 1):
            base = int(words.word_at[text[first]])
            out[text[first]].append({"start": int(p[first]) - base, "end": int(p[last]) + 1 - base})
    return out


def remove_repeats(df: DataFrame, key: str, text: str, width: int = WIDTH, with_spans: bool = True) -> DataFrame:
    """Add n_words, n_removed, spans (start and end of each removed run of words) and kept (the other words joined by one blank) to df.

    A word goes if it lies in a run of ``width`` words that some document with a smaller key has as well, both judged on the texts as they are. key holds whole numbers.

    Cases: a null text has no words, and an empty kept; a null key is less than all others; documents of one key don't take words from one another, so
    repeated rows get equal results; texts of fewer words than width stay whole; a run that repeats inside one document only stays; texts of any length are read
    whole; an empty table stays empty; other columns are carried, those with the outputs' names replaced.
    """
    if width < 2:
        raise ValueError("a run has two words at least")
    if key.lower() in OUTPUTS or text.lower() in OUTPUTS:
        raise ValueError(f"rename {key} or {text} first: the result has columns {OUTPUTS}")
    df = df.drop(*OUTPUTS)
    k, th, pieces = fresh(df, "k"), fresh(df, "th"), fresh(df, "pieces")
    marked = df.withColumns({k: F.coalesce(F.col(key).cast("long"), F.lit(NULL_KEY)), th: F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF).cast("long"))})
    # texts of so few bytes have no edge; they skip the join, and with them the null and empty ones, of which there may be many under one key
    short = F.coalesce(F.octet_length(text), F.lit(0)) < 2 * width - 1
    found = repeated_pieces(marked.where(~short).select(F.col(k).alias("k"), F.col(th).alias("th"), F.col(text).alias("text")), width)
    paths = found.groupBy("k", "th").agg(F.collect_list(F.struct("at", "what")).alias(pieces)).select(F.col("k").alias(k), F.col("th").alias(th), pieces)
    # dealt once more, so that the join reads plain shuffles on both sides and may split a hot document's rows
    paths = paths.repartition(k, th)
    whole = _shrunk(marked.where(~short), text).join(paths, [k, th], "left").select(*df.columns, pieces)
    joined = whole.unionByName(_shrunk(marked.where(short), text).select(*df.columns), allowMissingColumns=True)
    place = df.columns.index(text)
    added = [StructField("n_words", LongType()), StructField("n_removed", LongType())]
    added += [StructField("spans", ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())])))] * with_spans + [StructField("kept", StringType())]
    names = [*df.columns, *(f.name for f in added)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            full = zstandard.ZstdDecompressor()
            known = [None if t is None else full.decompress(t).decode() for t in batch.column(place).to_pylist()]
            batch = batch.set_column(place, batch.schema.names[place], pa.array(known, pa.string()))
            texts = [t or "" for t in known]
            every = batch.column(batch.num_columns - 1)
            for a, b in in_chunks(texts):
                words, own, at, edge, _ = edges(texts[a:b], width)
                mine = [None if not every[i].is_valid else (every[i].values.field(0).to_numpy(), every[i].values.field(1).to_numpy()) for i in range(a, b)]
                gone = _covered(words, own, at, edge, mine, width)
                upto = np.concatenate([[0], np.cumsum(gone)])[words.word_at]
                out = [pa.array(np.diff(words.word_at)), pa.array(np.diff(upto))]
                if with_spans:
                    out.append(pa.array(_spans(words, gone), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))
                out.append(pa.array(_kept_texts(words, gone), pa.binary()).cast(pa.string()))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *out], names=names)

    return joined.mapInArrow(tidy(run), StructType([*df.schema.fields, *added]))
