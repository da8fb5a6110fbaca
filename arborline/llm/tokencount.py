"""Operator 10: token counts by a linear longest-match automaton (Song et al., 2021).

The vocabulary is a trie. Each node has a failure link, to the node that matching goes on from when no edge fits, and the number of
tokens popped by following it. A word is read once, a character at a time; only counts are kept, pieces are never built.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from arborline.llm.common import tidy

#: The published split of byte-level vocabularies into words; fixed value.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SHIFT = 21  # bits of a code point
_MEMO_WORDS, _MEMO_CHARS = 200_000, 64


@dataclass
class Automaton:
    """edges: (node << 21 | code) -> node; fail: -1 where nothing can follow; pops: tokens popped on failing; rest: the node after a whole token."""

    edges: dict[int, int]
    fail: list[int]
    pops: list[int]
    rest: int

    def count(self, codes: Iterable[int]) -> int:
        """Pieces of one word by greedy longest match; a word that can't be spelt counts as one unknown token."""
        edges, fail, pops = self.edges, self.fail, self.pops
        node = n = 0
        for c in codes:
            while (to := edges.get(node << _SHIFT | c)) is None:
                if fail[node] < 0:
                    return 1
                n += pops[node]
                node = fail[node]
            node = to
        while node not in (0, self.rest):
            if fail[node] < 0:
                return 1
            n += pops[node]
            node = fail[node]
        return n


def build(tokens: Iterable[bytes | str], prefix: bytes | str = b"") -> Automaton:
    """The automaton of a vocabulary; tokens that begin with ``prefix`` go on a word, the others begin one (no prefix: both)."""
    edges: dict[int, int] = {}
    size = 1 if not prefix else 2
    rest = size - 1
    ends = set()
    for token in tokens:
        inner = bool(prefix) and token.startswith(prefix)
        node = rest if inner else 0
        codes = token[len(prefix) :] if inner else token
        for c in codes if isinstance(codes, bytes) else map(ord, codes):
            key = node << _SHIFT | c
            if key not in edges:
                edges[key] = size
                size += 1
            node = edges[key]
        if node > rest:
            ends.add(node)
    below: dict[int, list[tuple[int, int]]] = {}
    for key, to in edges.items():
        below.setdefault(key >> _SHIFT, []).append((key & (1 << _SHIFT) - 1, to))
    fail, pops = [-1] * size, [0] * size
    queue = deque(range(rest + 1))
    while queue:
        u = queue.popleft()
        for c, v in below.get(u, ()):
            if v in ends:
                fail[v], pops[v] = rest, 1
            else:
                z, n = fail[u], pops[u]
                while z >= 0 and (z << _SHIFT | c) not in edges:
                    n += pops[z]
                    z = fail[z]
                if z >= 0:
                    fail[v], pops[v] = edges[z << _SHIFT | c], n
            queue.append(v)
    return Automaton(edges, fail, pops, rest)


def byte_vocabulary(path: str) -> list[bytes]:
    """The tokens of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


class _Memo(dict):
    """Counts of words already seen by this task, at most _MEMO_WORDS short ones."""

    def __init__(self, automaton: Automaton) -> None:
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        n = self.automaton.count(word.encode("utf-8", "surrogatepass"))
        if len(word) <= _MEMO_CHARS:
            if len(self) >= _MEMO_WORDS:
                self.clear()
            self[word] = n
        return n


def count_tokens(df: DataFrame, text: str, vocabulary_file: str, pattern: str = WORD_PATTERN) -> DataFrame:
    """Add n_words (pieces of the pattern) and n_tokens (greedy longest-match tokens of their bytes) to df.

    Cases: a null text has null counts, an empty one none; repeated rows get equal counts, texts of any length are read whole; a word with a byte outside the vocabulary is one token; an empty table
    stays empty; other columns are carried, those with the outputs' names replaced. The vocabulary is read on the
    driver and its automaton broadcast: its size doesn't follow the data.
    """
    df = df.drop("n_words", "n_tokens")
    shared = df.sparkSession.sparkContext.broadcast(build(byte_vocabulary(vocabulary_file)))
    place = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Memo(shared.value)
        split = regex.compile(pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                words, tokens = [], []
                for t in part.column(place).to_pylist():
                    found = None if t is None else split.findall(t)
                    words.append(None if found is None else len(found))
                    tokens.append(None if found is None else sum(map(memo.__getitem__, found)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=[*part.schema.names, "n_words", "n_tokens"])

    return df.mapInArrow(tidy(run), StructType([*df.schema.fields, StructField("n_words", LongType()), StructField("n_tokens", LongType())]))
