"""Operator 7: language ID with string kernels.

A text is the set of its hashed character 1- to 3-grams; the kernel of two texts is the cosine of their sets (a blended-spectrum presence
kernel). One-versus-rest kernel ridge regression is fitted in the space of Nystroem landmarks. The product of the landmarks and
the coefficients is taken once, so scoring a batch of texts is one product of its presence matrix with (n-grams x languages).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from arborline.llm.common import checkpointed, tidy
from arborline.llm.words import in_chunks, mix64

GRAMS = (1, 2, 3)
DIMENSIONS = 1 << 15
BATCH_TEXTS = 64
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    """languages: sorted names; weights: DIMENSIONS x languages; bias: one a language; sharpness of the scores' softmax."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    sharpness: float = 6.0


def presence(texts: Sequence[str]) -> np.ndarray:
    """A row of 0 and 1 for each text: which hashed n-grams its lower-case form contains."""
    raw = [t.lower().encode("utf-32-le", "surrogatepass") for t in texts]
    codes = np.frombuffer(b"".join(raw), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), [len(r) // 4 for r in raw])
    out = np.zeros((len(texts), DIMENSIONS), np.uint8)
    rolled = np.zeros(len(codes), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        rolled = rolled[: len(codes) - n + 1] * np.uint64(1 << 21) + codes[n - 1 :]
        if n in GRAMS and len(rolled):
            whole = owner[: len(rolled)] == owner[n - 1 :]
            at = (mix64(rolled[whole], 70 + n) >> np.uint64(49)).astype(np.int64)
            out.reshape(-1)[owner[: len(rolled)][whole] * DIMENSIONS + at] = 1
    return out


def score(model: LanguageModel, texts: Sequence[str]) -> np.ndarray:
    """Regression scores, a row a text and a column a language."""
    x = presence(texts).astype(np.float32)
    return x @ model.weights / np.sqrt(np.maximum(x.sum(axis=1), 1))[:, None] + model.bias


def fit(packed: Sequence[bytes], labels: Sequence[str], landmarks: int = 256, ridge: float = 1e-3) -> LanguageModel:
    """Fit on presence rows packed into bits, in an order that does not depend on the label."""
    languages = sorted(set(labels))
    y = np.where(np.array(labels)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    unpack = lambda rows: np.unpackbits(np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1), axis=1).astype(np.float32)
    norm = lambda x: x / np.sqrt(np.maximum(x.sum(axis=1), 1))[:, None]
    marks = norm(unpack(packed[:landmarks]))
    kernel = np.concatenate([norm(unpack(packed[i : i + 128])) @ marks.T for i in range(0, len(packed), 128)]).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel[: len(marks)])
    good = values > values[-1] * 1e-6
    root = vectors[:, good] / np.sqrt(values[good])
    phi = kernel @ root
    weight = 1 / (y > 0).sum(axis=0)[np.argmax(y, axis=1)]
    weight = weight / weight.sum()
    mean, y_mean = weight @ phi, weight @ y
    centred = (phi - mean) * weight[:, None]
    beta = np.linalg.solve(centred.T @ (phi - mean) + ridge * np.eye(phi.shape[1]), centred.T @ (y - y_mean))
    return LanguageModel(languages, (marks.T @ (root @ beta).astype(np.float32)), (y_mean - mean @ beta).astype(np.float32))


def learn(df: DataFrame, key: str, text: str, lang: str, learnable: Column, per_language: int = 400, most_rows: int = 25_600) -> LanguageModel | None:
    """Fit on a bounded sample: of each language the learnable keys with the smallest hashes, one row a key, of texts with a letter.

    Every language is learnt; the driver gets at most per_language rows of 4 kB for each, and most_rows in all: of more than most_rows / per_language
    languages each gets its equal share of them. More languages than most_rows raise ValueError, as such a column names no languages. However often a key
    repeats, of its rows the one with the least presence bits counts.
    """
    whole = df.where(learnable).select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    key, text, lang = "key", "text", "lang"
    there = whole.dropna().where(F.col(text).rlike(r"\p{L}"))
    rank = Window.partitionBy("l").orderBy("h", "k")
    keyed = there.select(F.col(key).alias("k"), F.col(lang).alias("l"), F.xxhash64(F.lit(7), F.col(key)).alias("h")).distinct()
    counts = checkpointed(keyed.groupBy("l").count())
    languages = counts.count()
    if languages > most_rows:
        raise ValueError(f"{languages} labels can't be languages: at most {most_rows} are learnt")
    per_language = min(per_language, most_rows // max(1, languages))
    # of a large language only hashes that can be among the smallest go on: about four times as many as are wanted
    near = F.col("h") / F.lit(2.0**64) + F.lit(0.5) < F.lit(4.0 * per_language) / F.col("count")
    keyed = keyed.join(F.broadcast(counts), "l").where(near)
    chosen = keyed.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= per_language).select("k", "l", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_TEXTS):
                part = batch.slice(at, BATCH_TEXTS)
                bits = [np.packbits(row).tobytes() for row in presence(part.column(2).to_pylist())]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(bits, pa.binary())], names=["l", "h", "bits"])

    rows = there.join(F.broadcast(chosen), (F.col(key) == F.col("k")) & (F.col(lang) == F.col("l"))).select("l", "h", text)
    once = rows.mapInArrow(tidy(run), "l string, h long, bits binary").groupBy("l", "h").agg(F.min("bits").alias("bits"))
    sample = sorted(once.collect(), key=lambda r: (r.h, r.l, r.bits))
    return fit([bytes(r.bits) for r in sample], [r.l for r in sample]) if sample else None


def predict(df: DataFrame, text: str, model: LanguageModel | None) -> DataFrame:
    """Add lang_pred and score (0 to 1) to df. Cases: see identify."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    df = df.drop("lang_pred", "score")
    place = df.columns.index(text)

    def label(texts: list[str | None]) -> tuple[list[str], list[float]]:
        model = shared.value
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        there = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if model else []
        for a, b in in_chunks([texts[i] for i in there]):
            for c in range(a, b, BATCH_TEXTS):
                at = there[c : min(b, c + BATCH_TEXTS)]
                s = np.exp(model.sharpness * score_shifted(model, [texts[i] for i in at]))
                s /= s.sum(axis=1, keepdims=True)
                for i, row in zip(at, s):
                    names[i], scores[i] = model.languages[int(row.argmax())], float(row.max())
        return names, scores

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                names, scores = label(part.column(place).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*part.schema.names, "lang_pred", "score"])

    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    return df.mapInArrow(tidy(run), StructType([*df.schema.fields, *added]))


def score_shifted(model: LanguageModel, texts: Sequence[str]) -> np.ndarray:
    """Scores less each row's largest, safe to exponentiate."""
    s = score(model, texts).astype(np.float64)
    return s - s.max(axis=1, keepdims=True)


def held_out(key: Column) -> Column:
    """Rows never learnt from: crc32 of the key's text is a multiple of 5. A null key is not held out, and not learnt from either."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def identify(df: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """Add lang_pred (a learnt language or ``und``) and score to df, having learnt from df's own rows that aren't held out.

    Cases: a null text and one without a letter are ``und`` with score 0, and so is every text if no row has a language; a null language is
    not learnt from; equal texts get equal predictions, repeated rows too; of equal scores the first language by name stands; texts of any length are read
    whole; an empty table stays empty; more labels than learn allows raise ValueError; other columns are carried, those with the
    outputs' names replaced.
    """
    return predict(df, text, learn(df, key, text, lang, ~held_out(F.col(key))))
