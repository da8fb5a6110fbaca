"""Operator 9: licence scans by a trained paragraph classifier, with DataFrame functions only on the data's path.

A paragraph is a run of lines without a blank line between them; line breaks inside it don't matter, so wrapped notices stay whole. It is
read in windows of ``WINDOW`` words that overlap by half. Sparse word 1- to 3-grams feed a multinomial logistic regression over licence
families, an unknown class (other licences) and a class of text that licenses nothing, calibrated by a temperature and offsets of the last
two on held-out examples. A family stands if it beats both of them and one of its templates lies in the window. Every paragraph is
scored; a window without any n-gram of the model has the bias alone, which is text that licenses nothing. The model is
fitted on the driver on variants of the texts in ``license_texts``, a fixed set.
"""

from __future__ import annotations

import functools
import json
import math
import random
import re
import zlib
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborline.llm.common import fresh
from arborline.llm.license_texts import CALIBRATION, NAMES, NO_LICENSE, OTHER_LICENSES, PASSAGES, STOP_WORDS

UNKNOWN, NONE = "unknown", "none"
#: Share of a passage's n-grams that has to be there; of a name all have to.
CONFIRM = 0.8
WINDOW, STRIDE = 64, 32
_SIZES = (1, 2, 3)
_WORD_BUCKETS, _GRAM_BUCKETS = 4096, 8192
_PARAGRAPHS = "\n[ \t\r]*\n"
#: Scores are whole numbers of this part, so that sums are the same in any order.
_UNIT = 1000


def words_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def is_feature(gram: Iterable[str]) -> bool:
    return not all(w in STOP_WORDS or w.isdigit() for w in gram)


def grams_of(text: str) -> list[str]:
    """The distinct n-grams of a text that can be features."""
    words = words_of(text)
    return sorted({" ".join(words[i : i + n]) for n in _SIZES for i in range(len(words) - n + 1) if is_feature(words[i : i + n])})


@dataclass(frozen=True)
class Template:
    """family: a class number; need: how many of the n-grams a window must hold; must: those among them without which it doesn't count."""

    family: int
    grams: list[str]
    need: int
    must: list[str]


@dataclass(frozen=True)
class LicenseModel:
    """classes: families, unknown, none; weights: n-gram -> a whole number a class; bias."""

    classes: list[str]
    weights: dict[str, list[int]]
    bias: list[int]
    templates: list[Template]


def _spellings(text: str) -> list[str]:
    """The text, and with the other usual spelling of the word license if it has it."""
    return [text] + [re.sub("(?i)licens", "Licenc", text)] * bool(re.search("(?i)licens", text))


def templates(classes: list[str]) -> list[Template]:
    out = []
    for family, names in NAMES.items():
        for name in names:
            out += [Template(classes.index(family), g, len(g), []) for g in map(grams_of, _spellings(name))]
    for family, passages in PASSAGES.items():
        for text, must in passages:
            g = grams_of(text)
            out.append(Template(classes.index(family), g, math.ceil(CONFIRM * len(g)), list(must)))
    return out


def _examples(seed: int) -> list[tuple[str, str]]:
    """(text, class): every notice as it stands and in variants with other words around it and some words lost."""
    r = random.Random(seed)
    plain = [w for s in NO_LICENSE for w in words_of(s)]
    spare = plain + ["this", "file", "project", "software", "data", "code", "2019", "2021", "copyright", "author", "work", "released", "under", "licensed", "distributed", "terms", "see", "the"]
    leads = ("", "licensed under the", "released under the", "distributed under the terms of the", "this project is licensed under the", "this work is licensed under a", "available under", "code is", "under the", "license", "dedicated under")
    family = [(t, f) for f, ts in NAMES.items() for n in ts for t in _spellings(n)] + [(t, f) for f, ts in PASSAGES.items() for t, _ in ts]
    out = []
    for text, label in [*family, *[(t, UNKNOWN) for n in OTHER_LICENSES for t in _spellings(n)], *[(t, NONE) for t in NO_LICENSE]]:
        words = words_of(text)
        for k in range(12 if label != NONE else 8):
            kept = words
            if k and label != NONE:
                kept = [w for w in words if r.random() > 0.04] if len(words) > 8 else words
                kept = words_of(r.choice(leads)) + kept
            if k > 1:
                kept = [r.choice(spare) for _ in range(r.randint(0, 12))] + kept + [r.choice(spare) for _ in range(r.randint(0, 12))]
            out.append((" ".join(kept), label))
    for k in range(600):
        few = r.sample(plain, r.randint(1, 6))
        out.append((" ".join(few if k % 2 else (r.choice(plain) for _ in range(r.randint(8, 50)))), NONE))
    # single words of notices, however often they occur elsewhere, license nothing
    out += [(w, NONE) for w in sorted({w for t, _ in family for w in words_of(t)}) for _ in range(2)]
    return out


def _softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@functools.cache
def train(seed: int = 3, rounds: int = 250, ridge: float = 2e-4, rate: float = 6.0) -> LicenseModel:
    """Fit on the examples, calibrate on texts that are no variants of theirs."""
    classes = [*NAMES, UNKNOWN, NONE]
    made = [(grams_of(t), classes.index(f)) for t, f in _examples(seed)]
    fit_on, held = made, [(grams_of(t), classes.index(f)) for t, f in CALIBRATION]
    sources = [*(t for ts in NAMES.values() for n in ts for t in _spellings(n)), *(t for ts in PASSAGES.values() for t, _ in ts), *(t for n in OTHER_LICENSES for t in _spellings(n)), *NO_LICENSE]
    known = sorted({g for t in sources for g in grams_of(t)})
    column = {g: i for i, g in enumerate(known)}

    def matrix(rows: list) -> tuple[np.ndarray, np.ndarray]:
        x = np.zeros((len(rows), len(known)), np.float32)
        for i, (gs, _) in enumerate(rows):
            x[i, [column[g] for g in gs if g in column]] = 1
        return x, np.eye(len(classes), dtype=np.float32)[[y for _, y in rows]]

    x, y = matrix(fit_on)
    w, b = np.zeros((len(known), len(classes)), np.float32), np.zeros(len(classes), np.float32)
    b[-1] = 1.0
    step_w, step_b = np.zeros_like(w), np.zeros_like(b)
    for _ in range(rounds):
        miss = (_softmax(x @ w + b) - y) / len(x)
        step_w = 0.9 * step_w - rate * 0.1 * (x.T @ miss + ridge * w)
        step_b = 0.9 * step_b - rate * 0.1 * miss.sum(axis=0)
        w, b = w + step_w, b + step_b
    x, y = matrix(held)
    raw = (x @ w + b).astype(float)
    away = np.eye(len(classes))[-2:]
    trials = ((t, u, n) for t in (0.7, 1.0, 1.5, 2.0, 3.0) for u in (-1.0, -0.5, 0.0, 0.5) for n in (-0.5, 0.0, 0.5, 1.0, 1.5))
    _, t, u, n = min((-np.log((_softmax((raw + u * away[0] + n * away[1]) * t) * y).sum(axis=1) + 1e-12).mean(), t, u, n) for t, u, n in trials)
    whole = lambda v: [round(float(a) * t * _UNIT) for a in v]
    return LicenseModel(classes, {g: whole(w[i]) for g, i in column.items()}, whole(b + u * away[0] + n * away[1]), templates(classes))


# ---------------------------------------------------------------- the model as constants of a plan


@dataclass(frozen=True)
class _Tables:
    """Words in buckets by crc32, n-grams (numbers made of their words' numbers) in buckets by remainder, with their weights beside them."""

    words: list[list[str]]
    base: int
    keys: list[list[int]]
    weights: list[list[list[int]]]
    templates: list[dict]


def _tables(model: LicenseModel) -> _Tables:
    words: list[list[str]] = [[] for _ in range(_WORD_BUCKETS)]
    for w in sorted({w for g in [*model.weights, *(g for t in model.templates for g in t.grams)] for w in g.split()}):
        words[zlib.crc32(w.encode()) % _WORD_BUCKETS].append(w)
    number = {w: k * _WORD_BUCKETS + h + 1 for h, bucket in enumerate(words) for k, w in enumerate(bucket)}
    base = max(number.values()) + 1
    key = lambda g: functools.reduce(lambda a, w: a * base + number[w], g.split(), 0)
    keys: list[list[int]] = [[] for _ in range(_GRAM_BUCKETS)]
    weights: list[list[list[int]]] = [[] for _ in range(_GRAM_BUCKETS)]
    for g, w in model.weights.items():
        keys[key(g) % _GRAM_BUCKETS].append(key(g))
        weights[key(g) % _GRAM_BUCKETS].append(w)
    return _Tables(words, base, keys, weights, [{"c": t.family, "g": [key(g) for g in t.grams], "n": t.need, "m": [key(g) for g in t.must]} for t in model.templates])


def _constant(value: object, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)


def _bound(value: Column, body) -> Column:
    """body(value) with value computed once: a lambda's argument, not an expression repeated wherever body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _window_keys(paragraph: Column, tables: _Tables) -> Column:
    """For each window of a paragraph the distinct n-grams of the model in it, in an array of arrays."""
    buckets, keys = _constant(tables.words, "array<array<string>>"), _constant(tables.keys, "array<array<bigint>>")
    bucket_of = lambda w: (F.crc32(w) % F.lit(_WORD_BUCKETS)).cast("int")
    place = lambda w: F.array_position(F.element_at(buckets, bucket_of(w) + F.lit(1)), w)
    number = lambda w: _bound(place(w), lambda p: F.when(p > 0, (p - F.lit(1)) * F.lit(_WORD_BUCKETS) + bucket_of(w) + F.lit(1)).otherwise(F.lit(0).cast("long")))
    numbers = F.transform(F.regexp_extract_all(F.lower(paragraph), F.lit("[a-z0-9]+"), F.lit(0)), number)
    base = F.lit(tables.base).cast("long")
    there = lambda k: F.array_contains(F.element_at(keys, (k % F.lit(_GRAM_BUCKETS)).cast("int") + F.lit(1)), k)

    def grams(part: Column) -> Column:
        """N-grams that begin at the first STRIDE words of a part."""
        at = F.filter(F.sequence(F.lit(0), F.lit(STRIDE - 1)), lambda i: F.coalesce(F.get(part, i) > 0, F.lit(False)))

        def from_(i: Column) -> Column:
            one, two = F.get(part, i), F.get(part, i + F.lit(1))
            pair = F.when(two > 0, one * base + two)
            three = lambda k: F.when(F.get(part, i + F.lit(2)) > 0, k * base + F.get(part, i + F.lit(2)))
            return F.when(two > 0, _bound(pair, lambda k: F.array(one, k, three(k)))).otherwise(F.array(one))

        return F.filter(F.flatten(F.transform(at, from_)), lambda k: F.when(k.isNotNull(), there(k)).otherwise(F.lit(False)))

    def windows(ids: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.greatest(F.size(ids), F.lit(1)) - F.lit(1)) / F.lit(STRIDE)).cast("int"))
        parts = F.transform(starts, lambda c: _bound(F.slice(ids, c * F.lit(STRIDE) + F.lit(1), STRIDE + 2), grams))
        none = F.array().cast("array<bigint>")
        return _bound(parts, lambda ps: F.transform(ps, lambda p, c: F.array_distinct(F.concat(p, F.coalesce(F.get(ps, c + F.lit(1)), none)))))

    return F.filter(_bound(numbers, windows), lambda w: F.size(w) > 0)


def _judged(keys_: Column, model: LicenseModel, tables: _Tables) -> Column:
    """(families: array of (family, p), unknown) of one window's n-grams."""
    n = len(model.classes)
    keys, weights = _constant(tables.keys, "array<array<bigint>>"), _constant(tables.weights, "array<array<array<int>>>")
    slot = lambda k: (k % F.lit(_GRAM_BUCKETS)).cast("int") + F.lit(1)
    row = lambda k: F.element_at(F.element_at(weights, slot(k)), F.array_position(F.element_at(keys, slot(k)), k).cast("int"))
    scores = F.aggregate(keys_, _constant(model.bias, "array<int>"), lambda a, k: F.zip_with(a, row(k), lambda x, y: x + y))
    known = _constant(tables.templates, "array<struct<c:int,g:array<bigint>,n:int,m:array<bigint>>>")

    def judge(s: Column) -> Column:
        unknown, none = F.element_at(s, n - 1), F.element_at(s, n)
        floor = F.greatest(unknown, none)
        own = lambda t: F.element_at(s, t["c"] + F.lit(1))
        holds = lambda t: (own(t) > floor) & (F.size(F.array_intersect(t["g"], keys_)) >= t["n"]) & (F.size(F.array_intersect(t["m"], keys_)) == F.size(t["m"]))
        p = lambda t: F.lit(1.0) / (F.lit(1.0) + F.exp((unknown - own(t)) / F.lit(float(_UNIT))) + F.exp((none - own(t)) / F.lit(float(_UNIT))))
        found = F.transform(F.filter(known, holds), lambda t: F.struct(t["c"].alias("c"), p(t).alias("p")))
        speaks = F.array_max(s) > none
        empty = F.array().cast("array<struct<c:int,p:double>>")
        return F.struct(F.when(speaks, found).otherwise(empty).alias("families"), speaks.alias("speaks"))

    return _bound(scores, judge)


def scan_licenses(df: DataFrame, text: str) -> DataFrame:
    """Add license, n_licensed, n_unknown, probability to df, row by row.

    license: the sorted families that stand in a text, comma-joined; ``unknown`` if some of its windows speak of a licence and none stands; else
    ``none``. n_licensed: paragraphs in which a family stands; n_unknown: other paragraphs that speak of a licence. probability: the highest
    of a standing family against the unknown class and none, to six places, or null.

    Cases: null and empty texts are ``none``; repeated rows get equal results; equal scores don't beat each other, so a tie of a family
    with the unknown class is unknown; an empty table stays empty; other columns are carried, those with the outputs' names replaced; only
    ASCII letters and digits make words; a text or line of any length is read whole, in time in proportion to it; an n-gram
    that begins in a window counts there, though it ends up to two words later.
    """
    df = df.drop("license", "n_licensed", "n_unknown", "probability")
    model = train()
    tables = _tables(model)
    body = F.coalesce(F.col(text), F.lit(""))

    def paragraph(x: Column) -> Column:
        windows = F.transform(_window_keys(x, tables), lambda w: _judged(w, model, tables))
        return _bound(windows, lambda ws: F.struct(F.flatten(F.transform(ws, lambda w: w["families"])).alias("families"), F.exists(ws, lambda w: w["speaks"]).alias("speaks")))

    names = F.array(*[F.lit(c) for c in model.classes])

    def summed(ps: Column) -> Column:
        families = F.flatten(F.transform(ps, lambda p: p["families"]))
        label = F.array_join(F.array_sort(F.array_distinct(F.transform(families, lambda f: F.element_at(names, f["c"] + F.lit(1))))), ",")
        licensed = F.size(F.filter(ps, lambda p: F.size(p["families"]) > 0))
        unknown = F.size(F.filter(ps, lambda p: p["speaks"] & (F.size(p["families"]) == 0)))
        highest = F.round(F.array_max(F.transform(families, lambda f: f["p"])), 6)
        return F.struct(F.when(licensed > 0, label).when(unknown > 0, F.lit(UNKNOWN)).otherwise(F.lit(NONE)).alias("license"), licensed.alias("n_licensed"), unknown.alias("n_unknown"), highest.alias("probability"))

    result = fresh(df, "result")
    found = _bound(F.transform(F.split(body, _PARAGRAPHS), paragraph), summed)
    return df.withColumn(result, found).select(*[F.col(f"`{c}`") for c in df.columns], f"{result}.*")


def sql(documents: str = "documents") -> str:
    """The same scan in DuckDB SQL for documents with distinct keys, with the trained weights as a JSON constant: doc_id, license, n_licensed, n_unknown, probability."""
    model = train()
    n = len(model.classes)
    quote = lambda v: json.dumps(v).replace("'", "''")
    joined = ", ".join(f"CASE WHEN i + {k} < len(w) THEN array_to_string(w[i + 1 : i + {k + 1}], ' ') END" for k in range(len(_SIZES)))
    scores = ", ".join(f"{b} + sum(v[{i + 1}])" for i, b in enumerate(model.bias))
    names = "[" + ", ".join(f"'{c}'" for c in model.classes) + "]"
    return f"""
WITH weights AS (SELECT key AS g, value::BIGINT[] AS v FROM json_each('{quote(model.weights)}')),
templates AS (SELECT key AS t, (value->>'c')::INTEGER AS c, (value->'g')::VARCHAR[] AS gs, (value->>'n')::INTEGER AS need, (value->'m')::VARCHAR[] AS must
  FROM json_each('{quote([{"c": t.family, "g": t.grams, "n": t.need, "m": t.must} for t in model.templates])}')),
paragraphs AS (SELECT doc_id, pos, regexp_extract_all(lower(p), '[a-z0-9]+') AS w FROM (SELECT doc_id, regexp_split_to_array(coalesce(text, ''), '\\n[ \\t\\r]*\\n') AS ps FROM {documents}) d, unnest(ps) WITH ORDINALITY u(p, pos)),
begun AS (SELECT doc_id, pos, i // {STRIDE} AS k, unnest([{joined}]) AS g FROM (SELECT *, unnest(range(len(w))) AS i FROM paragraphs)),
hits AS (SELECT DISTINCT doc_id, pos, k, g FROM begun JOIN weights USING (g)),
windows AS (SELECT DISTINCT h.doc_id, h.pos, x.k, g FROM hits h, (SELECT unnest([0, -1]) AS o) s, LATERAL (SELECT h.k + s.o AS k) x WHERE x.k >= 0),
scored AS (SELECT doc_id, pos, k, list(g) AS gs, [{scores}] AS s FROM windows JOIN weights USING (g) GROUP BY ALL),
speaking AS (SELECT *, greatest(s[{n - 1}], s[{n}]) AS bar FROM scored WHERE list_max(s) > s[{n}]),
standing AS (SELECT doc_id, pos, c, 1 / (1 + exp((s[{n - 1}] - s[c + 1]) / {_UNIT}.0::DOUBLE) + exp((s[{n}] - s[c + 1]) / {_UNIT}.0::DOUBLE)) AS p FROM speaking x, templates t
  WHERE s[c + 1] > bar AND len(list_intersect(t.gs, x.gs)) >= need AND list_has_all(x.gs, must)),
per AS (SELECT doc_id, pos, count(c) > 0 AS yes FROM (SELECT DISTINCT doc_id, pos FROM speaking) LEFT JOIN standing USING (doc_id, pos) GROUP BY ALL),
counted AS (SELECT doc_id, count_if(yes) AS yes, count_if(NOT yes) AS no FROM per GROUP BY ALL),
named AS (SELECT doc_id, string_agg(DISTINCT ({names})[c + 1], ',' ORDER BY ({names})[c + 1]) AS fs, round(max(p), 6) AS p FROM standing GROUP BY ALL)
SELECT doc_id, CASE WHEN yes > 0 THEN fs WHEN no > 0 THEN '{UNKNOWN}' ELSE '{NONE}' END AS license, coalesce(yes, 0)::INTEGER AS n_licensed, coalesce(no, 0)::INTEGER AS n_unknown, p AS probability
FROM {documents} LEFT JOIN counted USING (doc_id) LEFT JOIN named USING (doc_id)
"""
