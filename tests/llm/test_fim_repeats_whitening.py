"""Fill-in-middle, removal of repeated passages and whitening against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from arborline.llm import common, fim, packing, queries, substrings, whitening

WHITE = " \t\n\x0b\x0c\r"
CLASH = ("k", "th", "x", "i", "w", "m", "spans", "kept", "n", "form", "output", "component", "whitened", "__k", "__units")


def with_clashes(df):
    return df.withColumns({c: F.lit("x") for c in CLASH})


# ---------------------------------------------------------------- 11


def fim_by_hand(key, text, rate=50, spm=80):
    text = text or ""
    units, i = [], 0
    while i < len(text):
        j = i
        while j < len(text) and text[j] in WHITE:
            j += 1
        while j < len(text) and text[j] not in WHITE:
            j += 1
        units.append(text[i:j])
        i = j
    h = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", text, None, None
    return (len(units), "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)) if h4 % 100 < spm else (len(units), "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m))


@pytest.fixture(scope="module")
def fim_rows():
    r = random.Random(3)
    pool = ["a", "word", "é", "😀x", "<", "<S", "S>", "P>", ">", " ", "  ", "\n", "\t\x0b", " ", " ", "<M", "end."]
    rows = [(i, "".join(r.choice(pool) for _ in range(r.randint(0, 40)))) for i in range(400)]
    return rows + [(1, "twice the same"), (1, "twice the same"), (None, "no key"), (None, None), (900, ""), (901, None), (902, "has <M> in it"), (903, " " * 5000), (904, "long word " * 60_000), (905, "x" * 300_000), (906, "\n")]


def test_fill_in_middle_is_by_hand(spark, fim_rows):
    df = with_clashes(spark.createDataFrame(fim_rows, "id long, t string")).repartition(3)
    out = fim.fill_in_middle(df, "id", "t").withColumn("back", fim.restored(F.col("output"), F.col("form")))
    got = sorted(((r.id, r.t, r.n, r.form, r.output, r.prefix_chars, r.middle_chars) for r in out.collect()), key=repr)
    assert got == sorted(((k, t, *fim_by_hand(k, t)) for k, t in fim_rows), key=repr)
    assert out.where(F.col("back") != F.coalesce("t", F.lit(""))).count() == 0 and out.where("back is null").count() == 0
    assert {r[3] for r in got} == {"plain", "spm", "psm"}
    assert set(CLASH) - {"n", "form", "output"} < set(out.columns)


def test_fill_in_middle_runs_on_columns_only(spark, fim_rows):
    out = fim.fill_in_middle(spark.createDataFrame(fim_rows, "id long, t string"), "id", "t")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Exchange"))
    assert fim.fill_in_middle(spark.createDataFrame([], "id long, t string"), "id", "t").count() == 0


def test_fill_in_middle_other_marks_and_rates(spark, fim_rows):
    marks = fim.Sentinels("[pre]", "[suf]", "[mid]")
    out = fim.fill_in_middle(spark.createDataFrame(fim_rows, "id long, t string"), "id", "t", rate=100, spm_rate=0, marks=marks)
    assert {r[0] for r in out.select("form").distinct().collect()} == {"psm", "plain"}
    assert out.where(F.coalesce("t", F.lit("")) != fim.restored(F.col("output"), F.col("form"), marks)).count() == 0
    for bad in (("", "b", "c"), ("ab", "b", "c"), ("ab", "ba", "c"), ("aXa", "b", "c")):
        with pytest.raises(ValueError):
            fim.Sentinels(*bad)
    with pytest.raises(ValueError):
        fim.fill_in_middle(out, "id", "output")


# ---------------------------------------------------------------- 12


def removed_by_hand(rows, width):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    keys = [substrings.NULL_KEY if k is None else k for k, _ in rows]
    least = {}
    for k, w in zip(keys, words):
        for i in range(len(w) - width + 1):
            run = tuple(w[i : i + width])
            least[run] = min(least.get(run, k), k)
    out = []
    for k, w in zip(keys, words):
        gone = sorted({p for i in range(len(w) - width + 1) if least[tuple(w[i : i + width])] < k for p in range(i, i + width)})
        spans = []
        for p in gone:
            if spans and spans[-1][1] == p:
                spans[-1][1] = p + 1
            else:
                spans.append([p, p + 1])
        out.append((len(w), len(gone), str(spans), " ".join(x for i, x in enumerate(w) if i not in set(gone))))
    return out


def repeat_rows(seed, width):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "😀", " x", "Word", "word"]
    passages = [[r.choice(vocabulary) for _ in range(r.randint(width - 1, 4 * width))] for _ in range(6)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(r.randint(0, 4)):
            words += [r.choice(vocabulary) for _ in range(r.randint(0, 12))]
            words += r.choice(passages)[r.randint(0, 3) :] if r.random() < 0.6 else []
        rows.append((r.choice([None, i, i, i, i // 2]), "".join(w + r.choice([" ", "  ", "\n", "\t "]) for w in words)))
    rows += [(i, "the one common line that stands in every third document of this whole table and no other one here " + f"tail{i}") for i in range(1000, 1060)]
    rows += [(i, f"{i} x y " + " ".join(passages[0]) + f" z {i}") for i in range(2000, 2040)]
    return rows + [(5, "a " * 3000), (6, "a " * 100), (7, None), (8, ""), (None, None), (None, ""), (9, "b c " * 400), (10, "c b " * 30), (3000, "q" * 50_000), *[rows[3]] * 2]


@pytest.mark.parametrize("seed, width, hot", [(1, 13, False), (2, 13, True), (3, 5, False), (4, 2, True), (5, 3, False)])
def test_repeats_are_by_hand(spark, monkeypatch, seed, width, hot):
    """hot: with all documents in the sample, so that common edges are settled by broadcast and common minimisers travel edge by edge."""
    if hot:
        monkeypatch.setattr(substrings, "SAMPLE", 1)
    rows = repeat_rows(seed, width)
    df = with_clashes(spark.createDataFrame(rows, "id long, t string")).repartition(5)
    out = substrings.remove_repeats(df, "id", "t", width)
    got = sorted(((r.id, r.t, r.n_words, r.n_removed, str([[s.start, s.end] for s in r.spans]), r.kept) for r in out.collect()), key=repr)
    assert got == sorted(((*row, *x) for row, x in zip(rows, removed_by_hand(rows, width))), key=repr)
    assert set(CLASH) - {"spans", "kept"} < set(out.columns)


def test_repeats_of_hot_edges_use_both_ways(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SAMPLE", 1)
    rows = repeat_rows(7, 13)
    docs = spark.createDataFrame([(i, 0, t) for i, (_, t) in enumerate(rows) if t], "k long, th long, text string")
    grams, edges = substrings._counted(docs, 13)
    assert len(grams) > 3 and len(edges) > 3
    keys = substrings._smallest_keys(docs, 13, edges)
    sizes = {len(r.w) for r in substrings._pieces(docs, 13, grams, edges, keys).collect()}
    assert substrings.EDGE_BYTES + 1 in sizes and substrings.EDGE_BYTES in sizes


def test_repeats_of_long_texts_and_empty_tables(spark):
    r = random.Random(1)
    base = [f"v{r.randrange(10**6)}" for _ in range(400_000)]
    rows = [(1, " ".join(base[1000:1100])), (2, " ".join(base)), (3, " ".join(base[200_000:]))]
    out = {x.id: x for x in substrings.remove_repeats(spark.createDataFrame(rows, "id int, t string"), "id", "t").collect()}
    assert [out[i].n_removed for i in (1, 2, 3)] == [0, 100, 200_000]
    assert substrings.remove_repeats(spark.createDataFrame([], "id int, t string"), "id", "t").count() == 0
    with pytest.raises(ValueError):
        substrings.remove_repeats(spark.createDataFrame(rows, "id int, t string"), "id", "t", 1)


# ---------------------------------------------------------------- 13


def whitened_by_hand(rows, k, scale=256):
    whole = [(i, np.floor(scale * np.array(v, float)).astype(int)) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.unique(np.array([x for _, x in whole]), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    z = fit - sums / n
    values, vectors = np.linalg.eigh(z.T @ z / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    for i, x in whole:
        for c in range(k):
            yield i, c + 1, n, int(((n * x - sums) ** 2).sum()), abs(float((x - sums / n) @ vectors[:, c] / np.sqrt(values[c]))), values[c] / values.sum()


@pytest.mark.parametrize("shape, falling", [((300, 24), True), ((200, 90), False), ((60, 90), True), ((500, 150), True)])
def test_whitening_is_by_hand(spark, shape, falling):
    r = np.random.default_rng(sum(shape))
    x = r.standard_normal(shape) * (0.93 ** np.arange(shape[1]) if falling else 1.0) + 0.3
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    rows += [(1, rows[0][1])] * 5 + [(None, rows[2][1]), (900, None), (901, [None] * shape[1]), (902, [float("nan")] * shape[1]), (903, [float("inf")] + [0.0] * (shape[1] - 1)), (904, []), (905, [1.0])]
    df = with_clashes(spark.createDataFrame(rows, "id long, v array<double>")).repartition(3)
    out = whitening.whiten(df, "v").collect()
    want = list(whitened_by_hand([row for row in rows if row[0] not in (904, 905)], 4))
    assert len(out) == len(want) and all(len({a.x for a in out}) == 1 for _ in out[:1])
    key = lambda t: (-1 if t[0] is None else t[0], t[1], t[2], t[3])
    for got, exp in zip(sorted(((a.id, a.component, a.n, a.deviation, abs(a.whitened), a.explained) for a in out), key=key), sorted(want, key=key)):
        assert got[:4] == exp[:4] and got[4] == pytest.approx(exp[4], abs=1e-8) and got[5] == pytest.approx(exp[5], rel=1e-9)
    assert len({a.identity_error for a in out}) == 1 and out[0].identity_error < 1e-9


def test_whitening_certifies_its_components(spark):
    """On a falling spectrum the block stays smaller than the space, and the residuals of the components are those of rounding."""
    r = np.random.default_rng(5)
    x = np.floor(1000 * r.standard_normal((400, 120)) * 0.8 ** np.arange(120)).astype(int)
    fit = spark.createDataFrame([(v,) for v in x.tolist()], "x array<long>")
    found = whitening.components(fit, 4)
    z = x - x.mean(axis=0)
    assert np.linalg.norm(z.T @ (z @ found.vectors.T) / len(x) - found.vectors.T * found.values, axis=0).max() < 1e-12 * found.values[0]
    assert found.passes < 20 and found.values == pytest.approx(np.linalg.eigvalsh(z.T @ z / len(x))[::-1][:4], rel=1e-11)


def test_whitening_without_variance(spark):
    empty = spark.createDataFrame([], "id long, v array<float>")
    assert whitening.whiten(empty, "v").count() == 0
    equal = spark.createDataFrame([(1, [1.0, 2.0])] * 3, "id long, v array<double>")
    assert whitening.whiten(equal, "v").count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(4)], "id long, v array<double>")
    assert sorted({r.component for r in whitening.whiten(line, "v").collect()}) == [1]
    large = spark.createDataFrame([(i, [4e15 * i, 1.0]) for i in range(3)], "id long, v array<double>")
    with pytest.raises(Exception, match="64 bits|out of bounds|overflow|too large|int too big"):
        whitening.whiten(large, "v").collect()


# ---------------------------------------------------------------- packing of odd texts


@pytest.mark.parametrize("blank", [" ", "\t", "\n"])
def test_packing_of_millions_of_blanks(spark, blank):
    """Texts at which the fast encoder stops; in the operator and in the pipeline's stage."""
    from tokenizers import Tokenizer

    path = queries.tokenizer_file("byte_bpe_50k.json")
    text = blank * 2_000_000
    want = [*Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, 2]
    df = spark.createDataFrame([(1, text, "en", "a", len(text))], "doc_id long, text string, lang string, source string, n_chars long")
    for out in (packing.pack_documents(df, "doc_id", "text", path), corpus_pipeline.pack(spark, df, "")):
        rows = sorted(out.select("piece", "ids").collect())
        assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in rows]).tolist() == want


def test_equal_rows_are_ranked_in_several_parts(spark, monkeypatch):
    """A third of all rows have neither key nor text; no part of their length holds them all."""
    monkeypatch.setattr(packing, "PART_ROWS", 20)
    rows = [(None, None)] * 400 + [(i, f"some words {i}") for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    largest = []
    real = common.gapless_rank

    def watch(pieces, groups, bucket, order, out):
        largest.append(pieces.where("length = 1").groupBy(bucket.alias("b")).count().agg(F.max("count")).first()[0])
        return real(pieces, groups, bucket, order, out)

    monkeypatch.setattr(packing, "gapless_rank", watch)
    out = packing.pack_documents(df, "doc_id", "text", queries.tokenizer_file("byte_bpe_50k.json"), keep_ids=False)
    got = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"), F.count_distinct("offset").alias("places"), F.count(F.lit(1)).alias("pieces")).collect()
    assert sum(r.pieces for r in got) == 1200 and all(r.n == r.end <= 1024 and r.places == r.pieces for r in got)
    assert largest[0] < 200
