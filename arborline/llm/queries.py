"""The registered queries of this subpackage, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborline.llm import fim, imatch, jaccard, langid, license, mixing, packing, pii, sharding, substrings, tokencount, topk, whitening
from arborline.llm.common import table

SHARDS = 8
WIDTH, THRESHOLD = 5, 0.8
CAPACITY = 1024
END_ID = 2
MIX_SEED, MIX_ALPHA = 17, 0.5
TOP_K, SCALE, QUERY_EVERY = 10, 1024, 100
FIM_SEED, FIM_RATE, SPM_RATE = 42, 50, 80
REPEAT_WIDTH = 13
WHITE_SCALE, COMPONENTS = 256, 4


def tokenizer_file(name: str) -> str:
    """The path of a public tokenizer file for the queries; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_jump_hash_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    sized = docs.select("doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"))
    return sharding.shard(sized, "doc_id", SHARDS, F.col("text_crc32")).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, sf_dir, "documents"), "doc_id", "text", WIDTH, THRESHOLD)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    packed = packing.pack_documents(docs, "doc_id", "text", tokenizer_file("byte_bpe_50k.json"), CAPACITY, END_ID, keep_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return mixing.mix(docs, "doc_id", "source", F.octet_length(F.coalesce("text", F.lit(""))) + F.lit(1), alpha=MIX_ALPHA, seed=MIX_SEED)


def op5_histogram_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % QUERY_EVERY == 0, TOP_K, SCALE)


def op6_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprint_edits(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")


def op7_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs, "doc_id", "text", "lang").select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    number = lambda k: F.size(F.filter("base_spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    named = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select("doc_id", *map(number, pii.KINDS), F.sha2(named("base_spans"), 256).alias("base_sha256"), named("spans").alias("spans"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license.scan_licenses(docs, "text").select("doc_id", "license", "n_licensed", "n_unknown", "probability")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokencount.count_tokens(docs, "text", tokenizer_file("byte_bpe_50k.tiktoken")).select("doc_id", "n_words", "n_tokens")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = fim.fill_in_middle(docs, "doc_id", "text", FIM_SEED, FIM_RATE, SPM_RATE)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substrings.remove_repeats(docs, "doc_id", "text", REPEAT_WIDTH)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(rows, "embedding", COMPONENTS, WHITE_SCALE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_jump_hash_sharding, op2_ngram_jaccard_join, op3_best_fit_packing, op4_mix_sources, op5_histogram_top_k,
        op6_imatch_fingerprints, op7_string_kernel_language, op8_semi_markov_pii, op9_license_scan, op10_token_counts,
        op11_fill_in_middle, op12_substring_dedup, op13_embedding_whitening,
    )
    return {f.__name__: f for f in every}


SQL_OP1 = f"""
WITH RECURSIVE crc_step(i, k, c) AS (
  SELECT i, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_step WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc_step WHERE k = 8),
sized AS (
  SELECT doc_id, coalesce(doc_id, 0)::UHUGEINT AS key, octet_length(encode(coalesce(text, ''))) + 1 AS size,
    xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS text_crc32
  FROM documents, crc_table),
jump(key, s, b, j) AS (
  SELECT DISTINCT key, key, 0::BIGINT, 0::BIGINT FROM sized
  UNION ALL
  SELECT key, n, j, floor((j + 1)::DOUBLE * (2147483648::DOUBLE / ((n // 8589934592)::BIGINT + 1)::DOUBLE))::BIGINT
  FROM (SELECT key, b, j, (s * 2862933555777941757::UHUGEINT + 1) % 18446744073709551616::UHUGEINT AS n FROM jump WHERE j < 9)),
placed AS (
  SELECT key, max(j) FILTER (WHERE j < 8)::INTEGER AS shard, max(j) FILTER (WHERE j < 9)::INTEGER AS grown_shard FROM jump GROUP BY key),
part AS (
  SELECT *, ((key * 2862933555777941757::UHUGEINT + 1) % 18446744073709551616::UHUGEINT) // 72057594037927936 * {sharding.SPREAD} + text_crc32 % {sharding.SPREAD} AS bucket FROM sized JOIN placed USING (key))
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id) - 1 AS slot, grown_shard
FROM part
"""

SQL_OP2 = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, text, regexp_extract_all(lower(text), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents WHERE text IS NOT NULL),
shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {WIDTH} THEN list_transform(range(1, len(w) - {WIDTH} + 2), lambda i: array_to_string(w[i : i + {WIDTH} - 1], ' '))
    WHEN len(w) > 0 THEN ['words ' || array_to_string(w, ' ')] ELSE ['text ' || text] END) AS s FROM split),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM common JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE c >= {THRESHOLD} * (p.n + q.n - c) - 1e-9),
way AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(x, y) AS (SELECT x, y FROM way UNION SELECT r.x, w.y FROM reach r JOIN way w ON r.y = w.x)
SELECT doc_id, least(doc_id, (SELECT min(y) FROM reach WHERE reach.x = d.doc_id)) AS class_id, (SELECT count(*) FROM way WHERE way.x = d.doc_id) AS n_links
FROM documents d
"""

SQL_OP4 = f"""
WITH RECURSIVE own AS (
  SELECT source, sum(octet_length(encode(coalesce(text, ''))) + 1)::DOUBLE AS n FROM documents GROUP BY source),
rates AS (
  SELECT source, round(pow(n, {MIX_ALPHA}) * (sum(n) OVER () / sum(pow(n, {MIX_ALPHA})) OVER ()) / n, 9) AS rate FROM own),
shared AS (SELECT source, greatest(ceil(rate / {mixing.MOST_RATE}), 1)::INTEGER AS parts, rate / greatest(ceil(rate / {mixing.MOST_RATE}), 1) AS rate FROM rates),
cdf(source, rate, k, l, c) AS (
  SELECT source, rate, 0, -rate, exp(-rate) FROM shared
  UNION ALL
  SELECT source, rate, k + 1, l + ln(rate) - ln(k + 1), c + exp(l + ln(rate) - ln(k + 1)) FROM cdf WHERE k < ceil(rate + 12 * sqrt(rate) + 30)),
drawn AS (
  SELECT doc_id, text, lang, source, n_chars, ('0x' || substr(md5('{MIX_SEED}|' || coalesce(doc_id::VARCHAR, '\\N') || CASE WHEN part > 0 THEN '|' || part ELSE '' END), 1, 13))::BIGINT::DOUBLE / 4503599627370496 AS u
  FROM (SELECT d.*, unnest(range(parts)) AS part FROM documents d JOIN shared s ON s.source IS NOT DISTINCT FROM d.source)),
counted AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, count(*) AS times
  FROM drawn d JOIN cdf ON cdf.source IS NOT DISTINCT FROM d.source AND cdf.c <= d.u GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy,
  md5('{MIX_SEED}-order|' || coalesce(doc_id::VARCHAR, '\\N') || '|' || copy) AS mix_key
FROM (SELECT *, unnest(range(times)) AS copy FROM counted)
"""


SQL_OP5 = f"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % {QUERY_EVERY} = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= {TOP_K}
"""


_HEX = lambda k: f"('0x' || substr(digest, {8 * k + 1}, 8))::BIGINT"
SQL_OP11 = f"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS u,
    sha256('{FIM_SEED}:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
drawn AS (
  SELECT *, least({_HEX(0)} % (len(u) + 1), {_HEX(1)} % (len(u) + 1)) AS low, greatest({_HEX(0)} % (len(u) + 1), {_HEX(1)} % (len(u) + 1)) AS high,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR {_HEX(2)} % 100 >= {FIM_RATE} THEN 'plain' WHEN {_HEX(3)} % 100 < {SPM_RATE} THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (SELECT *, array_to_string(u[1:low], '') AS p, array_to_string(u[low + 1:high], '') AS m, array_to_string(u[high + 1:], '') AS s FROM drawn)
SELECT doc_id, len(u)::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts
"""

SQL_OP12 = f"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, {substrings.NULL_KEY}) AS k, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
g AS (
  SELECT r, k, i, array_to_string(ws[i:i + {REPEAT_WIDTH - 1}], ' ') AS s FROM (SELECT *, unnest(range(1, len(ws) - {REPEAT_WIDTH - 2})) AS i FROM w WHERE len(ws) >= {REPEAT_WIDTH})),
least_key AS (SELECT s, min(k) AS m FROM g GROUP BY s HAVING min(k) < max(k)),
gone AS (SELECT DISTINCT r, unnest(range(i, i + {REPEAT_WIDTH})) AS p FROM g JOIN least_key USING (s) WHERE m < k),
each AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM each ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (r)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_jump_hash_sharding": SQL_OP1, "op2_ngram_jaccard_join": SQL_OP2, "op4_mix_sources": SQL_OP4, "op5_histogram_top_k": SQL_OP5, "op9_license_scan": license.sql(), "op11_fill_in_middle": SQL_OP11, "op12_substring_dedup": SQL_OP12}
