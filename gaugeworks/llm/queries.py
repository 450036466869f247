"""One query for each operator, over whole tables, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, divergence, fill_middle, html_extract, minhash, mixing, nbsvm, packing, pii, quality, secret_scan, token_store, topk
from .shared import new_folder


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_read(spark, sf_dir, "pages"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_read(spark, sf_dir, "documents"), size=3, percent=85)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(quality.measure(_read(spark, sf_dir, "documents"))).drop("failed_rules", "n_lines", "n_stop_words")


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    store = token_store.write_store(docs, new_folder(spark, "token-store"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_store.digests(docs, store)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_read(spark, sf_dir, "documents")).drop("found")


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.replace(_read(spark, sf_dir, "documents"), key="a key that the owner of the corpus keeps")
    return out.select("doc_id", "text", "n_entities", *[F.col("kinds")[k].cast("long").alias(f"n_{k}") for k in pii.PATTERNS])


def op7_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return nbsvm.score(docs, nbsvm.train(docs, _read(spark, sf_dir, "labels")))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=2048)


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_read(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(_read(spark, sf_dir, "documents"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(_read(spark, sf_dir, "documents"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_read(spark, sf_dir, "documents"))


def queries() -> dict:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


_STOP = ", ".join(f"'{w}'" for w in quality.STOP)
_GAP = r"[\x20\x09-\x0D]"

OP3 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT r, doc_id, text,
    list_filter(string_split_regex(text, '{_GAP}+'), lambda w: w <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM docs),
windows AS (
  SELECT r, unnest(range(1, len(words) - 3)) AS i, words FROM split WHERE len(words) >= 5),
texts AS (SELECT r, i, array_to_string(words[i:i + 4], ' ') AS w FROM windows),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS c FROM texts) WHERE c > 1),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r),
counts AS (
  SELECT r, doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(list_filter(words, lambda w: lower(w) IN ({_STOP}))) AS BIGINT) AS n_stop_words
  FROM split),
ready AS (
  SELECT counts.*, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    n_words < 10 OR 100 * coalesce(n, 0) > 20 * n_words AS base_failed
  FROM counts LEFT JOIN covered USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({quality.rule_sql()}) AS kept
FROM ready
"""


OP9 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


_HASHED, _MARKED = fill_middle.rule_sql()
OP12 = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, {_HASHED} AS digest FROM documents),
cut AS (
  SELECT *, regexp_extract_all(text, '{_GAP}*[^\x20\x09-\x0D]+|{_GAP}+') AS units,
    [CAST('0x' || substr(digest, 8 * i + 1, 8) AS BIGINT) FOR i IN range(4)] AS h
  FROM docs),
ends AS (
  SELECT doc_id, text, units, len(units) AS n,
    least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS a,
    greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS b,
    CASE WHEN text = '' OR {_MARKED} OR h[3] % 100 >= 50 THEN 'plain' WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM cut),
parts AS (
  SELECT *, array_to_string(units[:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix
  FROM ends)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CAST(CASE WHEN form <> 'plain' THEN length(prefix) END AS BIGINT) AS prefix_chars,
  CAST(CASE WHEN form <> 'plain' THEN length(middle) END AS BIGINT) AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""


OP13 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
found AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM found GROUP BY ALL HAVING count(DISTINCT r) >= 3),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
counts AS (SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL),
names AS (SELECT DISTINCT lang, source FROM docs),
vectors AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, v,
    1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) + v) AS p
  FROM names JOIN kept USING (lang) JOIN sizes USING (lang) LEFT JOIN counts USING (lang, source, term)),
langs AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 1)) // (sum(sum(n)) OVER (PARTITION BY lang) + any_value(v)) AS q
  FROM vectors GROUP BY lang, term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM vectors a JOIN vectors b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM names a JOIN names b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM vectors JOIN langs USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM rows)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_quality_rules": OP3, "op9_topk": OP9, "op12_fill_middle": OP12, "op13_divergence": OP13}
