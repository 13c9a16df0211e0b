"""Registered queries of the training-data operators: thin digests over each operator's own output."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tamarack.llm import bpe, exchange, fingerprint, jaccard, langid, licenses, packing, quality, sharding, substring, toxicity
from tamarack.sources.tables import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words under windows of 35 words that occur twice or more in the corpus."""
    return substring.repeated_words(table(spark, sf_dir, "documents", "doc_id", "text"), window=35)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = langid.identify(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets have Jaccard 0.75 or more."""
    return jaccard.components(table(spark, sf_dir, "documents", "doc_id", "text"), n=5, per=75)


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document; ids and texts are reported as digests."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.digests(docs, public_tokenizers.path("word_bpe_49k.json"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of at most 4096 tokens."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.best_fit(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document: coverage and span of each."""
    return licenses.scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    docs = docs.withColumn("text", F.coalesce("text", F.lit("")))
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")), exchange.text_bytes(docs) // fingerprint.RANGE_BYTES)
    rows = fingerprint.with_next(docs, "doc_id", ["text", "fp"], parts, lambda df: fingerprint.sketch(df, "text", "fp"))
    n = F.length("text")
    half = (n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    both = fingerprint.sketch(rows.withColumn("edited", edited), "edited", "efp")
    return both.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        F.array_join("fp", ".").alias("fingerprint"), F.array_join("efp", ".").alias("edited_fingerprint"),
        fingerprint.likeness("fp", "efp").alias("near_edited"), fingerprint.likeness("fp", "next_fp").alias("near_next"),
    )


def op9_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 shards of near equal bytes."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    rows = sharding.shard(docs, shards=24)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the suffix-array verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_toxicity, op3_language_id, op4_ngram_jaccard, op5_bpe_codec, op6_best_fit_packing, op7_license_scan, op8_order_minhash, op9_kd_sharding, op10_quality_rules)}
#: DuckDB on small tables; words are split at the contract's six blanks.
_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ORACLES: dict[str, str] = {
    "op1_substring_dedup": f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
g AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
b AS (SELECT h FROM g GROUP BY h HAVING count(*) > 1),
c AS (SELECT DISTINCT r, i + k AS p FROM (SELECT r, i, unnest(range(0, 35)) AS k FROM g SEMI JOIN b USING (h))),
s AS (SELECT r, list(p) AS ps FROM c GROUP BY r),
k AS (SELECT doc_id, len(w) AS n, len(coalesce(ps, [])) AS m, w, coalesce(ps, []) AS ps FROM d LEFT JOIN s USING (r)),
x AS (SELECT doc_id, n, m, CASE WHEN m = 0 THEN w ELSE list_filter(w, lambda v, i: NOT list_contains(ps, i)) END AS kept FROM k)
SELECT doc_id, n::BIGINT AS n_words, m::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM x""",
    "op4_ngram_jaccard": f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w
  FROM (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)),
s AS MATERIALIZED (SELECT DISTINCT r, h FROM (SELECT r, md5(array_to_string(w[i:i + 4], ' ')) AS h
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, CASE WHEN len(w) > 0 THEN 1 ELSE 0 END) + 1)) AS i FROM d))),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
l AS MATERIALIZED (SELECT a, b FROM (SELECT x.r AS a, y.r AS b, count(*) AS o FROM s x JOIN s y ON x.h = y.h AND x.r <> y.r GROUP BY ALL)
  JOIN n p ON p.r = a JOIN n q ON q.r = b WHERE 100 * o >= 75 * (p.n + q.n - o)),
c AS (SELECT r, r AS m FROM d UNION SELECT c.r, l.b FROM c JOIN l ON l.a = c.m)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(e.doc_id) AS component_id
FROM d LEFT JOIN n USING (r) JOIN c USING (r) JOIN d e ON e.r = c.m GROUP BY d.r, d.doc_id""",
}
