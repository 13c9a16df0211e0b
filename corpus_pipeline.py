"""A five-stage cleaning pipeline over ``documents``.

Each stage takes what its predecessor kept, is written as Parquet and read again by the next:

1. toxicity: documents that the calibrated trees call toxic go.
2. language ID: documents without a letter, whose language cannot be told, go.
3. n-gram Jaccard join: of each component of near duplicates the document with the smallest doc_id stays.
4. substring dedup: words under repeated windows of 35 words are removed from the texts.
5. best-fit packing: what is left is packed into sequences of at most 4096 tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamarack.llm import jaccard, langid, packing, substring, toxicity
from tamarack.sources.tables import table
from tamarack.storage import durable, release

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score(docs.select(*COLUMNS), model, keep_text=True).where("predicted = 0").select(*COLUMNS)


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language. Two that are equally near are no reason to drop a text, so the score is not asked."""
    found = langid.identify(docs.select(*COLUMNS), langid.fit(docs), keep_text=True)
    return found.where("lang_pred != 'und'").select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: the one with the smallest doc_id."""
    # Two hashes of all columns stand for a row, so that texts move once.
    marked = docs.select(*COLUMNS, F.xxhash64(*COLUMNS).alias("_row"), F.xxhash64(F.lit(1), *COLUMNS).alias("_too"))
    named = jaccard.components(marked, keep=("_row", "_too"))
    # A row without a doc_id stands for its component only where no other can; empty sets are linked with nothing.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "_row", "_too")).alias("least")
    chosen = named.where("component is not null").groupBy("component").agg(least).select("least._row", "least._too")
    kept = marked.join(chosen.union(named.where("component is null").select("_row", "_too")).distinct(), ["_row", "_too"], "left_semi")
    # Of rows that are equal in every column one stays.
    at = F.row_number().over(Window.partitionBy("_row", "_too").orderBy("_row"))
    return kept.withColumn("_at", at).where("_at = 1").select(*COLUMNS)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that repeat elsewhere."""
    cut = substring.repeated_words(docs.select(*COLUMNS), keep_text=True, keep=("doc_id", "lang", "source"))
    text = F.col("kept_text")
    return cut.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their sequences."""
    return packing.best_fit(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_known_language),
    ("ngram_jaccard", one_of_each_group),
    ("substring_dedup", drop_repeats),
    ("best_fit_packing", pack),
]

#: Learned stages and token packing have no SQL form; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        before, docs = docs, durable(stage(spark, docs, sf_dir))
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)
