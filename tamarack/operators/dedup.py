"""Exact duplicate groups, components over shared hashes, and n-gram overlap against a reference table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarack.functions.ids import group_id, sha
from tamarack.functions.text import bind, squash, words
from tamarack.operators.graph import connected_components
from tamarack.storage import durable


def exact_groups(df: DataFrame, key: str, text: str) -> DataFrame:
    """Groups of two or more rows whose white-space normalised texts are equal."""
    rows = df.select(F.col(key).alias("id"), sha(squash(text)).alias("normalized_sha256"))
    return rows.groupBy("normalized_sha256").agg(F.count("*").alias("members"), F.min("id").alias("first_id")).where("members > 1")


def duplicate_components(df: DataFrame, key: str, hashes: list[str]) -> DataFrame:
    """``key, component``: rows that share any of the hash columns, transitively; a missing hash is an error.

    Edges are a star per hash value (each row to the smallest of its hash), so a value with many rows stays linear.
    """
    stars = None
    for h in hashes:
        value = F.coalesce(F.col(h), F.raise_error(F.lit(f"missing {h}")).cast("string"))
        rows = df.select(F.col(key).alias("src"), value.alias("_h"))
        star = rows.join(rows.groupBy("_h").agg(F.min("src").alias("dst")), "_h").select("src", "dst")
        stars = star if stars is None else stars.union(star)
    found = connected_components(stars)
    return df.select(F.col(key)).join(found, F.col(key) == F.col("node"), "left").select(key, F.coalesce("component", key).alias("component"))


def name_groups(components: DataFrame, key: str, version: str) -> DataFrame:
    """Append ``group_id``, a digest of all members in text order, and ``members``."""
    ids = components.select("component", F.col(key).cast("string").alias("id"))
    named = ids.groupBy("component").agg(F.array_sort(F.collect_list("id")).alias("m")).select("component", group_id(version, F.col("m")).alias("group_id"), F.size("m").cast("bigint").alias("members"))
    return components.join(named, "component")


def grams(text: Column, n: int) -> Column:
    """Distinct 64-bit hashes of all runs of ``n`` words; a shorter text is one run, an empty text has none.

    Each word is hashed once. Two runs share a hash by chance once in 2**64 pairs, so a table of 10**13 runs meets one of
    10**5 falsely with a chance of about one in twenty.
    """
    def each(h: Column) -> Column:
        run = lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, n)])  # noqa: E731  words past the end are null
        return F.array_distinct(F.transform(F.slice(h, F.lit(1), F.greatest(F.size(h) - (n - 1), F.least(F.size(h), F.lit(1)))), run))

    return bind(F.transform(words(text), lambda w: F.xxhash64(w)), each)


def gram_rows(df: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """``key, n_grams, gram``: one row per distinct gram."""
    sets = df.select(F.col(key), grams(F.coalesce(text, F.lit("")), n).alias("g"))
    return sets.select(key, F.size("g").cast("bigint").alias("n_grams"), F.explode("g").alias("gram"))


def overlaps(left: DataFrame, left_key: str, right: DataFrame, right_key: str, n: int, text: str = "text", most: int = 2_000_000) -> DataFrame:
    """Pairs that share a gram: ``shared``, ``jaccard``. Texts without words take no part.

    ``right`` is the smaller table. Rows of ``left`` whose gram it doesn't have go before anything is shuffled, by a
    broadcast of its distinct grams if these are ``most`` (16 MB) or fewer, and by a join if they are more.
    """
    a = gram_rows(left, left_key, text, n).withColumnRenamed("n_grams", "left_grams")
    b = durable(gram_rows(right, right_key, text, n).withColumnRenamed("n_grams", "right_grams"))
    known = b.select("gram").distinct()
    a = a.join(F.broadcast(known) if known.count() <= most else known, "gram", "left_semi")
    both = a.join(b, "gram").groupBy(left_key, right_key, "left_grams", "right_grams").agg(F.count("*").alias("shared"))
    return both.select(left_key, right_key, "shared", (F.col("shared") / (F.col("left_grams") + F.col("right_grams") - F.col("shared"))).alias("jaccard"))


def best_overlap(pairs: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Each left row's best partner; of equals the smallest id."""
    w = Window.partitionBy(left_key).orderBy(F.desc("jaccard"), right_key)
    return pairs.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def memorized(outputs: DataFrame, key: str, targets: DataFrame, target_key: str, n: int, threshold: float, text: str = "text") -> DataFrame:
    """``exact``, ``near`` or null per output, with its best partner where it isn't exact."""
    known = targets.select(sha(squash(text)).alias("_h")).distinct()
    rows = outputs.select(key, text, sha(squash(text)).alias("_h"))
    exact = rows.join(known, "_h", "left_semi").select(key, F.lit("exact").alias("kind"))
    rest = rows.join(known, "_h", "left_anti")
    best = best_overlap(overlaps(rest, key, targets, target_key, n, text), key, target_key)
    near = rest.select(key).join(best, key, "left")
    near = near.select(key, F.when(F.col("jaccard") >= threshold, "near").alias("kind"), F.coalesce("jaccard", F.lit(0.0)).alias("jaccard"), F.col(target_key))
    return exact.select(key, "kind", F.lit(None).cast("double").alias("jaccard"), F.lit(None).cast(targets.schema[target_key].dataType).alias(target_key)).unionByName(near)
