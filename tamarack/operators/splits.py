"""Seeded orders, leak-free splits, strata, samples, balanced assignment and load matrices."""

from __future__ import annotations

import heapq
import random

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarack.functions.ids import sha
from tamarack.functions.stats import bit_length, half_even
from tamarack.operators.ordering import hex_spread, running_sum_before


def keyed_order(seed: int | str, key: Column) -> Column:
    """A seeded order that any engine can reproduce: the digest of seed and key."""
    return sha(F.concat_ws("\x1f", F.lit(str(seed)), key.cast("string")))


def assign_splits(groups: DataFrame, seed: int, validation: float, test: float, size: str = "members", key: str = "group_id") -> DataFrame:
    """Append ``split``: whole groups in seeded order fill validation, then test, and the rest is train.

    A group goes where the rows before it end, so a group larger than a target still goes in whole. A fraction that
    rounds to no rows, or targets that leave no training rows, are errors.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    if total == 0:
        return groups.withColumn("split", F.lit("train"))
    want = groups.sparkSession.range(1).select(half_even(F.lit(validation * total)).cast("bigint"), half_even(F.lit(test * total)).cast("bigint")).first()
    if (validation > 0 and want[0] == 0) or (test > 0 and want[1] == 0):
        raise ValueError("a split fraction rounds to no rows")
    if want[0] + want[1] >= total:
        raise ValueError("the splits leave no training rows")
    ordered = groups.withColumn("_o", keyed_order(seed, F.col(key)))
    placed = running_sum_before(ordered, [F.col("_o")], hex_spread("_o"), size, "_before")
    split = F.when(F.col("_before") < want[0], "validation").when(F.col("_before") - want[0] < want[1], "test").otherwise("train")
    return placed.withColumn("split", split).drop("_o", "_before")


def shuffled_like_python(ids: list, seed: int) -> list:
    """Sorted ids in the order that Python's generator gives for ``seed`` (driver side, for matching old manifests)."""
    out = sorted(ids)
    random.Random(seed).shuffle(out)
    return out


def sample(df: DataFrame, key: str, seed: int, limit: int) -> DataFrame:
    """A seeded sample without replacement, by id."""
    return df.withColumn("_o", keyed_order(seed, F.col(key))).orderBy("_o", key).limit(limit).drop("_o").orderBy(F.col(key).cast("string"))


def round_robin(df: DataFrame, key: str, bucket: list[Column], seed: int, limit: int) -> DataFrame:
    """Rows in turns over buckets in key order, seeded within a bucket."""
    names = [f"_b{i}" for i in range(len(bucket))]
    rows = df.select("*", *[b.alias(n) for b, n in zip(bucket, names, strict=True)], keyed_order(seed, F.col(key)).alias("_o"))
    turn = F.row_number().over(Window.partitionBy(*names).orderBy("_o"))
    # Only the first `limit` of a bucket can be chosen, so what is sorted as a whole stays small.
    rows = rows.withColumn("_turn", turn).where(F.col("_turn") <= limit)
    return rows.orderBy("_turn", *names).limit(limit).drop(*names, "_o", "_turn")


def length_bucket(text: Column) -> Column:
    return bit_length(F.length(text))


def strata(df: DataFrame, key: str, text: str, strata_: int, size: int, seed: int) -> DataFrame:
    """Nested prefixes: the ``strata_ * size`` rows by length, cut into equal strata, interleaved in seeded order."""
    rows = df.orderBy(F.length(text), F.col(key).cast("string")).limit(strata_ * size)
    at = F.row_number().over(Window.orderBy(F.length(text), F.col(key).cast("string"))) - 1  # strata_ * size rows
    rows = rows.withColumn("stratum", F.floor(at / size).cast("int")).withColumn("_o", keyed_order(seed, F.col(key)))
    turn = F.row_number().over(Window.partitionBy("stratum").orderBy("_o"))
    return rows.withColumn("turn", turn).drop("_o")


def balanced(items: list[tuple], workers: int, overhead: int = 1024) -> dict:
    """Longest first to the least loaded worker (of equals the first): ``{id: worker}`` of ``(index, id, chars)``."""
    loads, out = [(0, w) for w in range(workers)], {}
    for _, key, chars in sorted(items, key=lambda x: (-x[2], x[0])):
        load, w = heapq.heappop(loads)
        out[key] = w
        heapq.heappush(loads, (load + chars + overhead, w))
    return out


def balanced_assignment(df: DataFrame, index: str, key: str, chars: str, workers: int, overhead: int = 1024) -> DataFrame:
    """Append ``worker``. The greedy order is sequential, so one claim (a wave's limit of rows) is one task."""
    kind = df.schema[key].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        got = balanced(list(zip(pdf[index], pdf[key], pdf[chars], strict=True)), workers, overhead)
        return pdf.assign(worker=pdf[key].map(got).astype("int32")).sort_values([index])[[key, index, chars, "worker"]]

    rows = df.select(key, F.col(index).cast("bigint").alias(index), F.col(chars).cast("bigint").alias(chars))
    return rows.groupBy().applyInPandas(run, f"{key} {kind}, {index} bigint, {chars} bigint, worker int")


def repeat_workload(df: DataFrame, key: str, rows: int, have: int) -> DataFrame:
    """``rows`` rows out of ``have`` numbered ones (``source_row_index`` 0, 1, ...), each with an id of its own."""
    n = df.sparkSession.range(rows).withColumn("source_row_index", F.col("id") % have)
    named = F.when(F.col("id") < have, F.col(key).cast("string")).otherwise(F.format_string("%s-load-%04d", F.col(key).cast("string"), F.col("id")))
    return n.join(df, "source_row_index").select("id", named.alias("load_id"), "source_row_index")


def screen_size(c: Column) -> Column:
    return F.least(F.lit(100), F.greatest(F.lit(16), c * 2))


def share(total: int, replicas: int, index: Column) -> Column:
    """How much of ``total`` replica ``index`` gets: the quotient, and one of the remainder."""
    return F.lit(total // replicas) + F.when(index < total % replicas, 1).otherwise(0)
