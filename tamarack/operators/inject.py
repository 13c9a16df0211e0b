"""Seams for callables that are not part of the engine: models, tokenizers, compilers, image decoders.

A factory runs once per task and returns a function from a pandas batch to a pandas batch, so a model is loaded once and
batches travel as Arrow. Without a factory the operators give the documented status instead of guessing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Batch = Callable[[pd.DataFrame], pd.DataFrame]


def map_batches(df: DataFrame, factory: Callable[[], Batch], schema: str) -> DataFrame:
    """``factory()`` once per task, its function on every batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        work = factory()
        for b in batches:
            yield work(b)

    return df.mapInPandas(run, schema)


def generate(tasks: DataFrame, factory: Callable[[], Batch] | None) -> DataFrame:
    """Results of a generator: ``row_id, ok, instruction, finish_reason, error_category``. The generator must answer each
    task of a batch once; a batch it fails on, or answers for other tasks, becomes ``engine_transient`` failures."""
    schema = "row_id string, ok boolean, instruction string, finish_reason string, error_category string"
    if factory is None:
        none = F.lit(None).cast("string")
        return tasks.select("row_id", F.lit(False).alias("ok"), none.alias("instruction"), none.alias("finish_reason"), F.lit("engine_fatal").alias("error_category"))

    def guarded() -> Batch:
        work = factory()

        def one(b: pd.DataFrame) -> pd.DataFrame:
            try:
                out = work(b)
                if sorted(out["row_id"]) != sorted(b["row_id"]):
                    raise ValueError("answers don't match tasks")
                return out[["row_id", "ok", "instruction", "finish_reason", "error_category"]]
            except Exception:
                return pd.DataFrame({"row_id": b["row_id"], "ok": False, "instruction": None, "finish_reason": None, "error_category": "engine_transient"})

        return one

    return map_batches(tasks, guarded, schema)


def tokenize(df: DataFrame, factory: Callable[[], Callable[[str], list[int]]], text: str = "text") -> DataFrame:
    """Append ``input_ids`` by an injected tokenizer."""

    def make() -> Batch:
        encode = factory()
        return lambda b: b.assign(input_ids=[encode(t or "") for t in b[text]])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return map_batches(df, make, f"{fields}, input_ids array<int>")


def compile_outputs(df: DataFrame, factory: Callable[[], Batch] | None) -> DataFrame:
    """``row_id, status, category, error_line, error_message``; ``unavailable`` without a compiler."""
    schema = "row_id string, status string, category string, error_line int, error_message string"
    if factory is None:
        none = F.lit(None)
        return df.select(F.col("row_id").cast("string").alias("row_id"), F.lit("unavailable").alias("status"), F.lit("unavailable").alias("category"), none.cast("int").alias("error_line"), none.cast("string").alias("error_message"))
    return map_batches(df, factory, schema)


def similarity_status(df: DataFrame, pixels: str | None, reference: str | None) -> DataFrame:
    """Append ``similarity`` and its status from decoded gray pixel arrays: ``ok``, ``error`` where their sizes differ,
    ``not_available`` where either is missing or there is no decoder."""
    from tamarack.operators.evaluate import l1_similarity

    if pixels is None or reference is None:
        return df.withColumns({"similarity": F.lit(None).cast("double"), "similarity_status": F.lit("not_available")})
    a, b = F.col(pixels), F.col(reference)
    status = F.when(a.isNull() | b.isNull(), "not_available").when(F.size(a) != F.size(b), "error").otherwise("ok")
    return df.withColumns({"similarity": F.when(status == "ok", F.bround(l1_similarity(a, b), 6)), "similarity_status": status})
