"""Structured Streaming: exactly-once ingest of result documents and the per-row state machine.

Files are read once (the checkpoint knows them) and a document that arrives again under another name is dropped by its
content digest. Results then drive one state per row; terminal rows ignore late results. State lives in the state
store on the shared checkpoint, so a lost executor resumes from it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.operators.ledger import FRESH, RetryPolicy, step
from tamarack.sources.files import DOCUMENT

STATE = "state string, transient int, ceiling boolean, instruction string, attempts int, reason string, conflict boolean"
OUT = "row_id string, state string, reason string, attempts int, instruction string, conflict boolean"
_FIELDS = [f.split(" ")[0] for f in STATE.split(", ")]


def read_documents(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """A stream of result documents with a digest of their content."""
    rows = spark.readStream.schema(DOCUMENT).option("multiLine", True).option("maxFilesPerTrigger", files_per_trigger).json(path)
    return rows.withColumn("content_sha256", F.sha2(F.to_json(F.struct("run_id", "worker", "generation", "batch_index", "results")), 256))


def once(documents: DataFrame) -> DataFrame:
    """Each document's first arrival."""
    return documents.where("_corrupt_record is null and results is not null").dropDuplicates(["content_sha256"])


def results(documents: DataFrame) -> DataFrame:
    return documents.select("generation", "batch_index", F.explode("results").alias("r")).select("generation", "batch_index", "r.*")


def advance(rows: DataFrame, policy: RetryPolicy = RetryPolicy()) -> DataFrame:
    """The state of each row that has new results, after them (update mode)."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        now = dict(zip(_FIELDS, state.get, strict=True)) if state.exists else dict(FRESH)
        fresh = pd.concat(list(batches))
        for r in fresh.sort_values(["generation", "batch_index"]).to_dict("records"):
            now = step(now, {k: None if v is None or v != v else v for k, v in r.items()}, policy)
        state.update(tuple(now[f] for f in _FIELDS))
        yield pd.DataFrame([{"row_id": key[0], **{k: now[k] for k in ("state", "reason", "attempts", "instruction", "conflict")}}])

    picked = rows.select("row_id", "generation", "batch_index", "ok", "instruction", "finish_reason", "error_category", "max_tokens")
    return picked.groupBy("row_id").applyInPandasWithState(run, OUT, STATE, "update", "NoTimeout")


def run_available(stream: DataFrame, out: str, checkpoint: str, mode: str = "update") -> None:
    """Process what is there and stop. Every micro-batch is its own folder, so a replayed batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()


def last_states(spark: SparkSession, out: str) -> DataFrame:
    """The newest state of each row over all micro-batches."""
    rows = spark.read.parquet(out)
    return rows.groupBy("row_id").agg(F.max_by(F.struct("state", "reason", "attempts", "instruction", "conflict"), "batch").alias("s")).select("row_id", "s.*")


def stalled(heartbeats: DataFrame, worker: str, ts: str, now: float, timeout: float) -> DataFrame:
    """Workers whose last sign of life is older than ``timeout`` seconds."""
    return heartbeats.groupBy(worker).agg(F.max(ts).alias("last")).where(F.lit(now) - F.col("last") > timeout)
