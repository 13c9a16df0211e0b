"""Writers: verified Parquet commits, fixed-size ordered shards with digests, companions, small documents and reports."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.functions.ids import canonical_digest, json_string, logical_row, sha
from tamarack.operators.ordering import global_index


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def verified_write(df: DataFrame, path: str, key: str, partition_by: list[str] | None = None) -> int:
    """Write to a staging folder, read back, compare row count and key digest, then rename into place."""
    spark, staged = df.sparkSession, path.rstrip("/") + ".staged"
    fs, target = _fs(spark, path)
    _, stage = _fs(spark, staged)
    fs.delete(stage, True)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(staged)
    probe = lambda x: x.agg(F.count("*"), F.bit_xor(F.xxhash64(F.col(key).cast("string")))).first()
    want, got = probe(df), probe(spark.read.parquet(staged))
    if want != got:
        raise OSError(f"read-back of {path} differs: {want} rows written, {got} read")
    fs.delete(target, True)
    if not fs.rename(stage, target):
        raise OSError(f"cannot move {staged} to {path}")
    return got[0]


def with_shards(df: DataFrame, index: str, size: int) -> DataFrame:
    """Append ``shard``: the row's ordinal over the shard size."""
    at = global_index(df, [F.col(index)], F.col(index).cast("bigint"), "_at")
    return at.withColumn("shard", F.floor(F.col("_at") / size).cast("bigint")).drop("_at")


def shard_digests(df: DataFrame, index: str, line: Column, shard: str = "shard") -> DataFrame:
    """Per shard: rows, first and last index, and the digest of its ordered logical rows (a shard's size is bounded)."""
    rows = df.select(shard, F.col(index).alias("_i"), line.alias("_l"))
    ordered = F.array_sort(F.collect_list(F.struct("_i", "_l")))
    out = rows.groupBy(shard).agg(F.count("*").alias("rows"), F.min("_i").alias("first_index"), F.max("_i").alias("last_index"), ordered.alias("o"))
    return out.select(shard, "rows", "first_index", "last_index", sha(F.array_join(F.transform("o", lambda x: x["_l"]), "")).alias("logical_sha256"))


def dataset_digest(shards: DataFrame, shard: str = "shard") -> DataFrame:
    """One digest of the ordered shard digests: as many rows as shards."""
    ordered = F.array_sort(F.collect_list(F.struct(shard, "logical_sha256")))
    text = F.concat(F.lit('["'), F.array_join(F.transform(ordered, lambda x: x["logical_sha256"]), '", "'), F.lit('"]'))
    return shards.agg(sha(text).alias("dataset_sha256"))


def export(df: DataFrame, path: str, index: str, key: str, line: Column, size: int) -> dict:
    """Ordered shards under ``path`` with their digests in ``shards.json`` beside them; shards of old runs are gone."""
    cut = with_shards(df, index, size)
    ordered = cut.repartitionByRange("shard").sortWithinPartitions("shard", index)
    rows = verified_write(ordered, path, key, ["shard"])
    table = shard_digests(cut, index, line).orderBy("shard").collect()  # one row per shard
    meta = {"rows": rows, "shards": [r.asDict() for r in table]}
    meta["dataset_sha256"] = canonical_digest([r["logical_sha256"] for r in table])
    return meta


def text_atomic(path: str, text: str) -> None:
    """A small driver-side document: temporary file, flush, rename."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    temp = target.with_name(f".{target.name}.tmp")
    with open(temp, "w", encoding="utf-8") as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    os.replace(temp, target)


def json_atomic(path: str, value) -> None:
    text_atomic(path, json.dumps(value, indent=2, sort_keys=True, ensure_ascii=False) + "\n")


def tasks_by_worker(claims: DataFrame, path: str) -> None:
    """One folder of JSON lines per worker."""
    claims.write.mode("overwrite").partitionBy("worker").json(path)


def outstanding(tasks: DataFrame, keep: DataFrame, key: str = "row_id") -> DataFrame:
    """Tasks that are still open."""
    return tasks.join(keep.select(key).distinct(), key, "left_semi")


def csv_union(parts: list[DataFrame], path: str | None = None) -> DataFrame:
    """Rows of different shapes under the union of their columns; written as CSV with a header if a path is given."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    if path:
        out.write.mode("overwrite").option("header", True).csv(path)
    return out


def quarantine_jsonl(rows: DataFrame, path: str) -> None:
    """JSON lines of quarantined rows; the folder goes if there are none."""
    fs, target = _fs(rows.sparkSession, path)
    if rows.isEmpty():
        fs.delete(target, True)
    else:
        rows.write.mode("overwrite").json(path)


def snapshot(df: DataFrame, folder: str, stamp: str) -> str:
    """A copy under a name that is not taken yet."""
    spark, n = df.sparkSession, 0
    while True:
        path = f"{folder}/{stamp}{f'-{n}' if n else ''}"
        fs, p = _fs(spark, path)
        if not fs.exists(p):
            df.write.parquet(path)
            return path
        n += 1


def _cell(v) -> str:
    return "-" if v is None else f"{v:.4g}" if isinstance(v, float) else str(v)


def markdown(rows: list[dict], columns: list[str] | None = None) -> str:
    """A Markdown table of a small result: floats in four digits, a dash for null."""
    names = columns or list(rows[0]) if rows else columns or []
    lines = ["| " + " | ".join(names) + " |", "|" + " --- |" * len(names)]
    return "\n".join(lines + ["| " + " | ".join(_cell(r.get(c)) for c in names) + " |" for r in rows]) + "\n"


def table_report(title: str, df: DataFrame, limit: int = 1000) -> str:
    """A titled Markdown table of a small frame."""
    return f"# {title}\n\n" + markdown([r.asDict() for r in df.limit(limit).collect()], df.columns)


def document_line(**fields: Column) -> Column:
    """A logical row whose text fields are escaped here: pass text columns as they are."""
    return logical_row(**{n: json_string(c) for n, c in fields.items()})


def card(title: str, facts: dict, tables: dict[str, DataFrame] | None = None) -> str:
    """A Markdown card: facts as a list, small tables below."""
    lines = [f"# {title}", ""] + [f"- **{k}**: {_cell(v)}" for k, v in facts.items()] + [""]
    for name, df in (tables or {}).items():
        lines += [f"## {name}", "", markdown([r.asDict() for r in df.limit(1000).collect()], df.columns)]
    return "\n".join(lines)


def progress(states: dict[str, int], rates: dict[str, float | None]) -> str:
    """A progress report in text: rows per state, share done, rates and time to go."""
    total = sum(states.values())
    done = states.get("complete", 0) + states.get("rejected", 0)
    eta = rates.get("eta_seconds")
    lines = [f"{k:>10}: {v}" for k, v in states.items()] + [f"{'done':>10}: {done / total:.1%}" if total else f"{'done':>10}: -"]
    lines.append(f"{'per hour':>10}: {_cell(rates.get('recent_per_hour'))} lately, {_cell(rates.get('overall_per_hour'))} overall")
    lines.append(f"{'to go':>10}: " + ("-" if eta is None else f"{int(eta) // 3600}h {int(eta) % 3600 // 60:02d}m"))
    return "\n".join(lines) + "\n"


def evidence(path: str, gate: str, status: str, identity: str, detail: dict) -> None:
    """A gate's evidence document; only passed or failed can be recorded."""
    if status not in ("passed", "failed"):
        raise ValueError(f"status {status!r}")
    json_atomic(path, {"gate": gate, "status": status, "identity_sha256": identity, "detail": detail})


def step_log(df: DataFrame, path: str) -> None:
    """Append step rows ``time, step, epoch, logs`` as JSON lines."""
    df.select("time", "step", "epoch", "logs").write.mode("append").json(path)
