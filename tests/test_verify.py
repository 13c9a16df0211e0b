"""Verification of results, exports and documents; the entry without its optional part."""

import shutil
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from tamarack.operators import verify
from tamarack.sources import sinks

ROOT = Path(__file__).resolve().parent.parent


def test_result_identity(spark):
    manifest = spark.createDataFrame([("a", 1, "m", "t"), ("b", 2, "m", "t"), ("c", 3, "m", "t")], "row_id string, source_row_index int, image_sha256 string, tikz_sha256 string")
    results = spark.createDataFrame(
        [("a", 1, "c1", "m", "t"), ("b", 9, "c1", "m", "t"), ("c", 3, "c1", "m", "drift"), ("x", 1, "c1", "m", "t"), ("a", 1, None, "m", "t")],
        "row_id string, source_row_index int, config_hash string, image_sha256 string, tikz_sha256 string",
    )
    got = sorted(tuple(r) for r in verify.result_identity(results, manifest, {"config_hash": "c1"}).collect())
    assert got == [("a", "fatal", "config_hash mismatch"), ("b", "fatal", "index mismatch"), ("c", "row", "integrity"), ("x", "fatal", "unknown row")]


def test_result_structure(spark):
    columns = "row_id string, ok boolean, max_tokens int, prompt_tokens int, completion_tokens int, error_category string, finish_reason string"
    rows = [("a", True, 256, 1, 1, None, "stop"), ("", None, 0, None, None, None, None), ("b", False, 256, None, None, None, None), ("c", True, 1, -1, 0, None, "stop"), ("d", False, 1, None, None, None, "length")]
    got = [r.p for r in spark.createDataFrame(rows, columns).select(verify.result_structure().alias("p")).collect()]
    assert got == [[], ["row_id", "ok", "max_tokens"], ["failure without category"], ["tokens"], []]


def test_export_tampering(spark):
    rows = spark.createDataFrame([(i, f"r{i}", f"text {i}") for i in range(25)], "source_row_index long, id string, text string")
    cut = sinks.with_shards(rows, "source_row_index", 10)
    shards = sinks.shard_digests(cut, "source_row_index", sinks.document_line(text=F.col("text")))
    failing = lambda r, s: {x.check for x in verify.export_report(r, s, shards, quick=True).where("status = 'fail'").collect()}
    assert failing(cut, shards) == set()
    assert failing(cut.union(cut.limit(1)), shards) == {"export.unique_ids", "export.unique_indices"}
    assert failing(cut.withColumn("shard", F.when(F.col("source_row_index") == 24, 0).otherwise(F.col("shard"))), shards) == {"export.rising_indices"}
    assert failing(cut, shards.where("shard < 2")) == {"export.shards_listed"}
    assert failing(cut, shards.withColumn("rows", F.col("rows") + 1)) == {"export.shard_rows"}


def test_schema_subset():
    schema = {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {"a": {"type": "integer", "minimum": 1}, "b": {"type": "array", "minItems": 1, "items": {"enum": ["x"]}}, "c": {"pattern": "^[0-9]+$"}}}
    assert verify.schema_problems({"a": 1, "b": ["x"], "c": "12"}, schema) == []
    assert verify.schema_problems({"a": True, "b": [], "c": "z", "d": 0}, schema) == ["$.a: not integer", "$.b: too few items", "$.c: does not match", "$: unexpected d"]
    assert verify.schema_problems({"b": ["y"]}, schema) == ["$: missing a", "$.b[0]: not one of ['x']"]
    assert verify.structural_diff({"a": {"b": 1}, "c": 2}, {"a": {"b": 1.5}, "d": 3}) == ["a.b: 1 != 1.5", "c: 2 != None", "d: None != 3"]


def test_entry_without_the_optional_part(tmp_path):
    for name in ("tamarack", "__spark_entry__.py"):
        (shutil.copytree if (ROOT / name).is_dir() else shutil.copy)(ROOT / name, tmp_path / name)
    shutil.rmtree(tmp_path / "tamarack" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'policy_outcomes' in q and not any(n.startswith('op') for n in q) and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
