"""Ranges by size, durable tables that go, and an audit that passes and fails."""

import os

from pyspark.sql import functions as F

from tamarack.operators import audit, evaluate, ordering
from tamarack.storage import bucketed, durable, release


def test_many_ranges(spark):
    """Positions are the same however many ranges there are, with nulls and ties."""
    df = spark.range(3000).select(F.when(F.col("id") % 97 != 0, F.pmod(F.hash("id"), F.lit(700))).cast("long").alias("v"), "id")
    order = [F.col("v").asc_nulls_first(), F.col("id")]
    rows = sorted(((r.v is not None, r.v or 0, r.id) for r in df.collect()))
    want = {x[2]: i for i, x in enumerate(rows)}
    for parts in (None, 1, 2, 300, 4096):
        at = ordering.global_index(df, order, F.col("v"), "at", parts)
        assert {r.id: r["at"] for r in at.collect()} == want


def test_durable_tables_go(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    a, b = durable(df, 100), bucketed(df, "k", 4)
    paths = [x._tamarack_path.removeprefix("file://") for x in (a, b)]
    assert a.count() == b.count() == 100 and len([f for f in os.listdir(paths[0]) if f.startswith("part")]) == 1
    other = spark.range(7).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = b.join(other, "k")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1  # only the other side moves
    release(a, b, None, df)
    assert not any(map(os.path.exists, paths))
    release(a)  # gone already


def _run(spark, **change):
    text = "Draw a house with a roof and a red door, please."
    manifest = spark.createDataFrame([("a", 0, "valid", "i", "t"), ("b", 1, "rejected", "i", "t")], "row_id string, source_row_index int, status string, image_sha256 string, tikz_sha256 string")
    rows = spark.createDataFrame([("a", 0, "complete", text, None), ("b", 1, "rejected", None, "no image")], "row_id string, source_row_index int, state string, instruction string, reason string")
    out = spark.createDataFrame([("a", 0, "i", "t")], "id string, source_row_index int, image_sha256 string, tikz_sha256 string")
    shards = spark.createDataFrame([(0, 1, "x")], "shard int, rows long, logical_sha256 string")
    parts = {"manifest": manifest, "rows": rows, "attempts": rows.select("row_id"), "exported": out, "rejected": spark.createDataFrame([("b",)], "id string"), "shards": shards, "listed": shards,
             "start": 0, "limit": 2, "facts": {k: ("v", "v") for k in audit.FACTS}}
    return {r.check: (r.violations, r.status) for r in audit.audit(audit.Run(**parts | change)).collect()}


def test_audit(spark):
    found = _run(spark)
    assert len(found) == 34 and {s for _, s in found.values()} == {"pass"}
    nothing = spark.createDataFrame([], "id string, source_row_index int, image_sha256 string, tikz_sha256 string")
    found = _run(spark, exported=nothing, facts={k: ("v", "v") for k in audit.FACTS if k != "ledger.present"} | {"runtime.no_quarantined_results": (0, 2)}, limit=1)
    assert {k: v for k, v in found.items() if v[1] != "pass"} == {
        "export.checked": (1, "warn"), "export.row_count_matches_ledger": (1, "fail"), "ledger.present": (1, "fail"), "runtime.no_quarantined_results": (1, "warn"),
        "manifest.exact_row_count": (1, "fail"), "ledger.no_index_outside_slice": (1, "fail"),
    }


def test_compile_results(spark):
    df = spark.createDataFrame([(1, "success", "success"), (2, "timeout", "timeout"), (3, "latex_error", "undefined_command"), (4, "timeout", "timeout")], "i int, status string, category string")
    assert evaluate.compile_summary(df).first().asDict() == {"attempted": 4, "success": 1, "success_rate": 0.25}
    assert {r.category: r.n for r in evaluate.compile_failures(df).collect()} == {"timeout": 2, "undefined_command": 1}
    assert evaluate.compile_summary(df.limit(0)).first().success_rate is None
