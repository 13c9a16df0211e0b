"""Injected callables, cards, prompts, roll-ups."""

import base64
import hashlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tamarack.functions import stats, text
from tamarack.operators import checks, inject
from tamarack.sources import files, sinks


def test_generator(spark):
    tasks = spark.createDataFrame([("a",), ("b",)], "row_id string").coalesce(1)
    good = lambda: lambda b: pd.DataFrame({"row_id": b["row_id"], "ok": True, "instruction": "x", "finish_reason": "stop", "error_category": None})
    swapped = lambda: lambda b: good()(b.assign(row_id="z"))
    assert {(r.row_id, r.ok) for r in inject.generate(tasks, good).collect()} == {("a", True), ("b", True)}
    for broken in (swapped, lambda: lambda b: 1 / 0):
        assert {(r.row_id, r.error_category) for r in inject.generate(tasks, broken).collect()} == {("a", "engine_transient"), ("b", "engine_transient")}
    assert {r.error_category for r in inject.generate(tasks, None).collect()} == {"engine_fatal"}
    assert {r.status for r in inject.compile_outputs(tasks, None).collect()} == {"unavailable"}
    got = inject.tokenize(tasks, lambda: lambda t: [ord(c) for c in t], "row_id").collect()
    assert {tuple(r.input_ids) for r in got} == {(97,), (98,)}


def test_similarity(spark):
    df = spark.createDataFrame([(1, [0, 255], [0, 255]), (2, [0, 0], [255, 255]), (3, [0], [0, 1]), (4, None, [0])], "i int, a array<int>, b array<int>")
    got = {r.i: (r.similarity, r.similarity_status) for r in inject.similarity_status(df, "a", "b").collect()}
    assert got == {1: (1.0, "ok"), 2: (0.0, "ok"), 3: (None, "error"), 4: (None, "not_available")}
    assert inject.similarity_status(df, None, None).where("similarity_status = 'not_available'").count() == 4


def test_roll_ups(spark):
    got = checks.run_checks([("a", (), lambda: True), ("b", ("a",), lambda: "bad"), ("c", ("b",), lambda: True), ("d", (), lambda: 1 / 0), ("e", (), lambda: None)], skip=("e",))
    assert [g["status"] for g in got] == ["pass", "fail", "skipped", "fail", "skipped"]
    df = spark.createDataFrame([(True, True), (True, None)], "x boolean, y boolean")
    assert checks.all_true(df, ["x", "y"]).first()[:] == (["y"], False)


def test_documents(spark, tmp_path):
    (tmp_path / "v1.txt").write_text("Describe \n the figure.")
    pin = hashlib.sha256(b"Describe the figure.").hexdigest()
    assert files.prompt(str(tmp_path), "v1", {"v1": pin}) == "Describe the figure."
    for pins in ({}, {"v1": "0"}):
        with pytest.raises(ValueError):
            files.prompt(str(tmp_path), "v1", pins)
    (tmp_path / "img").mkdir()
    (tmp_path / "img" / "p!.png").write_bytes(b"PNG")
    df = spark.createDataFrame([(base64.b64encode(b"raw").decode(),), ("x/p!.png",), (None,)], "v string")
    got = [bytes(r.image) if r.image is not None else None for r in files.image_bytes(spark, df, "v", str(tmp_path / "img")).orderBy(F.col("v").desc_nulls_last()).collect()]
    assert got == [b"PNG", b"raw", None]
    assert "- **rows**: 3" in sinks.card("t", {"rows": 3}, {"n": df})
    assert "to go: 1h 01m" in sinks.progress({"complete": 1, "pending": 1}, {"eta_seconds": 3660.0})
    sinks.evidence(str(tmp_path / "e.json"), "g", "passed", "i", {})
    with pytest.raises(ValueError):
        sinks.evidence(str(tmp_path / "e.json"), "g", "maybe", "i", {})
    got = [r[0] for r in spark.createDataFrame([("1, 2",), ("1,1",), ("0",), ("x",)], "v string").select(text.positive_list("v")).collect()]
    assert got == [[1, 2], None, None, None]
    assert spark.range(1).select(stats.warmup_steps(F.lit(101), 0.03)).first()[0] == 4
