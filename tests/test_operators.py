"""Ledger, duplicates, splits, tokens, extraction, checks, files, sinks and streaming on small fixtures."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tamarack.operators import checks, dedup, evaluate, ledger, ordering, slots, splits, tokens
from tamarack.operators.graph import connected_components
from tamarack.sources import files, sinks
from tamarack.streaming import ingest

RESULT = "row_id string, attempt_no int, ok boolean, finish_reason string, error_category string, max_tokens int, instruction string"


def history(spark, events):
    rows = [(r, i + 1, *e) for r, es in events.items() for i, e in enumerate(es)]
    return {r.row_id: r for r in ledger.settle(spark.createDataFrame(rows, RESULT)).collect()}


OK, CUT, IO, STALE = (True, "stop", None, 256, "A box"), (True, "length", None, 256, None), (False, None, "io", 256, None), (False, None, "stale_claim", 256, None)
EVENTS = {
    "ok": [OK], "cut then ceiling": [CUT, (True, "length", None, 384, None)], "cut then fine": [CUT, (True, "stop", None, 384, "A")], "three times": [IO, IO, IO], "twice, then fine": [IO, IO, OK],
    "stale is free": [STALE] * 5 + [OK], "integrity": [(False, None, "integrity", 256, None)], "late after complete": [OK, OK], "conflict": [OK, (True, "stop", None, 256, "Other")], "late after rejected": [IO, IO, IO, OK],
    "blank stop": [(True, "stop", None, 256, "  ")] * 4,
}
EXPECTED = {
    "ok": ("complete", "ok"), "cut then ceiling": ("rejected", "truncated_at_ceiling"), "cut then fine": ("complete", "ok"), "three times": ("rejected", "transient_exhausted"), "twice, then fine": ("complete", "ok"),
    "stale is free": ("complete", "ok"), "integrity": ("rejected", "integrity"), "late after complete": ("complete", "ok"), "conflict": ("complete", "ok"), "late after rejected": ("rejected", "transient_exhausted"),
    "blank stop": ("retryable", "engine_transient"),
}


def test_histories(spark):
    got = history(spark, EVENTS)
    assert {k: (r.state, r.reason) for k, r in got.items()} == EXPECTED
    assert {k for k, r in got.items() if r.conflict} == {"conflict"}
    for name, events in EVENTS.items():  # the streaming rule is the same rule
        s = dict(ledger.FRESH)
        for ok, finish, category, top, txt in events:
            s = ledger.step(s, {"ok": ok, "finish_reason": finish, "error_category": category, "max_tokens": top, "instruction": txt})
        assert (s["state"], s["reason"], bool(s["conflict"])) == (got[name].state, got[name].reason, got[name].conflict)


def test_release_and_claim(spark):
    rows = spark.createDataFrame([("a", "running", 10.0, 2), ("b", "running", 99.0, 0), ("c", "complete", 10.0, 0)], "row_id string, state string, claimed_at double, transient_count int")
    got = {r.row_id: r for r in ledger.release(rows, "worker_lost", 100.0, older_than=50.0).collect()}
    assert {k: v.reason for k, v in got.items()} == {"a": "transient_exhausted"}
    assert [r.row_id for r in ledger.release(rows, "stale_claim", 100.0).orderBy("row_id").collect()] == ["a", "b"]
    with pytest.raises(ValueError):
        ledger.release(rows, "nonsense", 0.0)
    again = ledger.reprocess(spark.createDataFrame([("a", "rejected", "x", "input_invalid"), ("b", "rejected", "x", "transient")], "row_id string, state string, reason string, category string"))
    assert {r.row_id: r.state for r in again.collect()} == {"a": "rejected", "b": "pending"}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)] + [(7, 7), (None, 3)]
    parent = list(range(400))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a is not None:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {n: root(n) for e in edges if e[0] is not None for n in e}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_groups(spark):
    rows = spark.createDataFrame([("a", "t1", "i1"), ("b", "t1", "i2"), ("c", "t3", "i2"), ("d", "t3", "i4"), ("e", "t5", "i5"), ("f", "t6", "i6"), ("g", "t6", "i7")], "id string, t string, i string")
    named = dedup.name_groups(dedup.duplicate_components(rows, "id", ["t", "i"]), "id", "v")
    members = {}
    for r in named.collect():
        members.setdefault(r.group_id, set()).add(r.id)
    assert sorted(map(sorted, members.values())) == [["a", "b", "c", "d"], ["e"], ["f", "g"]]
    with pytest.raises(Exception, match="missing t"):
        dedup.duplicate_components(spark.createDataFrame([("a", None, "i")], "id string, t string, i string"), "id", ["t", "i"]).collect()


def test_overlap(spark):
    left = spark.createDataFrame([(1, "a b c d"), (2, "a b"), (3, None), (4, "x y z w")], "l int, text string")
    right = spark.createDataFrame([(8, "b c d e"), (9, "a b"), (7, "a  b\n")], "r int, text string")
    got = {(r.l, r.r): (r.shared, r.jaccard) for r in dedup.overlaps(left, "l", right, "r", 3).collect()}
    assert got == {(1, 8): (1, 1 / 3), (2, 9): (1, 1.0), (2, 7): (1, 1.0)}
    assert [r.r for r in dedup.best_overlap(dedup.overlaps(left, "l", right, "r", 3), "l", "r").where("l = 2").collect()] == [7]
    kinds = {r.l: r.kind for r in dedup.memorized(left, "l", right, "r", 3, 0.3).collect()}
    assert kinds == {1: "near", 2: "exact", 3: None, 4: None}


def test_order_and_slots(spark):
    rng = random.Random(2)
    values = rng.sample(range(10_000), 500)
    df = spark.createDataFrame([(v, rng.randrange(3)) for v in values], "v long, g int").repartition(7)
    at = {r.v: r.i for r in ordering.global_index(df, [F.col("v")], F.col("v"), "i").collect()}
    assert at == {v: i for i, v in enumerate(sorted(values))}
    before = {r.v: r.b for r in ordering.running_sum_before(df, [F.col("v")], F.col("v"), "v", "b").collect()}
    run = 0
    for v in sorted(values):
        assert before[v] == run
        run += v
    got = slots.dense_slots(df, "g", ["v"]).collect()
    for g in range(3):
        assert sorted(r.slot for r in got if r.g == g) == list(range(sum(1 for r in got if r.g == g)))


def test_splits(spark):
    groups = spark.createDataFrame([(f"g{i}", 30 if i == 3 else 1 + i % 3) for i in range(40)], "group_id string, members long")
    got = splits.assign_splits(groups, 1, 0.1, 0.1).collect()
    total = sum(r.members for r in got)
    by = {s: sum(r.members for r in got if r.split == s) for s in ("train", "validation", "test")}
    assert len(got) == 40 and by["validation"] >= round(total * 0.1) and by["train"] > 0
    with pytest.raises(ValueError):
        splits.assign_splits(groups, 1, 0.001, 0.1)
    with pytest.raises(ValueError):
        splits.assign_splits(groups, 1, 0.5, 0.5)
    items = [(i, f"r{i}", (i * 37) % 101) for i in range(50)]
    df = spark.createDataFrame(items, "i int, id string, chars int")
    assert {r.id: r.worker for r in splits.balanced_assignment(df, "i", "id", "chars", 3).collect()} == splits.balanced(items, 3)
    again = list(range(10))
    random.Random(5).shuffle(again)
    assert splits.shuffled_like_python(list(reversed(range(10))), 5) == again


def test_tokens(spark):
    df = spark.createDataFrame([("a", [1, 2, 3, 4], [-100, -100, 3, 4], 0), ("b", [5, 6], [-100, 6], 0)], "id string, input_ids array<int>, labels array<int>, b int")
    padded = tokens.pad(df, "b", 9, 3).withColumn("p", tokens.batch_problems(9))
    got = {r.id: r for r in padded.collect()}
    assert got["b"].input_ids == [5, 6, 9, 9, 9, 9] and got["b"].labels == [-100, 6] + [-100] * 4 and got["b"].attention_mask == [1, 1, 0, 0, 0, 0] and got["b"].position_ids == [0, 1, 0, 0, 0, 0]
    assert all(r.p == [] for r in got.values())
    bad = spark.createDataFrame(
        [(1, [1, 2, 9], [1, -100, -100], [1, 1, 0], [0, 1, 0]), (2, [1, 2], [-100, -100], [1, 1], [0, 1]), (3, [1, 8], [1, 5], [1, 0], [0, 3]), (4, [1, 2], [7, 2], [1, 1], [0, 1]), (5, [1], [1, 1], [1], [0])],
        "id int, input_ids array<int>, labels array<int>, attention_mask array<int>, position_ids array<int>",
    )
    found = {r.id: set(r.p) for r in bad.withColumn("p", tokens.batch_problems(9)).collect()}
    assert found[1] == {"ignored after supervised"} and found[2] == {"no supervised token"} and found[3] == {"padding token", "padding label", "padding position"} and found[4] == {"foreign label"} and "different lengths" in found[5]
    with pytest.raises(Exception, match="differ in length"):
        tokens.token_stats(bad).collect()
    off = spark.createDataFrame([(1, [(0, 2), (2, 5), (5, 6)], 2), (2, [(0, 3), (3, 5)], 2), (3, [(0, 2)], 5)], "id int, o array<struct<begin:int,end:int>>, t int")
    assert {r.id: r.b.problem for r in off.select("id", tokens.boundary(F.col("o"), F.col("t")).alias("b")).collect()} == {1: None, 2: "spanning token", 3: "no target tokens"}


def test_checks_and_runs(spark):
    a, b = (spark.createDataFrame([(x,) for x in v], "id int") for v in ([1, 2, 2], [2, 3]))
    assert {tuple(r) for r in checks.set_difference(a, b, "id").collect()} == {(1, "left"), (3, "right")}
    report = checks.report(checks.count_check("dup", checks.duplicates(a, "id"), "warn"), checks.row_checks(a, {"big": F.col("id") > 1, "none": F.col("id") > 9}))
    assert {r.check: (r.violations, r.status) for r in report.collect()} == {"dup": (1, "warn"), "big": (2, "fail"), "none": (0, "pass")}
    assert checks.roll_up(report).first()[:] == (1, 1, 1, "fail")
    doc = spark.createDataFrame([("\\documentclass{a}\n\\begin{document}x\\end{document} rest",)], "t string").select(evaluate.build(evaluate.extract("t"))).first()[0]
    assert doc == "\\documentclass{a}\n\\begin{document}x\\end{document}\n"


def document(rows, batch=0, generation=0):
    return json.dumps({"run_id": "r", "worker": "w", "worker_index": 0, "generation": generation, "batch_index": batch, "results": rows})


def result(row, ok=True, finish="stop", text="A box", category=None, top=256):
    return {"row_id": row, "ok": ok, "finish_reason": finish, "instruction": text, "error_category": category, "max_tokens": top}


def test_files_and_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    first = document([result("a"), result("b", False, None, None, "io")], 0)
    (folder / "1.json").write_text(first)
    (folder / "1-again.json").write_text(first)
    (folder / "bad.json").write_text("{nope")
    docs = files.result_documents(spark, str(folder))
    assert files.malformed(docs).count() == 1 and files.explode_results(docs).count() == 4
    run = lambda: ingest.run_available(ingest.advance(ingest.results(ingest.once(ingest.read_documents(spark, str(folder))))), str(tmp_path / "out"), str(tmp_path / "cp"))
    run()
    assert {r.row_id: (r.state, r.attempts) for r in ingest.last_states(spark, str(tmp_path / "out")).collect()} == {"a": ("complete", 1), "b": ("retryable", 1)}
    (folder / "2.json").write_text(document([result("b", False, None, None, "io"), result("a", text="Other")], 1))
    (folder / "3.json").write_text(document([result("b", False, None, None, "timeout")], 2))
    run()
    got = {r.row_id: r for r in ingest.last_states(spark, str(tmp_path / "out")).collect()}
    assert (got["b"].state, got["b"].reason, got["a"].conflict) == ("rejected", "transient_exhausted", True)


def test_readers(spark, tmp_path):
    (tmp_path / "jobs.txt").write_text("1|a|DONE|||||| 60\n2|b|DONE||||||\nshort|row\n")
    jobs = {r.job_id: r.seconds for r in files.job_history(spark, str(tmp_path / "jobs.txt")).collect()}
    assert jobs == {"1": 60, "2": 0}
    (tmp_path / "pins.txt").write_text("# comment\n\nNum_py==1.2 # why\ntorch==2.0\n")
    assert {tuple(r) for r in files.pins(spark, str(tmp_path / "pins.txt")).collect()} == {("num-py", "1.2"), ("torch", "2.0")}
    (tmp_path / "twice.txt").write_text("a==1\nA==2\n")
    with pytest.raises(Exception, match="duplicate pin"):
        files.pins(spark, str(tmp_path / "twice.txt")).collect()
    (tmp_path / "base.yaml").write_text("a: {x: 1, y: 2}\nl: [1, 2]\n")
    (tmp_path / "top.yaml").write_text("inherits: base.yaml\na: {y: 3}\nl: [9]\n")
    assert files.yaml_document(str(tmp_path / "top.yaml")) == {"a": {"x": 1, "y": 3}, "l": [9]}
    (tmp_path / "loop.yaml").write_text("inherits: loop.yaml\n")
    with pytest.raises(ValueError, match="inherits itself"):
        files.yaml_document(str(tmp_path / "loop.yaml"))
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    assert files.rows_by_id(rows, rows.where("id = 2"), "id").count() == 1
    with pytest.raises(Exception, match="missing id 9"):
        files.rows_by_id(rows, spark.createDataFrame([(9,)], "id int"), "id").collect()


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(i, f"r{i}", f"text {i}") for i in range(25)], "i long, id string, t string").repartition(3)
    line = sinks.document_line(id=F.col("id"), t=F.col("t"))
    meta = sinks.export(df, str(tmp_path / "out"), "i", "id", line, 10)
    assert [s["rows"] for s in meta["shards"]] == [10, 10, 5] and meta["rows"] == 25
    assert sinks.export(df.repartition(5), str(tmp_path / "out"), "i", "id", line, 10) == meta
    smaller = sinks.export(df.where("i < 7"), str(tmp_path / "out"), "i", "id", line, 10)
    assert smaller["rows"] == 7 and spark.read.parquet(str(tmp_path / "out")).count() == 7
    sinks.json_atomic(str(tmp_path / "m.json"), {"b": 1, "a": [1]})
    assert (tmp_path / "m.json").read_text() == '{\n  "a": [\n    1\n  ],\n  "b": 1\n}\n'
    assert sinks.markdown([{"a": 1.23456, "b": None}]) == "| a | b |\n| --- | --- |\n| 1.235 | - |\n"
    sinks.quarantine_jsonl(df.where("i < 2"), str(tmp_path / "q"))
    assert (tmp_path / "q").exists()
    sinks.quarantine_jsonl(df.where("i < 0"), str(tmp_path / "q"))
    assert not (tmp_path / "q").exists()
    assert sinks.snapshot(df, str(tmp_path), "s") != sinks.snapshot(df, str(tmp_path), "s")


def test_retry_range(spark):
    """The range is the caller's: to the last index it covers the whole table."""
    rows = spark.createDataFrame([(i, i, "complete" if i == 1999 else "retryable", 5000.0 - i) for i in range(2000)], "row_id int, source_row_index int, state string, not_before double")
    assert [ledger.next_retry(rows, a, b).first().next_retry for a, b in ((0, 1000), (0, 1999), (1500, 1600), (1999, 1999))] == [4000.0, 3002.0, 3400.0, None]
    assert [r.row_id for r in ledger.eligible(rows, 3500.0, 0, 1999, 50).collect()] == list(range(1500, 1550))
    assert ledger.eligible(rows, 3500.0, 0, 1000, 50).count() == 0
