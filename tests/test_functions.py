"""Text, identity, rank and time expressions against plain Python."""

import hashlib
import json
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tamarack.functions import ids, stats, text, time
from tamarack.operators.policy import instruction_policy, is_sha256

EDGE = ["", " ", "\n", "a\x00b", "a\x1cb\x85c\u00a0d\u3000e", '"\\\x1f\x7f', "😀 x", "\t\x0b\x0c y ", "é\u2028ü"]


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_white_space(spark):
    assert column(spark, EDGE, text.py_strip) == [s.strip() for s in EDGE]
    assert column(spark, EDGE, text.squash) == [" ".join(s.split()) for s in EDGE]
    assert column(spark, EDGE, text.word_count) == [len(s.split()) for s in EDGE]
    assert column(spark, [None], text.squash) == [""]
    assert column(spark, ["  a ", "\na\n"], text.sql_trim) == ["a", "\na\n"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=30), min_size=1, max_size=30))
def test_json_string(spark, values):
    assert column(spark, values, text.json_string) == [json.dumps(v, ensure_ascii=False) for v in values]


def test_identities(spark):
    df = spark.createDataFrame([(5, "x", "y")], "i int, t string, m string")
    made = df.select(ids.stable_row_id("v", "d", "r", "s", F.col("i"), ids.sha("t"), ids.sha("m"))).first()[0]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert made == sha("\x1f".join(["v", "d", "r", "s", "5", sha("x"), sha("y")]))[:32]
    assert df.select(ids.list_digest(F.array(F.lit("a"), F.lit("b")))).first()[0] == ids.canonical_digest(["a", "b"])
    assert df.select(ids.list_digest(F.array().cast("array<string>"))).first()[0] == ids.canonical_digest([])
    line = df.select(ids.logical_row(b=text.json_string("t"), a=F.col("i").cast("string"))).first()[0]
    assert line == json.dumps({"a": 5, "b": "x"}, sort_keys=True) + "\n"
    assert column(spark, ["a" * 64, "A" * 64, "a" * 64 + "\n"], is_sha256) == [True, False, False]


@pytest.mark.parametrize("n", [1, 2, 3, 10, 29])
def test_ranks(spark, n):
    values = [random.Random(n).randint(0, 9) for _ in range(n)]
    df = spark.createDataFrame([("g", v) for v in values] + [("h", None)], "k string, v int")
    got = {r.k: r for r in stats.ranks(df, ["k"], "v", {"p90": ("fraction", 0.9), "mid": ("middle",)}).collect()}
    s = sorted(values)
    assert (got["g"].p90, got["g"].mid) == (s[min(n - 1, int((n - 1) * 0.9))], s[n // 2])
    assert "h" not in got
    summary = stats.length_summary(df, ["k"], "v").where("k = 'g'").first()
    assert (summary["count"], summary.total, summary.p50) == (n, sum(s), s[int((n - 1) * 0.5)])


def test_numbers(spark):
    assert column(spark, [0, 1, 2, 255, 256], stats.bit_length, "int") == [0, 1, 2, 8, 9]
    assert column(spark, [0, 1, 2, 5, 6, 20], stats.backoff, "int") == [30, 30, 60, 480, 600, 600]
    assert column(spark, [0.5, 1.5, 2.5], stats.half_even, "double") == [0, 2, 2]
    assert column(spark, [0.0, 4.0, None], lambda c: stats.ratio(F.lit(1.0), c), "double") == [None, 0.25, None]
    assert column(spark, [0.0, 1e9 + 0.5], time.iso, "double") == ["1970-01-01T00:00:00Z", "2001-09-09T01:46:40Z"]
    assert column(spark, [1e9], time.file_stamp, "double") == ["20010909-014640"]
    assert column(spark, ["2001-09-09T01:46:41Z"], lambda c: time.between(F.lit("2001-09-09T01:46:40Z"), c)) == [1.0]
    low, high = stats.steps_per_run(F.lit(100), F.lit(8), F.lit(4), F.lit(2), F.lit(0))
    assert spark.range(1).select(low, high).first()[:] == (6, 8)


def test_text_helpers(spark):
    reasoning, answer = text.after_reasoning("v")
    df = spark.createDataFrame([("a</think>b</think>c",), ("plain",)], "v string")
    assert [tuple(r) for r in df.select(reasoning, answer).collect()] == [("a", "b</think>c"), ("", "plain")]
    assert column(spark, ["x" * 81, "x" * 80], text.shorten) == ["x" * 77 + "...", "x" * 80]
    assert column(spark, [" My_Pkg.x "], text.package_name) == ["my-pkg-x"]
    log = "\n".join(f"line {i}" for i in range(60))
    assert column(spark, [log], text.log_tail) == ["\n".join(log.splitlines()[-40:])]


def test_policy_table(spark):
    cases = {"x" * 19: "too_short", "x" * 20: "ok", "w " * 120 + "w": "too_many_words", "In THIS TASK we draw a box here": "task_reference", "nul \x00 in the middle of it all": "control_characters"}
    assert column(spark, list(cases), lambda c: instruction_policy(c)["rule"]) == list(cases.values())
