"""Row outcomes: the retry decision, ledger summaries, claims, releases and history folds.

A row is pending, running, retryable, complete or rejected. ``decide`` is one expression used everywhere; the fold over
a row's results in order and the streaming operator share :func:`step`, the same rules on plain values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarack.functions.stats import backoff
from tamarack.functions.text import py_strip

#: States and error categories.
STATES = ("pending", "running", "retryable", "complete", "rejected")
TRANSIENT = ("engine_transient", "engine_fatal", "timeout", "io", "transport", "decode", "worker_lost", "worker_stall")
NOT_COUNTED = ("stale_claim", "run_interrupted")
REJECTED_AT_ONCE = ("input_invalid", "integrity", "input_too_long", "invalid_instruction")


@dataclass(frozen=True)
class RetryPolicy:
    attempts: int = 3
    base_seconds: float = 30.0
    cap_seconds: float = 600.0
    tokens: int = 256
    ceiling: int = 384
    #: Count a blank stop without a category as transient, so that its budget ends.
    strict_budget: bool = False


def decide(ok: Column, finish: Column, instruction: Column, category: Column, at_ceiling: Column, transient: Column, policy: RetryPolicy = RetryPolicy()) -> Column:
    """``struct(state, reason, category, backoff_seconds)`` of a finished attempt.

    ``at_ceiling``: any attempt so far, this one included, had the ceiling's tokens. ``transient``: how many had a
    transient category.
    """
    named = F.coalesce(F.nullif(category, F.lit("")), F.lit("engine_transient"))
    done = F.coalesce(ok & (finish == "stop") & (F.length(py_strip(F.coalesce(instruction, F.lit("")))) > 0), F.lit(False))
    cut = F.coalesce(finish == "length", F.lit(False))
    wait = backoff(transient, policy.base_seconds, policy.cap_seconds)

    def out(state: str, reason, kind, seconds=None) -> Column:
        lit = lambda x: F.lit(x) if isinstance(x, str) else x
        return F.struct(F.lit(state).alias("state"), lit(reason).alias("reason"), lit(kind).alias("category"), (F.lit(0.0) if seconds is None else seconds).alias("backoff_seconds"))

    return (
        F.when(done, out("complete", "ok", "none"))
        .when(named.isin(*REJECTED_AT_ONCE), out("rejected", named, named))
        .when(cut & F.coalesce(at_ceiling, F.lit(False)), out("rejected", "truncated_at_ceiling", "truncation"))
        .when(cut, out("retryable", "truncated", "truncation"))
        .when(transient >= policy.attempts, out("rejected", "transient_exhausted", "transient"))
        .when(named.isin(*NOT_COUNTED), out("retryable", named, "transient"))
        .otherwise(out("retryable", named, "transient", wait))
    )


def step(state: dict, result: dict, policy: RetryPolicy = RetryPolicy()) -> dict:
    """The same rules on one row's running state: ``state`` after ``result``.

    ``state``: ``state, transient, ceiling, instruction, attempts, reason``. A terminal row never changes; a
    different text for a complete row is a conflict.
    """
    now = dict(state)
    if now["state"] == "complete":
        now["conflict"] = bool(now.get("conflict")) or now.get("instruction") != result.get("instruction")
        return now
    if now["state"] == "rejected":
        return now
    category = result.get("error_category") or None
    named, finish = category or "engine_transient", result.get("finish_reason")
    done = result.get("ok") and finish == "stop" and (result.get("instruction") or "").strip()
    now["attempts"] += 1
    now["transient"] += category in TRANSIENT or (policy.strict_budget and category is None and finish != "length" and not done)
    now["ceiling"] = now["ceiling"] or (result.get("max_tokens") or 0) >= policy.ceiling
    if done:
        return now | {"state": "complete", "reason": "ok", "instruction": result["instruction"]}
    if named in REJECTED_AT_ONCE:
        return now | {"state": "rejected", "reason": named}
    if finish == "length":
        return now | ({"state": "rejected", "reason": "truncated_at_ceiling"} if now["ceiling"] else {"state": "retryable", "reason": "truncated"})
    if now["transient"] >= policy.attempts:
        return now | {"state": "rejected", "reason": "transient_exhausted"}
    return now | {"state": "retryable", "reason": named}


FRESH = {"state": "pending", "transient": 0, "ceiling": False, "instruction": None, "attempts": 0, "reason": None, "conflict": False}


def attempts_from_events(events: DataFrame, policy: RetryPolicy = RetryPolicy()) -> DataFrame:
    """A deterministic attempt history out of an event stream, decided and cut at each row's first terminal state."""
    by = Window.partitionBy("user_id").orderBy("ts", "event_id")
    past = by.rowsBetween(Window.unboundedPreceding, -1)
    kind = F.col("event_type")
    category = (
        F.when(kind == "error", "engine_transient").when(kind == "signup", "stale_claim").when((kind == "view") & (F.col("event_id") % 97 == 0), "integrity").when(kind == "view", "timeout")
    )
    rows = events.select(
        F.col("user_id").alias("row_id"), "event_id", "ts", "value", F.row_number().over(by).alias("attempt_no"), (kind == "purchase").alias("ok"),
        F.when(kind == "purchase", "stop").when(kind == "click", "length").alias("finish_reason"), category.alias("error_category"),
        F.when(F.coalesce(F.max(F.when(kind == "click", 1)).over(past), F.lit(0)) == 1, policy.ceiling).otherwise(policy.tokens).alias("max_tokens"),
        F.when(kind == "purchase", F.concat(F.lit("event "), F.col("event_id"))).alias("instruction"),
    )
    seen = Window.partitionBy("row_id").orderBy("attempt_no")
    rows = rows.withColumn("transient_count", F.sum(F.when(F.col("error_category").isin(*TRANSIENT), 1).otherwise(0)).over(seen))
    rows = rows.withColumn("at_ceiling", F.max(F.col("max_tokens") >= policy.ceiling).over(seen))
    d = decide(F.col("ok"), F.col("finish_reason"), F.col("instruction"), F.col("error_category"), F.col("at_ceiling"), F.col("transient_count"), policy)
    rows = rows.withColumn("d", d)
    over = F.max(F.when(F.col("d.state").isin("complete", "rejected"), 1).otherwise(0)).over(seen.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_over", F.coalesce(over, F.lit(0))).where("_over = 0")
    return rows.select(
        "row_id", "event_id", "ts", "attempt_no", "ok", "finish_reason", "error_category", "max_tokens", "instruction", "value", "transient_count", F.col("d.state").alias("state"),
        F.col("d.reason").alias("reason"), F.col("d.category").alias("category"), F.col("d.backoff_seconds").alias("backoff_seconds"),
    )


def latest(attempts: DataFrame) -> DataFrame:
    """The last attempt of each row: its present state."""
    w = Window.partitionBy("row_id").orderBy(F.desc("attempt_no"))
    return attempts.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def state_counts(rows: DataFrame) -> DataFrame:
    """Rows per state, all five states present."""
    domain = rows.sparkSession.createDataFrame([(s,) for s in STATES], "state string")
    return domain.join(rows.groupBy("state").agg(F.count("*").alias("n")), "state", "left").select("state", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def eligible(rows: DataFrame, now: float, start: int, end: int, limit: int) -> DataFrame:
    """Rows that may be claimed, in index order."""
    ok = F.col("state").isin("pending", "retryable") & (F.col("not_before") <= now) & F.col("source_row_index").between(start, end)
    return rows.where(ok).orderBy("source_row_index").limit(limit)


def next_retry(rows: DataFrame, start: int, end: int) -> DataFrame:
    """When the first retryable row of an index range is due."""
    return rows.where((F.col("state") == "retryable") & F.col("source_row_index").between(start, end)).agg(F.min("not_before").alias("next_retry"))


def claim(rows: DataFrame, assignments: DataFrame, now: float) -> DataFrame:
    """Assigned rows with their new attempt number; ``conflict`` names what forbids a claim."""
    found = assignments.join(rows.drop("worker"), "row_id", "left")
    conflict = F.when(F.col("state").isNull(), "unknown_row").when(~F.col("state").isin("pending", "retryable"), F.concat(F.lit("state_"), F.col("state"))).when(F.col("not_before") > now, "not_due")
    return found.select("row_id", "worker", (F.coalesce("attempt_count", F.lit(0)) + 1).alias("attempt_no"), F.lit(now).alias("claimed_at"), conflict.alias("conflict"))


def release(rows: DataFrame, category: str, now: float, older_than: float | None = None, policy: RetryPolicy = RetryPolicy()) -> DataFrame:
    """What becomes of running rows whose worker is gone; ``transient_count`` is what they had before."""
    if category not in TRANSIENT + NOT_COUNTED:
        raise ValueError(f"unknown release category {category!r}")
    held = rows.where("state = 'running'")
    if older_than is not None:
        held = held.where(F.col("claimed_at") < older_than)
    count = F.col("transient_count") + (1 if category in TRANSIENT else 0)
    none = F.lit(None).cast("string")
    d = decide(F.lit(False), none, none, F.lit(category), F.lit(False), count, policy)
    out = held.withColumn("d", d)
    return out.select("row_id", F.col("d.state").alias("state"), F.col("d.reason").alias("reason"), (F.lit(float(now)) + F.col("d.backoff_seconds")).alias("not_before"))


def reprocess(rows: DataFrame) -> DataFrame:
    """Rejected rows go back to pending, unless their input was invalid."""
    again = (F.col("state") == "rejected") & (F.coalesce("category", F.lit("")) != "input_invalid")
    return rows.withColumn("state", F.when(again, "pending").otherwise(F.col("state"))).withColumn("reason", F.when(again, None).otherwise(F.col("reason")))


def settle(results: DataFrame, policy: RetryPolicy = RetryPolicy()) -> DataFrame:
    """Fold each row's results in order into its state (batch form of the streaming operator).

    A row's history is bounded by its retry budget, so the ordered list of one row is short.
    """
    kept = F.struct("attempt_no", "ok", "finish_reason", "error_category", "max_tokens", "instruction")
    history = results.groupBy("row_id").agg(F.array_sort(F.collect_list(kept)).alias("h"))
    start = F.struct(
        F.lit("pending").alias("state"), F.lit(0).alias("transient"), F.lit(False).alias("ceiling"), F.lit(0).alias("attempts"), F.lit(None).cast("string").alias("reason"),
        F.lit(None).cast("string").alias("instruction"), F.lit(False).alias("conflict"),
    )

    def fold(s: Column, r: Column) -> Column:
        over = s["state"].isin("complete", "rejected")
        transient = s["transient"] + F.when(F.coalesce(r["error_category"].isin(*TRANSIENT), F.lit(False)), 1).otherwise(0)
        ceiling = s["ceiling"] | F.coalesce(r["max_tokens"] >= policy.ceiling, F.lit(False))
        d = decide(r["ok"], r["finish_reason"], r["instruction"], r["error_category"], ceiling, transient, policy)
        clash = (s["state"] == "complete") & ~s["instruction"].eqNullSafe(r["instruction"])
        pick = lambda old, new, name: F.when(over, old).otherwise(new).alias(name)
        return F.struct(
            pick(s["state"], d["state"], "state"), pick(s["transient"], transient, "transient"), pick(s["ceiling"], ceiling, "ceiling"), pick(s["attempts"], s["attempts"] + 1, "attempts"),
            pick(s["reason"], d["reason"], "reason"), pick(s["instruction"], F.when(d["state"] == "complete", r["instruction"]), "instruction"), (s["conflict"] | clash).alias("conflict"),
        )

    out = history.select("row_id", F.aggregate("h", start, fold).alias("s"))
    return out.select("row_id", *[F.col(f"s.{c}").alias(c) for c in ("state", "reason", "attempts", "transient", "instruction", "conflict")])


def rate_and_eta(done: DataFrame, ts: str, now: float, remaining: Column, window: float = 1800.0) -> DataFrame:
    """Completions per hour lately and overall, and seconds to go at the better known of the two."""
    t = F.col(ts)
    lately = F.count_if(t >= now - window) * (3600.0 / window)
    span = F.greatest(F.lit(1.0), F.max(t) - F.min(t))
    rates = done.agg(F.count("*").alias("completed"), lately.cast("double").alias("recent_per_hour"), (F.count("*") * 3600.0 / span).alias("overall_per_hour"))
    rate = F.coalesce(F.nullif("recent_per_hour", F.lit(0.0)), "overall_per_hour")
    return rates.withColumn("eta_seconds", F.try_divide(remaining * 3600.0, rate))
