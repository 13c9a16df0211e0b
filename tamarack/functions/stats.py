"""Numeric rules: rank percentiles, half-even rounding, guarded ratios, retry and schedule arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def half_even(c: Column, digits: int = 0) -> Column:
    return F.bround(c, digits)


def ratio(a: Column, b: Column, digits: int | None = 6) -> Column:
    """``a / b``, null where ``b`` is null or 0."""
    r = F.try_divide(a, F.nullif(b, F.lit(0)))
    return r if digits is None else F.bround(r, digits)


def backoff(attempts: Column, base: float = 30.0, cap: float = 600.0) -> Column:
    """``min(cap, base * 2 ** max(0, attempts - 1))``."""
    return F.least(F.lit(float(cap)), F.lit(float(base)) * F.pow(F.lit(2.0), F.greatest(F.lit(0), attempts - 1)))


def bit_length(c: Column) -> Column:
    """Bits of a non-negative integer, 0 for 0."""
    return F.when(c == 0, 0).otherwise(F.length(F.bin(c)))


def finite(c: Column) -> Column:
    return ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def is_missing(c: Column, zero: Column) -> Column:
    """Null where ``c`` is null or its type's zero, for fallbacks that treat both as missing."""
    return F.nullif(c, zero)


def steps_per_run(rows: Column, batch: Column, accumulation: Column, epochs: Column, cap: Column) -> tuple[Column, Column]:
    """Least and most optimizer steps of a run; a positive ``cap`` bounds both."""
    batches = F.ceil(rows / batch)
    low = F.greatest(F.lit(1), F.floor(batches / accumulation) * epochs)
    high = F.greatest(F.lit(1), F.ceil(batches / accumulation) * epochs)
    held = lambda x: F.when(cap > 0, F.least(cap, x)).otherwise(x).cast("bigint")
    return held(low), held(high)


def warmup_steps(steps: Column, fraction: float) -> Column:
    """A fraction of all steps, rounded up."""
    return F.ceil(steps * F.lit(float(fraction)))


def loss_reduction(first: Column, last: Column) -> Column:
    """``1 - last / first`` of two finite numbers, the first positive; else null."""
    return F.when(finite(first) & finite(last) & (first > 0), 1 - last / first)


def ranks(df: DataFrame, by: list[str], value: str, picks: dict[str, tuple]) -> DataFrame:
    """Order statistics per group without collecting a group.

    ``picks`` maps a name to ``("fraction", f)`` for ``sorted[int((n - 1) * f)]`` or ``("middle",)`` for
    ``sorted[n // 2]``. Values are counted first, so what is sorted is distinct values. Nulls are left out.
    """
    keys = [F.col(c) for c in by] or [F.lit(0).alias("_all")]
    names = by or ["_all"]
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*names).orderBy("_v")
    run = counts.withColumn("_run", F.sum("_n").over(w)).withColumn("_total", F.sum("_n").over(Window.partitionBy(*names)))

    def want(pick: tuple) -> Column:
        if pick[0] == "middle":
            return F.expr("_total div 2") + 1
        return F.floor((F.col("_total") - 1) * F.lit(float(pick[1]))) + 1

    out = run.groupBy(*names).agg(*[F.min(F.when(F.col("_run") >= want(p), F.col("_v"))).alias(n) for n, p in picks.items()])
    return out if by else out.drop("_all")


def length_summary(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """``count, total, mean, min, p50, p90, p95, p99, max`` per group."""
    base = df.groupBy(*by).agg(
        F.count(value).alias("count"), F.sum(value).alias("total"), F.bround(F.sum(value) / F.count(value), 3).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max")
    )
    tail = ranks(df, by, value, {f"p{p}": ("fraction", p / 100) for p in (50, 90, 95, 99)})
    joined = base.join(tail, by, "left") if by else base.crossJoin(tail)  # one row on either side
    return joined.select(*by, "count", "total", "mean", "min", "p50", "p90", "p95", "p99", "max")
