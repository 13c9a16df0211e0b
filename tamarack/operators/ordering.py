"""Global order without a single task: ranges by approximate quantiles, exact positions within and across them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Rows in a range, and the bounds on the number of ranges.
ROWS, FEWEST, MOST = 1_000_000, 16, 4096


def ranged(df: DataFrame, spread: Column, parts: int | None = None) -> DataFrame:
    """Append ``_range``: the quantile range of a numeric ``spread`` (nulls in the first).

    There are ``parts`` ranges, or as many as give each about ``ROWS`` rows. A row finds its range in two steps, among the
    first bounds of blocks and then within a block, so that many ranges cost a row no more than twice the root of them.
    """
    fine = parts or MOST
    n, q = df.agg(F.count("*"), F.percentile_approx(spread, [i / fine for i in range(1, fine)], 10_000)).first()
    if parts is None:
        parts = min(MOST, max(FEWEST, -(-n // ROWS)))
        q = [q[i * MOST // parts - 1] for i in range(1, parts)] if q else q
    cuts = sorted(set(q or []))
    if not cuts:
        return df.withColumn("_range", F.lit(0))
    step = max(1, int(len(cuts) ** 0.5))
    blocks = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    below = lambda bounds: F.size(F.filter(bounds, lambda c: c <= spread))
    block = below(F.array(*[F.lit(x[0]) for x in blocks]))  # blocks that begin at or below the row
    inner = F.get(F.array(*[F.array(*map(F.lit, x)) for x in blocks]), block - 1)
    return df.withColumn("_range", F.coalesce(F.when(block > 0, (block - 1) * step + below(inner)), F.lit(0)))


def _lifted(df: DataFrame, amount: Column) -> DataFrame:
    """Per range, what all ranges before it amount to: one row per range."""
    sums = df.groupBy("_range").agg(amount.alias("_amount"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as ranges
    return sums.select("_range", F.coalesce(F.sum("_amount").over(before), F.lit(0)).alias("_lift"))


def global_index(df: DataFrame, order: list[Column], spread: Column, name: str, parts: int | None = None) -> DataFrame:
    """Append ``name``: the 0-based position in the order of ``order``; ``spread`` must not decrease along it."""
    cut = ranged(df, spread, parts)
    local = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    out = cut.withColumn("_local", local).join(F.broadcast(_lifted(cut, F.count("*"))), "_range")  # a row per range
    return out.withColumn(name, (F.col("_local") + F.col("_lift")).cast("bigint")).select(*df.columns, name)


def running_sum_before(df: DataFrame, order: list[Column], spread: Column, value: str, name: str, parts: int | None = None) -> DataFrame:
    """Append ``name``: the sum of ``value`` over all rows before this one."""
    cut = ranged(df, spread, parts)
    w = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = cut.withColumn("_local", F.coalesce(F.sum(value).over(w), F.lit(0))).join(F.broadcast(_lifted(cut, F.sum(value))), "_range")
    return out.withColumn(name, (F.col("_local") + F.col("_lift")).cast("bigint")).select(*df.columns, name)


def hex_spread(c: Column | str) -> Column:
    """A hex digest's first 15 digits as a number: grows with the digest's text order."""
    return F.conv(F.substring(c, 1, 15), 16, 10).cast("bigint")
