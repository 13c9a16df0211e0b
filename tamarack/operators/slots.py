"""Gapless positions within groups without one task per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dense_slots(df: DataFrame, group: str, order: list[str], name: str = "slot", spread: int | None = None) -> DataFrame:
    """Number the rows of each ``group`` 0, 1, 2, ... under ``name``.

    Every group is cut into ``spread`` sub-groups (64, or as many as leave a group that is the whole table half a million
    rows each) by a hash of its order columns. Rows are numbered inside
    their sub-group and lifted by the sizes of the sub-groups before it, so a group with a third of all rows
    takes part in many tasks. ``df`` must give the same rows each time it is read (a durable table).
    """
    spread = spread or max(64, df.count() // 500_000)
    cut = df.withColumn("_cut", F.pmod(F.xxhash64(*order), F.lit(spread)).cast("int"))
    sizes = cut.groupBy(group, "_cut").count()
    before = Window.partitionBy(group).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    lift = sizes.select(group, "_cut", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_lift"))
    local = F.row_number().over(Window.partitionBy(group, "_cut").orderBy(*order)) - 1
    numbered = cut.withColumn("_local", local)
    on = numbered[group].eqNullSafe(lift[group]) & (numbered["_cut"] == lift["_cut"])
    return numbered.join(lift, on).select(*[numbered[c] for c in df.columns], (F.col("_local") + F.col("_lift")).cast("long").alias(name))
