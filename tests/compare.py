"""Order-insensitive comparison of a Spark frame with DuckDB SQL."""

from __future__ import annotations

import math


def plain(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) in ("<NA>", "NaT"):
        return "NULL"
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    if isinstance(v, float) and v.is_integer() and abs(v) < 1e15:
        return str(int(v))
    return repr(v) if isinstance(v, float) else str(v)


def rows(pdf) -> list[str]:
    return sorted("|".join(plain(v) for v in r) for r in pdf[sorted(pdf.columns)].itertuples(index=False))


def same(spark_frame, duck, sql: str) -> None:
    got, want = spark_frame.toPandas(), duck.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
