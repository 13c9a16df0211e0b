"""Every registered query against its DuckDB equivalent on the smallest tables."""

import pytest
from compare import same

from tamarack.plans.catalogue import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(name, spark, duck, data):
    same(QUERIES[name](spark, data), duck, ORACLES[name])


def test_names():
    assert set(ORACLES) <= set(QUERIES)
    assert {n for n in QUERIES if n not in ORACLES} == {"lpt_assignment", "stream_settled_rows"}


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_stream_equals_batch(spark, data):
    q = QUERIES
    batch = {tuple(r) for r in q["settled_rows"](spark, data).select("row_id", "state", "reason", "attempts").collect()}
    assert {tuple(r) for r in q["stream_settled_rows"](spark, data).select("row_id", "state", "reason", "attempts").collect()} == batch
