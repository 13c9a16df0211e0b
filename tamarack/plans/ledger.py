"""Queries over row outcomes. The attempt history is derived from ``events`` so that both engines have one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamarack.functions import stats
from tamarack.functions.ids import sha
from tamarack.functions.time import micros, seconds
from tamarack.operators import checks
from tamarack.operators import ledger as L
from tamarack.operators.audit import FACTS, Run, audit
from tamarack.plans.corpus import _FROZEN_SQL, _ID_SQL, _line, _policy_sql, _row_id, frozen
from tamarack.plans.registry import duck_rows, query
from tamarack.sources.tables import table

_HISTORY = """b AS (SELECT user_id AS row_id, event_id, ts, value, event_type, row_number() OVER w AS attempt_no,
  CASE WHEN coalesce(max(CASE WHEN event_type = 'click' THEN 1 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 THEN 384 ELSE 256 END AS max_tokens,
  CASE event_type WHEN 'error' THEN 'engine_transient' WHEN 'signup' THEN 'stale_claim' WHEN 'view' THEN CASE WHEN event_id % 97 = 0 THEN 'integrity' ELSE 'timeout' END END AS error_category
  FROM {source} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
c AS (SELECT *, sum(CASE WHEN error_category IN ('engine_transient', 'timeout') THEN 1 ELSE 0 END) OVER w AS k, max(max_tokens) OVER w AS top FROM b WINDOW w AS (PARTITION BY row_id ORDER BY attempt_no)),
e AS (SELECT *, CASE WHEN event_type = 'purchase' THEN 'complete' WHEN error_category = 'integrity' THEN 'rejected' WHEN event_type = 'click' AND top >= 384 THEN 'rejected' WHEN event_type = 'click' THEN 'retryable'
  WHEN k >= 3 THEN 'rejected' ELSE 'retryable' END AS state,
  CASE WHEN event_type = 'purchase' THEN 'ok' WHEN error_category = 'integrity' THEN 'integrity' WHEN event_type = 'click' AND top >= 384 THEN 'truncated_at_ceiling' WHEN event_type = 'click' THEN 'truncated'
  WHEN k >= 3 THEN 'transient_exhausted' ELSE coalesce(error_category, 'engine_transient') END AS reason FROM c),
a AS MATERIALIZED (SELECT row_id, event_id, ts, attempt_no, event_type = 'purchase' AS ok, CASE event_type WHEN 'purchase' THEN 'stop' WHEN 'click' THEN 'length' END AS finish_reason, error_category, max_tokens, value, k, state, reason,
  CASE WHEN state = 'complete' THEN 'none' WHEN reason = 'integrity' THEN 'integrity' WHEN event_type = 'click' THEN 'truncation' ELSE 'transient' END AS category,
  CASE WHEN state = 'retryable' AND reason NOT IN ('truncated', 'stale_claim') THEN least(600.0::DOUBLE, 30.0::DOUBLE * pow(2, greatest(0, k - 1))) ELSE 0.0::DOUBLE END AS backoff_seconds
  FROM (SELECT *, coalesce(max(CASE WHEN state IN ('complete', 'rejected') THEN 1 ELSE 0 END) OVER (PARTITION BY row_id ORDER BY attempt_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS over FROM e) WHERE over = 0),
r AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY attempt_no DESC) AS n_ FROM a) WHERE n_ = 1)"""
HISTORY = _HISTORY.format(source="events")
#: One row per user and day: short histories, many of which have not ended.
DAILY = _HISTORY.format(source="(SELECT * REPLACE (user_id * 100000 + (ts::DATE - DATE '1970-01-01') AS user_id) FROM events)")


def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events", "event_id", "ts", "user_id", "event_type", "value")


def _attempts(spark: SparkSession, d: str) -> DataFrame:
    return L.attempts_from_events(_events(spark, d))


def _daily_events(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d).withColumn("user_id", F.col("user_id") * 100_000 + F.unix_date(F.col("ts").cast("date")))


def _daily(spark: SparkSession, d: str) -> DataFrame:
    return L.attempts_from_events(_daily_events(spark, d))


@query(f"WITH {HISTORY} SELECT row_id, attempt_no, ok, finish_reason, error_category, max_tokens, k::BIGINT AS transient_count, state, reason, category, backoff_seconds FROM a")
def retry_decisions(spark, d):
    """Every attempt with its decision; histories end at the first terminal state."""
    keep = ["row_id", "attempt_no", "ok", "finish_reason", "error_category", "max_tokens", "transient_count", "state", "reason", "category", "backoff_seconds"]
    return _attempts(spark, d).select(*[F.col(c).cast("bigint").alias(c) if c == "attempt_no" else F.col(c) for c in keep])


@query(f"WITH {DAILY} SELECT s AS state, count(r.row_id)::BIGINT AS n FROM (SELECT unnest(['pending', 'running', 'retryable', 'complete', 'rejected']) AS s) LEFT JOIN r ON r.state = s GROUP BY s")
def ledger_states(spark, d):
    """Rows per state, all states present."""
    return L.state_counts(L.latest(_daily(spark, d)))


@query(f"""WITH {HISTORY} SELECT count(*)::BIGINT AS attempts, count(*) FILTER (finish_reason = 'length')::BIGINT AS truncated, coalesce(sum(max_tokens), 0)::BIGINT AS token_budget,
coalesce(sum(CASE WHEN ok THEN max_tokens END), 0)::BIGINT AS completed_tokens FROM a""")
def ledger_tokens(spark, d):
    return _attempts(spark, d).agg(
        F.count("*").alias("attempts"), F.count_if(F.col("finish_reason") == "length").alias("truncated"), F.coalesce(F.sum("max_tokens"), F.lit(0)).cast("bigint").alias("token_budget"),
        F.coalesce(F.sum(F.when(F.col("ok"), F.col("max_tokens"))), F.lit(0)).cast("bigint").alias("completed_tokens"),
    )


@query(f"WITH {HISTORY} SELECT error_category, count(*)::BIGINT AS n FROM a WHERE error_category IS NOT NULL GROUP BY 1")
def ledger_categories(spark, d):
    return _attempts(spark, d).where("error_category is not null").groupBy("error_category").agg(F.count("*").alias("n"))


@query(f"WITH {HISTORY} SELECT CASE WHEN state = 'rejected' THEN reason END AS rejection_reason, category, count(*)::BIGINT AS n FROM r WHERE state = 'rejected' GROUP BY 1, 2")
def ledger_reasons(spark, d):
    rows = L.latest(_attempts(spark, d)).where("state = 'rejected'")
    return rows.groupBy(F.col("reason").alias("rejection_reason"), "category").agg(F.count("*").alias("n"))


@query(f"WITH {HISTORY} SELECT min(epoch_us(ts)) AS first_claim_us, min(CASE WHEN state = 'complete' THEN epoch_us(ts) END) AS first_done_us, max(CASE WHEN state = 'complete' THEN epoch_us(ts) END) AS last_done_us FROM a")
def ledger_window(spark, d):
    us, done = micros("ts"), F.when(F.col("state") == "complete", micros("ts"))
    return _attempts(spark, d).agg(F.min(us).alias("first_claim_us"), F.min(done).alias("first_done_us"), F.max(done).alias("last_done_us"))


@query(f"WITH {HISTORY} SELECT row_id, attempt_no, state, max_tokens FROM r")
def latest_attempt(spark, d):
    return L.latest(_attempts(spark, d)).select("row_id", F.col("attempt_no").cast("bigint").alias("attempt_no"), "state", "max_tokens")


@query("SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS attempt_no FROM events")
def attempt_no(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return _events(spark, d).select("user_id", "event_id", F.row_number().over(w).cast("bigint").alias("attempt_no"))


@query(f"WITH {HISTORY} SELECT u.user_id AS row_id, coalesce(list(a.reason ORDER BY a.attempt_no) FILTER (a.reason IS NOT NULL), []) AS reasons FROM (SELECT unnest([1, 2, 3, 5, 8, -1])::BIGINT AS user_id) u LEFT JOIN a ON a.row_id = u.user_id GROUP BY 1")
def attempts_of(spark, d):
    """The history of asked rows; rows without attempts keep an empty list."""
    asked = spark.createDataFrame([(i,) for i in (1, 2, 3, 5, 8, -1)], "row_id bigint")
    joined = asked.join(_attempts(spark, d), "row_id", "left")
    h = F.array_sort(F.collect_list(F.when(F.col("attempt_no").isNotNull(), F.struct("attempt_no", "reason"))))
    return joined.groupBy("row_id").agg(F.transform(h, lambda x: x["reason"]).alias("reasons"))


#: The range of all rows.
_LAST = (1 << 63) - 1
_ROWS_SQL = "q AS (SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS source_row_index, state, epoch_us(ts)::DOUBLE / 1e6 + backoff_seconds AS not_before, attempt_no AS attempt_count, k::BIGINT AS transient_count, category, reason FROM r)"


def _rows(spark: SparkSession, d: str) -> DataFrame:
    from tamarack.operators.ordering import global_index

    rows = L.latest(_daily(spark, d))
    rows = rows.withColumn("not_before", seconds("ts") + F.col("backoff_seconds")).withColumn("attempt_count", F.col("attempt_no").cast("bigint"))
    return global_index(rows, [F.col("row_id")], F.col("row_id"), "source_row_index")


@query(f"WITH {DAILY}, {_ROWS_SQL} SELECT row_id, source_row_index FROM q WHERE state IN ('pending', 'retryable') AND not_before <= 4e9 ORDER BY source_row_index LIMIT 50")
def eligible_rows(spark, d):
    """The next 50 rows that may be claimed (the claim limit is the feature)."""
    return L.eligible(_rows(spark, d), 4e9, 0, _LAST, 50).select("row_id", "source_row_index")


@query(f"WITH {DAILY}, {_ROWS_SQL} SELECT min(not_before) AS next_retry FROM q WHERE state = 'retryable'")
def next_retry(spark, d):
    """The earliest retry over all rows."""
    return L.next_retry(_rows(spark, d), 0, _LAST)


@query(f"""WITH {DAILY}, {_ROWS_SQL} SELECT x.row_id, x.worker, coalesce(attempt_count, 0) + 1 AS attempt_no, 4e9::DOUBLE AS claimed_at,
CASE WHEN state IS NULL THEN 'unknown_row' WHEN state NOT IN ('pending', 'retryable') THEN concat('state_', state) WHEN not_before > 4e9 THEN 'not_due' END AS conflict
FROM (SELECT user_id AS row_id, concat('w', user_id % 4) AS worker FROM (SELECT DISTINCT user_id * 100000 + (ts::DATE - DATE '1970-01-01') AS user_id FROM events) UNION ALL SELECT -5, 'w0') x LEFT JOIN q USING (row_id)""")
def claims(spark, d):
    """Claims of all rows with what forbids them."""
    asked = _daily_events(spark, d).select(F.col("user_id").alias("row_id")).distinct().union(spark.createDataFrame([(-5,)], "row_id bigint"))
    asked = asked.withColumn("worker", F.when(F.col("row_id") < 0, "w0").otherwise(F.concat(F.lit("w"), F.col("row_id") % 4)))
    return L.claim(_rows(spark, d), asked, 4e9)


_RUNNING = "CASE WHEN state = 'retryable' AND row_id % 2 = 0 THEN 'running' ELSE state END"


def _running(spark: SparkSession, d: str) -> DataFrame:
    rows = _rows(spark, d).withColumn("claimed_at", F.col("not_before"))
    return rows.withColumn("state", F.expr(_RUNNING))


@query(f"""WITH {DAILY}, {_ROWS_SQL} SELECT row_id, 'retryable' AS state, 'stale_claim' AS reason, 4e9::DOUBLE AS not_before FROM (SELECT *, {_RUNNING} AS s FROM q) WHERE s = 'running' AND not_before < 4e9 AND transient_count < 3""")
def stale_claims(spark, d):
    """Running rows whose claim is too old go back without spending budget."""
    return L.release(_running(spark, d), "stale_claim", 4e9, older_than=4e9)


@query(f"""WITH {DAILY}, {_ROWS_SQL} SELECT row_id, CASE WHEN transient_count + 1 >= 3 THEN 'rejected' ELSE 'retryable' END AS state, CASE WHEN transient_count + 1 >= 3 THEN 'transient_exhausted' ELSE 'worker_lost' END AS reason,
4e9::DOUBLE + CASE WHEN transient_count + 1 >= 3 THEN 0 ELSE 30.0::DOUBLE * pow(2, transient_count) END AS not_before FROM (SELECT *, {_RUNNING} AS s FROM q) WHERE s = 'running'""")
def lost_workers(spark, d):
    """Running rows of a lost worker spend an attempt."""
    return L.release(_running(spark, d), "worker_lost", 4e9)


@query(f"WITH {HISTORY} SELECT row_id, CASE WHEN state = 'rejected' AND coalesce(category, '') <> 'input_invalid' THEN 'pending' ELSE state END AS state FROM r")
def reprocess_rejected(spark, d):
    return L.reprocess(L.latest(_attempts(spark, d))).select("row_id", "state")


@query(f"WITH {HISTORY} SELECT row_id, state, reason, attempt_no AS attempts, k::BIGINT AS transient FROM r")
def settled_rows(spark, d):
    """The ordered fold over each row's raw results, late ones included: the same final states."""
    by = Window.partitionBy("user_id").orderBy("ts", "event_id")
    kind = F.col("event_type")
    category = F.when(kind == "error", "engine_transient").when(kind == "signup", "stale_claim").when((kind == "view") & (F.col("event_id") % 97 == 0), "integrity").when(kind == "view", "timeout")
    cut = F.coalesce(F.max(F.when(kind == "click", 1)).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) == 1
    raw = _events(spark, d).select(
        F.col("user_id").alias("row_id"), F.row_number().over(by).alias("attempt_no"), (kind == "purchase").alias("ok"), F.when(kind == "purchase", "stop").when(kind == "click", "length").alias("finish_reason"),
        category.alias("error_category"), F.when(cut, 384).otherwise(256).alias("max_tokens"), F.when(kind == "purchase", F.concat(F.lit("event "), F.col("event_id"))).alias("instruction"),
    )
    return L.settle(raw).select("row_id", "state", "reason", F.col("attempts").cast("bigint").alias("attempts"), F.col("transient").cast("bigint").alias("transient"))


@query(f"""WITH {HISTORY}, x AS (SELECT epoch_us(ts)::DOUBLE / 1e6 AS t FROM r WHERE state = 'complete'), y AS (SELECT count(*)::BIGINT AS completed, (count(*) FILTER (t >= (SELECT max(t) FROM x) - 1800) * 2.0::DOUBLE)::DOUBLE AS recent_per_hour,
count(*) * 3600.0::DOUBLE / greatest(1.0::DOUBLE, max(t) - min(t)) AS overall_per_hour FROM x)
SELECT *, 1000 * 3600.0::DOUBLE / coalesce(nullif(recent_per_hour, 0.0), overall_per_hour) AS eta_seconds FROM y""")
def recent_rate_eta(spark, d):
    done = L.latest(_attempts(spark, d)).where("state = 'complete'").select(seconds("ts").alias("t"))
    now = done.agg(F.max("t")).first()[0]
    return L.rate_and_eta(done, "t", now, F.lit(1000))


@query("""SELECT k, CASE WHEN k < 1 THEN 30.0::DOUBLE ELSE least(600.0::DOUBLE, 30.0::DOUBLE * pow(2, k - 1)) END AS seconds FROM (SELECT unnest(range(0, 9)) AS k)""")
def retry_backoff(spark, d):
    return spark.range(9).select(F.col("id").alias("k"), stats.backoff(F.col("id")).alias("seconds"))


_RESULTS = [
    (1, True, "stop", "A box", None, False, 0), (2, True, "stop", " ", None, False, 0), (3, False, None, None, "integrity", False, 0), (4, True, "length", "A", None, False, 0), (5, True, "length", "A", None, True, 0),
    (6, False, None, None, "timeout", False, 1), (7, False, None, None, "timeout", False, 3), (8, False, None, None, "stale_claim", False, 2), (9, False, None, None, None, False, 0), (10, False, "length", None, "input_invalid", True, 5),
    (11, False, None, None, "io", False, 2), (12, False, None, None, "run_interrupted", False, 3), (13, None, None, None, "", None, 0),
]


@query(f"""WITH {duck_rows('x', 'id INTEGER, ok BOOLEAN, finish VARCHAR, txt VARCHAR, category VARCHAR, top BOOLEAN, k INTEGER', _RESULTS)},
y AS (SELECT *, coalesce(nullif(category, ''), 'engine_transient') AS c, coalesce(ok AND finish = 'stop' AND trim(coalesce(txt, '')) <> '', false) AS done FROM x)
SELECT id, CASE WHEN done THEN 'complete' WHEN c IN ('input_invalid', 'integrity', 'input_too_long', 'invalid_instruction') THEN 'rejected' WHEN finish = 'length' AND coalesce(top, false) THEN 'rejected'
 WHEN finish = 'length' THEN 'retryable' WHEN k >= 3 THEN 'rejected' ELSE 'retryable' END AS state,
 CASE WHEN done THEN 'ok' WHEN c IN ('input_invalid', 'integrity', 'input_too_long', 'invalid_instruction') THEN c WHEN finish = 'length' AND coalesce(top, false) THEN 'truncated_at_ceiling' WHEN finish = 'length' THEN 'truncated'
 WHEN k >= 3 THEN 'transient_exhausted' ELSE c END AS reason FROM y""")
def decision_table(spark, d):
    """The decision on rows made to meet each line of the table."""
    x = spark.createDataFrame(_RESULTS, "id int, ok boolean, finish string, txt string, category string, top boolean, k int")
    return x.select("id", L.decide(*map(F.col, ("ok", "finish", "txt", "category", "top", "k"))).alias("d")).select("id", "d.state", "d.reason")


@query("""SELECT count(*)::BIGINT AS rows, count(*) FILTER (o_orderkey IS NULL)::BIGINT AS unmatched, count(*) FILTER (l_shipdate < o_orderdate)::BIGINT AS early FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey""")
def merge_join_check(spark, d):
    """Every line has its order, and none ships before it."""
    lines = table(spark, d, "lineitem", "l_orderkey", "l_shipdate")
    orders = table(spark, d, "orders", "o_orderkey", "o_orderdate")
    j = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return j.agg(F.count("*").alias("rows"), F.count_if(F.col("o_orderkey").isNull()).alias("unmatched"), F.count_if(F.col("l_shipdate") < F.col("o_orderdate")).alias("early"))


@query("SELECT doc_id, 'left' AS side FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'right' FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)")
def row_set_diff(spark, d):
    return checks.set_difference(table(spark, d, "documents", "doc_id"), table(spark, d, "labels", "doc_id"), "doc_id")


@query("""SELECT (SELECT count(*) FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents))::BIGINT AS not_subset, (SELECT count(*) FROM (SELECT doc_id FROM labels WHERE quality = 1 INTERSECT SELECT doc_id FROM labels WHERE quality = 0))::BIGINT AS both,
(SELECT count(*) - count(DISTINCT doc_id) FROM documents)::BIGINT AS repeated""")
def subset_checks(spark, d):
    """Subset, disjointness and uniqueness in one row of counts."""
    labels, docs = table(spark, d, "labels", "doc_id", "quality"), table(spark, d, "documents", "doc_id")
    a = labels.select("doc_id").subtract(docs).agg(F.count("*").alias("not_subset"))
    b = labels.where("quality = 1").select("doc_id").intersect(labels.where("quality = 0").select("doc_id")).agg(F.count("*").alias("both"))
    c = docs.agg((F.count("*") - F.count_distinct("doc_id")).alias("repeated"))
    return a.crossJoin(b).crossJoin(c)  # one row each


@query("SELECT count(*)::BIGINT AS orphans FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def orphan_rows(spark, d):
    return table(spark, d, "orders", "o_orderkey").join(table(spark, d, "lineitem", "l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").agg(F.count("*").alias("orphans"))


_AUDIT_SQL = f"""m AS (SELECT doc_id AS row_id, doc_id AS i, CASE WHEN doc_id % 11 = 0 THEN 'rejected' ELSE 'valid' END AS status, sha256(text) AS h, text FROM documents),
q AS (SELECT row_id, i, CASE WHEN row_id % 55 = 0 THEN 'complete' WHEN status = 'rejected' THEN 'rejected' WHEN row_id % 10 = 3 THEN 'pending' ELSE 'complete' END AS state,
  CASE WHEN row_id % 23 = 0 THEN ' ' ELSE text END AS instruction, CASE WHEN row_id % 22 = 0 THEN NULL ELSE 'unusable' END AS reason, h FROM m),
r AS (SELECT row_id, CASE WHEN row_id % 47 = 1 THEN i + 100000000 ELSE i END AS i, state, instruction, reason, h FROM q WHERE row_id % 53 <> 1),
o AS (SELECT DISTINCT user_id AS row_id FROM events),
x AS (SELECT row_id AS id, i, CASE WHEN row_id % 59 = 0 THEN 'drift' ELSE h END AS h FROM r WHERE state = 'complete' OR row_id % 77 = 0 UNION ALL SELECT row_id, i, h FROM r WHERE row_id % 61 = 2 AND state = 'complete'),
p AS (SELECT doc_id, rule FROM ({_policy_sql('text')} documents))),
f AS (SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS shard FROM documents), g AS (SELECT shard, count(*) AS n FROM f GROUP BY 1),
checks_(name, v, level) AS (
  SELECT name, CASE WHEN name IN ('run.validation_rules_match', 'runtime.no_quarantined_results') THEN 1 ELSE 0 END, CASE WHEN name = 'runtime.no_quarantined_results' THEN 'warn' ELSE 'fail' END FROM (SELECT unnest([{', '.join(f"'{n}'" for n in FACTS)}]) AS name)
  UNION ALL SELECT 'manifest.exact_row_count', (SELECT abs(count(*) - 990) FROM m), 'fail' UNION ALL SELECT 'manifest.unique_stable_ids', (SELECT count(*) FROM (SELECT row_id FROM m GROUP BY 1 HAVING count(*) > 1)), 'fail'
  UNION ALL SELECT 'ledger.row_count_matches_manifest', (SELECT count(*) FROM m) - (SELECT count(*) FROM r), 'fail' UNION ALL SELECT 'ledger.no_duplicate_ids', (SELECT count(*) FROM (SELECT row_id FROM r GROUP BY 1 HAVING count(*) > 1)), 'fail'
  UNION ALL SELECT 'ledger.row_set_matches_manifest', (SELECT count(*) FROM m WHERE row_id NOT IN (SELECT row_id FROM r)), 'fail'
  UNION ALL SELECT 'ledger.manifest_rejections_preserved', (SELECT count(*) FROM m LEFT JOIN r USING (row_id) WHERE status = 'rejected' AND state IS DISTINCT FROM 'rejected'), 'fail'
  UNION ALL SELECT 'ledger.index_pairs_match_manifest', (SELECT count(*) FROM m JOIN r USING (row_id) WHERE m.i <> r.i), 'fail' UNION ALL SELECT 'ledger.no_index_outside_slice', (SELECT count(*) FROM r WHERE i < 0 OR i > 989), 'fail'
  UNION ALL SELECT 'ledger.complete_rows_have_instructions', (SELECT count(*) FROM r WHERE state = 'complete' AND (instruction IS NULL OR trim(instruction) = '')), 'fail'
  UNION ALL SELECT 'ledger.rejected_rows_have_reasons', (SELECT count(*) FROM r WHERE state = 'rejected' AND (reason IS NULL OR trim(reason) = '')), 'fail'
  UNION ALL SELECT 'ledger.accepted_instructions_valid', (SELECT count(*) FROM r JOIN p ON p.doc_id = r.row_id WHERE state = 'complete' AND (rule <> 'ok' OR row_id % 23 = 0)), 'fail'
  UNION ALL SELECT 'ledger.instructions_attached_to_one_row', (SELECT count(*) FROM (SELECT instruction FROM r WHERE state = 'complete' AND instruction IS NOT NULL GROUP BY 1 HAVING count(*) > 1)), 'warn'
  UNION ALL SELECT 'ledger.attempts_reference_known_rows', (SELECT count(*) FROM o WHERE row_id NOT IN (SELECT row_id FROM r)), 'fail'
  UNION ALL SELECT 'export.only_complete_rows', (SELECT count(*) FROM x JOIN r ON id = row_id WHERE state <> 'complete'), 'fail' UNION ALL SELECT 'export.rejected_rows_excluded', (SELECT count(*) FROM x JOIN r ON id = row_id WHERE state = 'rejected'), 'fail'
  UNION ALL SELECT 'export.rows_map_to_manifest', (SELECT count(*) FROM x JOIN m ON id = row_id WHERE x.i <> m.i OR x.h <> m.h), 'fail'
  UNION ALL SELECT 'export.row_count_matches_ledger', abs((SELECT count(*) FROM x) - (SELECT count(*) FROM r WHERE state = 'complete')), 'fail' UNION ALL SELECT 'export.unique_ids', (SELECT count(*) FROM (SELECT id FROM x GROUP BY 1 HAVING count(*) > 1)), 'fail'
  UNION ALL SELECT 'export.checksums_match', (SELECT count(*) FROM g WHERE shard % 3 <> 0), 'fail' UNION ALL SELECT 'export.shard_count_matches_meta', (SELECT count(*) FROM g WHERE shard % 3 = 2), 'fail'
  UNION ALL SELECT 'export.rejected_matches_ledger', (SELECT count(*) FROM r WHERE state = 'rejected' AND row_id % 33 = 0), 'fail' UNION ALL SELECT 'export.checked', CASE WHEN (SELECT count(*) FROM x) = 0 THEN 1 ELSE 0 END, 'warn'),
audit AS (SELECT name AS "check", v::BIGINT AS violations, CASE WHEN v = 0 THEN 'pass' ELSE level END AS status FROM checks_)"""


@query(f"WITH {_AUDIT_SQL} SELECT * FROM audit")
def audit_report(spark, d):
    """All named checks over a run made of documents and events, tampered with in the ways that the checks are for."""
    from tamarack.sources import sinks

    docs, k = table(spark, d, "documents", "doc_id", "text", "lang"), F.col("row_id")
    h = sha("text")
    m = docs.select(F.col("doc_id").alias("row_id"), F.col("doc_id").alias("source_row_index"), F.when(F.col("doc_id") % 11 == 0, "rejected").otherwise("valid").alias("status"), sha(F.lit("")).alias("image_sha256"), h.alias("tikz_sha256"), "text")
    state = F.when(k % 55 == 0, "complete").when(F.col("status") == "rejected", "rejected").when(k % 10 == 3, "pending").otherwise("complete")
    full = m.where(k % 53 != 1).withColumns({"state": state, "source_row_index": F.when(k % 47 == 1, k + 100_000_000).otherwise(k), "instruction": F.when(k % 23 == 0, " ").otherwise(F.col("text")), "reason": F.when(k % 22 != 0, "unusable")})
    rows = full.select("row_id", "source_row_index", "state", "instruction", "reason")
    out = full.where((F.col("state") == "complete") | (k % 77 == 0)).withColumn("tikz_sha256", F.when(k % 59 == 0, "drift").otherwise(F.col("tikz_sha256")))
    out = out.unionByName(full.where((k % 61 == 2) & (F.col("state") == "complete"))).select(k.alias("id"), "source_row_index", "image_sha256", "tikz_sha256")
    shards = sinks.shard_digests(sinks.with_shards(docs, "doc_id", 100), "doc_id", _line())
    s = F.col("shard")
    listed = shards.where(s % 3 != 2).withColumn("logical_sha256", F.when(s % 3 == 1, "drift").otherwise(F.col("logical_sha256")))
    right = {name: (1, 2 if name in ("run.validation_rules_match", "runtime.no_quarantined_results") else 1) for name in FACTS}
    attempts = table(spark, d, "events", "user_id").select(F.col("user_id").alias("row_id")).distinct()
    rejected = rows.where((F.col("state") == "rejected") & (k % 33 != 0)).select(k.alias("id"))
    return audit(Run(m.drop("text"), rows, attempts, out, rejected, shards, listed, 0, 990, right))


@query(f"""WITH {_AUDIT_SQL} SELECT count(*) FILTER (status = 'pass')::BIGINT AS pass, count(*) FILTER (status = 'fail')::BIGINT AS fail, count(*) FILTER (status = 'warn')::BIGINT AS warn,
CASE WHEN count(*) FILTER (status = 'fail') > 0 THEN 'fail' ELSE 'pass' END AS overall FROM audit""")
def audit_roll_up(spark, d):
    """The audit's counts and overall status."""
    return checks.roll_up(audit_report(spark, d))


@query(f"""WITH {_FROZEN_SQL}, m AS (SELECT text, image, CASE WHEN doc_id % 37 = 0 THEN 'odd' WHEN rejection_reason IS NULL THEN 'valid' ELSE 'rejected' END AS status,
  CASE WHEN doc_id % 31 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN 'late' ELSE rejection_reason END AS rejection_reason, CASE WHEN doc_id % 29 = 0 THEN 'drift' ELSE sha256(text) END AS text_sha256,
  CASE WHEN doc_id % 41 = 0 THEN -1 - doc_id WHEN doc_id % 97 = 0 THEN doc_id - 1 ELSE doc_id END AS i, CASE WHEN doc_id % 43 = 0 THEN 'same' ELSE {_ID_SQL} END AS row_id, {_ID_SQL} AS right_id FROM f),
v(name, v) AS (SELECT 'manifest.known_status', (SELECT count(*) FROM m WHERE status = 'odd') UNION ALL SELECT 'manifest.text_sha', (SELECT count(*) FROM m WHERE text_sha256 IS DISTINCT FROM sha256(text))
  UNION ALL SELECT 'manifest.image_present', (SELECT count(*) FROM m WHERE status = 'valid' AND coalesce(octet_length(image), 0) = 0) UNION ALL SELECT 'manifest.rejection_reason', (SELECT count(*) FROM m WHERE status <> 'valid' AND rejection_reason IS NULL)
  UNION ALL SELECT 'manifest.no_reason_when_valid', (SELECT count(*) FROM m WHERE status = 'valid' AND rejection_reason IS NOT NULL) UNION ALL SELECT 'manifest.index_not_negative', (SELECT count(*) FROM m WHERE i < 0)
  UNION ALL SELECT 'manifest.row_id', (SELECT count(*) FROM m WHERE row_id <> right_id) UNION ALL SELECT 'manifest.unique_ids', (SELECT count(*) FROM (SELECT row_id FROM m GROUP BY 1 HAVING count(*) > 1))
  UNION ALL SELECT 'manifest.contiguous', (SELECT count(*) FROM (SELECT i, lead(i) OVER (ORDER BY i) AS after FROM (SELECT DISTINCT i FROM m)) WHERE after <> i + 1))
SELECT name AS "check", v::BIGINT AS violations, CASE WHEN v = 0 THEN 'pass' ELSE 'fail' END AS status FROM v""")
def manifest_checks(spark, d):
    """A frozen manifest, tampered with in every way that its checks are for."""
    k, reason = F.col("doc_id"), F.col("rejection_reason")
    rows = frozen(spark, d).withColumn("status", F.when(k % 37 == 0, "odd").when(reason.isNull(), "valid").otherwise("rejected")).withColumn("right_id", _row_id())
    rows = rows.withColumns({
        "rejection_reason": F.when(k % 31 == 0, None).when(k % 13 == 0, "late").otherwise(reason), "text_sha256": F.when(k % 29 == 0, "drift").otherwise(sha("text")),
        "source_row_index": F.when(k % 41 == 0, -1 - k).when(k % 97 == 0, k - 1).otherwise(k), "row_id": F.when(k % 43 == 0, "same").otherwise(F.col("right_id")),
    })
    return checks.manifest_report(rows, F.col("right_id"))


@query("""SELECT doc_id, CASE WHEN quality IS NULL THEN 'missing' ELSE 'different' END AS problem FROM documents LEFT JOIN labels USING (doc_id) WHERE (quality IS NULL OR quality IS DISTINCT FROM (doc_id % 2)::INTEGER)""")
def rows_map_to_manifest(spark, d):
    """Rows without a partner, or with one that differs."""
    left = table(spark, d, "documents", "doc_id").withColumn("quality", (F.col("doc_id") % 2).cast("int"))
    return checks.matched(left, table(spark, d, "labels", "doc_id", "quality"), "doc_id", ["quality"]).select("doc_id", "problem")


@query("""WITH w AS (SELECT doc_id FROM documents WHERE lang = 'en'), e AS (SELECT doc_id FROM labels), f AS (SELECT doc_id FROM labels WHERE toxic = 1)
SELECT doc_id, 'missing' AS problem FROM w WHERE doc_id NOT IN (FROM e) UNION ALL SELECT doc_id, 'extra' FROM e WHERE doc_id NOT IN (FROM w) UNION ALL SELECT doc_id, 'forbidden' FROM e WHERE doc_id IN (FROM f)""")
def emission_check(spark, d):
    """Wanted against emitted ids, and forbidden ones among these."""
    docs, labels = table(spark, d, "documents", "doc_id", "lang"), table(spark, d, "labels", "doc_id", "toxic")
    return checks.emission(docs.where("lang = 'en'"), labels, labels.where("toxic = 1"), "doc_id")


_PINS = ([("torch", "2.1"), ("numpy", "1.26"), ("only-left", "1"), ("created_at", "x")], [("torch", "2.2"), ("numpy", "1.26"), ("only-right", "3"), ("created_at", "y")])


@query(f"""WITH {duck_rows('a', 'key VARCHAR, value VARCHAR', _PINS[0])}, {duck_rows('b', 'key VARCHAR, value VARCHAR', _PINS[1])}
SELECT key, a.value AS left_value, b.value AS right_value FROM a FULL JOIN b USING (key) WHERE key <> 'created_at' AND a.value IS DISTINCT FROM b.value""")
def fingerprint_diff(spark, d):
    """Keys in which two fingerprints differ, provenance aside."""
    a, b = (spark.createDataFrame(x, "key string, value string") for x in _PINS)
    return checks.key_diff(a, b, ("created_at",))
