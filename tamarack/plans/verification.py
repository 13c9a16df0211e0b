"""Queries that look rows up and verify results, accepted rows and exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamarack.functions import ids, text
from tamarack.operators import evaluate, verify
from tamarack.operators import ledger as L
from tamarack.plans.corpus import _line, _row_id, _ID_SQL, _LINE_SQL
from tamarack.plans.ledger import DAILY, HISTORY, _attempts, _daily
from tamarack.plans.registry import query, strip_sql, words_sql
from tamarack.sources import sinks
from tamarack.sources.tables import table
from tamarack.storage import durable


@query(f"WITH {HISTORY} SELECT row_id, state, reason FROM r WHERE row_id = 3")
def ledger_lookup(spark, d):
    """One row by key."""
    return L.latest(_attempts(spark, d)).where("row_id = 3").select("row_id", "state", "reason")


@query(f"WITH {DAILY} SELECT row_id, state, attempt_no, reason FROM r WHERE state IN ('complete', 'rejected')")
def terminal_rows(spark, d):
    """Complete and rejected rows."""
    rows = L.latest(_daily(spark, d)).where(F.col("state").isin("complete", "rejected"))
    return rows.select("row_id", "state", F.col("attempt_no").cast("bigint").alias("attempt_no"), "reason")


@query(f"WITH {HISTORY} SELECT row_id, attempt_no, event_id FROM a")
def all_attempts(spark, d):
    return _attempts(spark, d).select("row_id", F.col("attempt_no").cast("bigint").alias("attempt_no"), "event_id")


_MANIFEST = f"m AS (SELECT {_ID_SQL} AS row_id, doc_id::INTEGER AS source_row_index, sha256('') AS image_sha256, sha256(text) AS tikz_sha256, CASE WHEN doc_id % 11 = 0 THEN 'rejected' ELSE 'valid' END AS status, text, doc_id FROM documents)"


def _manifest(spark, d):
    docs = table(spark, d, "documents", "doc_id", "text")
    return docs.select(
        _row_id().alias("row_id"), F.col("doc_id").cast("int").alias("source_row_index"), ids.sha(F.lit("")).alias("image_sha256"), ids.sha("text").alias("tikz_sha256"),
        F.when(F.col("doc_id") % 11 == 0, "rejected").otherwise("valid").alias("status"), "text", "doc_id",
    )


@query(f"""WITH {_MANIFEST}, r AS (SELECT CASE WHEN doc_id % 13 = 0 THEN 'nobody' ELSE row_id END AS row_id, CASE WHEN doc_id % 7 = 0 THEN -1 ELSE source_row_index END AS source_row_index, CASE WHEN doc_id % 5 = 0 THEN 'c2' ELSE 'c1' END AS config_hash,
  image_sha256, CASE WHEN doc_id % 3 = 0 THEN 'drift' ELSE tikz_sha256 END AS tikz_sha256, doc_id FROM m)
SELECT row_id, CASE WHEN reason = 'integrity' THEN 'row' ELSE 'fatal' END AS severity, reason FROM (SELECT r.row_id, CASE WHEN m.row_id IS NULL THEN 'unknown row' WHEN r.source_row_index <> m.source_row_index THEN 'index mismatch'
  WHEN config_hash <> 'c1' THEN 'config_hash mismatch' WHEN r.tikz_sha256 <> m.tikz_sha256 THEN 'integrity' END AS reason FROM r LEFT JOIN m ON m.row_id = r.row_id) WHERE reason IS NOT NULL""")
def result_identity(spark, d):
    """Results held against the manifest: fatal mismatches and drifted checksums."""
    m, k = _manifest(spark, d), F.col("doc_id")
    results = m.select(
        F.when(k % 13 == 0, "nobody").otherwise(F.col("row_id")).alias("row_id"), F.when(k % 7 == 0, -1).otherwise(F.col("source_row_index")).alias("source_row_index"), F.when(k % 5 == 0, "c2").otherwise("c1").alias("config_hash"),
        "image_sha256", F.when(k % 3 == 0, "drift").otherwise(F.col("tikz_sha256")).alias("tikz_sha256"),
    )
    return verify.result_identity(results, m, {"config_hash": "c1"})


@query(f"""WITH {_MANIFEST}, t AS (SELECT row_id, length(text) AS n, len({words_sql('text')}) AS w, trim(text) = '' AS e, status FROM m)
SELECT row_id, list_filter([CASE WHEN status <> 'valid' THEN 'manifest rejected' END, CASE WHEN e THEN 'empty' WHEN n < 20 THEN 'too_short' WHEN n > 2000 THEN 'too_long' WHEN w > 120 THEN 'too_many_words' END], lambda x: x IS NOT NULL) AS problems
FROM t WHERE status <> 'valid' OR e OR n < 20 OR n > 2000 OR w > 120""")
def accepted_problems(spark, d):
    """Accepted rows that the manifest or the policy would not accept."""
    m = _manifest(spark, d)
    rows = m.select("row_id", "source_row_index", F.col("text").alias("instruction"), F.lit("stop").alias("finish_reason"))
    return verify.accepted_problems(rows, m)


@query(f"""WITH s AS (SELECT doc_id, text, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS shard FROM documents),
x AS (SELECT shard, CASE WHEN doc_id % 17 = 0 THEN 'same' ELSE CAST(doc_id AS VARCHAR) END AS id, CASE WHEN doc_id % 100 = 99 THEN doc_id + 1 ELSE doc_id END AS i, text,
  CASE WHEN doc_id % 23 = 0 THEN ' ' ELSE 'draw' END AS instruction, CASE WHEN doc_id % 19 = 0 THEN 'drift' ELSE sha256(text) END AS h FROM s),
f AS (SELECT shard, count(*) AS n FROM s GROUP BY 1), v(name, v) AS (
  SELECT 'export.unique_ids', (SELECT count(*) FROM (SELECT id FROM x GROUP BY 1 HAVING count(*) > 1))
  UNION ALL SELECT 'export.unique_indices', (SELECT count(*) FROM (SELECT i FROM x GROUP BY 1 HAVING count(*) > 1))
  UNION ALL SELECT 'export.rising_indices', (SELECT count(*) FROM (SELECT shard, min(i) AS lo, lag(max(i)) OVER (ORDER BY shard) AS before FROM x GROUP BY 1) WHERE lo <= before)
  UNION ALL SELECT 'export.shards_listed', (SELECT count(*) FROM f WHERE shard % 3 = 2) UNION ALL SELECT 'export.shard_rows', (SELECT count(*) FROM f WHERE shard % 3 = 1)
  UNION ALL SELECT 'export.checksums_match', (SELECT count(*) FROM f WHERE shard % 3 <> 2 AND shard % 2 = 1)
  UNION ALL SELECT 'row.id', 0 UNION ALL SELECT 'row.text', (SELECT count(*) FROM x WHERE {strip_sql("coalesce(text, '')")} = '') UNION ALL SELECT 'row.instruction', (SELECT count(*) FROM x WHERE trim(instruction) = '')
  UNION ALL SELECT 'row.text_sha', (SELECT count(*) FROM x WHERE h IS DISTINCT FROM sha256(text)) UNION ALL SELECT 'row.image_sha', 0)
SELECT name AS "check", v::BIGINT AS violations, CASE WHEN v = 0 THEN 'pass' ELSE 'fail' END AS status FROM v""")
def export_verification(spark, d):
    """An export of ordered shards, tampered with in every way that its checks are for, verified against its list."""
    docs, k = table(spark, d, "documents", "doc_id", "lang", "text"), F.col("doc_id")
    shards = durable(sinks.shard_digests(sinks.with_shards(docs, "doc_id", 100), "doc_id", _line()))
    rows = sinks.with_shards(docs, "doc_id", 100).select(
        "shard", F.when(k % 17 == 0, "same").otherwise(k.cast("string")).alias("id"), F.when(k % 100 == 99, k + 1).otherwise(k).alias("source_row_index"), F.col("text").alias("tikz_code"),
        F.when(k % 23 == 0, " ").otherwise("draw").alias("instruction"), F.when(k % 19 == 0, "drift").otherwise(ids.sha("text")).alias("tikz_sha256"), F.lit("").alias("png_image"), ids.sha(F.lit("")).alias("image_sha256"),
    )
    s = F.col("shard")
    listed = shards.where(s % 3 != 2).withColumn("rows", F.col("rows") + (s % 3 == 1).cast("int")).withColumn("logical_sha256", F.when(s % 2 == 1, "drift").otherwise(F.col("logical_sha256")))
    return verify.export_report(rows, shards, listed)


@query(f"SELECT doc_id, CASE WHEN len({words_sql('text')}) + 256 > 1024 THEN 'input_too_long' END AS problem FROM documents")
def prompt_budget(spark, d):
    """Texts whose words and a reserved output exceed a context."""
    return table(spark, d, "documents", "doc_id", "text").select("doc_id", verify.prompt_budget(text.word_count("text"), 256, 1024).alias("problem"))


@query("SELECT doc_id, sha256(concat('<source>', chr(10), text, chr(10), '</source>')) AS message_sha256 FROM documents")
def source_messages(spark, d):
    """The payload wrapped as a chat message."""
    return table(spark, d, "documents", "doc_id", "text").select("doc_id", ids.sha(F.concat(F.lit("<source>\n"), "text", F.lit("\n</source>"))).alias("message_sha256"))


#: Compile statuses of the evaluation, dealt to event types.
_STATUS = {"purchase": "success", "error": "latex_error", "click": "timeout", "signup": "no_tikz", "view": "unsafe_primitive"}
_COMPILED = "c AS (SELECT event_id, event_type, CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _STATUS.items()) + " END AS status FROM events)"


def _compiled(spark, d):
    status = F.coalesce(*[F.when(F.col("event_type") == k, v) for k, v in _STATUS.items()])
    return table(spark, d, "events", "event_id", "event_type").select("event_id", "event_type", status.alias("status"), status.alias("category"), F.col("event_type").alias("error_message"))


@query(f"""WITH {_COMPILED} SELECT count(*)::BIGINT AS attempted, count(*) FILTER (status = 'success')::BIGINT AS success,
round_even(count(*) FILTER (status = 'success') / count(*)::DOUBLE, 6) AS success_rate FROM c""")
def compile_summary(spark, d):
    """Attempts, successes and their rate."""
    return evaluate.compile_summary(_compiled(spark, d))


@query(f"WITH {_COMPILED} SELECT status AS category, count(*)::BIGINT AS n FROM c WHERE status <> 'success' GROUP BY status")
def compile_failures(spark, d):
    """Failures by category."""
    return evaluate.compile_failures(_compiled(spark, d))


@query(f"""WITH {_COMPILED} SELECT event_id, event_type FROM c WHERE status <> 'success' ORDER BY event_id LIMIT 10""")
def first_errors(spark, d):
    """The first ten errors in record order (a top-k report)."""
    return evaluate.first_errors(_compiled(spark, d), "event_id").select("event_id", "event_type")


@query("""WITH g AS (SELECT DISTINCT source AS gate, lang AS identity FROM documents), s AS (SELECT DISTINCT gate FROM g), n AS (SELECT a.gate, b.gate AS missing FROM s a JOIN s b ON a.gate > b.gate),
p AS (SELECT DISTINCT source, lang FROM documents JOIN labels USING (doc_id) WHERE toxic = 1 AND doc_id % 3 = 0)
SELECT gate, missing FROM g JOIN n USING (gate) WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.source = missing AND p.lang = identity)""")
def gate_prerequisites(spark, d):
    """Sources need all sources before them, in each language: those without a third of a kind of toxic label are unmet."""
    docs, labels = table(spark, d, "documents", "doc_id", "source", "lang"), table(spark, d, "labels", "doc_id", "toxic")
    gates = docs.select(F.col("source").alias("gate"), F.col("lang").alias("identity")).distinct()
    names = gates.select("gate").distinct()
    needs = names.join(names.withColumnRenamed("gate", "prerequisite"), F.col("gate") > F.col("prerequisite"))  # a row per pair of sources
    passed = docs.join(labels, "doc_id").where("toxic = 1 and doc_id % 3 = 0").select(F.col("source").alias("gate"), F.col("lang").alias("identity")).distinct()
    return verify.unmet(gates, passed, needs)
