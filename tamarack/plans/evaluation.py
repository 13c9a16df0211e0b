"""Queries over conversations, outputs, runs and metrics: rendering, masks, padding, extraction, comparison, similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamarack.functions import ids, stats, text, time
from tamarack.functions.time import micros
from tamarack.operators import evaluate, splits, tokens
from tamarack.plans.registry import duck_rows, keyed_sql, query, squash_sql
from tamarack.sources.tables import table

_RENDER = """t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, coalesce(text, '') DESC) AS back FROM conversations),
p AS MATERIALIZED (SELECT conv_id, concat(coalesce(string_agg(concat('<|', role, '|>', chr(10), text, chr(10)), '' ORDER BY turn, role, text) FILTER (back > 1), ''), '<|assistant|>', chr(10)) AS prompt,
  max(text) FILTER (back = 1) AS target, max(role) FILTER (back = 1) AS role FROM t GROUP BY conv_id),
c AS MATERIALIZED (SELECT conv_id, prompt, target, concat(prompt, target, chr(10)) AS full_text FROM p WHERE role = 'assistant' AND trim(target) <> '')"""


def _chats(spark: SparkSession, d: str) -> DataFrame:
    return tokens.render_conversations(table(spark, d, "conversations", "conv_id", "turn", "role", "text"))


@query(f"WITH {_RENDER} SELECT conv_id, length(prompt)::BIGINT AS prompt_chars, sha256(full_text) AS full_sha256, starts_with(full_text, prompt) AS is_prefix FROM c")
def chat_render(spark, d):
    """Each conversation's prompt and full text; the prompt is a prefix."""
    return _chats(spark, d).select("conv_id", F.length("prompt").cast("bigint").alias("prompt_chars"), ids.sha("full").alias("full_sha256"), F.startswith("full", "prompt").alias("is_prefix"))


def _tokenized(spark: SparkSession, d: str) -> DataFrame:
    rows = _chats(spark, d).select("conv_id", tokens.character_tokens(F.col("full")).alias("input_ids"), F.length("prompt").alias("prompt_tokens"))
    return rows.withColumn("labels", tokens.masked(F.col("input_ids"), F.col("prompt_tokens")))


@query(f"WITH {_RENDER} SELECT conv_id, length(full_text)::BIGINT AS total_tokens, (length(full_text) - length(prompt))::BIGINT AS supervised_tokens, length(prompt)::BIGINT AS prompt_tokens FROM c")
def supervised_tokens(spark, d):
    """Token counts from the masked labels under the character tokenizer."""
    n = tokens.supervised(F.col("labels"))
    return _tokenized(spark, d).select("conv_id", F.size("input_ids").cast("bigint").alias("total_tokens"), n.cast("bigint").alias("supervised_tokens"), (F.size("input_ids") - n).cast("bigint").alias("prompt_tokens"))


@query(f"WITH {_RENDER} SELECT count(*)::BIGINT AS rows, sum(length(full_text))::BIGINT AS total_tokens, sum(length(full_text) - length(prompt))::BIGINT AS supervised_tokens, sum(length(prompt))::BIGINT AS prompt_tokens FROM c")
def token_totals(spark, d):
    return tokens.token_stats(_tokenized(spark, d))


@query(f"""WITH {_RENDER}, x AS (SELECT conv_id % 16 AS batch, length(full_text) AS n, length(full_text) - length(prompt) AS s FROM c)
SELECT batch, count(*)::BIGINT AS rows, (ceil(max(n) / 8.0) * 8)::BIGINT AS width, (count(*) * ceil(max(n) / 8.0) * 8)::BIGINT AS padded_tokens, sum(s)::BIGINT AS supervised_tokens, 0::BIGINT AS problems FROM x GROUP BY batch""")
def pad_batches(spark, d):
    """Batches padded to a multiple of eight, and how many rows break a rule of padded batches."""
    padded = tokens.pad(_tokenized(spark, d).withColumn("batch", F.col("conv_id") % 16), "batch", 0, 8)
    return padded.groupBy("batch").agg(
        F.count("*").alias("rows"), F.max("width").cast("bigint").alias("width"), F.sum(F.size("input_ids")).alias("padded_tokens"), F.sum(tokens.supervised(F.col("labels"))).alias("supervised_tokens"),
        F.count_if(F.size(tokens.batch_problems(0)) > 0).alias("problems"),
    )


@query(f"""WITH {_RENDER}, x AS (SELECT conv_id % 3 AS k, length(full_text) AS total, length(prompt) AS prompt FROM c), y AS (SELECT concat('s', k) AS split, m AS measure, CASE m WHEN 'total' THEN total WHEN 'prompt' THEN prompt ELSE total - prompt END AS v
  FROM x, (SELECT unnest(['total', 'prompt', 'supervised']) AS m) WHERE total <= 2000)
SELECT y.split, measure, count(v)::BIGINT AS count, sum(v)::BIGINT AS total, round_even(sum(v)::DOUBLE / count(v), 3) AS mean, min(v)::BIGINT AS min,
{', '.join(f"list_sort(list(v))[floor((count(v) - 1) * {p / 100}::DOUBLE)::BIGINT + 1]::BIGINT AS p{p}" for p in (50, 90, 95, 99))}, max(v)::BIGINT AS max, any_value(o) AS over_limit
FROM y JOIN (SELECT concat('s', k) AS split, count(*) FILTER (total > 2000)::BIGINT AS o FROM x GROUP BY k) z USING (split) GROUP BY y.split, measure""")
def token_report(spark, d):
    """Length summaries per split and measure of rows within the limit."""
    n = tokens.supervised(F.col("labels")).cast("bigint")
    total = F.size("input_ids").cast("bigint")
    rows = _tokenized(spark, d).select(F.concat(F.lit("s"), F.col("conv_id") % 3).alias("split"), total.alias("total_tokens"), (total - n).alias("prompt_tokens"), n.alias("supervised_tokens"))
    return tokens.token_report(rows, 2000)


@query(f"""WITH {_RENDER}, x AS (SELECT (row_number() OVER (ORDER BY conv_id) - 1) // 8 AS step, length(full_text) - length(prompt) AS s FROM c)
SELECT step::BIGINT AS step, count(*)::BIGINT AS micro_batches, sum(s)::BIGINT AS tokens, count(*) = 8 AS committed FROM x GROUP BY step""")
def step_accounting(spark, d):
    """Supervised tokens per optimizer step of eight micro-batches; a partial last step is not committed."""
    rows = _tokenized(spark, d).select("conv_id", tokens.supervised(F.col("labels")).cast("bigint").alias("supervised"))
    return tokens.step_accounting(rows, "conv_id", "supervised", 8)


_OUTPUTS = [
    (1, None), (2, " \n "), (3, "nothing here"), (4, "text ```tex\n\\draw (0,0);\n``` and ```\n\\begin{tikzpicture}\n\\node {long};\n\\end{tikzpicture}\n``` end"),
    (5, "x \\documentclass{a} \\documentclass{b}\n\\begin{document} hi \\end{document} tail"), (6, "\\begin{document} a \\end{document}"), (7, "\\end{document} \\begin{document} open"),
    (8, "pre \\begin{tikzpicture}[x] \\draw; \\end{tikzpicture} mid \\begin{tikzpicture} b \\end{tikzpicture}"), (9, "  \\draw (0,0) -- (1,1);  "), (10, "\\drawing is no command"), (11, "``` \n\\node{a} ```"), (12, "\\input{x} \\draw"),
    (13, "\\WRITE18 \\path (1,1);"), (14, "\\inputs \\clip"),
]
_EXTRACT = r"""WITH {rows}, f AS (SELECT id, t, regexp_extract_all(t, '(?s)```(?:latex|tex|tikz)?\s*(.*?)```', 1) AS b FROM o),
g AS (SELECT id, t, CASE WHEN len(b) > 0 THEN b[list_position(list_transform(b, lambda x: length(x)), list_max(list_transform(b, lambda x: length(x))))] ELSE t END AS c FROM f),
h AS (SELECT *, instr(c, '\begin{{document}}') AS bg FROM g),
i AS (SELECT *, CASE WHEN bg > 0 THEN instr(substr(c, bg), '\end{{document}}') ELSE 0 END AS en, CASE WHEN bg > 0 THEN instr(reverse(left(c, bg - 1)), reverse('\documentclass')) ELSE 0 END AS bk FROM h),
j AS (SELECT *, CASE WHEN bk > 0 THEN bg - bk - 13 ELSE bg END AS st, regexp_extract(c, '(?s)\\begin\{{tikzpicture\}}.*?\\end\{{tikzpicture\}}') AS pic FROM i)
SELECT id, CASE WHEN t IS NULL OR trim(t, ' ' || chr(10)) = '' THEN 'none' WHEN bg > 0 AND en > 0 THEN 'document' WHEN pic <> '' THEN 'picture'
 WHEN regexp_matches(c, '\\(draw|node|path|fill|filldraw|shade|shadedraw|coordinate|foreach|clip|matrix)\b') THEN 'picture' ELSE 'none' END AS kind,
CASE WHEN t IS NULL OR trim(t, ' ' || chr(10)) = '' THEN '' WHEN bg > 0 AND en > 0 THEN substr(c, st, bg - st + en + 13) WHEN pic <> '' THEN pic
 WHEN regexp_matches(c, '\\(draw|node|path|fill|filldraw|shade|shadedraw|coordinate|foreach|clip|matrix)\b') THEN trim(c, ' ' || chr(10)) ELSE '' END AS code,
coalesce(regexp_matches(t, '(?i)\\(input|include|openout|read|write|immediate)\b'), false) AS unsafe FROM j"""


@query(_EXTRACT.format(rows=duck_rows("o", "id INTEGER, t VARCHAR", _OUTPUTS)))
def extract_payload(spark, d):
    """The payload of made-up outputs that meet every path, and whether an output holds an unsafe command."""
    rows = spark.createDataFrame(_OUTPUTS, "id int, t string")
    e = rows.withColumn("e", evaluate.extract("t"))
    return e.select("id", "e.kind", "e.code", F.coalesce(evaluate.is_unsafe(F.col("t")), F.lit(False)).alias("unsafe"))


@query("""SELECT page_id, length(html)::BIGINT AS chars, CASE WHEN contains(html, '<title>') AND contains(html, '</title>') THEN regexp_extract(html, '(?s)<title>(.*?)</title>', 1) ELSE '' END AS title FROM pages""")
def tagged_payload(spark, d):
    """The first title of each page."""
    return table(spark, d, "pages", "page_id", "html").select("page_id", F.length("html").cast("bigint").alias("chars"), F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"))


_LOGS = [(1, "a\n./x.tex:12: Undefined control sequence.  \n! later"), (2, "ok\n! Missing $ inserted.\nl.3"), (3, "all fine"), (4, "! " + "e" * 400), (5, "")]


@query(rf"""WITH {duck_rows('o', 'id INTEGER, t VARCHAR', _LOGS)} SELECT id, try_cast(regexp_extract(t, '(?m)^(.+?):(\d+): (.*)$', 2) AS INTEGER) AS line,
left(trim(CASE WHEN regexp_matches(t, '(?m)^(.+?):(\d+): (.*)$') THEN regexp_extract(t, '(?m)^(.+?):(\d+): (.*)$', 3) WHEN regexp_matches(t, '(?m)^! (.*)$') THEN regexp_extract(t, '(?m)^! (.*)$', 1) END), 300) AS message FROM o""")
def log_errors(spark, d):
    rows = spark.createDataFrame(_LOGS, "id int, t string").select("id", text.log_error("t").alias("e"))
    return rows.select("id", "e.line", "e.message")


@query("""SELECT event_type, count(value)::BIGINT AS count, list_sort(list(value))[count(value) // 2 + 1] AS median, list_sort(list(value))[floor((count(value) - 1) * 0.1::DOUBLE)::BIGINT + 1] AS p10, max(value) AS max FROM events GROUP BY event_type""")
def latency_summary(spark, d):
    """Upper median, p10 and maximum per event type."""
    return evaluate.value_summary(table(spark, d, "events", "event_type", "value"), ["event_type"], "value").drop("mean")


_GEN = """g AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE text END AS raw_output, CASE WHEN doc_id % 5 = 0 THEN 'boom' END AS error, CASE WHEN doc_id % 3 = 0 THEN 'length' ELSE 'stop' END AS finish_reason FROM documents)"""


def _generated(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id")
    return table(spark, d, "documents", "doc_id", "text").select(
        "doc_id", F.when(k % 7 != 0, F.col("text")).alias("raw_output"), F.when(k % 5 == 0, "boom").alias("error"), F.when(k % 3 == 0, "length").otherwise("stop").alias("finish_reason"))


@query(f"""WITH {_GEN} SELECT count(*)::BIGINT AS examples, count(*) FILTER (error IS NULL AND finish_reason = 'stop')::BIGINT AS completed, count(*) FILTER (error IS NULL AND finish_reason = 'length')::BIGINT AS truncated,
count(*) FILTER (error IS NOT NULL)::BIGINT AS errors, count(*) FILTER ({squash_sql('raw_output')} = '')::BIGINT AS empty FROM g""")
def generation_counts(spark, d):
    return evaluate.generation_counts(_generated(spark, d))


@query(f"""WITH {_GEN}, k AS (SELECT CASE WHEN error IS NOT NULL THEN 'none' WHEN finish_reason = 'stop' THEN 'picture' ELSE 'none' END AS kind FROM g)
SELECT x AS kind, count(k.kind)::BIGINT AS n FROM (SELECT unnest(['picture', 'document', 'none']) AS x) LEFT JOIN k ON k.kind = x GROUP BY x""")
def extraction_kinds(spark, d):
    """A histogram over a fixed domain: absent kinds are 0."""
    kind = F.when(F.col("error").isNotNull(), "none").when(F.col("finish_reason") == "stop", "picture").otherwise("none")
    return evaluate.zero_filled(_generated(spark, d).select(kind.alias("kind")), "kind", ["picture", "document", "none"])


_RUNS = """r AS (SELECT concat('run', l_suppkey % 12) AS run_id, l_linenumber % 4 AS device, l_returnflag <> 'R' AS ok, 60.0::DOUBLE + l_suppkey % 7 AS wall_s, l_quantity::BIGINT AS completion_tokens FROM lineitem),
t AS (SELECT run_id, count(*)::BIGINT AS samples, count(*) FILTER (ok)::BIGINT AS successful, count(*) FILTER (NOT ok)::BIGINT AS failed, max(wall_s) AS wall_s, count(*) FILTER (ok) / max(wall_s) AS samples_per_second,
  count(*) FILTER (ok) * 3600 / (max(wall_s) * count(DISTINCT device)) AS samples_per_gpu_hour, sum(completion_tokens)::BIGINT AS completion_tokens FROM r GROUP BY run_id)"""


def _runs(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem", "l_suppkey", "l_linenumber", "l_returnflag", "l_quantity")
    return rows.select(F.concat(F.lit("run"), F.col("l_suppkey") % 12).alias("run_id"), (F.col("l_linenumber") % 4).alias("device"), (F.col("l_returnflag") != "R").alias("ok"),
                       (F.lit(60.0) + F.col("l_suppkey") % 7).alias("wall_s"), F.col("l_quantity").cast("bigint").alias("completion_tokens"))


@query(f"WITH {_RUNS} SELECT * FROM t")
def run_throughput(spark, d):
    return evaluate.throughput(_runs(spark, d))


@query(f"WITH {_RUNS} SELECT run_id, samples_per_gpu_hour FROM t ORDER BY samples_per_gpu_hour DESC, run_id LIMIT 3")
def top_configs(spark, d):
    """The three best runs (a top-k report)."""
    return run_throughput(spark, d).select("run_id", "samples_per_gpu_hour").orderBy(F.desc("samples_per_gpu_hour"), "run_id").limit(3)


@query(f"WITH {_RUNS}, x AS (SELECT (substr(run_id, 4)::INTEGER % 4) AS config, samples_per_gpu_hour AS v FROM t), m AS (SELECT config, list_sort(list(v))[len(list(v)) // 2 + 1] AS median FROM x GROUP BY config) SELECT config, median FROM m ORDER BY median DESC, config LIMIT 1")
def winner_median(spark, d):
    """The configuration with the best median of three runs."""
    x = run_throughput(spark, d).select((F.substring("run_id", 4, 9).cast("int") % 4).alias("config"), F.col("samples_per_gpu_hour").alias("v"))
    return stats.ranks(x, ["config"], "v", {"median": ("middle",)}).orderBy(F.desc("median"), "config").limit(1)


@query("SELECT event_id % 20 AS run, count(*)::BIGINT AS logged, count(*) FILTER (value IS NOT NULL)::BIGINT AS finite, 0::BIGINT AS non_finite, arg_min(value, event_id) AS first, arg_max(value, event_id) AS last FROM events WHERE value IS NOT NULL GROUP BY 1")
def loss_summaries(spark, d):
    rows = table(spark, d, "events", "event_id", "value").where("value is not null")
    return rows.groupBy((F.col("event_id") % 20).alias("run")).agg(
        F.count("*").alias("logged"), F.count_if(stats.finite(F.col("value"))).alias("finite"), F.count_if(~stats.finite(F.col("value"))).alias("non_finite"), F.min_by("value", "event_id").alias("first"), F.max_by("value", "event_id").alias("last"))


_METRICS_COLUMNS = "label string, model_id string, training_model_id string, training_method string, summary_method string, artifact_method string, artifact_kind string, source_kind string, tokens_seen bigint, tokens_committed bigint, training_tokens bigint, optimizer_steps bigint, global_step bigint, completed bigint, examples bigint, data_identity string, split string, max_seq_len bigint, evaluation_set string"
_METRICS = [
    ("base", "m1", None, None, None, None, "base", None, None, None, None, 0, None, 90, 100, "d1", "test", 2048, "e1"), ("lora", "", "m1", None, "lora", None, "final", None, None, 500, 400, 0, 70, 95, 100, "d1", "test", 2048, "e1"),
    ("full", "m2", None, "full", None, None, "", "checkpoint", 0, 9, None, 10, 99, 0, 0, "d2", None, 4096, "e1"), ("odd", None, None, None, None, None, None, None, None, None, None, None, None, None, None, None, None, None, None),
    ("base2", "m2", None, None, None, None, None, "base", None, None, None, None, None, 1, 3, "d2", None, 4096, "e2"),
]
_M = duck_rows("m", _METRICS_COLUMNS.replace("string", "VARCHAR").replace("bigint", "BIGINT"), _METRICS)
_FLAT = f"""{_M}, f AS (SELECT label, coalesce(nullif(model_id, ''), training_model_id) AS model_id, coalesce(nullif(coalesce(nullif(training_method, ''), nullif(summary_method, ''), artifact_method), ''),
  CASE WHEN coalesce(nullif(artifact_kind, ''), source_kind) = 'base' THEN 'base' END) AS training_method, coalesce(nullif(artifact_kind, ''), source_kind) AS source_kind, coalesce(tokens_seen, tokens_committed, training_tokens) AS supervised_tokens,
  coalesce(nullif(optimizer_steps, 0), global_step) AS optimizer_steps, CASE WHEN examples <> 0 THEN completed / examples::DOUBLE END AS completion_rate, data_identity, split, max_seq_len, evaluation_set FROM m)"""


def _metrics(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_METRICS, _METRICS_COLUMNS)


@query(f"WITH {_FLAT} SELECT * FROM f")
def compare_runs(spark, d):
    """Metrics documents flattened with their fallback chains."""
    return evaluate.summarize(_metrics(spark))


@query(f"WITH {_FLAT} SELECT b.label AS base, t.label AS trained FROM f b JOIN f t ON b.data_identity = t.data_identity AND b.split IS NOT DISTINCT FROM t.split WHERE b.source_kind = 'base' AND t.source_kind IN ('checkpoint', 'final')")
def readiness_pairs(spark, d):
    return evaluate.comparable_pairs(compare_runs(spark, d))


@query(f"WITH {_FLAT} SELECT *, base > 0 AND trained > 0 AND pairs > 0 AS ready FROM (SELECT count(*) FILTER (source_kind = 'base')::BIGINT AS base, count(*) FILTER (source_kind IN ('checkpoint', 'final'))::BIGINT AS trained, (SELECT count(*) FROM f b JOIN f t ON b.data_identity = t.data_identity AND b.split IS NOT DISTINCT FROM t.split WHERE b.source_kind = 'base' AND t.source_kind IN ('checkpoint', 'final'))::BIGINT AS pairs FROM f)")
def readiness(spark, d):
    return evaluate.readiness(compare_runs(spark, d))


@query(f"""WITH {_FLAT} SELECT problem, n AS distinct_values FROM (SELECT 'dataset identity' AS problem, count(DISTINCT data_identity)::BIGINT AS n FROM f UNION ALL SELECT 'sequence limit', count(DISTINCT max_seq_len) FROM f
UNION ALL SELECT 'evaluation set', count(DISTINCT evaluation_set) FROM f) WHERE n > 1""")
def comparison_problems(spark, d):
    return evaluate.disagreements(compare_runs(spark, d), {"data_identity": "dataset identity", "max_seq_len": "sequence limit", "evaluation_set": "evaluation set"})


@query("""SELECT a.vec_id, round_even(1 - list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: abs(z[1]::DOUBLE - z[2]::DOUBLE))) / (255.0::DOUBLE * len(a.embedding)), 9) AS similarity
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def vector_l1_similarity(spark, d):
    """Normalised L1 similarity of each vector to the next."""
    a = table(spark, d, "embeddings", "vec_id", "embedding")
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return a.join(b, "vec_id").select("vec_id", F.bround(evaluate.l1_similarity(F.col("embedding"), F.col("other")), 9).alias("similarity"))


@query("SELECT event_type, count(*)::BIGINT AS n, sum(CAST(json_extract(props, '$.k') AS BIGINT))::BIGINT AS total FROM events GROUP BY event_type")
def props_json(spark, d):
    """A field of a JSON column, with a given schema."""
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, d, "events", "event_type", "props").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("total"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, epoch_us(ts) AS us FROM events")
def iso_stamps(spark, d):
    return table(spark, d, "events", "event_id", "ts").select("event_id", time.iso(micros("ts") / 1e6).alias("iso"), micros("ts").alias("us"))


_SIZES = [(1, 0), (2, 1023), (3, 1024), (4, 1536), (5, 5 * 1024**2), (6, 3 * 1024**4), (7, 5000 * 1024**4)]


@query(f"""WITH {duck_rows('s', 'id INTEGER, n BIGINT', _SIZES)} SELECT id, CASE WHEN n < 1024 THEN printf('%.1f B', n::DOUBLE) WHEN n < 1048576 THEN printf('%.1f KiB', n / 1024.0::DOUBLE) WHEN n < 1073741824 THEN printf('%.1f MiB', n / 1048576.0::DOUBLE)
WHEN n < 1099511627776 THEN printf('%.1f GiB', n / 1073741824.0::DOUBLE) ELSE printf('%.1f TiB', n / 1099511627776.0::DOUBLE) END AS shown FROM s""")
def human_sizes(spark, d):
    return spark.createDataFrame(_SIZES, "id int, n bigint").select("id", text.human_bytes("n").alias("shown"))


_WALLS = [("30", 30), ("90:00", 90), ("1:30:00", 90), ("2-00", 2880), ("1-12:30", 2190), ("1-00:00:59", 1440), ("0:10", 1), ("x", None), ("", None), ("1:2:3:4", None)]


@query(f"WITH {duck_rows('w', 'wall VARCHAR, minutes BIGINT', _WALLS)} SELECT * FROM w")
def wall_minutes(spark, d):
    """Scheduler wall times in minutes; the expected values are the oracle."""
    return spark.createDataFrame([(w,) for w, _ in _WALLS], "wall string").select("wall", text.wall_minutes("wall").alias("minutes"))


@query("""SELECT concat('s', s) AS shard, count(l.doc_id)::BIGINT AS listed, (count(*) - count(l.doc_id))::BIGINT AS unlisted FROM (SELECT doc_id, doc_id % 4 AS s FROM documents) LEFT JOIN labels l USING (doc_id) GROUP BY s""")
def files_against_list(spark, d):
    """Names on disk against names in a list, by full outer join of counts."""
    by = lambda t, n: table(spark, d, t, "doc_id").groupBy(F.concat(F.lit("s"), F.col("doc_id") % 4).alias("shard")).agg(F.count("*").alias(n))
    both = by("labels", "listed").join(by("documents", "n"), "shard", "full_outer")
    return both.select("shard", F.coalesce("listed", F.lit(0)).alias("listed"), (F.coalesce("n", F.lit(0)) - F.coalesce("listed", F.lit(0))).alias("unlisted"))


@query(f"""SELECT count(*)::BIGINT AS rows, sha256(concat('["', string_agg(CAST(doc_id AS VARCHAR), '", "' ORDER BY CAST(doc_id AS VARCHAR)), '"]')) AS ids_sha256
FROM (SELECT doc_id FROM documents ORDER BY {keyed_sql(13, 'doc_id')} LIMIT 256)""")
def evaluation_set_digest(spark, d):
    """The digest of a seeded evaluation set of 256 rows (a sampling operator)."""
    rows = splits.sample(table(spark, d, "documents", "doc_id"), "doc_id", 13, 256)
    return rows.agg(F.count("*").alias("rows"), ids.list_digest(F.array_sort(F.collect_list(F.col("doc_id").cast("string")))).alias("ids_sha256"))


@query("""SELECT n AS name, count(*)::BIGINT AS n FROM (SELECT list_last(string_split(p_type, ' ')) AS n FROM part) GROUP BY n""")
def last_components(spark, d):
    """A histogram of the last component of a compound name."""
    return table(spark, d, "part", "p_type").groupBy(F.substring_index("p_type", " ", -1).alias("name")).agg(F.count("*").alias("n"))


@query("""SELECT l_returnflag, NULL::VARCHAR AS o_orderpriority, count(*)::BIGINT AS n FROM lineitem GROUP BY 1 UNION ALL SELECT NULL, o_orderpriority, count(*) FROM orders GROUP BY 2""")
def union_of_keys(spark, d):
    """Rows of different shapes under the union of their columns."""
    from tamarack.sources.sinks import csv_union

    a = table(spark, d, "lineitem", "l_returnflag").groupBy("l_returnflag").agg(F.count("*").alias("n"))
    b = table(spark, d, "orders", "o_orderpriority").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    return csv_union([a, b])


@query("""SELECT 'identity' AS criterion, (SELECT count(*) = count(DISTINCT doc_id) FROM documents) AS passed UNION ALL SELECT 'labelled', (SELECT count(*) FROM documents) = (SELECT count(*) FROM labels) UNION ALL SELECT 'rows', (SELECT count(*) > 0 FROM documents) UNION ALL SELECT 'labels', (SELECT count(*) > 0 FROM labels WHERE toxic = 1)""")
def gate_criteria(spark, d):
    """Named booleans; the gate passes if all hold."""
    docs, labels = table(spark, d, "documents", "doc_id"), table(spark, d, "labels", "toxic")
    of_docs = docs.agg((F.count("*") > 0).alias("rows"), (F.count("*") == F.count_distinct("doc_id")).alias("identity"), F.count("*").alias("n"))
    one = of_docs.crossJoin(labels.agg((F.count_if(F.col("toxic") == 1) > 0).alias("labels"), F.count("*").alias("m")))  # one row each
    pairs = F.array(*[F.struct(F.lit(n).alias("criterion"), c.alias("passed")) for n, c in (("identity", F.col("identity")), ("labelled", F.col("n") == F.col("m")), ("rows", F.col("rows")), ("labels", F.col("labels")))])
    return one.select(F.explode(pairs).alias("p")).select("p.*")


@query()
def stream_settled_rows(spark, d):
    """The streaming state machine over events written as result documents (compared with the batch fold in tests)."""
    import tempfile

    from tamarack.storage import shared_dir
    from tamarack.streaming import ingest

    base = f"{shared_dir(spark)}/stream-{next(tempfile._get_candidate_names())}"
    by = Window.partitionBy("user_id").orderBy("ts", "event_id")
    kind = F.col("event_type")
    rows = table(spark, d, "events", "event_id", "ts", "user_id", "event_type").withColumn("generation", F.row_number().over(by))
    category = F.when(kind == "error", "engine_transient").when(kind == "signup", "stale_claim").when((kind == "view") & (F.col("event_id") % 97 == 0), "integrity").when(kind == "view", "timeout")
    cut = F.coalesce(F.max(F.when(kind == "click", 1)).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) == 1
    result = F.struct(F.col("user_id").cast("string").alias("row_id"), (kind == "purchase").alias("ok"), F.when(kind == "purchase", F.concat(F.lit("event "), F.col("event_id"))).alias("instruction"),
                      F.when(kind == "purchase", "stop").when(kind == "click", "length").alias("finish_reason"), category.alias("error_category"), F.when(cut, 384).otherwise(256).alias("max_tokens"))
    documents = rows.select(F.lit("run").alias("run_id"), F.col("generation").cast("int").alias("generation"), F.lit(0).alias("batch_index"), F.array(result).alias("results"), F.pmod("user_id", F.lit(4)).alias("part"))
    documents.repartition(4, "part").drop("part").write.json(f"{base}/in")
    stream = spark.readStream.schema(ingest.DOCUMENT).json(f"{base}/in").withColumn("content_sha256", F.sha2(F.to_json(F.struct("run_id", "generation", "batch_index", "results")), 256))
    ingest.run_available(ingest.advance(ingest.results(ingest.once(stream))), f"{base}/out", f"{base}/checkpoint")
    return ingest.last_states(spark, f"{base}/out").select(F.col("row_id").cast("bigint").alias("row_id"), "state", "reason", F.col("attempts").cast("bigint").alias("attempts"))
