"""Queries over a corpus: slices, freezing, identities, policy, duplicates, splits, lengths, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.functions import ids, stats, text
from tamarack.operators import dedup, ordering, policy, splits, tokens
from tamarack.operators.policy import COMMANDS, PHRASES, FreezeLimits, instruction_policy
from tamarack.plans.registry import duck_rows, keyed_sql, query, squash_sql, strip_sql, words_sql
from tamarack.sources import sinks
from tamarack.sources.tables import table

VERSION, DATASET, REVISION, SPLIT = "row-v1", "documents", "0" * 40, "train"
LIMITS = FreezeLimits(max_chars=6000, max_image_bytes=3000)


def _docs(spark: SparkSession, d: str, *more: str) -> DataFrame:
    return table(spark, d, "documents", "doc_id", *(more or ("text",)))


@query("""SELECT doc_id, source_row_index FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS source_row_index FROM documents)
WHERE source_row_index >= 50 AND source_row_index < 350""")
def slice_rows(spark, d):
    """An exact contiguous slice by position."""
    at = ordering.global_index(_docs(spark, d, "lang").select("doc_id"), [F.col("doc_id")], F.col("doc_id"), "source_row_index")
    return at.where((F.col("source_row_index") >= 50) & (F.col("source_row_index") < 350))


@query("SELECT count(*)::BIGINT AS breaks FROM (SELECT doc_id - lag(doc_id) OVER (ORDER BY doc_id) AS step FROM documents) WHERE step <> 1")
def index_breaks(spark, d):
    """How often consecutive indices are not contiguous."""
    at = ordering.global_index(_docs(spark, d, "lang").select("doc_id"), [F.col("doc_id")], F.col("doc_id"), "i")
    after = at.select((F.col("i") + 1).alias("i"), F.col("doc_id").alias("before"))
    return at.join(after, "i").where("doc_id - before <> 1").agg(F.count("*").alias("breaks"))


_IMAGE_SQL = r"""CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN encode('') WHEN 2 THEN encode(text) ELSE unhex('89504E470D0A1A0A') || encode(text) END"""
_FROZEN_SQL = f"""f AS (SELECT doc_id, text, image, CASE WHEN {strip_sql("coalesce(text, '')")} = '' THEN 'empty_tikz' WHEN length(text) > 6000 THEN 'tikz_too_long'
  WHEN image IS NULL OR octet_length(image) = 0 THEN 'missing_image' WHEN octet_length(image) > 3000 THEN 'image_too_large'
  WHEN hex(image)[1:16] <> '89504E470D0A1A0A' THEN 'invalid_image' END AS rejection_reason FROM (SELECT doc_id, text, {_IMAGE_SQL} AS image FROM documents))"""


def with_images(docs: DataFrame) -> DataFrame:
    """Documents with a derived image column: missing, empty, no PNG, or PNG-signed bytes of the text."""
    k = F.col("doc_id") % 5
    png = F.concat(F.lit(policy.PNG), F.encode("text", "UTF-8"))
    return docs.withColumn("image", F.when(k == 0, None).when(k == 1, F.encode(F.lit(""), "UTF-8")).when(k == 2, F.encode("text", "UTF-8")).otherwise(png))


def frozen(spark: SparkSession, d: str) -> DataFrame:
    rows = with_images(_docs(spark, d))
    return rows.withColumn("rejection_reason", policy.freeze_problem(F.col("text"), F.col("image"), LIMITS))


@query(f"WITH {_FROZEN_SQL} SELECT doc_id, CASE WHEN rejection_reason IS NULL THEN 'valid' ELSE 'rejected' END AS status, rejection_reason FROM f")
def freeze_classify(spark, d):
    """Every source row stays in place with its status."""
    return frozen(spark, d).select("doc_id", F.when(F.col("rejection_reason").isNull(), "valid").otherwise("rejected").alias("status"), "rejection_reason")


@query(f"WITH {_FROZEN_SQL} SELECT coalesce(rejection_reason, 'valid') AS outcome, count(*)::BIGINT AS n FROM f GROUP BY 1")
def freeze_counts(spark, d):
    return frozen(spark, d).groupBy(F.coalesce("rejection_reason", F.lit("valid")).alias("outcome")).agg(F.count("*").alias("n"))


@query(f"""WITH {_FROZEN_SQL}, s AS (SELECT * FROM f ORDER BY doc_id LIMIT 200), a AS (SELECT count(*)::BIGINT AS sample_rows, coalesce(sum(coalesce(octet_length(image), 0)), 0)::BIGINT AS b,
  coalesce(sum(length(text)), 0)::BIGINT AS c FROM s)
SELECT sample_rows, round_even(b::DOUBLE / greatest(1, sample_rows), 1) AS average_image_bytes, round_even(c::DOUBLE / greatest(1, sample_rows), 1) AS average_text_chars,
  floor(100000 * (b::DOUBLE / greatest(1, sample_rows) + c::DOUBLE / greatest(1, sample_rows) + 256))::BIGINT AS projected_bytes,
  floor(floor(100000 * (b::DOUBLE / greatest(1, sample_rows) + c::DOUBLE / greatest(1, sample_rows) + 256)) * 1.5::DOUBLE)::BIGINT + 5368709120 AS required_bytes FROM a""")
def storage_estimate(spark, d):
    """Projected storage of 100,000 rows from the first 200, and the disk it asks for."""
    s = frozen(spark, d).orderBy("doc_id").limit(200)
    a = s.agg(F.count("*").alias("sample_rows"), F.coalesce(F.sum(F.coalesce(F.octet_length("image"), F.lit(0))), F.lit(0)).alias("b"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("c"))
    n = F.greatest(F.lit(1), F.col("sample_rows"))
    image, chars = F.col("b") / n, F.col("c") / n
    projected = F.floor(F.lit(100_000) * (image + chars + 256)).cast("bigint")
    return a.select("sample_rows", F.bround(image, 1).alias("average_image_bytes"), F.bround(chars, 1).alias("average_text_chars"), projected.alias("projected_bytes"), (F.floor(projected * F.lit(LIMITS.safety_factor)).cast("bigint") + LIMITS.reserve_bytes).alias("required_bytes"))


_ID_SQL = f"left(sha256(concat_ws(chr(31), '{VERSION}', '{DATASET}', '{REVISION}', '{SPLIT}', CAST(doc_id AS VARCHAR), sha256(text), sha256(''))), 32)"


def _row_id():
    return ids.stable_row_id(VERSION, DATASET, REVISION, SPLIT, F.col("doc_id"), ids.sha("text"), ids.sha(F.lit("")))


@query(f"SELECT doc_id, {_ID_SQL} AS row_id, sha256(text) AS text_sha256, length(text)::BIGINT AS text_chars FROM documents")
def stable_ids(spark, d):
    return _docs(spark, d).select("doc_id", _row_id().alias("row_id"), ids.sha("text").alias("text_sha256"), F.length("text").cast("bigint").alias("text_chars"))


def _escape_sql(c: str) -> str:
    out = f"replace(replace({c}, '\\', '\\\\'), '\"', '\\\"')"
    short = {8: "\\b", 9: "\\t", 10: "\\n", 12: "\\f", 13: "\\r"}
    for i in range(1, 32):
        out = f"replace({out}, chr({i}), '{short.get(i, f'\\u{i:04x}')}')"
    return f"concat('\"', {out}, '\"')"


_LINE_SQL = f"""concat('{{"doc_id": ', CAST(doc_id AS VARCHAR), ', "lang": ', {_escape_sql('lang')}, ', "text": ', {_escape_sql('text')}, '}}', chr(10))"""


def _line():
    return ids.logical_row(doc_id=F.col("doc_id").cast("string"), lang=text.json_string("lang"), text=text.json_string("text"))


@query(f"SELECT doc_id, sha256({_LINE_SQL}) AS logical_sha256 FROM documents")
def logical_rows(spark, d):
    """The digest of each row's canonical JSON line."""
    return _docs(spark, d, "lang", "text").select("doc_id", ids.sha(_line()).alias("logical_sha256"))


_SHARDS_SQL = f"""s AS (SELECT doc_id, {_LINE_SQL} AS line, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS shard FROM documents),
t AS (SELECT shard, count(*)::BIGINT AS rows, min(doc_id) AS first_index, max(doc_id) AS last_index, sha256(string_agg(line, '' ORDER BY doc_id)) AS logical_sha256 FROM s GROUP BY shard)"""


@query(f"WITH {_SHARDS_SQL} SELECT * FROM t")
def shard_digests(spark, d):
    """Ordered shards of 100 rows with their digests."""
    return sinks.shard_digests(sinks.with_shards(_docs(spark, d, "lang", "text"), "doc_id", 100), "doc_id", _line())


@query(f"""WITH {_SHARDS_SQL} SELECT sha256(concat('["', string_agg(logical_sha256, '", "' ORDER BY shard), '"]')) AS dataset_sha256 FROM t""")
def dataset_digest(spark, d):
    return sinks.dataset_digest(shard_digests(spark, d))


def _policy_sql(c: str) -> str:
    t, low = strip_sql(c), f"lower({strip_sql(c)})"
    command = f"list_filter([{', '.join(repr(x) for x in COMMANDS)}], lambda p: contains(t, p))[1]".replace("\\\\", "\\")
    phrase = f"list_filter([{', '.join(repr(x) for x in PHRASES)}], lambda p: contains(low, p))[1]"
    return f"""SELECT *, CASE WHEN {c} IS NULL THEN 'not_text' WHEN t = '' THEN 'empty' WHEN contains(low, '<think') OR contains(low, '</think') THEN 'thinking_leak'
  WHEN contains(low, '<source') OR contains(low, '</source') THEN 'source_tags' WHEN contains(t, '```') THEN 'markdown_fence' WHEN {command} IS NOT NULL THEN 'tikz_code'
  WHEN {phrase} IS NOT NULL THEN 'task_reference' WHEN length(t) < 20 THEN 'too_short' WHEN length(t) > 2000 THEN 'too_long' WHEN len({words_sql('t')}) > 120 THEN 'too_many_words' ELSE 'ok' END AS rule,
  CASE WHEN {c} IS NULL THEN 'instruction is NoneType' WHEN t = '' THEN 'instruction is empty after stripping' WHEN contains(low, '<think') OR contains(low, '</think') THEN 'instruction contains thinking tags'
  WHEN contains(low, '<source') OR contains(low, '</source') THEN 'instruction contains source tags' WHEN contains(t, '```') THEN 'instruction contains a code fence'
  WHEN {command} IS NOT NULL THEN concat('instruction contains ''', replace({command}, '\\', '\\\\'), '''') WHEN {phrase} IS NOT NULL THEN concat('instruction references ''', {phrase}, '''')
  WHEN length(t) < 20 THEN concat(length(t), ' chars < 20') WHEN length(t) > 2000 THEN concat(length(t), ' chars > 2000')
  WHEN len({words_sql('t')}) > 120 THEN concat(len({words_sql('t')}), ' words > 120') ELSE '' END AS detail FROM (SELECT *, {t} AS t, {low} AS low FROM """


@query(f"SELECT rule, count(*)::BIGINT AS n FROM ({_policy_sql('text')} documents)) GROUP BY rule")
def policy_outcomes(spark, d):
    """How many documents end at each rule of the instruction policy."""
    return _docs(spark, d).select(instruction_policy("text")["rule"].alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


@query(f"SELECT doc_id, rule = 'ok' AS ok, rule, detail FROM ({_policy_sql('text')} documents))")
def policy_detail(spark, d):
    return _docs(spark, d).select("doc_id", instruction_policy("text").alias("p")).select("doc_id", "p.ok", "p.rule", "p.detail")


@query(f"SELECT role, rule, count(*)::BIGINT AS n FROM ({_policy_sql('text')} conversations)) GROUP BY ALL")
def policy_conversations(spark, d):
    rows = table(spark, d, "conversations", "role", "text")
    return rows.select("role", instruction_policy("text")["rule"].alias("rule")).groupBy("role", "rule").agg(F.count("*").alias("n"))


_CASES = [
    (1, None), (2, ""), (3, " \t\n "), (4, "a" * 19), (5, "a" * 20), (6, "a" * 2000), (7, "a" * 2001), (8, "w " * 119 + "end"), (9, "w " * 120 + "end"), (10, "Draw a <THINK> box here please"),
    (11, "Has a </Source> tag in the text"), (12, "Some ```code``` is in here now"), (13, "Please \\draw (0,0) and \\begin{x}"), (14, "Use \\node{} and \\draw both here"), (15, "Take the SOURCE CODE as it stands"),
    (16, "In this task the supplied image"), (17, " 　Draw a red circle in a box "), (18, "Draw a red circle in a green box"), (19, "reference image, then \\pgf too"), (20, "Draw one\u0085two\u001cthree words and more"),
]


@query(f"WITH {duck_rows('c', 'id INTEGER, text VARCHAR', _CASES)} SELECT id, rule, detail FROM ({_policy_sql('text')} c))")
def policy_cases(spark, d):
    """The policy on rows made to trigger each rule."""
    rows = spark.createDataFrame(_CASES, "id int, text string")
    return rows.select("id", instruction_policy("text").alias("p")).select("id", "p.rule", "p.detail")


@query(f"SELECT doc_id, {squash_sql('text')} AS squashed, len({words_sql('text')})::BIGINT AS words FROM documents")
def squash_text(spark, d):
    return _docs(spark, d).select("doc_id", text.squash("text").alias("squashed"), text.word_count("text").cast("bigint").alias("words"))


_NORM = f"sha256({squash_sql('text')})"


@query(f"SELECT {_NORM} AS normalized_sha256, count(*)::BIGINT AS members, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_dup_groups(spark, d):
    return dedup.exact_groups(_docs(spark, d), "doc_id", "text")


@query(f"""SELECT count(*)::BIGINT AS duplicate_groups, coalesce(sum(n - 1), 0)::BIGINT AS duplicate_rows, coalesce(max(n), 0)::BIGINT AS largest_group
FROM (SELECT count(*) AS n FROM documents GROUP BY {_NORM} HAVING count(*) > 1)""")
def dup_stats(spark, d):
    from tamarack.operators.evaluate import duplicate_stats

    return duplicate_stats(_docs(spark, d), "text")


def _components(spark: SparkSession, d: str) -> DataFrame:
    rows = _docs(spark, d, "text", "source", "n_chars")
    rows = rows.select("doc_id", ids.sha("text").alias("text_sha256"), ids.sha(F.concat_ws("|", F.col("source"), F.col("n_chars").cast("string"))).alias("image_sha256"))
    return dedup.duplicate_components(rows, "doc_id", ["text_sha256", "image_sha256"])


_COMPONENTS_SQL = """r AS (SELECT doc_id, sha256(text) AS a, sha256(concat_ws('|', source, CAST(n_chars AS VARCHAR))) AS b FROM documents),
e AS MATERIALIZED (SELECT DISTINCT x.doc_id AS u, y.doc_id AS v FROM r x JOIN r y ON x.a = y.a UNION SELECT DISTINCT x.doc_id, y.doc_id FROM r x JOIN r y ON x.b = y.b),
c AS (SELECT doc_id, doc_id AS m FROM documents UNION SELECT c.doc_id, e.v FROM c JOIN e ON e.u = c.m),
k AS MATERIALIZED (SELECT doc_id, min(m) AS component FROM c GROUP BY doc_id)"""
_GROUPS_SQL = f"""{_COMPONENTS_SQL}, g AS MATERIALIZED (SELECT component, left(sha256(concat('group-v1', chr(31), string_agg(CAST(doc_id AS VARCHAR), chr(31) ORDER BY CAST(doc_id AS VARCHAR)))), 32) AS group_id,
  count(*)::BIGINT AS members FROM k GROUP BY component)"""


@query(f"WITH RECURSIVE {_GROUPS_SQL} SELECT doc_id, component, group_id, members FROM k JOIN g USING (component)")
def dup_components(spark, d):
    """Rows that share a text hash or a second hash, transitively, with the group's name."""
    return dedup.name_groups(_components(spark, d), "doc_id", "group-v1").select("doc_id", "component", "group_id", "members")


_SPLIT_SQL = f"""{_GROUPS_SQL}, o AS (SELECT *, coalesce(sum(members) OVER (ORDER BY {keyed_sql(7, 'group_id')} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(members) OVER () AS total FROM g),
s AS MATERIALIZED (SELECT component, group_id, members, CASE WHEN before < round_even(total * 0.1::DOUBLE, 0) THEN 'validation'
  WHEN before - round_even(total * 0.1::DOUBLE, 0) < round_even(total * 0.15::DOUBLE, 0) THEN 'test' ELSE 'train' END AS split FROM o)"""


def _splits(spark: SparkSession, d: str) -> DataFrame:
    from tamarack.storage import durable

    rows = durable(dup_components(spark, d))
    groups = rows.groupBy("component", "group_id", "members").count().drop("count")
    return rows.join(splits.assign_splits(groups, 7, 0.1, 0.15).select("component", "split"), "component")


@query(f"WITH RECURSIVE {_SPLIT_SQL} SELECT doc_id, group_id, split FROM k JOIN s USING (component)")
def split_assign(spark, d):
    """Leak-free splits: whole groups in seeded order."""
    return _splits(spark, d).select("doc_id", "group_id", "split")


@query(f"WITH RECURSIVE {_SPLIT_SQL} SELECT split, sum(members)::BIGINT AS rows, count(*)::BIGINT AS groups FROM s GROUP BY split")
def split_counts(spark, d):
    return _splits(spark, d).groupBy("split").agg(F.count("*").alias("rows"), F.count_distinct("group_id").alias("groups"))


@query(f"WITH RECURSIVE {_SPLIT_SQL} SELECT count(*)::BIGINT AS leaks FROM (SELECT sha256(text) FROM documents JOIN k USING (doc_id) JOIN s USING (component) GROUP BY 1 HAVING count(DISTINCT split) > 1)")
def split_leakage(spark, d):
    """Texts found in more than one split: none."""
    rows = _splits(spark, d).select("doc_id", "split").join(_docs(spark, d), "doc_id")
    return rows.groupBy(ids.sha("text").alias("h")).agg(F.count_distinct("split").alias("n")).where("n > 1").agg(F.count("*").alias("leaks"))


def _grams_sql(name: str, source: str, key: str, n: int) -> str:
    return f"""{name} AS MATERIALIZED (SELECT DISTINCT {key}, g FROM (SELECT {key}, sha256(array_to_string(w[i:i + {n - 1}], ' ')) AS g
  FROM (SELECT {key}, w, unnest(range(1, greatest(len(w) - {n - 1}, CASE WHEN len(w) > 0 THEN 1 ELSE 0 END) + 1)) AS i FROM (SELECT {key}, {words_sql("coalesce(text, '')")} AS w FROM {source}))))"""


_PAIRS_SQL = f"""{_grams_sql('a', 'documents', 'doc_id', 8)}, {_grams_sql('b', 'benchmark', 'item_id', 8)}, na AS (SELECT doc_id, count(*) AS n FROM a GROUP BY ALL), nb AS (SELECT item_id, count(*) AS n FROM b GROUP BY ALL),
p AS (SELECT doc_id, item_id, shared, shared::DOUBLE / (na.n + nb.n - shared) AS jaccard FROM (SELECT doc_id, item_id, count(*)::BIGINT AS shared FROM a JOIN b USING (g) GROUP BY ALL) JOIN na USING (doc_id) JOIN nb USING (item_id))"""


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return dedup.overlaps(_docs(spark, d), "doc_id", table(spark, d, "benchmark", "item_id", "text"), "item_id", 8)


@query(f"WITH {_grams_sql('a', 'documents', 'doc_id', 8)} SELECT doc_id, count(*)::BIGINT AS n_grams FROM a GROUP BY doc_id")
def ngram_sets(spark, d):
    """How many distinct 8-grams each document has."""
    return _docs(spark, d).select("doc_id", F.size(dedup.grams(F.coalesce("text", F.lit("")), 8)).cast("bigint").alias("n_grams")).where("n_grams > 0")


@query(f"WITH {_PAIRS_SQL} SELECT * FROM p")
def contamination_pairs(spark, d):
    return _pairs(spark, d)


@query(f"WITH {_PAIRS_SQL} SELECT doc_id, item_id, shared, jaccard FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY jaccard DESC, item_id) AS r FROM p) WHERE r = 1")
def contamination_best(spark, d):
    return dedup.best_overlap(_pairs(spark, d), "doc_id", "item_id")


_MEMORIZED_SQL = f"""{_PAIRS_SQL}, x AS (SELECT {_NORM} AS h FROM benchmark), best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY jaccard DESC, item_id) AS r FROM p) WHERE r = 1),
m AS (SELECT doc_id, CASE WHEN e THEN 'exact' WHEN jaccard >= 0.1 THEN 'near' END AS kind, CASE WHEN NOT e THEN coalesce(jaccard, 0) END AS jaccard, CASE WHEN NOT e THEN item_id END AS item_id
  FROM (SELECT doc_id, {_NORM} IN (SELECT h FROM x) AS e FROM documents) LEFT JOIN best USING (doc_id))"""


@query(f"WITH {_MEMORIZED_SQL} SELECT * FROM m")
def memorized_flags(spark, d):
    """Documents that repeat a benchmark item exactly or by at least a tenth of their 8-grams."""
    return dedup.memorized(_docs(spark, d), "doc_id", table(spark, d, "benchmark", "item_id", "text"), "item_id", 8, 0.1)


@query(f"WITH {_MEMORIZED_SQL} SELECT count(*)::BIGINT AS checked, count(*) FILTER (kind = 'exact')::BIGINT AS exact_matches, count(*) FILTER (kind = 'near')::BIGINT AS near_matches FROM m")
def memorized_counts(spark, d):
    m = memorized_flags(spark, d)
    return m.agg(F.count("*").alias("checked"), F.count_if(F.col("kind") == "exact").alias("exact_matches"), F.count_if(F.col("kind") == "near").alias("near_matches"))


def _rank_sql(v: str, f: float) -> str:
    return f"list_sort(list({v}))[floor((count({v}) - 1) * {f}::DOUBLE)::BIGINT + 1]"


@query(f"""SELECT lang, count(n_chars)::BIGINT AS count, sum(n_chars)::BIGINT AS total, round_even(sum(n_chars)::DOUBLE / count(n_chars), 3) AS mean, min(n_chars) AS min,
{', '.join(f"{_rank_sql('n_chars', p / 100)} AS p{p}" for p in (50, 90, 95, 99))}, max(n_chars) AS max FROM documents GROUP BY lang""")
def length_report(spark, d):
    """Length summary per language with lower nearest ranks."""
    return stats.length_summary(table(spark, d, "documents", "lang", "n_chars"), ["lang"], "n_chars")


@query(f"SELECT source, count(n_chars)::BIGINT AS count, min(n_chars) AS min, max(n_chars) AS max, {_rank_sql('n_chars', 0.5)} AS p50, {_rank_sql('n_chars', 0.95)} AS p95 FROM documents GROUP BY source")
def token_statistics(spark, d):
    rows = table(spark, d, "documents", "source", "n_chars")
    base = rows.groupBy("source").agg(F.count("n_chars").alias("count"), F.min("n_chars").alias("min"), F.max("n_chars").alias("max"))
    return base.join(stats.ranks(rows, ["source"], "n_chars", {"p50": ("fraction", 0.5), "p95": ("fraction", 0.95)}), "source")


_TOKENS_SQL = f"t AS MATERIALIZED (SELECT doc_id, len({words_sql('text')})::BIGINT AS total_tokens FROM documents)"


def _word_tokens(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", text.word_count("text").cast("bigint").alias("total_tokens"))


@query(f"WITH {_TOKENS_SQL} SELECT doc_id, total_tokens, 'over_length' AS reason FROM t WHERE total_tokens > 1000")
def quarantine(spark, d):
    return tokens.quarantine(_word_tokens(spark, d), 1000)


@query(f"WITH {_TOKENS_SQL} SELECT count(*)::BIGINT AS rows, count(*) FILTER (total_tokens > 1000)::BIGINT AS quarantined, count(*) FILTER (total_tokens > 1000) / count(*)::DOUBLE AS fraction FROM t")
def quarantine_fraction(spark, d):
    over = F.count_if(F.col("total_tokens") > 1000)
    return _word_tokens(spark, d).agg(F.count("*").alias("rows"), over.alias("quarantined"), (over / F.count("*")).alias("fraction"))


@query(f"""WITH RECURSIVE {_SPLIT_SQL}, {_TOKENS_SQL} SELECT split, count(*) FILTER (total_tokens <= 1000)::BIGINT AS eligible, count(*) FILTER (total_tokens > 1000)::BIGINT AS quarantined
FROM k JOIN s USING (component) JOIN t USING (doc_id) GROUP BY split""")
def eligible_by_split(spark, d):
    """Rows per split that stay after quarantined ids are excluded."""
    rows = _splits(spark, d).select("doc_id", "split")
    gone = tokens.quarantine(_word_tokens(spark, d), 1000).select("doc_id")
    stay = rows.join(gone, "doc_id", "left_anti").groupBy("split").agg(F.count("*").alias("eligible"))
    lost = rows.join(gone, "doc_id", "left_semi").groupBy("split").agg(F.count("*").alias("quarantined"))
    return stay.join(lost, "split", "full_outer").select("split", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("eligible", "quarantined")])


@query(f"SELECT doc_id, lang FROM documents ORDER BY {keyed_sql(42, 'doc_id')} LIMIT 64")
def seeded_sample(spark, d):
    """64 documents by seeded order (a sampling operator)."""
    return splits.sample(_docs(spark, d, "lang"), "doc_id", 42, 64)


_BITS = "CASE WHEN length(text) = 0 THEN 0 ELSE length(bin(length(text))) END"


@query(f"""SELECT doc_id, source FROM (SELECT doc_id, source, {_BITS} AS b, row_number() OVER (PARTITION BY source, {_BITS} ORDER BY {keyed_sql(42, 'doc_id')}) AS turn FROM documents)
ORDER BY turn, source, b LIMIT 100""")
def round_robin_sample(spark, d):
    """100 documents in turns over (source, length bucket)."""
    rows = _docs(spark, d, "source", "text")
    return splits.round_robin(rows, "doc_id", [F.col("source"), splits.length_bucket(F.col("text"))], 42, 100).select("doc_id", "source")


@query(f"""SELECT doc_id, stratum, row_number() OVER (PARTITION BY stratum ORDER BY {keyed_sql(42, 'doc_id')}) AS turn FROM
(SELECT doc_id, ((row_number() OVER (ORDER BY length(text), CAST(doc_id AS VARCHAR)) - 1) // 25)::INTEGER AS stratum FROM documents ORDER BY length(text), CAST(doc_id AS VARCHAR) LIMIT 100)""")
def strata_prefix(spark, d):
    """Four strata of 25 by length, interleaved by seeded turns."""
    out = splits.strata(_docs(spark, d), "doc_id", "text", 4, 25, 42)
    return out.select("doc_id", "stratum", F.col("turn").cast("bigint").alias("turn"))


@query("""WITH b AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS source_row_index FROM benchmark ORDER BY item_id LIMIT 10)
SELECT r.id, CASE WHEN r.id < 10 THEN CAST(item_id AS VARCHAR) ELSE printf('%s-load-%04d', CAST(item_id AS VARCHAR), r.id) END AS load_id, source_row_index
FROM (SELECT unnest(range(0, 64)) AS id) r JOIN b ON b.source_row_index = r.id % 10""")
def workload_repeat(spark, d):
    """A workload of 64 rows out of ten items."""
    items = ordering.global_index(table(spark, d, "benchmark", "item_id"), [F.col("item_id")], F.col("item_id"), "source_row_index").where("source_row_index < 10")
    return splits.repeat_workload(items, "item_id", 64, 10)


@query()
def lpt_assignment(spark, d):
    """Longest-first assignment of all documents to four workers (greedy, so no SQL; tested against Python)."""
    rows = table(spark, d, "documents", "doc_id", "n_chars").withColumn("source_row_index", F.col("doc_id"))
    return splits.balanced_assignment(rows, "source_row_index", "doc_id", "n_chars", 4)


@query("""SELECT unnest(range(0, 4)) AS replica, unnest([13, 13, 12, 12])::INTEGER AS share""")
def concurrency_share(spark, d):
    return spark.range(4).select(F.col("id").alias("replica"), splits.share(50, 4, F.col("id")).cast("int").alias("share"))


@query("""SELECT e AS engine, c AS concurrency, least(100, greatest(16, 2 * c))::INTEGER AS screen_size FROM (SELECT unnest(['offline', 'http', 'other']) AS e), (SELECT unnest([1, 8, 32]) AS c)""")
def config_matrix(spark, d):
    """Cross product of two small literal domains with the screen size of each concurrency."""
    engines = spark.createDataFrame([("offline",), ("http",), ("other",)], "engine string")
    loads = spark.createDataFrame([(1,), (8,), (32,)], "concurrency int")
    return engines.crossJoin(loads).withColumn("screen_size", splits.screen_size(F.col("concurrency")).cast("int"))
