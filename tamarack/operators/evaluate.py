"""Metrics of generated outputs: counters, extraction, latency, duplicates, throughput, comparison of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.functions.ids import sha
from tamarack.functions.stats import finite, ranks, ratio
from tamarack.functions.text import py_strip, squash

#: The payload's delimiters and what counts as drawing or as unsafe.
FENCE = r"(?s)```(?:latex|tex|tikz)?\s*(.*?)```"
PICTURE = r"(?s)\\begin\{tikzpicture\}.*?\\end\{tikzpicture\}"
DRAWING = r"\\(draw|node|path|fill|filldraw|shade|shadedraw|coordinate|foreach|clip|matrix)\b"
UNSAFE = r"(?i)\\(input|include|openout|read|write|immediate)\b"
BEGIN, END, CLASS = "\\begin{document}", "\\end{document}", "\\documentclass"
PREAMBLE = "\\documentclass[border=2pt]{standalone}\n\\usepackage[T1]{fontenc}\n\\usepackage{tikz}\n\\usepackage{amsmath,amssymb}\n\\begin{document}\n"
POSTAMBLE = "\n\\end{document}\n"


def candidate(text: Column) -> Column:
    """The longest fenced block (of equals the first), or the text itself."""
    blocks = F.regexp_extract_all(text, F.lit(FENCE), F.lit(1))
    ranked = F.transform(blocks, lambda b, i: F.struct(F.length(b).alias("n"), (-i).alias("at"), b.alias("b")))
    return F.when(F.size(blocks) > 0, F.array_max(ranked)["b"]).otherwise(text)


def whole_document(c: Column) -> Column:
    """From the last class declaration before the first begin to the next end; null without both."""
    begin = F.locate(BEGIN, c)
    tail = c.substr(begin, F.length(c))
    end = F.locate(END, tail)
    head = c.substr(F.lit(1), begin - 1)
    back = F.locate(CLASS[::-1], F.reverse(head))
    start = F.when(back > 0, F.length(head) - back - len(CLASS) + 2).otherwise(begin)
    return F.when((begin > 0) & (end > 0), c.substr(start, begin - start + end + len(END) - 1))


def extract(text: Column | str) -> Column:
    """``struct(kind, code, note)`` of the payload in an output."""
    t = F.col(text) if isinstance(text, str) else text
    c = candidate(t)
    document, picture = whole_document(c), F.regexp_extract(c, PICTURE, 0)
    out = lambda kind, code, note: F.struct(F.lit(kind).alias("kind"), code.alias("code"), F.lit(note).alias("note"))
    return (
        F.when(t.isNull() | (F.length(py_strip(F.coalesce(t, F.lit("")))) == 0), out("none", F.lit(""), "empty output"))
        .when(F.length(document) > 0, out("document", document, "complete LaTeX document"))
        .when(F.length(picture) > 0, out("picture", picture, "tikzpicture environment"))
        .when(c.rlike(DRAWING), out("picture", py_strip(c), "bare drawing commands wrapped in tikzpicture"))
        .otherwise(out("none", F.lit(""), "no TikZ picture found"))
    )


def build(extraction: Column) -> Column:
    """A compilable document of an extraction; null for none."""
    code = extraction["code"]
    return F.when(extraction["kind"] == "document", F.when(code.endswith("\n"), code).otherwise(F.concat(code, F.lit("\n")))).when(
        extraction["kind"] == "picture", F.concat(F.lit(PREAMBLE), code, F.lit(POSTAMBLE))
    )


def is_unsafe(code: Column) -> Column:
    return code.rlike(UNSAFE)


def generation_counts(records: DataFrame) -> DataFrame:
    """Examples by outcome: an error wins over a stop, a stop over a cut; empties are counted beside these."""
    fine = F.col("error").isNull() | (F.col("error") == "")
    return records.agg(
        F.count("*").alias("examples"), F.count_if(fine & (F.col("finish_reason") == "stop")).alias("completed"), F.count_if(fine & (F.col("finish_reason") == "length")).alias("truncated"),
        F.count_if(~fine).alias("errors"), F.count_if(squash("raw_output") == "").alias("empty"),
    )


def zero_filled(df: DataFrame, column: str, domain: list[str]) -> DataFrame:
    """Counts of ``column`` over a fixed domain, absent values as 0."""
    every = df.sparkSession.createDataFrame([(d,) for d in domain], f"{column} string")
    return every.join(df.groupBy(column).agg(F.count("*").alias("n")), column, "left").select(column, F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def duplicate_stats(df: DataFrame, text: str) -> DataFrame:
    """Groups of equal normalised texts, rows beyond the first of each, and the largest group."""
    groups = df.groupBy(sha(squash(text)).alias("_h")).agg(F.count("*").alias("n")).where("n > 1")
    return groups.agg(F.count("*").alias("duplicate_groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"), F.coalesce(F.max("n"), F.lit(0)).alias("largest_group"))


def value_summary(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """``count, mean, median, p10, max`` per group; the median is the upper middle."""
    base = df.groupBy(*by).agg(F.count(value).alias("count"), F.avg(value).alias("mean"), F.max(value).alias("max"))
    return base.join(ranks(df, by, value, {"median": ("middle",), "p10": ("fraction", 0.1)}), by, "left").select(*by, "count", "mean", "median", "p10", "max")


#: Fixed value: the status of a compiled document.
COMPILED = "success"


def compile_summary(results: DataFrame) -> DataFrame:
    """Attempts, successes and their rate to six places (null without attempts)."""
    done = F.count_if(F.col("status") == COMPILED)
    return results.agg(F.count("*").alias("attempted"), done.alias("success"), ratio(done, F.count("*")).alias("success_rate"))


def compile_failures(results: DataFrame) -> DataFrame:
    """How many attempts failed in each category: ``category, n``."""
    return results.where(F.col("status") != COMPILED).groupBy("category").agg(F.count("*").alias("n"))


def first_errors(results: DataFrame, order: str, limit: int = 10) -> DataFrame:
    """The first error messages in record order."""
    return results.where((F.col("status") != COMPILED) & F.col("error_message").isNotNull()).orderBy(order).limit(limit)


def throughput(records: DataFrame, run: str = "run_id") -> DataFrame:
    """Per run: successes, the slowest replica's wall time, samples per second and per device hour, tokens."""
    ok = F.count_if("ok")
    wall = F.max("wall_s")
    return records.groupBy(run).agg(
        F.count("*").alias("samples"), ok.alias("successful"), (F.count("*") - ok).alias("failed"), wall.alias("wall_s"), F.try_divide(ok, wall).alias("samples_per_second"),
        F.try_divide(ok * 3600, wall * F.count_distinct("device")).alias("samples_per_gpu_hour"), F.sum("completion_tokens").alias("completion_tokens"),
    )


def loss_summary(log: DataFrame, order: str, loss: str) -> DataFrame:
    """Logged losses: how many, finite or not, and the first and last of all."""
    logged = log.where(F.col(loss).isNotNull())
    return logged.agg(
        F.count("*").alias("logged"), F.count_if(finite(F.col(loss))).alias("finite"), F.count_if(~finite(F.col(loss))).alias("non_finite"), F.min_by(loss, order).alias("first"),
        F.max_by(loss, order).alias("last"),
    )


def l1_similarity(a: Column, b: Column, scale: float = 255.0) -> Column:
    """``1 - sum |a - b| / (scale * n)`` of two equally long arrays; null if they differ in length."""
    total = F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, v: s + v)
    return F.when(F.size(a) == F.size(b), 1 - total / (scale * F.size(a)))


def summarize(metrics: DataFrame) -> DataFrame:
    """Flatten metrics documents: fallbacks take the first value that is there (0 and '' count as missing where noted)."""
    some = lambda c: F.nullif(c, F.lit("")) if isinstance(c, str) else c
    kind = F.coalesce(some("artifact_kind"), F.col("source_kind"))
    method = F.coalesce(some("training_method"), some("summary_method"), F.col("artifact_method"))
    return metrics.select(
        "label", F.coalesce(some("model_id"), F.col("training_model_id")).alias("model_id"), F.coalesce(some_text(method), F.when(kind == "base", "base")).alias("training_method"), kind.alias("source_kind"),
        F.coalesce("tokens_seen", "tokens_committed", "training_tokens").alias("supervised_tokens"), F.coalesce(F.nullif("optimizer_steps", F.lit(0).cast("bigint")), F.col("global_step")).alias("optimizer_steps"),
        ratio(F.col("completed"), F.col("examples"), None).alias("completion_rate"), "data_identity", "split", "max_seq_len", "evaluation_set",
    )


def some_text(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def disagreements(rows: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Fields in which candidates differ, missing values aside: ``problem, distinct_values``."""
    counts = rows.agg(*[F.count_distinct(f).alias(f) for f in fields])
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("problem"), F.col(f).alias("distinct_values")) for f, d in fields.items()])).alias("p")
    return counts.select(pairs).select("p.*").where("distinct_values > 1")


def comparable_pairs(rows: DataFrame) -> DataFrame:
    """Base and trained artifacts of one data identity and split."""
    base = rows.where("source_kind = 'base'").select(F.col("label").alias("base"), F.col("data_identity").alias("i"), F.col("split").alias("s"))
    trained = rows.where(F.col("source_kind").isin("checkpoint", "final")).select(F.col("label").alias("trained"), "data_identity", F.col("split").alias("trained_split"))
    return base.join(trained, (F.col("i") == F.col("data_identity")) & F.col("s").eqNullSafe(F.col("trained_split"))).select("base", "trained")


def readiness(rows: DataFrame) -> DataFrame:
    """One row: whether base and trained artifacts exist and can be compared."""
    kinds = rows.agg(F.count_if(F.col("source_kind") == "base").alias("base"), F.count_if(F.col("source_kind").isin("checkpoint", "final")).alias("trained"))
    pairs = comparable_pairs(rows).agg(F.count("*").alias("pairs"))
    return kinds.crossJoin(pairs).withColumn("ready", (F.col("base") > 0) & (F.col("trained") > 0) & (F.col("pairs") > 0))  # one row each
