"""Chat rendering, supervised-token masks, padding, batch checks and token accounting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarack.functions.stats import length_summary

IGNORED = -100


def render(role: Column, text: Column) -> Column:
    """One turn of the fixed chat format."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n"))


def render_conversations(turns: DataFrame) -> DataFrame:
    """``prompt`` (all turns before the last and the assistant's cue), ``target`` and ``full`` per conversation that ends
    with a non-blank assistant turn; ``prompt`` is a prefix of ``full``."""
    rows = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text")))).alias("t"))
    last = F.element_at("t", -1)
    lines = F.transform(F.slice("t", 1, F.size("t") - 1), lambda x: render(x["role"], x["text"]))
    out = rows.where((last["role"] == "assistant") & (F.length(F.trim(last["text"])) > 0))
    out = out.select("conv_id", F.concat(F.array_join(lines, ""), F.lit("<|assistant|>\n")).alias("prompt"), last["text"].alias("target"))
    return out.withColumn("full", F.concat("prompt", "target", F.lit("\n")))


def character_tokens(c: Column) -> Column:
    """The character tokenizer: ids are code points, offsets are positions."""
    return F.transform(F.filter(F.split(c, ""), lambda x: x != ""), lambda x: F.ascii(x))


def masked(ids: Column, prompt_tokens: Column) -> Column:
    """Labels: the prompt is ignored, the rest are the ids."""
    return F.concat(F.array_repeat(F.lit(IGNORED), prompt_tokens), F.slice(ids, prompt_tokens + 1, F.greatest(F.lit(0), F.size(ids) - prompt_tokens)))


def boundary(offsets: Column, target_start: Column) -> Column:
    """``struct(split, problem)``: how many tokens precede ``target_start``, and why that can't be masked exactly.
    ``offsets``: array of ``struct(begin, end)``."""
    k = F.size(F.filter(offsets, lambda o: o["begin"] < target_start))
    problem = (
        F.when(k == 0, "no prompt tokens")
        .when(k >= F.size(offsets), "no target tokens")
        .when(F.get(offsets, k - 1)["end"] > target_start, "spanning token")
        .when(F.get(offsets, k)["begin"] != target_start, "gap before target")
    )
    return F.struct(k.alias("split"), problem.alias("problem"))


def supervised(labels: Column) -> Column:
    return F.size(F.filter(labels, lambda x: x != IGNORED))


def token_stats(df: DataFrame) -> DataFrame:
    """Total, supervised and prompt tokens of ``input_ids, labels``; unequal lengths are an error."""
    bad = F.when(F.size("input_ids") != F.size("labels"), F.raise_error(F.lit("input_ids and labels differ in length")).cast("bigint"))
    return df.agg(
        F.count("*").alias("rows"), F.sum(F.coalesce(bad, F.size("input_ids").cast("bigint"))).alias("total_tokens"), F.sum(supervised(F.col("labels"))).alias("supervised_tokens"),
        F.sum(F.size("input_ids") - supervised(F.col("labels"))).alias("prompt_tokens"),
    )


def pad(df: DataFrame, batch: str, pad_id: int, multiple: int | None = None) -> DataFrame:
    """Right-pad ``input_ids, labels`` to each batch's width: also ``attention_mask`` and ``position_ids``."""
    widths = df.groupBy(batch).agg(F.max(F.size("input_ids")).alias("width"))
    if multiple:
        widths = widths.withColumn("width", (F.ceil(F.col("width") / multiple) * multiple).cast("int"))
    n = F.size("input_ids")
    rest = F.col("width") - n
    zeros = F.array_repeat(F.lit(0), rest)
    counting = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return df.join(widths, batch).withColumns({
        "attention_mask": F.concat(F.array_repeat(F.lit(1), n), zeros), "position_ids": F.concat(counting, zeros),
        "input_ids": F.concat("input_ids", F.array_repeat(F.lit(pad_id), rest)), "labels": F.concat("labels", F.array_repeat(F.lit(IGNORED), rest)),
    })


def batch_problems(pad_id: int) -> Column:
    """Names of the rules that a padded row breaks."""
    cols = F.arrays_zip("input_ids", "labels", "attention_mask", "position_ids")
    at = lambda name: (lambda x: x[name])
    i, y, m, p = (at(n) for n in ("input_ids", "labels", "attention_mask", "position_ids"))
    padded = lambda test: F.exists(cols, lambda x: (m(x) == 0) & test(x))
    real = F.filter(cols, lambda x: m(x) == 1)
    first = F.array_position(F.transform(real, lambda x: (y(x) != IGNORED).cast("int")), 1)
    late = F.exists(F.slice(real, F.greatest(first, F.lit(1)).cast("int"), F.size(real)), lambda x: y(x) == IGNORED)
    lengths = (F.size("input_ids") == F.size("labels")) & (F.size("labels") == F.size("attention_mask")) & (F.size("attention_mask") == F.size("position_ids"))
    rules = [
        (~lengths, "different lengths"), (F.exists("attention_mask", lambda v: ~v.isin(0, 1)), "mask is not 0 or 1"), (padded(lambda x: i(x) != pad_id), "padding token"),
        (padded(lambda x: y(x) != IGNORED), "padding label"), (padded(lambda x: p(x) != 0), "padding position"), ((first > 0) & late, "ignored after supervised"),
        (F.exists(real, lambda x: (y(x) != IGNORED) & (y(x) != i(x))), "foreign label"), (first == 0, "no supervised token"),
    ]
    return F.array_compact(F.array(*[F.when(test, name) for test, name in rules]))


def finish_reason(ids: Column, ends: list[int], prompt_tokens: Column) -> Column:
    """``stop`` if any end token follows the prompt, else ``length``."""
    tail = F.slice(ids, prompt_tokens + 1, F.greatest(F.size(ids), F.lit(1)))
    return F.when(F.exists(tail, lambda x: x.isin(*ends)), "stop").otherwise("length")


def token_report(rows: DataFrame, limit: int) -> DataFrame:
    """Per split and measure: the length summary of rows within ``limit``; over it are counted apart."""
    within = rows.where(F.col("total_tokens") <= limit)
    long = within.select("split", F.explode(F.map_from_arrays(F.array(*[F.lit(m) for m in ("total", "prompt", "supervised")]), F.array("total_tokens", "prompt_tokens", "supervised_tokens"))).alias("measure", "v"))
    over = rows.groupBy("split").agg(F.count_if(F.col("total_tokens") > limit).alias("over_limit"))
    return length_summary(long, ["split", "measure"], "v").join(over, "split")


def quarantine(rows: DataFrame, limit: int) -> DataFrame:
    """Rows over the limit, with the reason."""
    return rows.where(F.col("total_tokens") > limit).withColumn("reason", F.lit("over_length"))


def step_accounting(rows: DataFrame, order: str, tokens: str, accumulation: int) -> DataFrame:
    """Supervised tokens per optimizer step; a last step that isn't full is not committed."""
    from tamarack.operators.ordering import global_index

    at = global_index(rows, [F.col(order)], F.col(order).cast("bigint"), "_at")
    steps = at.groupBy(F.floor(F.col("_at") / accumulation).cast("bigint").alias("step")).agg(F.count("*").alias("micro_batches"), F.sum(tokens).cast("bigint").alias("tokens"))
    return steps.withColumn("committed", F.col("micro_batches") == accumulation)


def latest_per(df: DataFrame, key: str, order: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
