"""Verification of results, accepted rows, exports, documents and run prerequisites."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.functions.ids import sha
from tamarack.functions.text import py_strip
from tamarack.operators.checks import count_check, report, row_checks
from tamarack.operators.policy import InstructionLimits, instruction_policy


def result_identity(results: DataFrame, manifest: DataFrame, expected: dict[str, str]) -> DataFrame:
    """``row_id, severity, reason`` of results that don't belong: fatal where row, index or run differ, ``integrity``
    where a checksum drifted. ``expected``: run-wide values by column."""
    known = manifest.select("row_id", F.col("source_row_index").alias("_i"), F.col("image_sha256").alias("_m"), F.col("tikz_sha256").alias("_t"), F.lit(True).alias("_there"))
    j = results.join(known, "row_id", "left")
    reason = F.when(F.col("_there").isNull(), "unknown row").when(~F.col("source_row_index").eqNullSafe(F.col("_i")), "index mismatch")
    for column, value in expected.items():
        reason = reason.when(~F.col(column).eqNullSafe(F.lit(value)), f"{column} mismatch")
    drift = ~F.col("image_sha256").eqNullSafe(F.col("_m")) | ~F.col("tikz_sha256").eqNullSafe(F.col("_t"))
    out = j.withColumn("reason", reason.when(drift, "integrity"))
    return out.where("reason is not null").select("row_id", F.when(F.col("reason") == "integrity", "row").otherwise("fatal").alias("severity"), "reason")


def result_structure() -> Column:
    """Names of the rules that a result breaks."""
    rules = {
        "row_id": F.coalesce(F.col("row_id") == "", F.lit(True)), "ok": F.col("ok").isNull(), "max_tokens": F.coalesce(F.col("max_tokens") <= 0, F.lit(True)),
        "tokens": F.coalesce(F.col("ok") & ((F.col("prompt_tokens") < 0) | (F.col("completion_tokens") < 0)), F.lit(False)),
        "failure without category": F.coalesce(~F.col("ok"), F.lit(False)) & F.col("error_category").isNull() & ~F.coalesce(F.col("finish_reason") == "length", F.lit(False)),
    }
    return F.array_compact(F.array(*[F.when(t, n) for n, t in rules.items()]))


def accepted_problems(rows: DataFrame, manifest: DataFrame, limits: InstructionLimits = InstructionLimits()) -> DataFrame:
    """What is wrong with accepted rows: ``row_id, problems`` (only rows with any)."""
    known = manifest.select("row_id", F.col("source_row_index").alias("_i"), F.col("status").alias("_s"))
    j = rows.join(known, "row_id", "left")
    rule = instruction_policy("instruction", limits)["rule"]
    tests = [
        (F.col("_s").isNull(), F.lit("not in manifest")), (F.coalesce(F.col("_s") != "valid", F.lit(False)), F.lit("manifest rejected")),
        (F.col("_i").isNotNull() & ~F.col("source_row_index").eqNullSafe(F.col("_i")), F.lit("index mismatch")), (~F.coalesce(F.col("finish_reason") == "stop", F.lit(False)), F.lit("not finished")), (rule != "ok", rule),
    ]
    return j.select("row_id", F.array_compact(F.array(*[F.when(t, n) for t, n in tests])).alias("problems")).where(F.size("problems") > 0)


def prompt_budget(tokens: Column, reserved: int, context: int) -> Column:
    """``input_too_long`` where prompt and reserved output exceed the context."""
    return F.when(tokens + reserved > context, "input_too_long")


def acceptable(finish: Column, instruction: Column) -> Column:
    return F.coalesce((finish == "stop") & (F.length(py_strip(F.coalesce(instruction, F.lit("")))) > 0), F.lit(False))


def content_tests() -> dict[str, Column]:
    """Per-row checks of exported rows."""
    blank = lambda c: F.coalesce(F.length(py_strip(c)) == 0, F.lit(True))
    return {"row.id": blank("id"), "row.text": blank("tikz_code"), "row.instruction": blank("instruction"), "row.text_sha": ~sha("tikz_code").eqNullSafe(F.col("tikz_sha256")),
            "row.image_sha": ~sha("png_image").eqNullSafe(F.col("image_sha256"))}


def export_report(rows: DataFrame, shards: DataFrame, listed: DataFrame, quick: bool = False) -> DataFrame:
    """Checks of an export: unique ids, rising indices, shard counts and digests against their list.

    ``rows``: exported rows with ``shard``; ``shards`` and ``listed``: ``shard, rows, logical_sha256`` found and recorded.
    """
    from tamarack.operators.checks import duplicates

    one = listed.select("shard", F.col("rows").alias("_rows"), F.col("logical_sha256").alias("_sha"))
    both = shards.join(one, "shard", "full_outer")
    spans = rows.groupBy("shard").agg(F.min("source_row_index").alias("lo"), F.max("source_row_index").alias("hi"))
    after = spans.select((F.col("shard") + 1).alias("shard"), F.col("hi").alias("before"))
    parts = [
        count_check("export.unique_ids", duplicates(rows, "id")), count_check("export.unique_indices", duplicates(rows, "source_row_index")), count_check("export.rising_indices", spans.join(after, "shard").where("lo <= before")),
        count_check("export.shards_listed", both.where("rows is null or _rows is null")), count_check("export.shard_rows", both.where("rows <> _rows")),
    ]
    if not quick:
        parts += [count_check("export.checksums_match", both.where("logical_sha256 <> _sha")), row_checks(rows, content_tests())]
    return report(*parts)


def unmet(gates: DataFrame, passed: DataFrame, needs: DataFrame) -> DataFrame:
    """``gate, missing`` prerequisites: ``needs(gate, prerequisite)`` that are not in ``passed(gate, identity)`` with the
    asked identity (``gates(gate, identity)``)."""
    asked = gates.join(needs, "gate").select("gate", F.col("prerequisite").alias("missing"), "identity")
    done = passed.select(F.col("gate").alias("missing"), "identity")
    return asked.join(done, ["missing", "identity"], "left_anti").select("gate", "missing")


def structural_diff(left, right, path: str = "") -> list[str]:
    """Paths at which two nested documents differ (driver side)."""
    if isinstance(left, dict) and isinstance(right, dict):
        return [p for k in sorted({*left, *right}, key=str) for p in structural_diff(left.get(k), right.get(k), f"{path}.{k}" if path else str(k))]
    return [] if left == right and type(left) is type(right) else [f"{path}: {left!r} != {right!r}"]


_TYPES = {"object": dict, "array": list, "string": str, "integer": int, "number": (int, float), "boolean": bool, "null": type(None)}


def _is(value, kind: str) -> bool:
    if isinstance(value, bool):
        return kind == "boolean"
    return isinstance(value, _TYPES[kind])


def schema_problems(value, schema: dict, path: str = "$") -> list[str]:
    """Violations of a JSON-Schema subset, each with its path (driver side; documents are small)."""
    kinds = schema.get("type")
    if kinds and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{path}: not {kinds}"]
    out = []
    if "const" in schema and value != schema["const"]:
        out.append(f"{path}: not {schema['const']!r}")
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{path}: not one of {schema['enum']!r}")
    if isinstance(value, str):
        out += [f"{path}: does not match"] if "pattern" in schema and not re.search(schema["pattern"], value) else []
        out += [f"{path}: too short"] if len(value) < schema.get("minLength", 0) else []
    if isinstance(value, int | float) and not isinstance(value, bool):
        out += [f"{path}: too small"] if value < schema.get("minimum", value) else []
        out += [f"{path}: too large"] if value > schema.get("maximum", value) else []
    if isinstance(value, list):
        out += [f"{path}: too few items"] if len(value) < schema.get("minItems", 0) else []
        out += [f"{path}: too many items"] if len(value) > schema.get("maxItems", len(value)) else []
        out += [p for i, v in enumerate(value) for p in schema_problems(v, schema.get("items", {}), f"{path}[{i}]")]
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}: missing {k}" for k in schema.get("required", []) if k not in value]
        more = schema.get("additionalProperties", True)
        for k, v in value.items():
            if k in known:
                out += schema_problems(v, known[k], f"{path}.{k}")
            elif more is False:
                out.append(f"{path}: unexpected {k}")
            elif isinstance(more, dict):
                out += schema_problems(v, more, f"{path}.{k}")
    return out
