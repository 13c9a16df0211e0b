"""The audit of a run: named checks over its manifest, ledger, attempts and export, each a count of violations."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.operators.checks import count_check, duplicates, report, row_checks, set_difference
from tamarack.operators.policy import instruction_policy


@dataclass(frozen=True)
class Run:
    """What an audit reads.

    ``manifest``: row_id, source_row_index, status, image_sha256, tikz_sha256; ``rows``: row_id, source_row_index, state,
    instruction, reason; ``attempts``: row_id; ``exported``: id, source_row_index, image_sha256, tikz_sha256;
    ``rejected``: id; ``shards`` and ``listed``: shard, rows, logical_sha256, found and recorded. ``facts`` has for each
    check of ``FACTS`` what is recorded and what was found; the slice is ``limit`` rows from ``start``.
    """

    manifest: DataFrame
    rows: DataFrame
    attempts: DataFrame
    exported: DataFrame
    rejected: DataFrame
    shards: DataFrame
    listed: DataFrame
    start: int
    limit: int
    facts: dict[str, tuple] = field(default_factory=dict)


#: The checks that compare one recorded value with one found, and the level of a mismatch.
FACTS = {
    "manifest.verified": "fail", "run.record_present": "fail", "run.prompt_matches_registry": "fail", "run.validation_rules_match": "fail", "ledger.present": "fail",
    "ledger.identity_matches_run": "fail", "ledger.manifest_matches_run": "fail", "ledger.prompt_hash_consistent": "fail", "runtime.no_quarantined_results": "warn", "export.meta_present": "fail",
    "export.companion_checksums_match": "fail", "export.identity_matches_run": "fail",
}


def _facts(run: Run) -> DataFrame:
    """A row per fact; one that isn't given is a violation."""
    spark = run.manifest.sparkSession
    rows = [(name, int(name not in run.facts or run.facts[name][0] != run.facts[name][1]), level) for name, level in FACTS.items()]
    made = spark.createDataFrame(rows, "check string, violations bigint, level string")
    return made.select("check", "violations", F.when(F.col("violations") == 0, "pass").otherwise(F.col("level")).alias("status"))


def _apart(name: str, left: DataFrame, right: DataFrame) -> DataFrame:
    """How many rows the two tables are apart."""
    n = left.agg(F.count("*").alias("a")).crossJoin(right.agg(F.count("*").alias("b"))).select(F.abs(F.col("a") - F.col("b")).alias("violations"))  # one row each
    return n.select(F.lit(name).alias("check"), "violations", F.when(F.col("violations") == 0, "pass").otherwise("fail").alias("status"))


def audit(run: Run) -> DataFrame:
    """``check, violations, status`` of all checks: ``pass``, ``fail`` or ``warn``."""
    m, r, x, state = run.manifest, run.rows, run.exported, F.col("state")
    complete, rejected = r.where(state == "complete"), r.where(state == "rejected")
    blank = lambda c: F.col(c).isNull() | (F.trim(c) == "")
    entry = m.select("row_id", "status", F.col("source_row_index").alias("_index"), F.col("image_sha256").alias("_image"), F.col("tikz_sha256").alias("_tikz"), F.lit(True).alias("_listed"))
    both = r.withColumn("_there", F.lit(True)).join(entry, "row_id", "full_outer")
    states = r.groupBy("row_id").agg(F.min("state").alias("state"))
    out = x.join(states.withColumnRenamed("row_id", "id"), "id", "left").join(entry.withColumnRenamed("row_id", "id"), "id", "left")
    same = F.col("_listed") & F.col("source_row_index").eqNullSafe(F.col("_index")) & F.col("image_sha256").eqNullSafe(F.col("_image")) & F.col("tikz_sha256").eqNullSafe(F.col("_tikz"))
    listed = run.listed.select("shard", F.col("logical_sha256").alias("_sha"))
    spark = m.sparkSession
    return report(
        _facts(run),
        _apart("manifest.exact_row_count", m, spark.range(run.limit)),
        count_check("manifest.unique_stable_ids", duplicates(m, "row_id")),
        _apart("ledger.row_count_matches_manifest", r, m),
        count_check("ledger.no_duplicate_ids", duplicates(r, "row_id")),
        row_checks(both, {
            "ledger.row_set_matches_manifest": F.col("_there").isNull() | F.col("_listed").isNull(), "ledger.manifest_rejections_preserved": (F.col("status") == "rejected") & ~state.eqNullSafe("rejected"),
            "ledger.index_pairs_match_manifest": F.col("_there") & ~F.col("source_row_index").eqNullSafe(F.col("_index")),
        }),
        row_checks(r, {
            "ledger.no_index_outside_slice": ~F.col("source_row_index").between(run.start, run.start + run.limit - 1), "ledger.complete_rows_have_instructions": (state == "complete") & blank("instruction"),
            "ledger.rejected_rows_have_reasons": (state == "rejected") & blank("reason"), "ledger.accepted_instructions_valid": (state == "complete") & ~instruction_policy("instruction")["ok"],
        }),
        count_check("ledger.instructions_attached_to_one_row", duplicates(complete.where("instruction is not null"), "instruction"), "warn"),
        count_check("ledger.attempts_reference_known_rows", run.attempts.join(r.select("row_id"), "row_id", "left_anti")),
        row_checks(out, {"export.only_complete_rows": ~state.eqNullSafe("complete"), "export.rejected_rows_excluded": state == "rejected", "export.rows_map_to_manifest": ~F.coalesce(same, F.lit(False))}),
        _apart("export.row_count_matches_ledger", x, complete),
        count_check("export.unique_ids", duplicates(x, "id")),
        count_check("export.checksums_match", run.shards.join(listed, "shard", "left").where(~F.col("logical_sha256").eqNullSafe(F.col("_sha")))),
        _apart("export.shard_count_matches_meta", run.shards, run.listed),
        count_check("export.rejected_matches_ledger", set_difference(run.rejected, rejected.select(F.col("row_id").alias("id")), "id")),
        row_checks(x.limit(1).agg(F.count("*").alias("n")), {"export.checked": F.col("n") == 0}, "warn"),
    )
