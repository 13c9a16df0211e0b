"""Named checks: each is a query that counts violations; a report is their union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_check(name: str, violations: DataFrame, level: str = "fail") -> DataFrame:
    """One row ``check, violations, status``; any violation gives ``level``."""
    return violations.agg(F.count("*").alias("violations")).select(
        F.lit(name).alias("check"), "violations", F.when(F.col("violations") == 0, "pass").otherwise(level).alias("status")
    )


def row_checks(df: DataFrame, tests: dict[str, Column], level: str = "fail") -> DataFrame:
    """Many per-row tests in one pass: true is a violation."""
    one = df.agg(*[F.count_if(F.coalesce(t, F.lit(False))).alias(f"c{i}") for i, t in enumerate(tests.values())])
    pairs = F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"c{i}").alias("violations")) for i, n in enumerate(tests)])
    out = one.select(F.explode(pairs).alias("p")).select("p.*")
    return out.withColumn("status", F.when(F.col("violations") == 0, "pass").otherwise(level))


def report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def roll_up(checks: DataFrame) -> DataFrame:
    """Passes, failures, warnings and the overall status."""
    n = checks.agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("pass", "fail", "warn")])
    return n.withColumn("overall", F.when(F.col("fail") > 0, "fail").otherwise("pass"))


def duplicates(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys on one side only: ``key, side``."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("left")).union(b.join(a, key, "left_anti").withColumn("side", F.lit("right")))


def matched(left: DataFrame, right: DataFrame, key: str, same: list[str]) -> DataFrame:
    """Rows of ``left`` that have no partner, or one that differs in any of ``same``."""
    other = right.select(key, *[F.col(c).alias(f"_{c}") for c in same], F.lit(True).alias("_there"))
    joined = left.join(other, key, "left")
    differ = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in same], F.lit(False))
    problem = F.when(F.col("_there").isNull(), "missing").when(differ, "different")
    return joined.withColumn("problem", problem).where("problem is not null").select(*left.columns, "problem")


def emission(wanted: DataFrame, emitted: DataFrame, forbidden: DataFrame, key: str) -> DataFrame:
    """Ids that should have been emitted and weren't, were and shouldn't, or are forbidden: ``key, problem``."""
    miss = wanted.select(key).join(emitted.select(key), key, "left_anti").withColumn("problem", F.lit("missing"))
    extra = emitted.select(key).join(wanted.select(key), key, "left_anti").withColumn("problem", F.lit("extra"))
    bad = emitted.select(key).join(forbidden.select(key), key, "left_semi").withColumn("problem", F.lit("forbidden"))
    return miss.union(extra).union(bad)


def key_diff(left: DataFrame, right: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """``(key, value)`` tables: keys whose values differ or are on one side only."""
    a = left.where(~F.col("key").isin(*ignore)) if ignore else left
    b = right.where(~F.col("key").isin(*ignore)) if ignore else right
    both = a.select("key", F.col("value").alias("left_value")).join(b.select("key", F.col("value").alias("right_value")), "key", "full_outer")
    return both.where(~F.col("left_value").eqNullSafe(F.col("right_value")))


def manifest_tests(index: str = "source_row_index") -> dict[str, Column]:
    """Per-row checks of a frozen manifest."""
    from tamarack.functions.ids import sha

    valid = F.col("status") == "valid"
    return {
        "manifest.known_status": ~F.coalesce(F.col("status").isin("valid", "rejected"), F.lit(False)), "manifest.text_sha": ~sha("text").eqNullSafe(F.col("text_sha256")),
        "manifest.image_present": valid & F.coalesce(F.octet_length("image") == 0, F.lit(True)), "manifest.rejection_reason": ~valid & F.col("rejection_reason").isNull(),
        "manifest.no_reason_when_valid": valid & F.col("rejection_reason").isNotNull(), "manifest.index_not_negative": F.col(index) < 0,
    }


def manifest_report(rows: DataFrame, right_id: Column, index: str = "source_row_index") -> DataFrame:
    """Checks of a frozen manifest: those of each row, the id that ``right_id`` computes anew, unique ids and contiguous indices."""
    have = rows.select(F.col(index).alias("_i")).distinct()
    last = have.agg(F.max("_i").alias("_last"))
    gaps = have.join(have.select((F.col("_i") - 1).alias("_i")), "_i", "left_anti").join(last, F.col("_i") < F.col("_last"))  # one row on the right
    each = row_checks(rows, manifest_tests(index) | {"manifest.row_id": ~F.col("row_id").eqNullSafe(right_id)})
    return report(each, count_check("manifest.unique_ids", duplicates(rows, "row_id")), count_check("manifest.contiguous", gaps))


def run_checks(checks: list[tuple[str, tuple[str, ...], object]], skip: tuple[str, ...] = ()) -> list[dict]:
    """Driver-side checks ``(name, prerequisites, function)`` in order: a check whose prerequisite did not pass is skipped,
    an exception fails it."""
    done: dict[str, str] = {}
    out = []
    for name, needs, test in checks:
        detail = ""
        if name in skip:
            status = "skipped"
        elif lacking := [n for n in needs if done.get(n) != "pass"]:
            status, detail = "skipped", f"needs {', '.join(lacking)}"
        else:
            try:
                result = test()
                status, detail = ("pass", "") if result in (None, True) else ("fail", str(result))
            except Exception as e:
                status, detail = "fail", f"{type(e).__name__}: {e}"
        done[name] = status
        out.append({"check": name, "status": status, "detail": detail})
    return out


def all_true(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: which booleans failed anywhere, and whether all hold."""
    bad = F.array_compact(F.array(*[F.when(~F.every(F.coalesce(c, F.lit(False))), c) for c in columns]))
    return df.agg(bad.alias("failed")).withColumn("passed", F.size("failed") == 0)
