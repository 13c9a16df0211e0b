"""Readers for the text formats around a corpus: result documents, JSONL, CSV, job histories, pin files, images.

Schemas are always given. A malformed document is kept as a row with its text in ``_corrupt_record``.
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KINDS = {"string": T.StringType(), "int": T.IntegerType(), "boolean": T.BooleanType()}


def _struct(columns: str) -> T.StructType:
    return T.StructType([T.StructField(n, _KINDS[k]) for n, k in (c.split(" ") for c in columns.split(", "))])


RESULT = _struct(
    "row_id string, source_row_index int, worker string, max_tokens int, ok boolean, instruction string, finish_reason string, prompt_tokens int, completion_tokens int, "
    "error_category string, error_detail string, model_revision string, prompt_sha256 string, config_hash string, image_sha256 string, tikz_sha256 string, text string"
)
DOCUMENT = _struct("run_id string, worker string, worker_index int, generation int, batch_index int").add("results", T.ArrayType(RESULT)).add("_corrupt_record", T.StringType())


def result_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per result document with its file name and content digest."""
    rows = spark.read.schema(DOCUMENT).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    return rows.select("*", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("file_path"))


def explode_results(documents: DataFrame) -> DataFrame:
    """One row per result; documents that could not be parsed are left out (see :func:`malformed`)."""
    good = documents.where("_corrupt_record is null and results is not null")
    return good.select("run_id", F.col("worker").alias("document_worker"), "generation", "batch_index", F.explode("results").alias("r")).select("run_id", "document_worker", "generation", "batch_index", "r.*")


def malformed(documents: DataFrame) -> DataFrame:
    """Documents for quarantine."""
    return documents.where("_corrupt_record is not null or results is null")


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank lines are skipped, bad lines keep their text in ``_corrupt_record``."""
    return spark.read.schema(f"{schema}, _corrupt_record string").json(path)


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def job_history(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-delimited job rows; those with fewer than nine fields go, blank seconds are 0."""
    parts = F.split("value", r"\|")
    rows = spark.read.text(path).select(parts.alias("p")).where(F.size("p") >= 9)
    return rows.select(F.col("p")[0].alias("job_id"), F.col("p")[1].alias("name"), F.col("p")[2].alias("state"), F.coalesce(F.trim(F.col("p")[8]).try_cast("bigint"), F.lit(0)).alias("seconds"), "p")


def pins(spark: SparkSession, path: str) -> DataFrame:
    """``name, version`` of a ``name==version`` file; comments and blanks are skipped, duplicates are an error."""
    from tamarack.functions.text import package_name

    line = F.trim(F.regexp_replace("value", r"#.*$", ""))
    rows = spark.read.text(path).select(line.alias("l")).where("l <> ''")
    named = rows.select(package_name(F.substring_index("l", "==", 1)).alias("name"), F.trim(F.regexp_extract("l", r"==\s*([^;\s]+)", 1)).alias("version"))
    twice = named.groupBy("name").agg(F.count("*").alias("n"), F.min("version").alias("version"))
    return twice.select("name", F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("duplicate pin "), F.col("name"))).cast("string")).otherwise(F.col("version")).alias("version"))


def binaries(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path, content`` of files."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")


def rows_by_id(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of an id set; an id that isn't there is an error when read."""
    found = ids.select(key).distinct().join(df.withColumn("_there", F.lit(True)), key, "left")
    lost = F.when(F.col("_there").isNull(), F.raise_error(F.concat(F.lit("missing id "), F.col(key).cast("string"))).cast("boolean")).otherwise(True)
    return found.withColumn("_there", lost).where("_there").drop("_there")


def json_document(path: str, what: str) -> dict:
    """A small JSON document on the driver, with an error that says which."""
    try:
        found = json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError) as e:
        raise ValueError(f"cannot read {what} {path}: {e}") from e
    if not isinstance(found, dict):
        raise ValueError(f"{what} {path} is not an object")
    return found


def merged(base: dict, over: dict) -> dict:
    """Maps merge, everything else is replaced."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def yaml_document(path: str, seen: tuple[str, ...] = ()) -> dict:
    """A YAML document with its ``inherits`` chain merged under it; a cycle is an error."""
    import yaml

    here = str(Path(path).resolve())
    if here in seen:
        raise ValueError(f"configuration inherits itself: {here}")
    found = yaml.safe_load(Path(here).read_text(encoding="utf-8")) or {}
    parent = found.pop("inherits", None)
    return merged(yaml_document(str(Path(here).parent / parent), (*seen, here)), found) if parent else found


def prompt(folder: str, version: str, pins: dict[str, str]) -> str:
    """A registered prompt, refused unless its normalised text has the pinned digest."""
    import hashlib

    if version not in pins:
        raise ValueError(f"unknown prompt version {version!r}")
    text = " ".join(Path(folder, f"{version}.txt").read_text(encoding="utf-8").split())
    if hashlib.sha256(text.encode()).hexdigest() != pins[version]:
        raise ValueError(f"prompt {version!r} differs from its pin")
    return text


def image_bytes(spark: SparkSession, df: DataFrame, column: str, folder: str | None = None) -> DataFrame:
    """Append ``image`` from text that is base64 or, where it isn't, the name of a file under ``folder``."""
    decoded = df.withColumn("image", F.try_to_binary(F.col(column), F.lit("base64")))
    if folder is None:
        return decoded
    held = binaries(spark, folder).select(F.element_at(F.split("path", "/"), -1).alias("_name"), F.col("content").alias("_content"))
    joined = decoded.join(held, F.col("image").isNull() & (F.element_at(F.split(column, "/"), -1) == F.col("_name")), "left")
    return joined.withColumn("image", F.coalesce("image", "_content")).drop("_name", "_content")
