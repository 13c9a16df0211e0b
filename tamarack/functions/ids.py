"""Content-derived identities and digests."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.functions.text import json_string

SEPARATOR = "\x1f"


def sha(c: Column | str) -> Column:
    """SHA-256 in hex of text (UTF-8) or bytes."""
    return F.sha2(c, 256)


def stable_row_id(version: str, dataset: str, revision: str, split: str, index: Column, text_sha: Column, image_sha: Column) -> Column:
    """32 hex digits that name a source row by place and content."""
    parts = [F.lit(version), F.lit(dataset), F.lit(revision), F.lit(split), index.cast("string"), text_sha, image_sha]
    return F.substring(sha(F.concat_ws(SEPARATOR, *parts)), 1, 32)


def logical_row(**fields: Column) -> Column:
    """One JSON object per row, keys sorted, ``", "`` and ``": "`` between; strings are escaped, numbers are not."""
    parts, lead = [], "{"
    for name in sorted(fields):
        parts += [F.lit(f'{lead}"{name}": '), fields[name]]
        lead = ", "
    return F.concat(*parts, F.lit("}\n"))


def quoted(c: Column) -> Column:
    return json_string(c)


def list_digest(sorted_ids: Column) -> Column:
    """SHA-256 of the JSON text of a list of plain strings."""
    inner = F.when(F.size(sorted_ids) == 0, F.lit("[]")).otherwise(F.concat(F.lit('["'), F.array_join(sorted_ids, '", "'), F.lit('"]')))
    return sha(inner)


def group_id(version: str, sorted_members: Column) -> Column:
    """32 hex digits that name a set of rows."""
    return F.substring(sha(F.array_join(F.concat(F.array(F.lit(version)), sorted_members), SEPARATOR)), 1, 32)


def canonical_digest(value) -> str:
    """SHA-256 of a document's JSON with sorted keys (driver side)."""
    return hashlib.sha256(json.dumps(value, sort_keys=True).encode()).hexdigest()


def tree_digest(files: DataFrame) -> DataFrame:
    """``(path, content)`` -> one digest of the sorted path-to-digest map. For source trees: few files."""
    pair = F.concat(F.lit('"'), F.col("path"), F.lit('": "'), sha("content"), F.lit('"'))
    lines = F.array_sort(F.collect_list(F.struct("path", pair.alias("pair"))))
    return files.agg(sha(F.concat(F.lit("{"), F.array_join(F.transform(lines, lambda x: x["pair"]), ", "), F.lit("}"))).alias("digest"))
