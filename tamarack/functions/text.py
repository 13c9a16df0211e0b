"""Text expressions with Python's notions of white space, stripping and JSON escapes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as ``str.isspace`` has it, in a form that Java's regex and RE2 both read.
WS = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: The same characters.
WS_CHARACTERS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` names it inside lambdas."""
    return F.get(F.transform(F.array(value), body), 0)


def py_strip(c: Column | str) -> Column:
    """``str.strip()``: all white space goes from both ends (only the ends are looked at)."""
    return F.btrim(_col(c), F.lit(WS_CHARACTERS))


def sql_trim(c: Column | str) -> Column:
    """SQL ``TRIM``: only spaces go."""
    return F.trim(_col(c))


def words(c: Column | str) -> Column:
    """``str.split()``; null for null."""
    return F.filter(F.split(_col(c), f"{WS}+"), lambda w: w != "")


def squash(c: Column | str, null_as_empty: bool = True) -> Column:
    """Words joined by one space; null counts as empty unless told otherwise."""
    c = _col(c)
    return F.array_join(words(F.coalesce(c, F.lit("")) if null_as_empty else c), " ")


def word_count(c: Column | str) -> Column:
    return F.size(words(c))


def json_string(c: Column | str) -> Column:
    """A JSON string literal that escapes only what must be escaped, control characters in lower-case hex."""
    out = F.replace(F.replace(_col(c), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    short = {8: "\\b", 9: "\\t", 10: "\\n", 12: "\\f", 13: "\\r"}
    for i in range(32):
        out = F.replace(out, F.lit(chr(i)), F.lit(short.get(i, f"\\u{i:04x}")))
    return F.concat(F.lit('"'), out, F.lit('"'))


def human_bytes(c: Column | str) -> Column:
    """Bytes with one decimal in B, KiB, MiB, GiB or TiB."""
    v, units = _col(c).cast("double"), ["B", "KiB", "MiB", "GiB", "TiB"]
    out = None
    for i in reversed(range(len(units))):
        text = F.format_string(f"%.1f {units[i]}", v / float(1024**i))
        out = text if out is None else F.when(F.abs(v / float(1024**i)) < 1024, text).otherwise(out)
    return out


def shorten(c: Column | str, limit: int = 80) -> Column:
    """At most ``limit`` characters; a longer text ends in three dots."""
    c = _col(c)
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit - 3), F.lit("..."))).otherwise(c)


def wall_minutes(c: Column | str) -> Column:
    """Scheduler wall time (``M``, ``M:S``, ``H:M:S``, ``D-H``, ``D-H:M``, ``D-H:M:S``) in whole minutes, 1 at least;
    null where it is none of these."""
    c = F.trim(_col(c))
    ok = c.rlike(r"^(\d+-)?\d+(:\d+){0,2}$")
    days = F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(c, r"^(\d+)-", 1), F.lit("")), F.lit("999999999")).cast("bigint"), F.lit(0))
    parts = F.split(F.regexp_replace(c, r"^\d+-", ""), ":")
    at = lambda i: F.coalesce(F.get(parts, i).try_cast("bigint"), F.lit(0))
    n, dated = F.size(parts), c.contains("-")
    hours = F.when(dated | (n == 3), at(0)).otherwise(0)
    minutes = F.when(dated | (n == 3), at(1)).otherwise(at(0))
    seconds = F.when(dated | (n == 3), at(2)).when(n == 2, at(1)).otherwise(0)
    total = days * 1440 + hours * 60 + minutes + F.floor(seconds / 60)
    return F.when(ok, F.greatest(F.lit(1).cast("bigint"), total))


def after_reasoning(c: Column | str, mark: str = "</think>") -> tuple[Column, Column]:
    """``(reasoning, answer)`` split at the first ``mark``; without one, all is the answer."""
    c = _col(c)
    at = F.locate(mark, c)
    answer = F.when(at > 0, c.substr(at + len(mark), F.length(c))).otherwise(c)
    return F.when(at > 0, c.substr(F.lit(1), at - 1)).otherwise(F.lit("")), answer


def package_name(c: Column | str) -> Column:
    """Lower case, dashes for underscores and dots."""
    return F.translate(F.lower(F.trim(_col(c))), "_.", "--")


def log_error(c: Column | str) -> Column:
    """``struct(line, message)`` of the first ``file:line: message``, else of the first ``! message``."""
    c, located, bang = _col(c), r"(?m)^(.+?):(\d+): (.*)$", r"(?m)^! (.*)$"
    line = F.regexp_extract(c, located, 2)
    found = F.regexp_instr(c, F.lit(located)) > 0
    text = F.when(found, F.regexp_extract(c, located, 3)).when(F.regexp_instr(c, F.lit(bang)) > 0, F.regexp_extract(c, bang, 1))
    return F.struct(F.when(found, line.try_cast("int")).alias("line"), F.substring(py_strip(text), 1, 300).alias("message"))


def log_tail(c: Column | str, lines: int = 40, chars: int = 4000) -> Column:
    """The last lines, and of these the last characters."""
    parts = F.split(py_strip(c), "\n")
    return F.right(F.array_join(F.slice(parts, F.greatest(F.lit(1), F.size(parts) - lines + 1), lines), "\n"), F.lit(chars))


def positive_list(c: Column | str) -> Column:
    """A comma-separated list of distinct positive integers; null if it is anything else."""
    parts = F.transform(F.split(_col(c), ","), lambda x: F.trim(x).try_cast("int"))
    ok = F.forall(parts, lambda x: F.coalesce(x > 0, F.lit(False))) & (F.size(F.array_distinct(parts)) == F.size(parts))
    return F.when(ok, parts)


def scalar_text(c: Column | str) -> Column:
    """Any scalar as text; null stays null."""
    return _col(c).cast("string")
