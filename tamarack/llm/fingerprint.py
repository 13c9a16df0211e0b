"""Order-sensitive document fingerprints: Order MinHash with built-in functions only (operator 8, native).

A text's k-mers are runs of ``k`` words (its words are runs of bytes other than white space; texts of fewer words are
one k-mer). Each k-mer is numbered by its occurrence, so repeats stay distinct, and hashed once; the top bits of the
hash deal it to one of ``bins`` sketches, the one-permutation form of many hash functions. From each bin the ``take``
smallest are selected, put back into text order and hashed as a tuple. Moving passages changes tuples that a plain
MinHash would keep, so agreement of two fingerprints follows edit distance rather than overlap alone.

Everything is a chain of array expressions over one row: hashes and positions are packed into longs and sorted as
primitive arrays, so a text costs O(n log n) whatever it repeats. The last 22 bits hold positions; longer texts have
their positions scaled down to that range, which keeps their order up to ties.

Null and empty texts have the fingerprint of no k-mers (``bins`` empty cells). Equal texts have equal fingerprints.
Likeness is the share of equal cells among the cells that either text has, and 1 for two texts without any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamarack.operators import ordering
from tamarack.storage import durable

POSITION = 22
KEY = 63 - POSITION
#: Text bytes in a range of neighbouring rows.
RANGE_BYTES = 64_000_000


def _runs(keys: Column) -> Column:
    """Where each run of equal values of a sorted array begins (0-based)."""
    return F.filter(F.sequence(F.lit(0), F.size(keys) - 1), lambda j: (j == 0) | (F.get(keys, j) != F.get(keys, j - 1)))


def sketch(df: DataFrame, text: str, name: str, k: int = 3, bins: int = 32, take: int = 2) -> DataFrame:
    """Append ``name array<string>``: one cell per bin, empty where no k-mer fell."""
    bits = bins.bit_length() - 1
    assert 1 << bits == bins, "bins is a power of two"
    w, h, s, o, g, b = (f"_{name}_{x}" for x in ("w", "h", "s", "o", "g", "b"))
    some = lambda c, x: F.when(F.size(c) > 0, x).otherwise(F.array().cast("array<bigint>"))
    mask, low = (1 << KEY) - 1, (1 << POSITION) - 1
    parts = F.split(F.coalesce(F.col(text), F.lit("")), "[\\x20\\x09-\\x0D]+")
    out = df.withColumn(w, F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.xxhash64(x)))
    # One long per k-mer: the top of its hash, then its position.
    n = F.size(w)
    count = F.when(n == 0, 0).otherwise(F.greatest(F.lit(1), n - (k - 1)))
    scale = F.greatest(F.lit(0), F.length(F.bin(n.cast("bigint"))) - POSITION)
    gram = lambda x, i: F.xxhash64(x, *[F.get(F.col(w), i + j) for j in range(1, k)])  # noqa: E731  missing words of short texts are null
    packed = lambda x, i: F.shiftleft(F.shiftrightunsigned(gram(x, i), 64 - KEY), POSITION).bitwiseOR(F.call_function("shiftright", i, scale).cast("long"))
    hashed = F.transform(F.slice(F.col(w), F.lit(1), count), packed)
    out = out.withColumn(h, F.sort_array(F.when(count > 0, hashed).otherwise(F.array().cast("array<bigint>"))))
    # Number occurrences: equal hashes are neighbours now.
    out = out.withColumn(s, some(h, F.transform(h, lambda x: F.shiftright(x, POSITION))))
    out = out.withColumn(o, F.when(F.size(h) > 0, _runs(F.col(s))).otherwise(F.array().cast("array<int>")))
    number = F.flatten(F.transform(o, lambda at, j: F.sequence(F.lit(1), F.coalesce(F.get(F.col(o), j + 1), F.size(h)) - at)))
    numbered = F.zip_with(
        F.col(h),
        number,
        lambda x, occ: F.shiftleft(F.shiftrightunsigned(F.xxhash64(F.shiftright(x, POSITION), occ), 64 - KEY), POSITION).bitwiseOR(x.bitwiseAND(F.lit(low))),
    )
    out = out.withColumn(g, F.sort_array(numbered))
    # Bins are runs of equal top bits; the first `take` of each run are its smallest.
    out = out.withColumn(s, some(g, F.transform(g, lambda x: F.shiftright(x, 63 - bits))))
    out = out.withColumn(b, F.when(F.size(g) > 0, _runs(F.col(s))).otherwise(F.array().cast("array<int>")))

    def cell(at: Column, j: Column) -> Column:
        stop = F.coalesce(F.get(F.col(b), j + 1), F.size(g))
        least = F.slice(F.col(g), at + 1, F.least(F.lit(take), stop - at))
        turned = lambda x: F.shiftleft(x.bitwiseAND(F.lit(low)), KEY - 1).bitwiseOR(F.shiftrightunsigned(x, POSITION + 1).bitwiseAND(F.lit(mask >> 1)))
        ordered = F.transform(F.sort_array(F.transform(least, turned)), lambda x: x.bitwiseAND(F.lit(mask >> 1)))
        return F.struct(F.get(F.col(s), at).alias("bin"), F.substring(F.hex(F.xxhash64(ordered)), -8, 8).alias("cell"))

    # A one-element array binds the map, so that it is built once and not for every bin.
    table = F.array(F.map_from_entries(F.transform(b, cell)))
    cells = F.flatten(F.transform(table, lambda m: F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.coalesce(F.element_at(m, i.cast("bigint")), F.lit("")))))
    return out.withColumn(name, cells).drop(w, h, s, o, g, b)


def likeness(a: str, b: str) -> Column:
    """Share of equal cells among the cells that either fingerprint has."""
    x, y = F.col(a), F.col(b)
    both = F.zip_with(x, y, lambda p, q: F.struct(((p != "") | (q != "")).cast("int").alias("any"), ((p == q) & (p != "")).cast("int").alias("same")))
    total = lambda f: F.aggregate(both, F.lit(0), lambda s, c: s + c[f])
    return F.when(x.isNull() | y.isNull(), F.lit(0.0)).when(total("any") == 0, 1.0).otherwise(total("same") / total("any"))


def _apart(spark: SparkSession, n: int) -> list[int]:
    """A number for each of ``n`` ranges, such that a repartitioning by them puts each range into a partition of its own."""
    hashed = spark.range(40 * n).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("at")).agg(F.min("id").alias("id"))
    met = {r.at: r.id for r in hashed.collect()}  # n rows
    return [met.get(i, 40 * n + i) for i in range(n)]  # one that none was found for may share a partition


def with_next(docs: DataFrame, order: str, columns: list[str], parts: int, derive=lambda df: df) -> DataFrame:
    """``derive(docs)`` with ``next_<c>`` of the row that follows in ascending ``order`` (the last row's is the first row's).

    Rows are dealt to ``parts`` ranges of ``order`` by approximate quantiles, so each range is one sorted partition and
    texts move once. Only the first row of each range is looked up across ranges; these few are found by a map-side minimum
    before anything is derived. Rows of equal ``order`` follow each other by a hash of their other columns.
    """
    ranged = ordering.ranged(docs, F.col(order), parts)
    ranged = ranged.withColumn("_tie", F.xxhash64(*[c for c in docs.columns if c != order]))
    first_rows = ranged.groupBy("_range").agg(F.min_by(F.struct(*docs.columns), F.struct(F.col(order), F.col("_tie"))).alias("_row")).select("_range", "_row.*")
    heads = durable(derive(first_rows).select("_range", F.struct(*columns).alias("_head")), parts, 64)  # one row per range
    place = F.get(F.array(*map(F.lit, _apart(docs.sparkSession, parts))), F.col("_range")).cast("bigint")
    moved = derive(ranged.withColumn("_place", place)).repartition(parts, "_place")
    w = Window.partitionBy("_place").orderBy(F.col(order).asc_nulls_first(), "_tie")
    placed = moved.withColumns({f"_next_{c}": F.lead(F.struct(c)).over(w) for c in columns})
    across = Window.orderBy("_range")
    first = F.first("_head").over(across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    follow = heads.select("_range", F.coalesce(F.lead("_head").over(across), first).alias("_head"))
    out = placed.join(follow, "_range")
    kept = [c for c in moved.columns if c not in ("_range", "_tie", "_place")]
    return out.select(*kept, *[F.coalesce(F.col(f"_next_{c}"), F.struct(F.col("_head")[c].alias(c)))[c].alias(f"next_{c}") for c in columns])
