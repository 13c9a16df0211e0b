"""K-d tree sharding: recursive splits at weighted medians along the widest metadata dimension (operator 9).

Law ``bytes``: leaves hold near equal bytes. Every row has one coordinate per metadata dimension, scaled to [0, 1]. For a
categorical column it is the share of bytes of all more frequent values, so a frequent value is far from the next and rare
ones lie close; only the ``NAMED`` most frequent values are placed so, the others share what is left by a hash. For the
size it is the logarithm between the smallest and the largest. A node for m shards is split in the proportion of floor(m/2)
to the rest, along the dimension in which its rows lie widest apart. The weighted median is found without sorting: sums of
bytes in equal bins of the node's keys, then in bins of the bin that holds the cut, until that bin weighs under
``tolerance`` of a shard or can't be cut. Keys end in a hash of the text and one of the row, so equal texts stay
neighbours, and a value or a group of copies that holds a third of all bytes is still cut where the median falls.

Rows are never sorted, shuffled or rewritten for the tree: each pass adds up bytes by node and bin, and the driver gets
at most ``BINS`` sums (or 16 a node, if there are more than 4096 nodes). The tree is an array of dimensions and one of cuts, and a row walks it
by looking its node up in them.

Null texts weigh the overhead alone. Null metadata are a value of their own. Repeated rows are separate rows; rows that
are equal in every column share a key and so a shard. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.operators.slots import dense_slots
from tamarack.storage import durable, release

COORD, TEXT, ROW = 15, 24, 24
#: Bins of all open nodes together in a pass.
BINS = 1 << 16
#: Values of a categorical column that are placed by frequency.
NAMED = 4096


def _by_frequency(docs: DataFrame, column: str, size: Column) -> tuple[DataFrame, float]:
    """``value, place``: the bytes of all more frequent values as a share of all, for the most frequent values; and the
    share of these together."""
    sums = docs.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("\x00")).alias("value")).agg(F.sum(size).alias("w"))
    first = sums.orderBy(F.desc("w"), "value").limit(NAMED).collect()  # at most NAMED rows
    total = sums.agg(F.sum("w")).first()[0] or 1
    rows, before = [], 0
    for r in first:
        rows.append((r.value, before / total))
        before += r.w
    return docs.sparkSession.createDataFrame(rows, "value string, place double"), before / total


def weigh(docs: DataFrame, categories: list[str], overhead: int = 8, text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32`` and one sortable key per dimension."""
    body = F.coalesce(F.col(text), F.lit(""))
    tail = F.shiftleft(F.shiftrightunsigned(F.xxhash64(text), 64 - TEXT), ROW).bitwiseOR(F.shiftrightunsigned(F.xxhash64("doc_id", text), 64 - ROW))
    size = F.octet_length(body).cast("long") + overhead
    top = (1 << COORD) - 1
    low, high = docs.agg(F.min(F.log2(size)), F.max(F.log2(size))).first()
    rows = docs.select("doc_id", size.alias("size"), F.crc32(body).alias("text_crc32"), tail.alias("_tail"), *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")).alias(f"v_{c}") for c in categories])
    for c in categories:
        places, known = _by_frequency(docs, c, size)
        rows = rows.join(F.broadcast(places.withColumnsRenamed({"value": f"v_{c}", "place": f"p_{c}"})), f"v_{c}", "left")  # at most NAMED rows
        other = known + (1 - known) * F.shiftrightunsigned(F.xxhash64(f"v_{c}"), 32) / float(1 << 32)
        rows = rows.withColumn(f"p_{c}", F.coalesce(f"p_{c}", other))
    places = {c: F.col(f"p_{c}") for c in categories} | {"size": (F.log2("size") - (low or 0)) / max((high or 0) - (low or 0), 1e-9)}
    keys = [F.shiftleft(F.floor(v * top).cast("long"), TEXT + ROW).bitwiseOR(F.col("_tail")).alias(f"k_{n}") for n, v in places.items()]
    return rows.select("doc_id", "size", "text_crc32", *keys)


@dataclass
class Node:
    """A node of the heap: its shards are ``first`` and ``m - 1`` more; a split one has the dimension and the cut."""

    first: int
    m: int
    d: int = 0
    cut: int | None = None


def _array(values: list[int | None], kind: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def _walk(nodes: dict[int, Node], keys: list[str], depth: int) -> Column:
    """A row's node, as deep as the tree goes."""
    split = [nodes[i] if i in nodes and nodes[i].cut is not None else None for i in range(max(nodes) + 1)]
    dims, cuts = _array([n and n.d for n in split], "int"), _array([n and n.cut for n in split], "bigint")
    key = F.array(*keys)

    def step(at: Column, _: Column) -> Column:
        cut = F.get(cuts, at)
        return F.when(cut.isNull(), at).otherwise(2 * at + 1 + (F.get(key, F.get(dims, at)) >= cut).cast("int"))

    return F.aggregate(F.array(*[F.lit(0)] * depth), F.lit(0), step) if depth else F.lit(0)


def _cuts(rows: DataFrame, keys: list[str], open_: dict[int, tuple], tolerance: float) -> dict[int, int]:
    """The cut of each open node. ``open_``: by node, its dimension, the keys' range, and the weights wanted and to be near."""
    found: dict[int, int] = {}
    while open_:
        fan = max(16, BINS // len(open_))
        asked = [(n, d, lo, hi, max(1, -(-(hi - lo) // fan)), want, close) for n, (d, lo, hi, want, close) in open_.items()]
        of = {x[0]: x for x in asked}
        d, lo, hi, width = (F.get(_array([of[n][i] if n in of else None for n in range(max(of) + 1)], kind), F.col("node")) for i, kind in ((1, "int"), (2, "bigint"), (3, "bigint"), (4, "bigint")))
        near = rows.select("node", "size", F.get(F.array(*keys), d).alias("k"), lo.alias("lo"), hi.alias("hi"), width.alias("width")).where("k >= lo and k < hi")
        bins: dict[int, list[tuple[int, int]]] = {}
        for r in near.groupBy("node", F.expr("(k - lo) div width").alias("b")).agg(F.sum("size").alias("here")).collect():  # at most BINS rows, or 16 a node
            bins.setdefault(r.node, []).append((r.b, r.here))
        left = {}
        for n, d, lo, _, width, want, close in asked:
            total = 0
            for b, here in sorted(bins[n]):
                total += here
                if total >= want:
                    break
            begin, prior = lo + b * width, total - here
            if width == 1 or here <= close:
                found[n] = begin if want - prior < total - want else begin + width
            else:
                left[n] = (d, begin, begin + width, want - prior, close)
        open_ = left
    return found


def kd_tree(rows: DataFrame, shards: int, tolerance: float = 0.0005) -> DataFrame:
    """``rows`` (which must give the same rows each time they are read) with ``shard``."""
    keys, top = [c for c in rows.columns if c.startswith("k_")], TEXT + ROW
    nodes, depth = {0: Node(0, shards)}, 0
    while any(n.m > 1 and n.cut is None for n in nodes.values()):
        at = rows.withColumn("node", _walk(nodes, keys, depth))
        stats = at.groupBy("node").agg(F.sum("size").cast("double").alias("w"), *[f(k).alias(f"{f.__name__}_{k}") for k in keys for f in (F.min, F.max)]).collect()  # a row per node
        open_ = {}
        for r in stats:
            n = nodes[r.node]
            if n.m > 1:
                spans = [(r[f"max_{k}"] >> top) - (r[f"min_{k}"] >> top) for k in keys]
                n.d = spans.index(max(spans))
                open_[r.node] = (n.d, r[f"min_{keys[n.d]}"], r[f"max_{keys[n.d]}"] + 1, r.w * (n.m // 2) / n.m, r.w / n.m * tolerance)
        cuts = _cuts(at, keys, open_, tolerance)
        for i, n in [(i, n) for i, n in nodes.items() if n.m > 1 and n.cut is None]:
            n.cut, half = cuts.get(i, 0), n.m // 2  # no rows: any cut
            nodes |= {2 * i + 1: Node(n.first, half), 2 * i + 2: Node(n.first + half, n.m - half)}
        depth += 1
    first = _array([nodes[i].first if i in nodes else None for i in range(max(nodes) + 1)], "int")
    return rows.withColumn("shard", F.get(first, _walk(nodes, keys, depth)).cast("int"))


def shard(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, categories: list[str] | None = None) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, shard, slot``; give ``shards`` or ``target_bytes``."""
    cols = categories if categories is not None else [c for c in ("source", "lang") if c in docs.columns]
    rows = durable(weigh(docs, cols))
    if shards is None:
        shards = max(1, math.ceil((rows.agg(F.sum("size")).first()[0] or 0) / target_bytes))
    placed = durable(kd_tree(rows, shards).select("doc_id", "size", "text_crc32", "shard"))
    release(rows)
    return dense_slots(placed, "shard", ["doc_id", "text_crc32", "size"], "slot")
