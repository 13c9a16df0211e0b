"""Best-fit packing of token sequences with large-item matching (operator 6).

1. Every text becomes ids plus an end id; texts longer than the capacity are cut into full pieces and a rest.
2. Only the histogram of piece lengths (never more rows than the capacity) goes to the driver. There, pieces of
   more than a third of the capacity are matched: longest first, each with the longest partner that fits, so a
   sequence has two of them at most. All smaller pieces then go, longest first, to the fullest sequence that
   takes them. Whole runs of equal lengths and equal gaps move at once, so the plan's size depends on the
   capacity and not on the number of pieces.
3. Pieces of one length get gapless ranks (salted, so a length shared by a third of all rows is many tasks);
   rank and length look up the sequence and the offset in the plan.

Null and empty texts are one piece holding the end id. Ties (equal lengths) are ordered by doc_id, piece and
contents; repeated rows are separate pieces. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.bpe import BATCH, codec, map_texts
from tamarack.llm.words import let_go
from tamarack.operators.slots import dense_slots
from tamarack.storage import durable


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Histogram of lengths -> runs ``(length, first rank, count, first sequence, offset)``.

    The run's pieces, ranks ``first rank ...``, go to the sequences ``first sequence ...`` at ``offset``.
    """
    left = {n: c for n, c in counts.items() if c > 0 and n > 0}
    used = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int]] = []
    open_at: dict[int, list[tuple[int, int]]] = {}  # gap -> ranges (first sequence, number)
    gaps: list[int] = []
    made = 0

    def put(n: int, k: int, first: int, gap: int) -> None:
        """k pieces of length n into k sequences from ``first`` whose gap is ``gap``."""
        runs.append((n, used[n], k, first, capacity - gap))
        used[n] += k
        left[n] -= k
        if gap > n:
            if gap - n not in open_at:
                bisect.insort(gaps, gap - n)
                open_at[gap - n] = []
            open_at[gap - n].append((first, k))

    large = sorted(n for n in left if 3 * n > capacity)
    for n in reversed(large):
        while left[n]:
            fits = bisect.bisect_right(large, capacity - n)
            mate = next((m for m in reversed(large[:fits]) if left[m] and (m != n or left[n] > 1)), None)
            k = left[n] if mate is None else left[n] // 2 if mate == n else min(left[n], left[mate])
            first, made = made, made + k
            if mate is None:
                put(n, k, first, capacity)
                continue
            runs.append((n, used[n], k, first, 0))
            used[n] += k
            left[n] -= k
            put(mate, k, first, capacity - n)
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            at = bisect.bisect_left(gaps, n)
            if at == len(gaps):  # no gap takes it: open sequences, each as full of this length as it gets
                per = capacity // n
                k = max(1, left[n] // per)
                first, made = made, made + k
                gap = capacity
                for _ in range(per):
                    now = min(k, left[n])
                    if not now:
                        break
                    if now < k or gap - n < n or left[n] == now:
                        put(n, now, first, gap)
                        if now < k:
                            if gap not in open_at:
                                bisect.insort(gaps, gap)
                                open_at[gap] = []
                            open_at[gap].append((first + now, k - now))
                        break
                    runs.append((n, used[n], now, first, capacity - gap))
                    used[n] += now
                    left[n] -= now
                    gap -= n
                continue
            gap = gaps[at]
            first, k = open_at[gap].pop()
            if not open_at[gap]:
                del open_at[gap], gaps[at]
            now = min(k, left[n])
            if now < k:
                if gap not in open_at:
                    bisect.insort(gaps, gap)
                    open_at[gap] = []
                open_at[gap].append((first + now, k - now))
            put(n, now, first, gap)
    return runs


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int, text: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``."""
    end = np.array([end_id], "<u4")

    def make():
        c = codec(path)

        def one(ids):
            ids = np.concatenate([ids, end])
            cut = range(0, len(ids), capacity)
            return [len(ids[a : a + capacity]) for a in cut], [zlib.crc32(ids[a : a + capacity].tobytes()) for a in cut]

        return lambda texts: [one(ids) for ids in c.encode_many(texts)]

    cut = map_texts(docs.select("doc_id", text), text, "lengths array<int>, crcs array<bigint>", make, size=BATCH)
    rows = cut.select("doc_id", F.posexplode(F.arrays_zip("lengths", "crcs")).alias("piece", "x"))
    return rows.select("doc_id", "piece", (F.col("piece").cast("long") * capacity).alias("start"), F.col("x.lengths").cast("long").alias("length"), F.col("x.crcs").alias("ids_crc32"))


def best_fit(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, text: str = "text") -> DataFrame:
    """Pack all texts: the columns of :func:`pieces` with ``sequence_id`` and ``offset``."""
    rows = durable(pieces(docs, path, capacity, end_id, text))
    counts = {r.length: r.n for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    by: dict[int, list[tuple]] = {}
    for run in plan(counts, capacity):
        by.setdefault(run[0], []).append(run[1:])
    table = {n: np.array(sorted(v), np.int64) for n, v in by.items()}
    ranked = dense_slots(rows, "length", ["doc_id", "piece", "ids_crc32"], "_rank")
    shared = docs.sparkSession.sparkContext.broadcast(table)  # bounded by the capacity

    def place(batches):
        let_go()
        look = shared.value
        for b in batches:
            n, rank = b.column("length").to_numpy(), b.column("_rank").to_numpy()
            seq, off = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            for k in np.unique(n):
                t, at = look[int(k)], np.flatnonzero(n == k)
                i = np.searchsorted(t[:, 0], rank[at], "right") - 1
                seq[at], off[at] = t[i, 2] + rank[at] - t[i, 0], t[i, 3]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq), pa.array(off)], [*b.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", sequence_id bigint, offset bigint")
