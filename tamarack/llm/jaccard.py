"""N-gram Jaccard self-join with multiple global orders (operator 4).

Texts with one word sequence (after folding A-Z) are one *class* from the start, so exact copies never meet as pairs.
For classes the prefix principle holds: ordered by any global order of shingles, two sets of Jaccard t or more share a
shingle among the first n - ceil(t n) + 1 of each. Three orders are used, all from rare to frequent but by document
frequency in different grain and with different tie-breaks:

1. Document frequencies of all shingles are counted by a packed exchange (see ``exchange``). A shingle of one class
   cannot be shared; a class whose prefix has only such shingles has no partner and is done.
2. Shared prefix shingles under the first order are posted. Every posting list names one pivot, and each member is
   paired with it: linear in the postings, whatever the size of a list. This is repeated with other pivots for lists
   that span several components.
3. A pair must pass the filters of the second and third order, of which only the prefixes move: what both have before
   the earlier prefix ends, and what either has left there, bound the overlap from above. Sets of the pairs that are
   left are compared.
4. Links make components. Only lists that still span several components give pairs, and only pairs across
   components whose sizes and positions in the list allow the threshold; these pass the same filters and comparison.
   Links inside a component change nothing, so no link between components is lost and none is needed inside.

Sets and prefixes lie bucketed by class, so pairs travel to them. A pair's pivot is looked up once for all its pairs and
then joined from a table of its own, which lets a pivot with very many pairs be split among tasks.

Null texts and texts without words have empty sets and are linked with nothing: each is its own component. Repeated
rows and equal texts share a component. Null doc_ids take part but never name a component; extra columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm import exchange as X
from tamarack.llm.words import Words, let_go, mix, slices, windows
from tamarack.operators.graph import connected_components
from tamarack.storage import bucketed, durable, release

COUNT_BITS = 32
_SENT = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_BACK = pa.schema([("chunk", pa.int32()), ("keys", pa.binary()), ("grades", pa.binary())])
_RECORD = pa.schema([("key", pa.binary()), ("n", pa.int32()), ("lone", pa.int32()), ("post", pa.list_(pa.int64())), ("second", pa.binary()), ("third", pa.binary()), ("shared", pa.binary())])
#: Per order: how many doublings of document frequency make one grade, and the salt of the tie-break.
ORDERS = ((1, 0x8CB92BA72F3D8DD7), (64, 0xB5026F5AA96619E9), (3, 0xC2B2AE3D27D4EB4F))
#: A place in the second and third order has 32 bits: the grade's, and below them so many of the tie-break.
TIE_BITS = 26
#: Rows that carry sets in a task that writes them, where there are few.
PER_FILE = 4096
#: Shingles before a posting that tell whether a pair has met already.
RECENT = 8


def shingle_sets(w: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, sorted, and where each document's begin."""
    parts = [windows(w, n)]
    hashes, docs = [parts[0][0]], [w.doc[parts[0][1]]]
    size = np.diff(w.first)
    for short in range(1, n):
        if (size == short).any():
            h, at = windows(w, short)
            ok = size[w.doc[at]] == short
            hashes.append(mix(h[ok] + np.uint64(short)))
            docs.append(w.doc[at][ok])
    h, d = np.concatenate(hashes), np.concatenate(docs)
    by = np.lexsort((h, d))
    h, d = h[by], d[by]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    h, d = h[new], d[new]
    return h, np.searchsorted(d, np.arange(w.docs + 1))


def class_key(text: str | None) -> bytes:
    """16 bytes that name a word sequence."""
    return hashlib.md5(b" ".join((text or "").encode().lower().split()), usedforsecurity=False).digest()


def least_overlap(n: int, per: int) -> int:
    """ceil(per/100 * n)."""
    return -(-n * per // 100)


def _keys(docs: DataFrame, with_text: bool, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``keep`` columns and ``key`` of every row, or ``key, text`` of the first row of each key in a task."""
    kept = docs.select(F.col("doc_id").cast("long"), *keep).schema
    named, kinds = [*kept.names, "key"], ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        seen: set[bytes] = set()  # no more than the task's input
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column(part.num_columns - 1)
                keys = [class_key(t) for t in texts.to_pylist()]
                if not with_text:
                    yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(keys, pa.binary())], named)
                    continue
                fresh = []
                for i, k in enumerate(keys):
                    if k not in seen:
                        seen.add(k)
                        fresh.append(i)
                yield pa.RecordBatch.from_arrays([pa.array([keys[i] for i in fresh], pa.binary()), texts.take(pa.array(fresh, pa.int64()))], ["key", "text"])

    return docs.select(F.col("doc_id").cast("long"), *keep, F.col("text").cast("string").alias("text")).mapInArrow(run, "key binary, text string" if with_text else f"{kinds}, key binary")


def _once(table: pa.Table) -> pa.Table:
    """The first row of each key."""
    first: dict[bytes, int] = {}
    for i, k in enumerate(table.column("key").to_pylist()):
        first.setdefault(k, i)
    return table if len(first) == table.num_rows else table.take(pa.array(list(first.values()), pa.int64()))


def records(docs: DataFrame, n: int, per: int, plan: X.Layout | None) -> DataFrame:
    """One row per class: its key and set size, and what joining needs where it may have a partner."""
    lay = plan or X.layout(docs)
    bits = lay.bits
    texts = X.chunked(_keys(docs, True), lay.chunks, "key")

    def count(key, table):
        let_go()
        parts = [X.fold(shingle_sets(w, n)[0], bits, COUNT_BITS) for _, w in slices(_once(table).column("text"), lower=True)]
        keys, counts = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.uint64), return_counts=True)
        cut = X.by_bucket(keys, bits, COUNT_BITS)
        return X.payload([(b, key[0].as_py(), X.pack(keys[i:j]), X.squeeze(counts[i:j].astype(np.uint32))) for b, i, j in cut], _SENT)

    def add_up(table):
        let_go()
        chunks = table.column("chunk").to_pylist()
        keys = [X.unpack(k) for k in table.column("keys").to_pylist()]
        counts = np.concatenate([X.expand(c, np.uint32) for c in table.column("counts").to_pylist()])
        every, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, counts).astype(np.int64)
        grade = np.where(total > 1, np.ceil(np.log2(np.maximum(total, 2))), 0).astype(np.uint8)
        mine, rows, at = grade[place], [], 0
        for c, k in zip(chunks, keys, strict=True):
            g = mine[at : at + len(k)]
            at += len(k)
            if g.any():
                rows.append((c, X.pack(k[g > 0]), X.squeeze(g[g > 0])))
        return X.payload(rows, _BACK)

    def prefix(h, grade, order):
        step, salt = ORDERS[order]
        m = len(h)
        by = np.lexsort((mix(h ^ np.uint64(salt)), -(-grade.astype(np.int64) // step)))
        head = by[: m - least_overlap(m, per) + 1]
        return head[grade[head] > 0]

    def places(h, grade, order):
        """Places of the prefix's shingles in an order, ascending; only their first bits, so two may share one."""
        step, salt = ORDERS[order]
        head = prefix(h, grade, order)
        level = (-(-grade[head].astype(np.int64) // step)).astype(np.uint64)
        return (level << np.uint64(TIE_BITS) | mix(h[head] ^ np.uint64(salt)) >> np.uint64(64 - TIE_BITS)).astype(np.uint32).tobytes()

    def describe(key, table, back):
        let_go()
        table = _once(table)
        names = table.column("key").to_pylist()
        known, grades = np.zeros(0, np.uint64), np.zeros(0, np.uint8)
        if back.num_rows:
            known = np.concatenate([X.unpack(k) for k in back.column("keys").to_pylist()])
            grades = np.concatenate([X.expand(g, np.uint8) for g in back.column("grades").to_pylist()])
            by = np.argsort(known)
            known, grades = known[by], grades[by]
        rows = []
        for at, w in slices(table.column("text"), lower=True):
            h, first = shingle_sets(w, n)
            grade = np.zeros(len(h), np.uint8)
            if len(known):
                f = X.fold(h, bits, COUNT_BITS)
                i = np.minimum(np.searchsorted(known, f), len(known) - 1)
                grade = np.where(known[i] == f, grades[i], 0).astype(np.uint8)
            for d in range(w.docs):
                s, g = h[first[d] : first[d + 1]], grade[first[d] : first[d + 1]]
                a = prefix(s, g, 0) if g.any() else ()
                if not len(a):
                    rows.append((names[at + d], len(s), 0, None, None, None, None))
                    continue
                rows.append((names[at + d], len(s), int((g == 0).sum()), s[a].view(np.int64), places(s, g, 1), places(s, g, 2), s[g > 0].tobytes()))
        return X.payload(rows, _RECORD)

    sent = texts.groupBy("chunk").applyInArrow(count, "bucket int, chunk int, keys binary, counts binary")
    back = sent.groupBy("bucket").applyInArrow(add_up, "chunk int, keys binary, grades binary")
    return texts.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(describe, "key binary, n int, lone int, post array<bigint>, second binary, third binary, shared binary")


def _flat(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """Values of a column of packed arrays, and the row of each."""
    raw = column.to_pylist()
    size = [len(x) // np.dtype(kind).itemsize for x in raw]
    return np.frombuffer(b"".join(raw), kind).astype(np.uint64), np.repeat(np.arange(len(raw)), size)


def _common(a: np.ndarray, of_a: np.ndarray, b: np.ndarray, of_b: np.ndarray, rows: int) -> np.ndarray:
    """How many values each row has on both sides; neither side repeats one."""
    values, of = np.concatenate([a, b]), np.concatenate([of_a, of_b])
    by = np.lexsort((values, of))
    values, of = values[by], of[by]
    return np.bincount(of[1:][(values[1:] == values[:-1]) & (of[1:] == of[:-1])], minlength=rows)


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(c).to_numpy().astype(np.int64) for c in names]


def may_link(batch: pa.RecordBatch, per: int) -> np.ndarray:
    """Pairs that the second and third order allow to link.

    Where the shorter-reaching prefix ends, both prefixes hold every shared shingle before; so the overlap is at most what
    both have there and the rest of the set that has less left. Equal places of different shingles only raise the bound.
    """
    a_n, b_n, a_lone, b_lone = _numbers(batch, "a_n", "b_n", "a_lone", "b_lone")
    ok = np.ones(batch.num_rows, bool)
    for order in ("second", "third"):
        (a, of_a), (b, of_b) = (_flat(batch.column(f"{s}_{order}"), np.uint32) for s in "ab")
        last = [x[np.searchsorted(of, np.arange(batch.num_rows), "right") - 1] for x, of in ((a, of_a), (b, of_b))]
        stop = np.minimum(*last)
        in_a, in_b = a < stop[of_a], b < stop[of_b]
        rest = [n - lone - np.bincount(of[i], minlength=batch.num_rows) for n, lone, of, i in ((a_n, a_lone, of_a, in_a), (b_n, b_lone, of_b, in_b))]
        most = _common(a[in_a], of_a[in_a], b[in_b], of_b[in_b], batch.num_rows) + np.minimum(*rest)
        ok &= most * (100 + per) >= per * (a_n + b_n)
    return ok


def do_link(batch: pa.RecordBatch, per: int) -> np.ndarray:
    """Pairs whose whole sets have Jaccard ``per`` percent or more."""
    a_n, b_n = _numbers(batch, "a_n", "b_n")
    o = _common(*_flat(batch.column("a_shared"), np.uint64), *_flat(batch.column("b_shared"), np.uint64), batch.num_rows)
    return 100 * o >= per * (a_n + b_n - o)


def _passing(pairs: DataFrame, rows: int, sets: DataFrame, columns: tuple[str, ...], test: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """The ``pairs(a, b)``, ``rows`` of them, that pass ``test`` on both sides' ``columns``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(test(part)))

    of = lambda side: sets.select(F.col("key").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns])
    pivots = durable(pairs.select("b").distinct().join(of("b"), "b"), rows, PER_FILE)
    names = ["a", "b", *[f"{side}_{c}" for side in "ab" for c in columns]]
    found = durable(pairs.join(pivots, "b").join(of("a"), "a").select(*names).mapInArrow(run, "a binary, b binary"), rows, PER_FILE)
    release(pivots)
    return found


def verified(pairs: DataFrame, sets: DataFrame, per: int) -> DataFrame:
    """Those ``pairs(a, b)`` whose Jaccard is ``per`` percent or more, again as ``a, b``; a durable table."""
    asked = durable(pairs.select("a", "b").distinct())
    rows = asked.count()
    some = _passing(asked, rows, sets, ("n", "lone", "second", "third"), lambda batch: may_link(batch, per))
    sure = _passing(some, rows, sets, ("n", "shared"), lambda batch: do_link(batch, per))
    release(asked, some)
    return sure


def components(docs: DataFrame, n: int = 5, per: int = 75, plan: X.Layout | None = None, pivots: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``doc_id``, ``keep`` columns, ``n_shingles``, ``component_id``, and with ``keep`` also
    ``component``, which names the component where all its doc_ids are null too (null for empty sets). ``pivots`` is how
    often lists are compared with one of their members before the components that are left are compared with each other."""
    classes = bucketed(records(docs, n, per, plan), "key", int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sets = classes.where("post is not null")

    def sizes(x: str, y: str):
        """Whether the sizes of two classes let them link."""
        return F.least(x, y) * 100 >= F.greatest(x, y) * per

    def posted(frame: DataFrame, *more: str) -> DataFrame:
        return frame.select("key", "n", *more, F.posexplode("post").alias("k", "token"))

    def spanning(known: DataFrame) -> DataFrame:
        """Postings of lists that have more than one label; lists that have one need no more."""
        open_ = durable(known.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("token"), tokens)
        rest = durable(known.join(open_, "token", "left_semi"), postings)
        release(open_)
        return rest

    def labelled(frame: DataFrame, labels: DataFrame, on: str) -> DataFrame:
        """``label`` as ``labels(node, component)`` has it for ``on``, or ``on`` itself."""
        met = frame.withColumnRenamed(on, "node").join(labels, "node", "left")
        return met.withColumn("_label", F.coalesce("component", "node")).drop("component", *(["node"] if on == "label" else [])).withColumnsRenamed({"_label": "label", "node": on})

    # Tables by token are written before they are joined, so that a token with very many postings can be split among tasks.
    lists = durable(posted(sets).groupBy("token").agg(F.min(F.struct("key", "n")).alias("p"), F.count("*").alias("members")).where("members > 1"))
    tokens, postings = lists.agg(F.count("*"), F.coalesce(F.sum("members"), F.lit(0))).first()
    first = posted(sets).drop("k").join(lists.drop("members"), "token").where(F.col("key") != F.col("p.key")).where(sizes("n", "p.n"))
    links = verified(first.select(F.col("key").alias("a"), F.col("p.key").alias("b")), sets, per)
    release(lists)
    found = [durable(connected_components(links.toDF("src", "dst")), 2 * links.count())]
    rest = spanning(posted(labelled(sets.select("key", "n", "post"), found[0], "key"), "label"))
    release(links)

    def join_more(links: DataFrame) -> DataFrame:
        """Components of the labels that ``links`` connect: labels are the nodes from the second time on."""
        ends = labelled(labelled(links, found[0], "a").withColumnRenamed("label", "src"), found[0], "b").withColumnRenamed("label", "dst").select("src", "dst")
        for earlier in found[1:]:
            for end in ("src", "dst"):
                ends = labelled(ends.withColumnRenamed(end, "label"), earlier, "label").withColumnRenamed("label", end)
        found.append(durable(connected_components(ends.select("src", "dst")), 2 * links.count()))
        release(links)
        return found[-1]

    for turn in range(pivots - 1):  # other pivots, drawn per list, and only across components
        drawn = durable(rest.groupBy("token").agg(F.min_by(F.struct("key", "n", "label"), F.xxhash64("token", "key", F.lit(turn))).alias("p")), tokens)
        met = rest.join(drawn, "token").where(F.col("label") != F.col("p.label")).where(sizes("n", "p.n"))
        moved = join_more(verified(met.select(F.col("key").alias("a"), F.col("p.key").alias("b")), sets, per))
        still = spanning(labelled(rest, moved, "label").select("key", "n", "label", "k", "token"))
        release(drawn, rest)
        rest = still
    near = F.slice("post", F.greatest(F.lit(1), F.col("k") - RECENT + 1), F.least(F.col("k"), F.lit(RECENT)))
    # Shingles of one class come first in the order; places count them, though they are not posted.
    left = F.col("n") - F.col("k") - F.col("lone")
    last = durable(rest.join(sets.select("key", "lone", "post"), "key").select("token", "key", F.struct("n", left.alias("left")).alias("s"), "label", near.alias("near")), postings)
    x, y = (last.select("token", *[F.col(c).alias(f"{s}_{c}") for c in ("key", "s", "label", "near")]) for s in "xy")
    # A pair is met at the first token that both share, where the places leave most room, and at few others: where it has
    # met just before, it isn't met again.
    room = F.least("x_s.left", "y_s.left") * (100 + per) >= (F.col("x_s.n") + F.col("y_s.n")) * per
    across = x.join(y, "token").where("x_label < y_label").where(sizes("x_s.n", "y_s.n")).where(room).where(~F.arrays_overlap("x_near", "y_near"))
    join_more(verified(across.select(F.col("x_key").alias("a"), F.col("y_key").alias("b")), sets, per))
    release(rest, last)
    rows = durable(_keys(docs, False, keep))
    ids = rows.groupBy("key").agg(F.min("doc_id").alias("low"))
    named = labelled(classes.select("key", "n").join(ids, "key"), found[0], "key")
    for later in found[1:]:
        named = labelled(named, later, "label")
    named = durable(named.select("key", "n", "low", "label"))
    least = durable(named.groupBy("label").agg(F.min("low").alias("component_id")))
    final = named.join(least, "label").select("key", "n", "component_id", F.when(F.col("n") > 0, F.col("label")).alias("component"))
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    out = durable(rows.join(final, "key").select("doc_id", *keep, F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"), *(["component"] if keep else [])))
    release(classes, rows, named, least, *found)
    return out
