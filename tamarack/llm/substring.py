"""Exact substring deduplication with fixed-block anchors (operator 1).

A window of ``window`` words that occurs at two places of the corpus is a repeat; every word under a repeat goes.

1. Anchors. Each document is cut into non-overlapping blocks of ``block = (window + 1) // 2`` words; any window holds
   one of them whole. The blocks' hashes are the index. Every rolling run of ``block`` words of every document probes
   it, and a block that is met at two places or more is a hit.
2. Extension. A window can only repeat if the block in it is a hit, so hits are extended to all windows around them,
   and those windows are matched among each other by 64-bit hashes. Where the corpus is so large that these would
   match falsely anywhere, the windows found are matched once more by independent hashes. Overlapping repeated windows
   unite to maximal exact repeats.

Both steps exchange packed sorted keys between chunks of documents and ranges of keys (see ``exchange``): texts move
once, pairs of places are never formed, and a passage that a third of all documents share costs one key per chunk.

Null and empty texts have no words. Identical rows repeat each other like any two documents. All occurrences go, the
first too; windows are judged on the input. Documents shorter than a window keep all words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm import exchange as X
from tamarack.llm.words import Words, let_go, slices, windows

#: Bits of a block hash that travel beside its bucket: false hits are rare and only cost work.
HIT_BITS = 32
_SENT = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("keys", pa.binary()), ("twice", pa.binary()), ("blocks", pa.binary())])
_BACK = pa.schema([("chunk", pa.int32()), ("keys", pa.binary())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "bigint", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _send(parts: list[np.ndarray], blocks: list[np.ndarray] | None, chunk: int, bits: int, width: int) -> pa.Table:
    """A chunk's keys, one row per bucket: distinct keys, those it has twice, those at block starts."""
    let_go()
    keys, n = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.uint64), return_counts=True)
    twice = keys[n > 1]
    anchors = np.unique(np.concatenate(blocks)) if blocks else np.zeros(0, np.uint64)
    cut = {b: [keys[i:j], np.zeros(0, np.uint64), np.zeros(0, np.uint64)] for b, i, j in X.by_bucket(keys, bits, width)}
    for k, more in ((1, twice), (2, anchors)):
        for b, i, j in X.by_bucket(more, bits, width):
            cut[b][k] = more[i:j]
    return X.payload([(b, chunk, *map(X.pack, v)) for b, v in cut.items()], _SENT)


# Functions given to applyInArrow carry no annotations: PySpark 4.1 reads them and can't resolve postponed ones.


def _match(anchored: bool):
    """Which keys of a bucket occur twice (and start a block somewhere): back to each chunk that has them."""

    def match(table):
        let_go()
        chunks = table.column("chunk").to_pylist()
        keys = [X.unpack(k) for k in table.column("keys").to_pylist()]
        twice = [X.unpack(k) for k in table.column("twice").to_pylist()]
        every = np.sort(np.concatenate(keys))
        found = np.union1d(every[1:][every[1:] == every[:-1]], np.concatenate(twice))
        if anchored:
            found = np.intersect1d(found, np.concatenate([X.unpack(k) for k in table.column("blocks").to_pylist()]))
        rows = []
        for c, k in zip(chunks, keys, strict=True):
            mine = k[_within(k, found)]
            if len(mine):
                rows.append((c, X.pack(mine)))
        return X.payload(rows, _BACK)

    return match


def _within(keys: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which keys are in the sorted ``found``."""
    if not len(found) or not len(keys):
        return np.zeros(len(keys), bool)
    i = np.searchsorted(found, keys)
    i[i == len(found)] = 0
    return found[i] == keys


def _found(table: pa.Table) -> np.ndarray:
    return np.sort(np.concatenate([X.unpack(k) for k in table.column("keys").to_pylist()])) if table.num_rows else np.zeros(0, np.uint64)


def repeated_words(docs: DataFrame, window: int = 35, keep_text: bool = False, keep: tuple[str, ...] = ("doc_id",), plan: X.Layout | None = None, rounds: int | None = None) -> DataFrame:
    """One row per document: ``keep`` columns, ``n_words``, ``n_removed``, ``kept_sha256`` and, if asked, ``kept_text``.

    ``kept_text`` is the text itself where nothing was removed, else the kept words joined by one space.
    """
    block = (window + 1) // 2
    lay = plan or X.layout(docs)
    width = 64 - lay.bits
    if rounds is None:  # about six bytes a word; expected false matches of one round are n**2 / 2**65
        rounds = 1 if ((lay.total or X.text_bytes(docs)) / 6) ** 2 / 2**65 < 1e-3 else 2
    if "chunk" in keep:
        raise ValueError("a kept column may not be called chunk")
    texts = X.chunked(docs.select(*keep, F.col("text").cast("string").alias("text")), lay.chunks, *keep, "text")

    def hits_of(keys: np.ndarray, hits: np.ndarray) -> np.ndarray:
        return _within(X.fold(keys, lay.bits, HIT_BITS), hits)

    def candidates(w: Words, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys and first words of the windows whose own block is a hit."""
        runs, at = windows(w, block)
        mark = np.zeros(len(w.hash) + 1, bool)
        aligned = (at - w.first[w.doc[at]]) % block == 0
        mark[at[aligned]] = hits_of(runs[aligned], hits)
        keys, first = windows(w, window, 1)
        inner = first + (w.first[w.doc[first]] - first) % block
        ok = mark[inner]
        return keys[ok], first[ok]

    def probe(key, table):
        parts, blocks = [], []
        for _, w in slices(table.column("text")):
            runs, at = windows(w, block)
            folded = X.fold(runs, lay.bits, HIT_BITS)
            parts.append(folded)
            blocks.append(folded[(at - w.first[w.doc[at]]) % block == 0])
        return _send(parts, blocks, key[0].as_py(), lay.bits, HIT_BITS)

    def extend(key, table, back):
        hits, parts = _found(back), []
        if len(hits):
            parts = [candidates(w, hits)[0] for _, w in slices(table.column("text"))]
        return _send(parts, None, key[0].as_py(), lay.bits, width)

    def again(key, table, back):
        found, parts = _found(back), []
        for _, w in slices(table.column("text")) if len(found) else ():
            ok = _within(windows(w, window, 1)[0], found)
            parts.append(windows(w, window, 0)[0][ok])
        return _send(parts, None, key[0].as_py(), lay.bits, width)

    names = [*keep, "n_words", "n_removed", "kept_sha256", *(["kept_text"] if keep_text else [])]

    def cut(key, table, back):
        let_go()
        found = _found(back)
        rows: list[tuple] = []
        column = table.column("text")
        for _, w in slices(column):
            gone = np.zeros(len(w.hash) + 1, np.int64)
            if len(found):
                keys, first = windows(w, window, rounds % 2)
                first = first[_within(keys, found)]
                np.add.at(gone, first, 1)
                np.add.at(gone, first + window, -1)
            stay = np.cumsum(gone)[:-1] == 0
            for d in range(w.docs):
                a, b = w.first[d], w.first[d + 1]
                removed = int((b - a) - stay[a:b].sum())
                kept = w.kept(d, stay if removed else None)
                rows.append((int(b - a), removed, hashlib.sha256(kept).hexdigest(), *([kept.decode() if removed else None] if keep_text else [])))
        made = list(zip(*rows, strict=True)) if rows else [[]] * (3 + keep_text)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
        arrays = [pa.array(list(m), k) for m, k in zip(made, kinds, strict=False)]
        if keep_text:
            import pyarrow.compute as pc

            arrays[3] = pc.if_else(pc.equal(arrays[1], 0), column.combine_chunks().cast(pa.string()), arrays[3])
        return pa.table([*(table.column(c) for c in keep), *arrays], names=names)

    sent = texts.groupBy("chunk").applyInArrow(probe, _ddl(_SENT))
    hits = sent.groupBy("bucket").applyInArrow(_match(True), _ddl(_BACK))
    wide = texts.groupBy("chunk").cogroup(hits.groupBy("chunk")).applyInArrow(extend, _ddl(_SENT))
    found = wide.groupBy("bucket").applyInArrow(_match(False), _ddl(_BACK))
    if rounds == 2:
        wide = texts.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(again, _ddl(_SENT))
        found = wide.groupBy("bucket").applyInArrow(_match(False), _ddl(_BACK))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
    out = ", ".join([*kinds, "n_words bigint", "n_removed bigint", "kept_sha256 string", *(["kept_text string"] if keep_text else [])])
    return texts.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(cut, out)
