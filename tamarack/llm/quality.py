"""Document quality rules with suffix-array repetition (operator 10).

For a slice of documents one suffix array over words is built by prefix doubling, vectorised; the document index
leads every key, so suffixes never match across documents. Only suffixes that still share their rank are sorted
again. Words are compared for the longest common prefix of neighbouring suffixes; for the suffix at word i the longer
of its two neighbours' is the longest repeat that starts there, which is the depth of its deepest LCP interval. The spans of all maximal repeats of ``min_words`` or more are united; a document goes if
they cover more than ``max_fraction`` of its words or one is longer than ``max_longest`` words.

Memory is linear in the slice, or in a text that is longer than a slice: about 20 bytes for each of its bytes.

Null and empty texts have no words, so all counts are 0 and the base rule fails them. Repeated rows are judged
alike, and only within a text do repeats count. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.words import Words, let_go, slices

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
_WORD = re.compile(r"[^\x20\x09-\x0D]")


def suffix_order(words: Words) -> np.ndarray:
    """All suffixes in order: by document, then word by word up to the document's end.

    A rank is the number of smaller suffixes, so ranks of settled suffixes never change again.
    """
    n = len(words.hash)
    kind = np.int32 if n < 1 << 31 else np.int64
    order = np.lexsort((words.hash, words.doc)).astype(kind)
    new = np.ones(n, bool)
    new[1:] = (words.hash[order[1:]] != words.hash[order[:-1]]) | (words.doc[order[1:]] != words.doc[order[:-1]])
    starts = np.flatnonzero(new).astype(kind)
    sizes = np.diff(starts, append=kind(n))
    rank = np.empty(n, kind)
    rank[order] = np.repeat(starts, sizes)
    active, k = order[np.repeat(sizes > 1, sizes)], 1
    del new, starts, sizes
    while len(active):
        ahead = active + kind(k)
        inside = np.flatnonzero(ahead < words.first[words.doc[active] + 1])
        both = rank[active].astype(np.int64) * (n + 1)
        both[inside] += rank[ahead[inside]] + np.int64(1)  # 0 where the document ends
        del ahead, inside
        by = np.argsort(both)
        active, both = active[by], both[by]
        del by
        m = len(active)
        cut, head = np.ones(m, bool), np.ones(m, bool)
        cut[1:] = both[1:] != both[:-1]
        both //= n + 1
        head[1:] = both[1:] != both[:-1]
        del both
        at, heads = np.flatnonzero(cut), np.flatnonzero(head)  # where new and old classes begin
        old = np.repeat(heads, np.diff(heads, append=m))
        sizes = np.diff(at, append=m)
        rank[active] += (np.repeat(at, sizes) - old).astype(kind)
        del old
        order[rank[active[at]]] = active[at]
        active = active[np.repeat(sizes > 1, sizes)]
        k *= 2
    order[rank] = np.arange(n, dtype=kind)
    return order


def matches(w: np.ndarray, i: np.ndarray, j: np.ndarray, limit: np.ndarray, together: int = 32) -> np.ndarray:
    """How many words agree from ``i`` and from ``j`` on, at most ``limit``; all pairs together first, long ones by blocks."""
    n = np.zeros(len(i), np.int64)
    left = np.flatnonzero(limit > 0)
    for _ in range(together):
        left = left[w[i[left] + n[left]] == w[j[left] + n[left]]]
        n[left] += 1
        left = left[n[left] < limit[left]]
        if not len(left):
            return n
    for x in left.tolist():
        a, b, at, end, block = int(i[x]), int(j[x]), together, int(limit[x]), 64
        while at < end:
            to = min(end, at + block)
            differ = w[a + at : a + to] != w[b + at : b + to]
            if differ.any():
                at += int(differ.argmax())
                break
            at, block = to, min(2 * block, 1 << 20)
        n[x] = at
    return n


def longest_repeats(words: Words) -> np.ndarray:
    """For each word, the length of the longest run of words from it that also starts elsewhere in its document.

    A suffix and the one before it in order share one word less than the pair one word to the left, if that pair starts
    with one word too. So only pairs that don't are compared, which is no more than n log n words in all.
    """
    n = len(words.hash)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    order, w = suffix_order(words), words.hash
    j, i = order[:-1], order[1:]
    same = (w[i] == w[j]) & (words.doc[i] == words.doc[j])  # others share no word
    i, j = i[same], j[same]
    start, stop = words.first[words.doc[i]], words.first[words.doc[i] + 1]
    follows = (i > start) & (j > start)
    follows[follows] = w[i[follows] - 1] == w[j[follows] - 1]
    known = np.ones(n, bool)
    known[i[follows]] = False
    i, j, stop = i[~follows], j[~follows], stop[~follows]
    common = np.zeros(n, np.int64)
    common[i] = matches(w, i, j, stop - np.maximum(i, j))
    last = np.maximum.accumulate(np.where(known, np.arange(n), 0))
    common = common[last] - (np.arange(n) - last)
    out[:] = common
    out[order[:-1]] = np.maximum(common[order[:-1]], common[order[1:]])
    return out


def covered(words: Words, repeats: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in a repeat of ``least`` words or more."""
    n = len(repeats)
    at = np.flatnonzero(repeats >= least)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + repeats[at], -1)
    return np.cumsum(edge[:n]) > 0


def _per_doc(words: Words, mark: np.ndarray) -> np.ndarray:
    return np.add.reduceat(np.append(mark.astype(np.int64), 0), words.first[:-1]) * (np.diff(words.first) > 0)


def _lines(text: str) -> int:
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    return len(lines) - len(set(lines))


SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, covered_words bigint, longest_repeat bigint"
)


def judge(docs: DataFrame, min_words: int = 8, max_fraction: float = 0.4, max_longest: int = 64, least_words: int = 50) -> DataFrame:
    """One row per document: counts, ``base_failed``, ``kept``, ``covered_words`` and ``longest_repeat``."""
    names = [f.split(" ")[0] for f in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for at, w in slices(texts):
                d = w.docs
                part = [t or "" for t in texts.slice(at, d).to_pylist()]
                n = np.diff(w.first)
                repeats = longest_repeats(w)
                three = _per_doc(w, covered(w, repeats, 3))
                long = _per_doc(w, covered(w, repeats, min_words))
                longest = np.zeros(d, np.int64)
                np.maximum.at(longest, w.doc, repeats)
                chars = np.array([len(t) - sum(map(t.count, BLANKS)) for t in part], np.int64)
                symbols = np.array([sum(map(t.count, SYMBOLS)) for t in part], np.int64)
                lines = np.array([_lines(t) for t in part], np.int64)
                failed = (n < least_words) | (100 * three > 50 * n)
                kept = ~failed & (long <= max_fraction * n) & (longest <= max_longest)
                yield pa.RecordBatch.from_arrays([ids.slice(at, d), *map(pa.array, (n, chars, symbols, lines, three, failed, kept, long, longest))], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)
