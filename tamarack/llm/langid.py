"""Language identification by cross-parsing entropy (operator 3).

For each language a suffix automaton of a bounded sample of labelled text is built. A text is parsed against it
greedily: the longest match from here is one phrase, and the next phrase starts after it. The fewer phrases per
character a language needs, the closer the text is to it; the fewest win. Texts are parsed whole, in stretches of
``STRETCH`` characters that each begin a new phrase, so thousands of stretches step through the automaton's moves
together. Case is folded; runs of anything but letters count as one blank. Every letter of the samples has its own
code, of whatever script; only letters in no sample share one. Automata keep only the moves that exist, in a hash
table, so their size follows the sample and not the number of letters.

Every labelled language is learned. The sample per language is bounded by ``docs_per_language`` and
``chars_per_language``, so the model grows with the number of languages only. The documents drawn share the characters:
short ones are taken whole and the others give a span of one length, from anywhere in the text, so few long documents
teach as much as many. Only a language whose drawn documents are shorter together has a smaller sample, which tells
against it, as phrases are not corrected for the size of a sample. Null texts and texts without a
letter are ``und`` with score 0, as is everything when no language was learned. Ties go to the alphabetically
first language. Held out is every row whose crc32(doc_id as text) mod 4 is 2.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarack.llm.bpe import map_texts
from tamarack.llm.words import held

STRETCH = 1024
#: How many characters of a text's phrase rate make one unit of evidence.
SHARPNESS = 0.02
BLANK, OTHER = 0, 1


def held_out(doc_id: str = "doc_id"):
    """Whether a row is held out of training."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


@dataclass
class Automaton:
    """Moves of a suffix automaton in an open hash table: ``key`` is state * letters + code, or -1 in a free place, and
    ``to`` next state * letters * 2 + phrase begun. Where a state has no move for a code, ``root`` of the code holds and
    begins a phrase."""

    key: np.ndarray
    to: np.ndarray
    root: np.ndarray

    def _place(self, keys: np.ndarray) -> np.ndarray:
        top = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
        return (top * np.uint64(len(self.key)) >> np.uint64(32)).astype(np.int64)

    def put(self, keys: np.ndarray, to: np.ndarray) -> None:
        """Enter moves; each goes to the first free place from its own on."""
        at = self._place(keys)
        while len(keys):
            free = self.key[at] < 0
            self.key[at[free]] = keys[free]  # of several that want a place the last one has it
            won = self.key[at] == keys
            self.to[at[won]] = to[won]
            keys, to, at = keys[~won], to[~won], (at[~won] + 1) % len(self.key)

    def move(self, state: np.ndarray, codes: np.ndarray) -> np.ndarray:
        want = state + codes
        at = self._place(want)
        have = self.key[at]
        out = np.where(have == want, self.to[at], self.root[codes])
        more = np.flatnonzero((have != want) & (have >= 0))
        while len(more):
            at[more] = (at[more] + 1) % len(self.key)
            have = self.key[at[more]]
            hit = have == want[more]
            out[more[hit]] = self.to[at[more[hit]]]
            more = more[~hit & (have >= 0)]
        return out


def automaton(codes: list[int], letters: int) -> Automaton:
    """Suffix automaton of ``codes``; moves from the root begin a phrase."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        cur = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = cur
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    kind = np.int32 if len(moves) * letters < 1 << 30 else np.int64
    root = np.ones(letters, kind)
    for c, to in moves[0].items():
        root[c] = to * letters * 2 + 1
    key = np.array([s * letters + c for s, out in enumerate(moves) for c in out], kind)
    to = np.array([t * letters * 2 + (s == 0) for s, out in enumerate(moves) for t in out.values()], kind)
    size = 4 * len(key) + 1
    table = Automaton(np.full(size, -1, kind), np.zeros(size, kind), root)
    table.put(key, to)
    return table


class Model:
    """Automata of all learned languages over one alphabet."""

    def __init__(self, samples: dict[str, str]):
        self.langs = sorted(samples)
        alphabet = sorted({c for t in samples.values() for c in _fold(t) if c != " "})
        self.letters = len(alphabet) + 2
        self.code = np.full(0x110000, BLANK, np.uint8 if self.letters <= 256 else np.int32)
        self.code[_letters()] = OTHER
        for i, c in enumerate(alphabet):
            self.code[ord(c)] = i + 2
        self.automata = [automaton(self.codes(samples[k]).tolist(), self.letters) for k in self.langs]

    def codes(self, text: str) -> np.ndarray:
        c = self.code[np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)]
        keep = c != BLANK
        keep[1:] |= c[:-1] != BLANK
        return c[keep]

    def rates(self, texts: list[str | None]) -> np.ndarray:
        """Phrases per character, ``[text, language]``; NaN for texts without a letter."""
        parts = [self.codes(t) if t else np.zeros(0, self.code.dtype) for t in texts]
        size = np.array([len(p) for p in parts])
        out = np.full((len(texts), len(self.langs)), np.nan)
        some = np.array([bool((p != BLANK).any()) for p in parts])
        if not some.any():
            return out
        flat = np.concatenate(parts)
        first = np.concatenate([[0], np.cumsum(size)])[:-1]
        pieces = -(-size // STRETCH)
        owner = np.repeat(np.arange(len(texts)), pieces)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = first[owner] + inner * STRETCH
        length = np.minimum(STRETCH, size[owner] - inner * STRETCH)
        by = np.argsort(-length, kind="stable")
        owner, start, length = owner[by], start[by], length[by]
        active = np.searchsorted(-length, -np.arange(1, length[0] + 1), "right")  # stretches that have an i-th character
        for k, one in enumerate(self.automata):
            state = np.zeros(len(owner), one.key.dtype)
            phrases = np.zeros(len(owner), np.int32)
            for i, m in enumerate(active.tolist()):
                move = one.move(state[:m], flat[start[:m] + i])
                phrases[:m] += move & 1
                state[:m] = move >> 1
            out[:, k] = np.bincount(owner, phrases, len(texts)) / np.maximum(size, 1)
        out[~some] = np.nan
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if not self.langs:
            return [("und", 0.0)] * len(texts)
        rates = self.rates(texts)
        out = []
        for r in rates:
            if np.isnan(r[0]):
                out.append(("und", 0.0))
                continue
            k = int(r.argmin())
            out.append((self.langs[k], float(1 / np.exp(-(r - r[k]) / SHARPNESS).sum())))
        return out


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def _fold(text: str) -> str:
    return "".join(c if c.isalpha() else " " for c in text.lower())


def model(samples: tuple[tuple[str, str], ...]) -> Model:
    """One set of automata per worker process and sample, as long as no other operator needs the worker."""
    return held("langid", samples, lambda: Model(dict(samples)))


def fit(docs: DataFrame, docs_per_language: int = 120, chars_per_language: int = 40_000) -> tuple[tuple[str, str], ...]:
    """Sample of labelled text per language, from rows that are not held out."""
    rows = docs.where("lang is not null and text is not null").where(~held_out())
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    # Rows are drawn by a hash of doc_id at a rate per language, so no language is sorted as a whole.
    u, place = (F.pmod(F.xxhash64("doc_id", F.lit(v)), F.lit(1 << 30)) / float(1 << 30) for v in ("sample", "place"))
    rated = rows.join(F.broadcast(counts), "lang").where(u < F.least(F.lit(1.0), 2.0 * docs_per_language / F.col("n")))  # a row per language

    def span(text: str, size):
        return F.substring(F.col(text), (F.floor(place * (F.greatest(F.length(text) - size, F.lit(0)) + 1)) + 1).cast("int"), size.cast("int"))

    drawn = rated.select("lang", u.alias("u"), "doc_id", span("text", F.lit(chars_per_language)).alias("part"))
    at = F.row_number().over(Window.partitionBy("lang").orderBy("u", "doc_id", "part"))
    drawn = drawn.withColumn("at", at).where(F.col("at") <= docs_per_language).withColumn("size", F.length("part"))
    # What is left for each document when all shorter ones are whole; it is largest where that stops to fit.
    shorter = Window.partitionBy("lang").orderBy("size", "at")
    before = F.coalesce(F.sum("size").over(shorter.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    of = Window.partitionBy("lang")
    share = F.ceil((chars_per_language - before) / (F.count("*").over(of) - F.row_number().over(shorter) + 1))
    drawn = drawn.withColumn("share", share).withColumn("share", F.max("share").over(of))
    found: dict[str, list] = {}
    for r in drawn.select("lang", "at", span("part", F.col("share")).alias("part")).collect():  # bounded by both parameters a language
        found.setdefault(r.lang, []).append((r.at, r.part))
    return tuple((k, "\n".join(t for _, t in sorted(v))[:chars_per_language]) for k, v in sorted(found.items()))


def identify(docs: DataFrame, samples: tuple[tuple[str, str], ...], keep_text: bool = False) -> DataFrame:
    """Append ``lang_pred`` and ``score`` to ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(samples)  # bounded by fit's parameters

    def make():
        m = model(shared.value)
        return m.predict

    return map_texts(docs, "text", "lang_pred string, score double", make, step=1024, keep_text=keep_text)
