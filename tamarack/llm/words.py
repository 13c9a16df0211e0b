"""Vectorised word and window hashes over Arrow text buffers (NumPy, no per-word Python).

Words are runs of bytes other than ``\\x20`` and ``\\x09-\\x0D``; UTF-8 never uses those bytes inside a
character, so byte runs are exactly the words ``[^\\x20\\x09-\\x0D]+`` of the text. Hashes are polynomial prefix
sums modulo 2**64 with odd bases, so the hash of any span costs two look-ups; a mixer follows each level.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Odd multipliers of the byte level and of two independent window levels.
BYTE_BASE, WINDOW_BASES = 0x9E3779B97F4A7C15, (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
try:
    _libc = ctypes.CDLL("libc.so.6")
except OSError:  # another C library
    _libc = None
#: Bytes or words hashed at a time, so that sums take no more memory than this many numbers.
BLOCK = 1 << 17
_FINE = 1 << 10
_held: dict[str, tuple[object, object]] = {}


class Powers:
    """``base**i`` and ``base**-i`` modulo 2**64 for i < n: products of two short tables, so nothing grows with n but n / 1024."""

    def __init__(self, base: int, n: int):
        coarse = n // _FINE + 1
        self.up, self.up_far = self._table(base, _FINE), self._table(pow(base, _FINE, 1 << 64), coarse)
        back = pow(base, -1, 1 << 64)
        self.down, self.down_far = self._table(back, _FINE), self._table(pow(back, _FINE, 1 << 64), coarse)

    @staticmethod
    def _table(base: int, n: int) -> np.ndarray:
        t = np.full(n, base, np.uint64)
        t[0] = 1
        return np.cumprod(t)

    def ups(self, start: int, stop: int) -> np.ndarray:
        """``base**i`` for i from ``start`` (a multiple of 1024) to ``stop``."""
        far = self.up_far[start // _FINE : -(-stop // _FINE)]
        return np.multiply.outer(far, self.up).ravel()[: stop - start]

    def downs(self, at: np.ndarray) -> np.ndarray:
        """``base**-i`` for i in ``at``."""
        return self.down_far[at // _FINE] * self.down[at % _FINE]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def tidy() -> None:
    """Give memory that NumPy and Arrow have freed back to the system: workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def held(name: str, key, make):
    """What ``make()`` gives, kept for later tasks of this worker under ``name`` as long as ``key`` stays the same. A worker
    keeps one such thing, so operators that follow each other don't pile up their tables."""
    have = _held.get(name)
    if have is None or have[0] != key:
        let_go()
        have = _held[name] = (key, make())
    return have[1]


def let_go() -> None:
    """Drop what other operators have kept in this worker."""
    _held.clear()
    tidy()


@dataclass
class Words:
    """Words of a slice of documents: ``hash``, ``doc`` (index in the slice), byte ``start`` and ``end``."""

    hash: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray
    first: np.ndarray  # first word of each document, and the total at the end

    @property
    def docs(self) -> int:
        return len(self.first) - 1

    def kept(self, doc: int, keep: np.ndarray | None = None) -> bytes:
        """The document's words (those of ``keep``) joined by one space."""
        a, b = self.first[doc], self.first[doc + 1]
        if a == b:
            return b""
        lo = int(self.start[a])
        text = self.data[lo : int(self.end[b - 1])].tobytes()
        if keep is None:
            return b" ".join(text.split())
        at = a + np.flatnonzero(keep[a:b])
        return b" ".join([text[i:j] for i, j in zip((self.start[at] - lo).tolist(), (self.end[at] - lo).tolist(), strict=True)])


def hash_words(data: np.ndarray, offsets: np.ndarray, lower: bool = False, breaks: np.ndarray = SPACE) -> Words:
    """``data``: UTF-8 bytes of consecutive documents; ``offsets``: where each begins, and the end.
    ``breaks``: which bytes are no part of a word."""
    if lower:
        data = LOWER[data]
    n = len(data)
    solid = ~breaks[data]
    begins = np.zeros(n + 1, bool)
    begins[offsets] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | begins[1:n]
    end = np.zeros(n + 1, bool)
    end[1:] = solid
    end[1:n] &= ~solid[1:] | begins[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end)
    powers = Powers(BYTE_BASE, n)
    h, total = np.zeros(len(s), np.uint64), np.uint64(0)
    for at in range(0, n, BLOCK):  # h becomes the sum over a word's bytes: what is summed at its end less that at its start
        to = min(n, at + BLOCK)
        sums = np.cumsum((data[at:to].astype(np.uint64) + np.uint64(1)) * powers.ups(at, to))
        sums += total
        i, j = np.searchsorted(s, (at, to))
        h[i:j] -= np.where(s[i:j] > at, sums[s[i:j] - at - 1], total)
        i, j = np.searchsorted(e, (at, to), "right")
        h[i:j] += sums[e[i:j] - at - 1]
        total = sums[-1]
    h *= powers.downs(s)
    h = mix(h + (e - s).astype(np.uint64))
    doc = (np.searchsorted(offsets, s, "right") - 1).astype(np.int32)
    # An empty document shares its offset with the next one; "right" gives the last of them, which has the words.
    return Words(h, doc, s, e, data, np.searchsorted(doc, np.arange(len(offsets))))


def windows(words: Words, n: int, level: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words inside one document, and the first word of each run."""
    w, m = words.hash, len(words.hash)
    if m < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sums, powers = word_sums(words, level)
    at = np.flatnonzero(words.doc[: m - n + 1] == words.doc[n - 1 :])
    return mix((sums[at + n] - sums[at]) * powers.downs(at)), at


def word_sums(words: Words, level: int = 0) -> tuple[np.ndarray, Powers]:
    """Prefix sums of word hashes times powers: the difference of two, times ``downs`` of the first, names a run of words."""
    w, m = words.hash, len(words.hash)
    powers, sums = Powers(WINDOW_BASES[level], m), np.zeros(m + 1, np.uint64)
    np.multiply(w if level == 0 else mix(w + np.uint64(0x632BE59BD9B4E019)), powers.ups(0, m), out=sums[1:])
    np.cumsum(sums[1:], out=sums[1:])
    return sums, powers


def slices(texts: pa.Array, size: int = 1 << 20, lower: bool = False, breaks: np.ndarray = SPACE) -> Iterator[tuple[int, Words]]:
    """Cut a text column into slices of about ``size`` bytes (one document at least); nulls have no words."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    if texts.type != pa.large_string():
        texts = texts.cast(pa.large_string())
    if not len(texts):
        return
    _, where, raw = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    if texts.null_count:  # a null may have bytes behind it
        return (yield from slices(texts.fill_null(""), size, lower, breaks))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, hash_words(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], lower, breaks)
        at = to
