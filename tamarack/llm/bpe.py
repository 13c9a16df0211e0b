"""Byte-pair encoding and decoding of whole texts with a published vocabulary (operator 5).

Tree concatenation. A text is cut into leaves of some 2,000 characters, which are encoded independently of each other.
Neighbouring halves are then joined pairwise up a tree: the words next to the join are encoded again as one window by
the library, and the window grows until its first token is the left half's there and its last the right half's; then the
window's tokens stand for both sides'. All joins of a level, over all texts of a batch, are one call of the library,
which encodes them in parallel where a task has several cores (``spark.task.cpus``).

Leaves end at white space, unless there is none: a run of more than ``LONG_WORD`` characters that the vocabulary's own
splitter leaves whole is cut into leaves of ``LEAF`` characters, and joined by the same rule on its tokens. From a window
outwards every neighbouring pair of tokens was adjacent in a correct encoding already, and an encoding whose neighbouring
pairs are all correct is the encoding, so the joined ids are exactly the library's.

Within a leaf most words were seen before, so ids of words are kept in a bounded table per worker, and only unseen words
go through the library. Texts in which a word's ids could depend on its neighbours (special-token strings, the separators
U+001C-U+001F) are one leaf that the library encodes.

Null texts count as empty, empty texts have no ids, repeated rows are encoded alike, other columns pass through.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.words import held, tidy

#: Words of more characters are looked at for unsplit runs.
LONG_WORD = 512
#: Characters in a leaf of a long word, and in one of a text.
LEAF, TEXT_LEAF = 128, 2048
#: Leaves of a text whose words are looked up together.
TOGETHER = 32
#: Bytes of texts that are encoded together.
BATCH = 1 << 20
#: Words whose ids a worker keeps.
KEPT_WORDS = 400_000
#: The byte-level alphabet: printable bytes stand for themselves, the others for characters from U+0100 on; spaces stay.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_SYMBOLS = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTED)} | {32: " "}
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_BLANK = re.compile(r"\s")


def _library():
    import os

    task = TaskContext.get()
    cores = task.cpus() if task else 1
    os.environ.setdefault("RAYON_NUM_THREADS", str(cores))
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "true" if cores > 1 else "false")
    import tokenizers

    return tokenizers


@dataclass
class Half:
    """A stretch of a text with its ids: the words at its ends, and how many bytes of ids they have (-1: not known apart)."""

    text: str
    ids: bytes
    first: str = ""
    last: str = ""
    n_first: int = -1
    n_last: int = -1


class Codec:
    """Encoder and decoder of one vocabulary file of the ``tokenizers`` library."""

    def __init__(self, path: str, kept_words: int = KEPT_WORDS, long_word: int = LONG_WORD, leaf: int = LEAF):
        self.tokenizer = _library().Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kept_words, self.long_word, self.leaf = kept_words, long_word, max(2, leaf)
        self.packed: dict[str, bytes] = {}
        self.joins = 0
        self.tails: dict[str, bytes] = {}
        self.tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        model = json.loads(self.tokenizer.to_str())["model"]
        self.mark = model.get("end_of_word_suffix")
        self.ends = np.array([bool(self.mark) and t.endswith(self.mark) for t in self.tokens])
        probe = "Probe of THE \u00e4\u00d6\u00df \u00e9t\u00e9 \u4f60\u597d\u0416 letters"
        self.bytewise = bool(self.mark) and self.models[1].encode(self._symbols(probe), add_special_tokens=False).ids == self.tokenizer.encode(probe, add_special_tokens=False).ids

    def whole(self, text: str) -> np.ndarray:
        """The library's own encoding."""
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text (little-endian unsigned 32-bit), equal to :meth:`whole`."""
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text: leaves, then all joins of a level at once until every text is whole."""
        trees = [self._leaves(t) if t else [] for t in texts]
        while any(len(t) > 1 for t in trees):
            pairs = [(t[i], t[i + 1]) for t in trees for i in range(0, len(t) - 1, 2)]
            joined = iter(self._join_all(pairs))
            trees = [[next(joined) if i + 1 < len(t) else t[i] for i in range(0, len(t), 2)] for t in trees]
        return [np.frombuffer(t[0].ids if t else b"", "<u4") for t in trees]

    def _leaves(self, text: str) -> list[Half]:
        if any(s in text for s in self.special) or any(c in text for c in _SEPARATORS):
            return [Half(text, self.whole(text).tobytes())]
        parts, at = [], 0
        while at < len(text):
            blank = _BLANK.search(text, at + TEXT_LEAF)
            to = blank.start() if blank else len(text)
            parts.append(text[at:to])
            at = to
        out = []
        for i in range(0, len(parts), TOGETHER):
            words = [p.split() for p in parts[i : i + TOGETHER]]
            ids = self._ids(list(chain.from_iterable(words)))
            at = 0
            for part, w in zip(parts[i : i + TOGETHER], words, strict=True):
                if w:
                    mine = ids[at : at + len(w)]
                    at += len(w)
                    out.append(Half(part, b"".join(mine), w[0], w[-1], len(mine[0]), len(mine[-1])))
        return out

    def _join_all(self, pairs: list[tuple[Half, Half]]) -> list[Half]:
        """Both halves of each pair as one."""
        self.joins += len(pairs)
        windows = self.tokenizer.encode_batch_fast([f"{a.last} {b.first}" for a, b in pairs], add_special_tokens=False)
        return [self._joined(a, b, np.array(w.ids, "<u4").tobytes()) for (a, b), w in zip(pairs, windows, strict=True)]

    def _joined(self, a: Half, b: Half, window: bytes, reach: int = 1) -> Half:
        """``window``: ids of the ``reach`` words before the join and as many after it, as one text."""
        left, right = (a.ids[len(a.ids) - a.n_last :], b.ids[: b.n_first]) if a.n_last > 0 and b.n_first > 0 else (b"", b"")
        while True:
            if left and right and window == left + right:  # nothing changes at the join
                return Half(a.text + b.text, a.ids + b.ids, a.first, b.last, a.n_first, b.n_last)
            if left and right and window[:4] == left[:4] and window[-4:] == right[-4:]:
                return Half(a.text + b.text, a.ids[: len(a.ids) - len(left)] + window + b.ids[len(right) :])
            reach *= 2
            before, after = a.text.split()[-reach:], b.text.split()[:reach]
            window = self.whole(" ".join(before + after)).tobytes()
            left, right = (b"".join(self._ids(w)) for w in (before, after))
            if not a.ids.endswith(left) or not b.ids.startswith(right) or len(left) == len(a.ids) or len(right) == len(b.ids):
                return Half(a.text + b.text, self.whole(a.text + b.text).tobytes())

    def _ids(self, words: list[str]) -> list[bytes]:
        """Packed ids of each word."""
        known = self.packed
        packed = list(map(known.get, words))
        if None in packed:
            holes = [i for i, p in enumerate(packed) if p is None]
            fresh = self._learn(list({words[i] for i in holes}))
            for i in holes:
                packed[i] = fresh[words[i]]
            if len(known) + len(fresh) <= self.kept_words:
                known.update(fresh)
        return packed

    def _learn(self, unseen: list[str]) -> dict[str, bytes]:
        """Packed ids of words."""
        found: dict[str, bytes] = {}
        plain, cores, ends, odd = [], [], {}, []
        mark, limit = self.mark, self.long_word
        for w in unseen:
            core = w if w.isalpha() else w.rstrip(".,")
            if mark and core.isalpha() and len(w) <= limit and (core.isascii() or core.lower().isalpha()):
                plain.append(w)
                cores.append(core)
                if len(core) < len(w):
                    ends[w[len(core) :]] = b""
            else:
                odd.append(w)
        tails = self.tails
        short = [w for w in odd if len(w) <= self.long_word] + [e for e in ends if e not in tails]
        single = {w: np.array(e.ids, "<u4").tobytes() for w, e in zip(short, self.tokenizer.encode_batch_fast(short, add_special_tokens=False), strict=True)} if short else {}
        for e in ends:
            if e not in tails and len(tails) < 1000:
                tails[e] = single[e]
        for w in odd:
            found[w] = single[w] if w in single else self._long(w).tobytes()
        if cores:
            # A run of letters is one unit of the splitter, and each unit's last token alone carries the mark.
            ids = self._letters(" ".join(cores))
            raw, at = ids.tobytes(), 0
            for w, core, to in zip(plain, cores, ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist(), strict=True):
                if len(core) == len(w):
                    found[w] = raw[at:to]
                else:
                    end = w[len(core) :]
                    found[w] = raw[at:to] + (tails[end] if end in tails else single[end])
                at = to
        return found

    def _letters(self, joined: str) -> np.ndarray:
        """Ids of words of letters only, joined by spaces. Where folding case is plain, the vocabulary's merges can be
        run on the byte symbols at once; the library's own text handling costs three times the merging."""
        if self.bytewise and not any(c in joined for c in "\u0130\u03a3") and unicodedata.is_normalized("NFC", joined):
            return np.array(self.models[1].encode_batch_fast([self._symbols(joined)], add_special_tokens=False)[0].ids, "<u4")
        return self.whole(joined)

    @staticmethod
    def _symbols(text: str) -> str:
        return text.lower().encode().decode("latin-1").translate(_BYTE_SYMBOLS)

    def _long(self, word: str) -> np.ndarray:
        """A word with long unsplit runs: each run by tree concatenation."""
        out: list[int] = []
        text = self.tokenizer.normalizer.normalize_str(word) if self.tokenizer.normalizer else word
        for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text):  # symbols of the model from here on
            out += self.unsplit(piece) if len(piece) > 2 * self.leaf else self._run(piece, True)
        return np.array(out, "<u4")

    @property
    def models(self):
        """The vocabulary's merges with and without the end-of-word mark, on ready symbols."""
        if not hasattr(self, "_models"):
            lib, spec = _library(), json.loads(self.tokenizer.to_str())["model"]
            merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in spec["merges"]]
            mark = self.mark
            self._models = tuple(lib.Tokenizer(lib.models.BPE(vocab=spec["vocab"], merges=merges, **more)) for more in ({}, {"end_of_word_suffix": mark} if mark else {}))
            self._models[1].pre_tokenizer = lib.pre_tokenizers.WhitespaceSplit()
            self._bare = [t[: -len(mark)] if mark and t.endswith(mark) else t for t in self.tokens]
        return self._models

    def _run(self, symbols: str, last: bool) -> list[int]:
        return self.models[last].encode(symbols, add_special_tokens=False).ids

    def unsplit(self, symbols: str) -> list[int]:
        """Ids of one unsplit run of model symbols, by joining encoded halves."""
        inner, final = self.models
        cuts = list(range(0, len(symbols), self.leaf))
        leaves = [symbols[a : a + self.leaf] for a in cuts]
        parts = [e.ids for e in inner.encode_batch(leaves[:-1], add_special_tokens=False)]
        parts.append(final.encode(leaves[-1], add_special_tokens=False).ids)
        while len(parts) > 1:
            n = len(parts)
            parts = [self.join(parts[i], parts[i + 1], i + 2 >= n) if i + 1 < n else parts[i] for i in range(0, n, 2)]
        return parts[0]

    def join(self, left: list[int], right: list[int], last: bool) -> list[int]:
        """Join the encodings of two neighbouring pieces; ``last``: the right one ends the run."""
        reach, bare = 4, self._bare
        while True:
            a, b = max(0, len(left) - reach), min(len(right), reach)
            ends = b == len(right)
            middle = self._run("".join(bare[i] for i in chain(left[a:], right[:b])), last and ends)
            if (a == 0 or middle[0] == left[a]) and (ends or middle[-1] == right[b - 1]):
                return left[:a] + middle + right[b:]
            reach *= 2

    def decode(self, ids) -> str:
        """The library's ``decode(ids, skip_special_tokens=False)``."""
        if self.tokenizer.decoder is None:  # then the library joins tokens by one space
            return " ".join(map(self.tokens.__getitem__, ids if isinstance(ids, list) else np.asarray(ids, np.int64).tolist()))
        return self.tokenizer.decode([int(i) for i in ids], skip_special_tokens=False)


def codec(path: str) -> Codec:
    """One codec per worker process and file, as long as no other operator needs the worker."""
    return held("codec", path, lambda: Codec(path))


def map_texts(df: DataFrame, column: str, schema: str, make: Callable[[], Callable[[list], list[tuple]]], step: int = 256, keep_text: bool = False, size: int = 8 << 20) -> DataFrame:
    """Append columns computed from whole texts. ``make()`` runs once per task and gives a function that
    takes a list of texts (None for null) and returns one tuple per text: at most ``step`` texts of about ``size`` bytes
    at once, or one longer text. The text itself goes unless kept."""
    fields = df.select(*[F.lit(None).cast(t).alias(n) for n, t in (f.strip().split(" ") for f in schema.split(","))]).schema
    names = [f.name for f in fields]
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(f.dataType) for f in fields]
    keep = [c for c in df.columns if c not in names and (keep_text or c != column)]
    hidden = "_text"
    while hidden.lower() in {c.lower() for c in df.columns}:
        hidden += "_"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for at, rows_in in _pieces(batch.column(len(keep)), step, size):
                part = batch.slice(at, rows_in)
                rows = work(part.column(len(keep)).to_pylist())
                made = [pa.array(list(v), k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(keep))] + made, keep + names)
        tidy()

    kept = df.select(*keep, F.col(column).cast("string").alias(hidden))
    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema[:-1]), *(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)])
    return kept.mapInArrow(run, out)


def _pieces(texts: pa.Array, step: int, size: int) -> Iterator[tuple[int, int]]:
    """``(first row, rows)`` of at most ``step`` rows and about ``size`` bytes; a longer text is a piece of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at, n = 0, len(texts)
    while at < n:
        base = int(ends[at - 1]) if at else 0
        to = min(n, at + step, max(at + 1, int(np.searchsorted(ends, base + size, "right"))))
        yield at, to - at
        at = to


def encode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` without ``text`` and with ``ids array<int>``."""

    def make():
        c = codec(path)
        return lambda texts: [(ids.tolist(),) for ids in c.encode_many(texts)]

    return map_texts(df.drop("ids"), text, "ids array<int>", make, size=BATCH)


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Append ``decoded`` to rows with an id array (null: empty text)."""
    rest = [c for c in df.columns if c != "decoded"]

    def run(batches):
        c = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [c.decode(x if x is not None else []) for x in part.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*rest, "decoded"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*rest).schema)
    return df.select(*rest).mapInArrow(run, f"{kinds}, decoded string")


def digests(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Round trip of every text in one pass: ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` instead of the text."""

    def make():
        c = codec(path)

        def one(ids):
            return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(c.decode(ids).encode()).hexdigest()

        return lambda texts: [one(ids) for ids in c.encode_many(texts)]

    return map_texts(df, text, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", make, size=BATCH)

