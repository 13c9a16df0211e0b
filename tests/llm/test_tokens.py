"""BPE against the library, tree concatenation, and packing."""

import hashlib
import random
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tamarack.llm import bpe, packing

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
TRICKY = ["a\x1cb c", "x <|endoftext|> y", "foo<|endoftext|>bar", "a　b\u0085c", "don't 'S 12 3a", "é ́", "ΑΣ Σ", "İstanbul", "Ångström Å", "a.b,c.", "...", "²Ⅷx", "\U0001f600 hi"]


def ids(t):
    return LIBRARY.encode(t, add_special_tokens=False).ids


def test_codec(documents):
    c = bpe.Codec(PATH, kept_words=50)
    for t in [*(r[1] for r in documents), *TRICKY]:
        assert c.encode(t).tolist() == ids(t or "")
        assert c.decode(c.encode(t)) == LIBRARY.decode(ids(t or ""), skip_special_tokens=False)


@pytest.mark.parametrize("leaf", [2, 7, 128])
def test_tree_concatenation(leaf):
    rng = random.Random(leaf)
    parts = ["th", "in", "e", "an", "é", "ß", "你", "ing", "a", "er", "x", "Σ", "1", "!", "'s", "İ", "́"]
    c = bpe.Codec(PATH, long_word=20, leaf=leaf)
    for n in (1, 50, 400, 1500):
        w = "".join(rng.choice(parts[: rng.choice([3, 6, 17])]) for _ in range(n))
        assert c.encode(f"x {w} y").tolist() == ids(f"x {w} y")


def test_other_vocabulary():
    path = public_tokenizers.path("byte_bpe_50k.json")
    c = bpe.Codec(path)
    assert c.decode(c.whole("Hello there")) == "Hello there"


def test_round_trip(docs, documents, empty):
    got = {(r.doc_id, r.n_tokens): r for r in bpe.digests(docs.select("doc_id", "text"), PATH).collect()}
    for r in documents:
        want = ids(r[1] or "")
        g = got[r[0], len(want)]
        assert g.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in want)).hexdigest()
        assert g.decoded_sha256 == hashlib.sha256(LIBRARY.decode(want, skip_special_tokens=False).encode()).hexdigest()
    encoded = bpe.encode(docs.select("doc_id", "text"), PATH)
    assert {r.decoded for r in bpe.decode(encoded, PATH).collect()} == {LIBRARY.decode(ids(r[1] or ""), skip_special_tokens=False) for r in documents}
    assert bpe.digests(empty, PATH).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_plan(seed):
    rng = random.Random(seed)
    cap = rng.choice([12, 100, 4096])
    counts = {}
    for _ in range(rng.choice([1, 5, 50, 3000])):
        n = rng.choice([rng.randint(1, cap), cap, cap // 3, 1])
        counts[n] = counts.get(n, 0) + rng.choice([1, 1, 7])
    bins, ranks = {}, {}
    for n, rank, k, first, offset in packing.plan(counts, cap):
        for i in range(k):
            bins.setdefault(first + i, []).append((offset, n))
            ranks.setdefault(n, []).append(rank + i)
    assert {n: sorted(v) for n, v in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= cap and sum(3 * n > cap for _, n in parts) <= 2
    # First-fit-decreasing as a yardstick.
    left = []
    for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        k = next((i for i, room in enumerate(left) if room >= n), None)
        if k is None:
            left.append(cap - n)
        else:
            left[k] -= n
    assert len(bins) <= len(left) * 1.05 + 1


def test_best_fit(docs, documents, empty):
    got = packing.best_fit(docs, PATH, capacity=64).collect()
    want = []
    for r in documents:
        x = ids(r[1] or "") + [1]
        for p, a in enumerate(range(0, len(x), 64)):
            want.append((r[0], p, a, len(x[a : a + 64]), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in x[a : a + 64]))))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 64
    assert packing.best_fit(empty, PATH).count() == 0
