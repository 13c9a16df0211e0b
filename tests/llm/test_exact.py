"""Substring dedup, Jaccard join, sharding, quality rules: brute force on small documents, and odd inputs."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tamarack.llm import exchange as X
from tamarack.llm import jaccard, quality, sharding, substring
from tamarack.llm.words import hash_words, slices, windows


def tokens(t):
    return (t or "").encode().split()


def brute_repeats(rows, window):
    counts = Counter()
    for r in rows:
        w = tokens(r[1])
        counts.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = []
    for r in rows:
        w = tokens(r[1])
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((r[0], len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("window", "bits", "rounds"), [(35, 0, 1), (35, 3, 2), (6, 2, 1)])
def test_repeats(docs, documents, window, bits, rounds):
    got = substring.repeated_words(docs, window, plan=X.Layout(5, bits), rounds=rounds)
    assert sorted(map(tuple, got.collect()), key=str) == brute_repeats(documents, window)


def test_repeats_text(docs, documents, empty):
    rows = substring.repeated_words(docs, 35, keep_text=True, keep=("doc_id", "source")).collect()
    texts = Counter(r[1] for r in documents)
    for r in rows:
        assert hashlib.sha256(b" ".join(tokens(r.kept_text))).hexdigest() == r.kept_sha256
        assert r.n_removed or r.kept_text in texts
    assert substring.repeated_words(empty).count() == 0


def sets(rows, n=5):
    out = []
    for r in rows:
        w = (r[1] or "").encode().lower().split()
        out.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    return out


def brute_components(rows, per=75):
    s = sets(rows)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= per * len(s[i] | s[j]):
                parent[root(i)] = root(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[root(i)] = min(low.get(root(i), r[0]), r[0])
    return sorted(((r[0], len(s[i]), low.get(root(i)) if s[i] else r[0]) for i, r in enumerate(rows)), key=str)


@pytest.mark.parametrize("plan", [None, X.Layout(4, 2)])
def test_components(docs, documents, plan):
    got = jaccard.components(docs, plan=plan)
    assert sorted(map(tuple, got.collect()), key=str) == brute_components(documents)


def test_borderline_components(spark):
    """Many texts a few edits apart, most pairs near the threshold: no link between components may be lost."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.choice([1, 2, 3])):
            w[rng.randrange(60)] = f"e{rng.randrange(200)}"
        rows.append((i, " ".join(w)))
    got = jaccard.components(spark.createDataFrame(rows, "doc_id long, text string"), pivots=1)
    assert sorted(map(tuple, got.collect()), key=str) == brute_components(rows)


def test_components_empty(empty):
    assert jaccard.components(empty).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
@pytest.mark.parametrize("top", [8, 1 << 33, 1 << 64])
def test_packing_of_keys(n, top):
    keys = np.unique(np.random.default_rng(n).integers(0, top, n, dtype=np.uint64))
    assert (X.unpack(X.pack(keys)) == keys).all()


def test_window_hashes():
    rng = random.Random(0)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randrange(12))) for _ in range(50)] + [None, " a"]
    seen = {}
    for at, w in slices(pa.array(texts, pa.string()), size=30):
        for h, i in zip(*windows(w, 3), strict=True):
            d = int(w.doc[i])
            key = tuple(tokens(texts[at + d])[i - w.first[d] : i - w.first[d] + 3])
            assert len(key) == 3 and seen.setdefault(int(h), key) == key
    assert len(seen) == len(set(seen.values()))
    assert len(hash_words(np.zeros(0, np.uint8), np.array([0])).hash) == 0


def test_quality(docs, documents, empty):
    rng = random.Random(9)
    rows = documents + [(900 + i, " ".join(rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(0, 90)))) for i in range(40)] + [(990, "same line\nsame line\n\n \nother")]
    got = {(r.doc_id, r.n_words): r for r in quality.judge(docs.sparkSession.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()}
    for r in rows:
        t, w = r[1] or "", tokens(r[1])
        g = got[r[0], len(w)]
        three = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        cover = {k for i in range(len(w) - 2) if three[tuple(w[i : i + 3])] > 1 for k in range(i, i + 3)}
        lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        assert (g.word_chars, g.n_symbols) == (sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t))
        assert (g.n_dup_lines, g.n_repeat_words) == (len(lines) - len(set(lines)), len(cover))
        assert g.base_failed == (len(w) < 50 or 100 * len(cover) > 50 * len(w))
        if len(w) < 100:
            runs = [max((next((k for k in range(len(w) - max(i, j)) if w[i + k] != w[j + k]), len(w) - max(i, j)) for j in range(len(w)) if j != i), default=0) for i in range(len(w))]
            long = {k for i, n in enumerate(runs) if n >= 8 for k in range(i, i + n)}
            assert (g.longest_repeat, g.covered_words) == (max(runs, default=0), len(long))
        assert g.kept == (not g.base_failed and g.covered_words <= 0.4 * len(w) and g.longest_repeat <= 64)
    assert quality.judge(empty).count() == 0


@pytest.mark.parametrize("shards", [1, 5, 24])
def test_shards(docs, documents, shards):
    got = sharding.shard(docs, shards=shards).collect()
    want = sorted(((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in documents), key=str)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == want
    sizes = Counter()
    for s in range(shards):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
        sizes[s] = sum(r.size for r in got if r.shard == s)
    largest = max(r.size for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 3 * largest


def test_shards_of_one_hot_value(spark):
    rows = spark.createDataFrame([(i, "copy" if i % 3 else f"text {i}", "one", "one") for i in range(2000)], "doc_id long, text string, source string, lang string")
    got = sharding.shard(rows, shards=24).groupBy("shard").sum("size").collect()
    sizes = [r[1] for r in got]
    assert len(got) == 24 and max(sizes) < 1.15 * min(sizes)
    assert sharding.shard(rows, target_bytes=10_000).select("shard").distinct().count() == 3


def test_shards_empty(empty):
    assert sharding.shard(empty, shards=24).count() == 0
