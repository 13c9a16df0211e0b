"""Plain versions of what the other tests only bound: fingerprint cells, tree scores, notices, long repeats, joins of halves."""

import random
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import Row
from tokenizers import Tokenizer

import corpus_pipeline
from tamarack.llm import bpe, fingerprint, jaccard, licenses, quality, substring, toxicity
from tamarack.llm import exchange as X
from tamarack.llm.words import slices


def _hash(values, seed=42):
    """The engine's xxhash64 of strings and longs; nulls leave the hash as it is."""
    for v in values:
        if v is not None:
            seed = xxhash.xxh64(v.encode() if isinstance(v, str) else struct.pack("<q", v), seed=seed).intdigest()
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def test_fingerprint_cells(spark):
    """Which k-mers a cell has, and in which order, by sorting in plain Python."""
    rng = random.Random(2)
    words = ["w%d" % i for i in range(30)]
    texts = [" ".join(rng.choice(words) for _ in range(n)) for n in (0, 1, 2, 3, 5, 40, 300)] * 2
    texts += [" ".join(reversed(t.split())) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: r.fp for r in fingerprint.sketch(df, "text", "fp").collect()}
    want = {i: _plain(t) for i, t in enumerate(texts)}
    # Cells are hashes of tuples: equal tuples give equal cells, others different ones.
    names = {}
    for i, cells in got.items():
        assert [c != "" for c in cells] == [c is not None for c in want[i]]
        for c, t in zip(cells, want[i], strict=True):
            if t is not None:
                assert names.setdefault(c, t) == t
    assert len(set(names.values())) == len(names)


def _plain(text, k=3, bins=32, take=2):
    """Per bin, the chosen k-mers as (words, occurrence) in text order."""
    w = text.split()
    n = max(1, len(w) - k + 1) if w else 0
    seen, chosen = {}, [[] for _ in range(bins)]
    for i in range(n):
        gram = tuple(w[i : i + k])
        seen[gram] = seen.get(gram, 0) + 1
        first = _hash([_hash([x]) for x in gram])
        top = (first & (1 << 64) - 1) >> (64 - fingerprint.KEY)
        # The occurrence is a 32-bit integer to the engine.
        second = xxhash.xxh64(struct.pack("<i", seen[gram]), seed=_hash([top]) & (1 << 64) - 1).intdigest() >> (64 - fingerprint.KEY)
        chosen[second >> (fingerprint.KEY - bins.bit_length() + 1)].append((second, i, gram, seen[gram]))
    return [tuple((g, o) for _, i, g, o in sorted(sorted(c)[:take], key=lambda x: x[1])) if c else None for c in chosen]


def test_tree_scores(spark, data):
    """Margins by walking every tree row by row, and scores by the steps between knots."""
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    words, stems, trees = toxicity.fit(docs, labels)
    rows = toxicity.score(docs.select("doc_id", "text"), (words, stems, trees), keep_text=True).collect()
    for r in rows[:120]:
        x = toxicity.features(r.text, words, stems)
        margin = trees.base
        for feature, cut, leaf in trees.nodes:
            at = 0
            for _ in range(trees.depth):
                j = feature[at]
                at = 2 * at + 1 + (sum(e <= x[j] for e in trees.edges[j]) > cut[at])
            margin += leaf[at - (2**trees.depth - 1)]
        knots, steps = trees.steps
        k = sum(m <= margin for m in knots)
        step = steps[0] if k == 0 else steps[-1] if k == len(knots) else steps[k - 1] + (steps[k] - steps[k - 1]) * (margin - knots[k - 1]) / (knots[k] - knots[k - 1])
        assert r.score == pytest.approx(min(1, max(0, 0.99 * step + 0.01 / (1 + np.exp(-margin)))), abs=1e-9)
        assert r.predicted == int(r.score >= 0.3)


def test_license_recall(spark):
    """Edited copies of the notices that an exact alignment covers by 0.8 are found; the rest isn't."""
    rng = random.Random(4)
    short = {k: v for k, v in licenses.TEMPLATES.items() if 20 <= len(v.split()) <= 200}
    rows, want = [], {}

    def plain(t):
        return "".join(c if c.isalnum() else " " for c in t.lower()).split()

    def common(a, b):
        line = [0] * (len(b) + 1)
        for x in a:
            before = 0
            for j, y in enumerate(b, 1):
                before, line[j] = line[j], before + 1 if x == y else max(line[j], line[j - 1])
        return line[-1]

    for name, text in sorted(short.items()):
        for _ in range(4):
            words = [w for w in text.split() if rng.random() > 0.04]
            words = [x for w in words for x in ([w] if rng.random() > 0.04 else [w, "extra"])]
            i = len(rows)
            rows.append((i, "before it " + " ".join(words) + " and after"))
            want[i] = (name, common(plain(text), plain(rows[i][1])) >= 0.8 * len(plain(text)))
    found = {}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found.setdefault(r.doc_id, set()).add(r.license)
    due = [i for i, (_, ok) in want.items() if ok]
    assert len(due) > 20
    family = lambda n: n.split("-")[0]  # noqa: E731  an edited notice may be nearer to a relative
    assert sum(any(family(want[i][0]) == family(x) for x in found.get(i, ())) for i in due) >= 0.9 * len(due)


def test_long_repeats():
    rng = random.Random(3)
    for _ in range(30):
        texts = [" ".join(rng.choice("abcdefgh"[: rng.randint(1, 8)]) for _ in range(rng.choice([0, 1, 2, 60, 200]))) for _ in range(3)]
        texts.append(" ".join(["x y z q"] * 40 + ["w"] + ["x y z q"] * 35))
        for at, w in slices(pa.array(texts)):
            got = quality.longest_repeats(w)
            for d in range(w.docs):
                words = texts[at + d].split()
                n = len(words)
                same = [[0] * (n + 1) for _ in range(n + 1)]
                for a in range(n - 1, -1, -1):
                    for b in range(n - 1, -1, -1):
                        same[a][b] = same[a + 1][b + 1] + 1 if words[a] == words[b] else 0
                assert got[w.first[d] : w.first[d + 1]].tolist() == [max((same[a][b] for b in range(n) if b != a), default=0) for a in range(n)]


def test_joins_of_ordinary_texts(data):
    """All ids of a whole table come through the tree and are the library's; halves that disagree are joined too."""
    path = public_tokenizers.path("word_bpe_49k.json")
    codec, library = bpe.Codec(path), Tokenizer.from_file(path)
    texts = pq.read_table(f"{data}/documents.parquet", columns=["text"]).column("text").to_pylist()
    assert [x.tolist() for x in codec.encode_many(texts)] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert codec.joins > 50
    text = "one two three four five six"
    a, b = (codec._leaves(t)[0] for t in ("one two three", " four five six"))
    right = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(codec._joined(a, b, b"").ids, "<u4").tolist() == right  # a window that agrees nowhere
    a.n_last = -1
    assert np.frombuffer(codec._join_all([(a, b)])[0].ids, "<u4").tolist() == right


def test_bounds_of_orders():
    """The filters of the second and third order let every pair through that links."""
    rng = np.random.default_rng(6)
    for _ in range(300):
        core = rng.integers(0, 1 << 62, rng.integers(5, 80)).astype(np.uint64)
        sets = [np.unique(np.concatenate([core[rng.random(len(core)) > 0.1], rng.integers(0, 1 << 62, rng.integers(0, 8)).astype(np.uint64)])) for _ in "ab"]
        shared = np.intersect1d(*sets)
        if 100 * len(shared) < 75 * (len(sets[0]) + len(sets[1]) - len(shared)):
            continue
        one = {}
        for side, s in zip("ab", sets, strict=True):
            known = s[np.isin(s, shared) | (s % np.uint64(3) == 0)]  # others are of one class
            one |= {f"{side}_n": len(s), f"{side}_lone": len(s) - len(known)}
            for order, salt in (("second", 5), ("third", 9)):
                places = np.sort((known * np.uint64(2 * salt + 1) >> np.uint64(54)).astype(np.uint32))  # few bits, so that some fall together
                head = places[: max(0, len(s) - jaccard.least_overlap(len(s), 75) + 1 - (len(s) - len(known)))]
                one[f"{side}_{order}"] = head.tobytes()
        if all(one[f"{side}_{o}"] for side in "ab" for o in ("second", "third")):
            assert jaccard.may_link(pa.RecordBatch.from_pylist([one]), 75).all()


def test_exchange_sizes(docs):
    assert X.sized(0).rows == 1
    assert X.sized(10**12).rows < 10**12 / 500
    with pytest.raises(ValueError, match="chunk"):
        substring.repeated_words(docs, keep=("doc_id", "chunk"))


def test_one_of_each_group(spark):
    """Rows that only share a doc_id stay; of a group the smallest doc_id does; equal rows and rows without an id once."""
    rng = random.Random(8)
    words = ["v%d" % i for i in range(500)]
    a, b, c = (" ".join(rng.choice(words) for _ in range(60)) for _ in range(3))
    rows = [(5, a), (3, a + " end"), (9, a), (7, b), (7, c), (7, c), (None, c), (None, "nobody else has this text at all"), (None, "nobody else has this text at all"), (4, None), (6, "")]
    docs = spark.createDataFrame([Row(doc_id=i, text=t, lang="en", source="s", n_chars=len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.one_of_each_group(spark, docs, "").collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(3, a + " end"), (7, b), (7, c), (None, "nobody else has this text at all"), (4, None), (6, "")], key=str)
