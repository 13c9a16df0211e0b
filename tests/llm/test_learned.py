"""Toxicity and language ID on held-out rows, licenses, fingerprints, the pipeline."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tamarack.llm import fingerprint, langid, licenses, toxicity
from tamarack.llm.queries import QUERIES
from tamarack.sources.tables import table

SMALL, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.fixture(scope="module")
def scored(spark):
    return QUERIES["op2_toxicity"](spark, LARGER).collect()


def test_toxicity(spark, scored):
    labels = {r.doc_id: r.toxic for r in table(spark, LARGER, "labels").collect()}
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in scored)
    test = [(r.score, labels[r.doc_id]) for r in scored if r.held_out and r.doc_id in labels]
    bad, good = [s for s, y in test if y == 1], [s for s, y in test if y == 0]
    assert np.mean([b > g for b in bad for g in good]) > 0.98
    assert np.mean([s >= 0.3 for s in bad]) > 0.9 and np.mean([s >= 0.3 for s in good]) < 0.02


def test_toxicity_odd(docs, empty, spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels) is None
    assert {(r.score, r.predicted) for r in toxicity.score(docs, None).collect()} == {(0.0, 0)}
    assert toxicity.features(None, {}, {}) == toxicity.features("", {}, {}) == [0.0] * len(toxicity.FEATURES)
    one = spark.createDataFrame([(i, 1) for i in range(20)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.fit(docs, one)).count() == docs.count()
    assert toxicity.score(empty, None).count() == 0


def test_isotonic():
    rng = np.random.default_rng(0)
    x = rng.normal(size=400)
    y = (rng.random(400) < 1 / (1 + np.exp(-2 * x))).astype(float)
    knots, fit = toxicity.isotonic(x, y)
    assert (np.diff(knots) > 0).all() and (np.diff(fit) > 0).all() and abs(np.interp(x, knots, fit).mean() - y.mean()) < 0.03
    trees = toxicity.boost(x[:, None], y, rounds=20)
    assert np.corrcoef(trees.margin(x[:, None]), x)[0, 1] > 0.8


def test_language(spark):
    want = {r.doc_id: r.lang for r in table(spark, SMALL, "documents", "doc_id", "lang").collect()}
    got = QUERIES["op3_language_id"](spark, SMALL).collect()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in got)
    test = [r.lang_pred == want[r.doc_id] for r in got if r.held_out]
    assert np.mean(test) > 0.97


def test_language_odd(docs, empty):
    model = langid.fit(docs)
    assert {k for k, _ in model} == {"de", "en"}
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs, model).collect()}
    assert {got[300], got[301], got[302], got[308], got[309]} == {"und"} and got[305] in ("de", "en")
    assert {r.lang_pred for r in langid.identify(docs, ()).collect()} == {"und"}
    assert langid.fit(empty) == ()


def test_cross_parsing():
    """The table's phrases against a search for the longest match."""
    rng = random.Random(3)
    samples = {k: "".join(rng.choice(v) for _ in range(400)) for k, v in {"a": "abc d", "b": "abcde "}.items()}
    m = langid.Model(samples)
    for n in (1, 5, 300, 2500):
        t = "".join(rng.choice("abcdefX ") for _ in range(n)) + "x"
        codes = bytes(m.codes(t))
        for k, lang in enumerate(m.langs):
            sample, phrases = bytes(m.codes(samples[lang])), 0
            for a in range(0, len(codes), langid.STRETCH):
                part, i = codes[a : a + langid.STRETCH], 0
                while i < len(part):
                    j = i + 1
                    while j <= len(part) and part[i:j] in sample:
                        j += 1
                    i, phrases = max(j - 1, i + 1), phrases + 1
            assert m.rates([t])[0][k] == pytest.approx(phrases / len(codes))


def test_many_letters():
    """Every sampled letter counts: two languages of one shape, with letters behind the first 253 of the samples."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 5))) for _ in range(60)]
    apart = {k: {c: chr(at + 7 * i) for i, c in enumerate("abcdefghij")} for k, at in {"x": 0x6000, "y": 0xB000, "z": 0x20100}.items()}

    def say(lang, n):
        return " ".join("".join(apart[lang][c] for c in rng.choice(words)) for _ in range(n))

    samples = {k: say(k, 300) for k in apart} | {"many": " ".join(chr(0x4E00 + i) for i in range(3000))}
    m = langid.Model(samples)
    assert len({int(m.code[ord(c)]) for t in samples.values() for c in t if c != " "}) == m.letters - 2 > 3000
    for lang in apart:
        for k, score in m.predict([say(lang, n) for n in (1, 2, 5, 40, 900)]):
            assert k == lang and score > 0.9
    assert m.letters > 256 and len(m.automata[0].key) < 10 * len(samples["many"])  # moves that exist, not states x letters


def test_language_samples(spark):
    """Few long documents give as much as many, from anywhere in the text, and all languages are learned."""
    keep = [i for i in range(2000) if not held(i)]
    text = "".join(chr(0x4E00 + i) for i in range(20_000))
    rows = [(keep[i], text, "few") for i in range(2)] + [(keep[2 + i], "word " * 200, "many") for i in range(150)] + [(keep[200], "short", "mixed"), (keep[201], "x" * 50_000, "mixed")]
    rows += [(keep[300 + i], f"text {i}", f"l{i:03d}") for i in range(90)]
    got = dict(langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), chars_per_language=30_000))
    assert len(got) == 93 and {k: len(got[k]) for k in ("few", "many", "mixed")} == {"few": 30_000, "many": 30_000, "mixed": 30_000}
    assert any(not part.startswith(text[:100]) for part in got["few"].split("\n")) and got["l089"] == "text 89"


def test_licenses(spark, empty):
    mit = licenses.TEMPLATES["MIT-notice"]
    w = mit.split()
    texts = {
        1: "Released under the MIT License.", 2: f"before {mit} after", 3: "nothing to see", 4: None, 5: "", 6: "released UNDER the mit licence. Released under the MIT License! Released under the MIT License",
        7: " ".join(w[:20] + ["odd"] + w[20:30] + w[31:]), 8: " ".join(w[:15]),
    }
    got = {}
    for r in licenses.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert set(got) == {1, 2, 6, 7}
    assert [(r.license, r.start_word, r.end_word, r.coverage) for r in got[1]] == [("MIT", 0, 5, 1.0)]
    n = len(licenses.hash_words(np.frombuffer(mit.encode(), np.uint8), np.array([0, len(mit)]), True, licenses.BREAKS).hash)
    assert [(r.license, r.start_word, r.end_word, r.matched_words) for r in got[2]] == [("MIT-notice", 1, n + 1, n)]
    assert [r.start_word for r in got[6]] == [0, 5, 10] and got[6][0].matched_words == 4
    assert got[7][0].matched_words == n - 1
    assert licenses.scan(empty).count() == 0


def test_license_family(spark):
    """Whole licenses and notices are named as what they are, even with a word changed, and only once."""
    known = licenses.TEMPLATES
    wholes = [k for k in known if k.endswith(("-text", "-notice", "-Clause"))] + ["ISC", "Unlicense"]
    assert len(wholes) > 20 and {"AGPL-3.0-notice", "LGPL-3.0-notice", "GPL-2.0-notice", "BSD-2-Clause", "GPL-2.0-text"} <= set(wholes)
    rows, want = [], {}
    for k in wholes:
        w = known[k].split()
        for edited in (w, w[: len(w) // 2] + ["odd"] + w[len(w) // 2 + 1 :]):
            want[len(rows)] = k
            rows.append((len(rows), f"Some words before. {' '.join(edited)} Some words after."))
    rows.append((len(rows), known["BSD-opening"]))
    got = {}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert {i: [r.license for r in got.get(i, [])] for i in want} == {i: [k] for i, k in want.items()}
    assert all(got[i][0].coverage == 1 for i in want if i % 2 == 0)
    assert [r.license for r in got[len(rows) - 1]] == ["BSD-opening"]


def test_license_edits(spark):
    """Short templates are found with one word changed, wherever it is."""
    rows, want = [], {}
    for k, v in licenses.TEMPLATES.items():
        raw = np.frombuffer(v.encode(), np.uint8)
        w = licenses.hash_words(raw, np.array([0, len(raw)]), True, licenses.BREAKS)
        words = [raw[a:b].tobytes().decode() for a, b in zip(w.start, w.end, strict=True)]
        if 5 <= len(words) <= 20:
            for i in range(len(words)):
                want[len(rows)] = (k, len(words) - 1)
                rows.append((len(rows), f"here it is {' '.join([*words[:i], 'odd', *words[i + 1 :]])} and on"))
    got = {r.doc_id: (r.license, r.matched_words) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(rows) > 50
    # In these two the changed word is what tells one license line from the other.
    same = {"CC-BY-NC-4.0", "CC-BY-SA-4.0"}
    assert {i: v for i, v in got.items() if want[i][0] not in same} == {i: v for i, v in want.items() if v[0] not in same}
    assert all(got[i][1] == n and got[i][0] in same for i, (k, n) in want.items() if k in same)


def test_alignment():
    assert licenses.align([9, 1, 2, 3, 9], [1, 2, 3], 0, 2) == (3, 1, 3)
    assert licenses.align([1, 7, 2, 3], [1, 2, 3], 0, 2) == (3, 0, 3)
    assert licenses.align([5, 6], [1, 2], 0, 1)[0] == 0


def test_fingerprints(docs, documents, spark, empty):
    got = fingerprint.sketch(docs.select("doc_id", "text"), "text", "fp").collect()
    by = {}
    for r in got:
        assert len(r.fp) == 32 and by.setdefault(r.text or "", r.fp) == r.fp
    assert set(by[""]) == {""} and by["x"] != by["UPPER lower"]
    rng = random.Random(2)
    w = [f"w{i}" for i in range(400)]
    few, many, moved = list(w), list(w), w[200:] + w[:200]
    few[10] = few[300] = "edit"
    for i in rng.sample(range(400), 120):
        many[i] = f"e{i}"
    rows = spark.createDataFrame([(i, " ".join(w), " ".join(x)) for i, x in enumerate([w, few, many, moved, [f"z{i}" for i in range(400)], ["a"] * 400])], "i int, a string, b string")
    near = fingerprint.sketch(fingerprint.sketch(rows, "a", "x"), "b", "y").select("i", fingerprint.likeness("x", "y").alias("n"))
    n = {r.i: r.n for r in near.collect()}
    assert n[0] == 1 and n[0] > n[1] > n[2] > n[4] == 0 and n[3] < 0.8
    assert fingerprint.sketch(empty, "text", "fp").count() == 0


def test_fingerprint_query(spark, tmp_path, documents):
    rows = [(r[0], r[1]) for r in documents if r[0] is not None]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    got = QUERIES["op8_order_minhash"](spark, str(tmp_path)).collect()
    order = sorted({i for i, _ in rows})
    texts = {}
    for i, t in rows:
        texts.setdefault(i, t or "")
    for r in got:
        t = texts[r.doc_id]
        after = t if sum(i == r.doc_id for i, _ in rows) > 1 else texts[order[(order.index(r.doc_id) + 1) % len(order)]]
        edits = {hashlib.sha256((t[: len(t) - len(t) // 2] + x[: len(t) // 2]).encode()).hexdigest() for x in (after, texts[order[(order.index(r.doc_id) + 1) % len(order)]])}
        assert r.n_chars == len(t) and r.edited_sha256 in edits
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_pipeline(spark, tmp_path):
    folder = SMALL
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, folder).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        kept[name] = docs
        if name != "best_fit_packing":
            assert docs.columns == before.columns == list(corpus_pipeline.COLUMNS)
            assert docs.count() <= before.count() and docs.join(before, "doc_id", "left_anti").isEmpty()
    toxic = {r.doc_id for r in QUERIES["op2_toxicity"](spark, folder).where("predicted = 1").collect()}
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in kept.items()}
    every = {r.doc_id for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert toxic and ids["toxicity"] == every - toxic
    from test_exact import brute_components, brute_repeats

    rows = [(r.doc_id, r.text) for r in kept["language_id"].collect()]
    assert ids["ngram_jaccard"] == {c for _, _, c in brute_components(rows)}
    rows = [(r.doc_id, r.text) for r in kept["ngram_jaccard"].collect()]
    want = {r[0]: r[3] for r in brute_repeats(rows, 35)}
    got = kept["substring_dedup"].select("doc_id", F.col("text"), "n_chars").collect()
    assert {r.doc_id: hashlib.sha256(b" ".join(r.text.encode().split())).hexdigest() for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)
    assert ids["best_fit_packing"] == ids["substring_dedup"]


def test_pipeline_keeps_languages(spark):
    """Documents with a letter stay, also short ones and ones whose languages tie."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    words = ["This.", "Re.", "De.", "a", "e", "No", "s n", "1 2 3", "..."]
    odd = spark.createDataFrame([(-1 - i, t, None, "s", len(t)) for i, t in enumerate(words)], docs.schema)
    both = docs.unionByName(odd).cache()
    want = {r.doc_id for r in both.collect() if r.text and any(c.isalpha() for c in r.text)}
    assert {r.doc_id for r in corpus_pipeline.keep_known_language(spark, both, SMALL).collect()} == want >= {-1, -7}


def test_pipeline_odd(docs, empty, spark):
    plain = docs.select(*corpus_pipeline.COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, plain, SMALL).count() > 0
        assert stage(spark, empty.select(*corpus_pipeline.COLUMNS), SMALL).count() == 0
