"""Toxicity scores: gradient-boosted trees over dense text features, with isotonic calibration (operator 2).

A bounded sample of labelled training rows (``max_labelled``, the smallest hashes of doc_id) is used three ways:
word and word-stem lexicons by smoothed log-odds of document frequencies; dense features of each sampled text,
where a text's lexicon densities come from the half of the sample it isn't in; and boosted trees on quantile bins
with an isotonic fit of held-back margins. Lexicons, trees and steps are a few thousand numbers whatever the
corpus, and are broadcast. Scoring is one pass over whole texts without a shuffle.

Held out is every row whose crc32(doc_id as text) mod 4 is 2. Null labels are not used; of several labels of one
doc_id the larger holds. Null and empty texts score by their features, all 0. Without labels every score is 0.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.bpe import map_texts
from tamarack.llm.words import let_go
from tamarack.storage import durable

#: Second-person words of the four languages of the corpus.
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros"
STEM = 4
FEATURES = ("lexicon", "distinct", "weight", "peak", "stems", "person", "near", "capitals", "shout", "marks", "obfuscated", "length")
_TOKEN = re.compile(r"[^\W_]+")
_HIDDEN = re.compile(r"[^\W\d_][\d@$*!#]+[^\W\d_]")


def held_out(doc_id: str = "doc_id"):
    """Whether a row is held out of training."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def features(text: str | None, words: dict[str, float], stems: dict[str, float], near: int = 4) -> list[float]:
    """Dense features of a whole text, in the order of ``FEATURES``."""
    if not text:
        return [0.0] * len(FEATURES)
    tokens = _TOKEN.findall(text.lower())
    n = len(tokens) or 1
    get = words.get
    hits = [(i, w) for i, w in enumerate(tokens) if w in words]
    stemmed = sum(1 for w in tokens if w[:STEM] in stems and len(w) > STEM) if stems else 0
    person = [i for i, w in enumerate(tokens) if w in _PERSON]
    close = 0
    if hits and person:
        p = np.array(person)
        for i, _ in hits:
            k = int(np.searchsorted(p, i))
            close += any(abs(int(p[j]) - i) <= near for j in (k - 1, k) if 0 <= j < len(p))
    weight = sum(get(w) for _, w in hits)
    c = len(text)
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    return [
        len(hits) / n, math.log1p(len({w for _, w in hits})), weight / n, max((get(w) for _, w in hits), default=0.0), stemmed / n, len(person) / n,
        close / n, upper / c, (text.count("!") + text.count("?")) / c, sum(map(text.count, ".,;:\"'")) / c, len(_HIDDEN.findall(text)) / n, math.log1p(n),
    ]


_PERSON = frozenset(SECOND_PERSON.split())


def log_odds(toxic: int, clean: int, n_toxic: int, n_clean: int) -> tuple[float, float]:
    """Smoothed log-odds of a term in toxic documents, and its z-score."""
    d = math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))
    return d, d / math.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))


def lexicons(train: DataFrame, least: int = 4, size: int = 4000) -> list[tuple[dict, dict]]:
    """Word and stem lexicons from each half of ``train(text, toxic, half)`` and from all of it: [half 0, half 1, all]."""
    tokens = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))
    stems = F.array_distinct(F.transform(F.filter(tokens, lambda w: F.length(w) > STEM), lambda w: F.concat(F.lit("\x00"), F.substring(w, 1, STEM))))
    terms = train.select("toxic", "half", F.explode(F.concat(tokens, stems)).alias("term")).where("length(term) > 1")
    n = {(r.half, r.toxic): r.n for r in train.groupBy("half", "toxic").agg(F.count("*").alias("n")).collect()}
    by = terms.groupBy("term").agg(*[F.count_if((F.col("half") == h) & (F.col("toxic") == y)).alias(f"n{h}{y}") for h in (0, 1) for y in (0, 1)])
    found = by.where(F.col("n01") + F.col("n11") >= least).where((F.col("n01") + F.col("n11")) * 2 > F.col("n00") + F.col("n10"))
    rows = found.orderBy(F.desc(F.col("n01") + F.col("n11") - F.col("n00") - F.col("n10")), "term").limit(4 * size).collect()
    out = []
    for halves in ((0,), (1,), (0, 1)):
        total = [sum(n.get((h, y), 0) for h in halves) for y in (0, 1)]
        # The more documents, the more terms are tried, and the surer a term must be.
        z = max(2.0, math.sqrt(2 * math.log(1 + total[1] / 8)))
        words, stem = {}, {}
        for r in rows:
            t, c = (sum(r[f"n{h}{y}"] for h in halves) for y in (1, 0))
            d, score = log_odds(t, c, total[1], total[0])
            if t >= max(2, least * len(halves) // 2) and score > z:
                (stem if r.term[0] == "\x00" else words)[r.term.lstrip("\x00")] = min(d, 6.0)
        out.append((words, stem))
    return out


@dataclass
class Trees:
    """Boosted regression trees of fixed depth over binned features; ``steps`` calibrate the margin."""

    edges: list[np.ndarray]
    base: float = 0.0
    depth: int = 3
    nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)  # feature, bin, leaf values
    steps: tuple[np.ndarray, np.ndarray] | None = None

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], 1) if len(x) else np.zeros(x.shape, np.int64)

    def _leaf(self, b: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(b), np.int64), np.arange(len(b))
        for _ in range(self.depth):
            at = 2 * at + 1 + (b[rows, feature[at]] > cut[at])
        return at - (2**self.depth - 1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        return self.base + sum((leaf[self._leaf(b, f, c)] for f, c, leaf in self.nodes), np.zeros(len(x)))

    def score(self, x: np.ndarray) -> np.ndarray:
        m = self.margin(x)
        p = 1 / (1 + np.exp(-np.clip(m, -30, 30)))
        if self.steps is None:
            return p
        # The step function has long flat parts; a hundredth of the uncalibrated score keeps their order.
        return np.clip(0.99 * np.interp(m, *self.steps) + 0.01 * p, 0, 1)


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 80, rate: float = 0.1, depth: int = 3, bins: int = 48, ridge: float = 1.0, least: float = 1.0) -> Trees:
    """Second-order boosting of the logistic loss, best split by histogram."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    rate0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    t = Trees(edges, float(np.log(rate0 / (1 - rate0))), depth)
    b, width = t.bins(x), bins + 1
    m = np.full(len(y), t.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-m))
        g, h = y - p, p * (1 - p)
        feature, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, width)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            base = 2**level - 1
            best = np.full(2**level, 1e-9)
            for j in range(x.shape[1]):
                key = (at - base) * width + b[:, j]
                G = np.bincount(key, g, 2**level * width).reshape(-1, width).cumsum(1)
                H = np.bincount(key, h, 2**level * width).reshape(-1, width).cumsum(1)
                gt, ht = G[:, -1:], H[:, -1:]
                gain = G**2 / (H + ridge) + (gt - G) ** 2 / (ht - H + ridge) - gt**2 / (ht + ridge)
                gain[(H < least) | (ht - H < least)] = 0
                k = gain.argmax(1)
                top = gain[np.arange(len(k)), k]
                won = np.flatnonzero(top > best)
                best[won], feature[base + won], cut[base + won] = top[won], j, k[won]
            at = 2 * at + 1 + (b[np.arange(len(y)), feature[at]] > cut[at])
        leaf = at - (2**depth - 1)
        value = rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + ridge)
        t.nodes.append((feature, cut, value))
        m += value[leaf]
    return t


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots of the non-decreasing fit of ``y`` to ``margin``."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # sum of y, weight, sum of margins
    for m, v in zip(margin[order], y[order], strict=True):
        blocks.append([float(v), 1.0, float(m)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, w, q = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += w
            blocks[-1][2] += q
    return np.array([q / w for _, w, q in blocks]), np.array([s / w for s, w, _ in blocks])


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000) -> tuple[dict, dict, Trees] | None:
    """Word lexicon, stem lexicon and calibrated trees from a bounded sample of labelled rows; None without any."""
    chosen = labels.where("toxic is not null and doc_id is not null").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).cast("int")
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(4)).cast("int")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most max_labelled ids
    train = durable(rows.select(F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic"), half.alias("half"), fold.alias("fold")))
    halves = lexicons(train)

    def make():
        let_go()
        return lambda texts: [(features(t, *halves[0]), features(t, *halves[1])) for t in texts]

    got = map_texts(train, "text", "f0 array<double>, f1 array<double>", make).collect()  # two dozen numbers for each drawn row; all rows of a drawn doc_id
    if not got:
        return None
    x = np.array([r.f1 if r.half == 0 else r.f0 for r in got])
    y, part = np.array([r.toxic for r in got], float), np.array([r.fold for r in got])
    held = part == 0
    if held.all() or not held.any() or len(np.unique(y[~held])) < 2:
        trees = boost(x, y)
    else:
        margins = np.zeros(len(y))
        for f in range(4):  # margins of rows that the trees behind them have not seen
            if (part == f).any():
                margins[part == f] = boost(x[part != f], y[part != f]).margin(x[part == f])
        trees = boost(x, y)
        trees.steps = isotonic(margins, y)
    return *halves[2], trees


def score(docs: DataFrame, model: tuple[dict, dict, Trees] | None, threshold: float = 0.3, keep_text: bool = False) -> DataFrame:
    """Append ``score`` and ``predicted`` to ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def make():
        let_go()
        if shared.value is None:
            return lambda texts: [(0.0, 0)] * len(texts)
        words, stems, trees = shared.value

        def run(texts):
            s = trees.score(np.array([features(t, words, stems) for t in texts]))
            return [(float(v), int(v >= threshold)) for v in s]

        return run

    return map_texts(docs, "text", "score double, predicted int", make, keep_text=keep_text)
