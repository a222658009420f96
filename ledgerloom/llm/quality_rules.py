"""Quality rules learned as gradient-boosted trees over document statistics.

The statistics are exact counts over whole texts (``STATISTICS``). Ratios of them feed boosted trees with
a logistic loss, fitted on the driver from a bounded sample of labelled documents (``SAMPLE`` expected
rows, chosen by a hash of the id). A monotonic constraint makes more symbols, repetition or shouting
never raise the score: splits that break it are refused, and the children's bounds hold further down.
The trees are flattened into node arrays; all texts of a batch walk all trees together in numpy.

Base rules come first: fewer than 50 words, or over half of the words repeated, fail whatever the trees
say. Null text counts as empty. Without labelled rows of both kinds the base rules alone decide.
Columns of the input that bear the name of a result column are replaced; repeated rows get equal answers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm.common import batches_with, query, table

SAMPLE = 8000
TREES, DEPTH, BINS, RATE, LEAST, SMOOTH = 60, 3, 32, 0.2, 20, 1.0
THRESHOLD = 0.5
SYMBOLS = "#*$%&|<>"
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks",
              "n_digits", "n_distinct_words", "n_lines"]
# 0 free; -1: the score never rises with the feature.
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbols": -1, "dup_lines": -1, "repeat_words": -1, "upper": -1,
    "marks": -1, "digits": 0, "distinct": 0,
}
_SPACE = b" \t\n\v\f\r"


def statistics(text: bytes) -> list[int]:
    """The counts of ``STATISTICS`` for one UTF-8 text."""
    words = text.split()  # ASCII white space only
    count = len(words)
    plain = text.decode()
    seen, dup_lines, lines = set(), 0, 0
    for line in text.split(b"\n"):
        if line.strip(_SPACE):
            lines += 1
            dup_lines += line in seen
            seen.add(line)
    return [
        count,
        len(plain) - sum(text.count(bytes([c])) for c in _SPACE),
        sum(plain.count(c) for c in SYMBOLS),
        dup_lines,
        repeated_words(words),
        sum(1 for c in plain if c.isupper()) if not plain.islower() else 0,
        plain.count("!") + plain.count("?"),
        sum(text.count(bytes([c])) for c in b"0123456789"),
        len(set(words)),
        lines,
    ]


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words which the text has at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times: dict[tuple, int] = {}
    for w in windows:
        times[w] = times.get(w, 0) + 1
    total, reached = 0, 0  # words before ``reached`` are counted already
    for i, w in enumerate(windows):
        if times[w] > 1:
            total += i + 3 - max(reached, i)
            reached = i + 3
    return total


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


def features(counts: np.ndarray) -> np.ndarray:
    """One row per text, one column per name in ``FEATURES``."""
    c = {name: counts[:, i].astype(np.float64) for i, name in enumerate(STATISTICS)}
    words, chars, lines = (np.maximum(c[n], 1) for n in ("n_words", "word_chars", "n_lines"))
    return np.stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / words, c["n_dup_lines"] / lines,
        c["n_repeat_words"] / words, c["n_upper"] / chars, c["n_marks"] / words, c["n_digits"] / chars,
        c["n_distinct_words"] / words,
    ], 1)


@dataclass
class Forest:
    """All trees in flat arrays; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        at = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            right = x[rows, self.feature[at]] > self.threshold[at]
            at = np.where(right, self.right[at], self.left[at])
        return 1 / (1 + np.exp(-(self.start + self.value[at].sum(1))))


def fit_forest(x: np.ndarray, y: np.ndarray, signs: list[int], trees: int = TREES) -> Forest:
    """Boosting with Newton leaves over binned features; ``signs`` are the monotonic constraints."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    margin = np.full(len(y), start)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def leaf(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + SMOOTH), low, high))

    def add(rows: np.ndarray, g, h, depth: int, low: float, high: float) -> int:
        me = len(feature)
        feature.append(0), threshold.append(0.0), left.append(me), right.append(me)
        total_g, total_h = g[rows].sum(), h[rows].sum()
        own = leaf(total_g, total_h, low, high)
        value.append(own)
        best = (1e-6, None)
        if depth < DEPTH and len(rows) >= 2 * LEAST:
            gain_of = lambda a, b, v: -(a * v + 0.5 * (b + SMOOTH) * v * v)
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                bins = binned[rows, j]
                gs = np.cumsum(np.bincount(bins, g[rows], len(e) + 1))[:-1]
                hs = np.cumsum(np.bincount(bins, h[rows], len(e) + 1))[:-1]
                ns = np.cumsum(np.bincount(bins, minlength=len(e) + 1))[:-1]
                lv = np.clip(-gs / (hs + SMOOTH), low, high)
                rv = np.clip(-(total_g - gs) / (total_h - hs + SMOOTH), low, high)
                gain = gain_of(gs, hs, lv) + gain_of(total_g - gs, total_h - hs, rv) - gain_of(total_g, total_h, own)
                wrong = signs[j] * (rv - lv) < 0
                gain[wrong | (ns < LEAST) | (len(rows) - ns < LEAST)] = -np.inf
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (j, k, lv[k], rv[k]))
        if best[1]:
            j, k, lv, rv = best[1]
            feature[me], threshold[me] = j, float(edges[j][k])
            middle = (lv + rv) / 2
            bounds = {0: ((low, high), (low, high)), -1: ((middle, high), (low, middle)), 1: ((low, middle), (middle, high))}
            goes = binned[rows, j] > k
            left[me] = add(rows[~goes], g, h, depth + 1, *bounds[signs[j]][0])
            right[me] = add(rows[goes], g, h, depth + 1, *bounds[signs[j]][1])
            value[me] = 0.0
        return me

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        before = len(value)
        roots.append(add(np.arange(len(y)), p - y, np.maximum(p * (1 - p), 1e-6), 0, -np.inf, np.inf))
        for i in range(before, len(value)):
            value[i] *= RATE
        tree = Forest(*map(np.array, (feature, threshold, left, right, value)), np.array(roots[-1:]), 0.0)
        at = np.full(len(y), roots[-1])
        for _ in range(DEPTH):
            goes = x[np.arange(len(y)), tree.feature[at]] > tree.threshold[at]
            at = np.where(goes, tree.right[at], tree.left[at])
        margin += tree.value[at]
    return Forest(*map(np.array, (feature, threshold, left, right, value)), np.array(roots), start)


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with the statistics."""
    def work(texts: list[bytes]) -> dict[str, list]:
        return dict(zip(STATISTICS, map(list, zip(*map(statistics, texts)))))

    return batches_with(docs, "text", {n: pa.int64() for n in STATISTICS}, {n: "bigint" for n in STATISTICS}, work)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Forest | None:
    """From documents and ``doc_id, quality``; the driver gets the statistics of the sample alone."""
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    share = min(1.0, sample / max(1, labels.count()))
    drawn = known.where(
        F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    )
    # ``sample`` rows of two numbers: a bounded side.
    chosen = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    each = measure(chosen).groupBy("doc_id").agg(
        *[F.max(n).alias(n) for n in STATISTICS], F.max("quality").alias("quality"))
    rows = each.orderBy("doc_id").toPandas()
    if rows["quality"].nunique() < 2:
        return None
    x = features(rows[STATISTICS].to_numpy())
    return fit_forest(x, rows["quality"].to_numpy(np.float64), list(FEATURES.values()))


def judge(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """``docs`` with the statistics, ``base_failed``, ``score`` and ``kept``."""
    held = docs.sparkSession.sparkContext.broadcast(forest)  # a fixed number of trees

    def work(texts: list[bytes]) -> dict[str, list]:
        counts = np.array([statistics(t) for t in texts], np.int64)
        failed = [base_failed(int(c[0]), int(c[4])) for c in counts]
        score = held.value.score(features(counts)) if held.value else np.ones(len(texts))
        kept = [not f and s >= THRESHOLD for f, s in zip(failed, score.tolist())]
        return {n: counts[:, i] for i, n in enumerate(STATISTICS)} | {
            "base_failed": failed, "score": score, "kept": kept}

    kinds = {n: pa.int64() for n in STATISTICS} | {"base_failed": pa.bool_(), "score": pa.float64(), "kept": pa.bool_()}
    names = {n: "bigint" for n in STATISTICS} | {"base_failed": "boolean", "score": "double", "kept": "boolean"}
    return batches_with(docs, "text", kinds, names, work)


@query("op6_quality_rules")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    forest = fit(docs, table(spark, folder, "labels"))
    return judge(docs, forest).select("doc_id", *STATISTICS[:5], "base_failed", "score", "kept")
