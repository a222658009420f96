"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on each whole text. Expectation-maximisation (one
accuracy per labeller and class, votes independent given the class) runs on the counts of vote
patterns over all documents: a table of at most ``3 ** len(LABELLERS)`` rows, counted on the cluster. Each
pattern's posterior then labels a bounded sample of documents (``SAMPLE`` expected rows, chosen by a
hash of id and text, equal ones once), from whose hashed features a linear scorer is trained: shapes of words and of
neighbouring characters, and repetition. Given labels are never read; tests measure against them.

Null text counts as empty: no labeller votes, score 0.5 at most. Equal texts get equal scores. An
empty table gives an empty result. Columns that bear the name of a result column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm.common import batches_with, query, table

SAMPLE = 4000
DIMENSIONS = 1 << 12
PRIOR_GOOD = 0.8
EM_ROUNDS = 100
STEPS, STEP, DECAY = 300, 0.5, 1e-4
THRESHOLD = 0.5
_SYMBOLS = frozenset("#*$%&|<>")
# Character classes of the shapes: code point -> one of few codes.
_SHAPES: list[np.ndarray] = []


def _ratios(text: str) -> dict[str, float]:
    words = text.split()
    count = max(1, len(words))
    chars = max(1, len(text))
    lines = [x for x in text.split("\n") if x.strip()]
    return {
        "words": len(words),
        "symbols": sum(map(text.count, _SYMBOLS)) / count,
        "marks": (text.count("!") + text.count("?")) / count,
        "upper": sum(1 for w in words if len(w) > 1 and w.isupper()) / count,
        "again": sum(1 for a, b in zip(words, words[1:]) if a == b) / count,
        "distinct": len(set(words)) / count ** 0.9,
        "bars": text.count(" | ") / count,
        "lines": 1 - len(set(lines)) / max(1, len(lines)),
        "letters": sum(map(str.isalpha, text)) / chars,
    }


def _vote(value: float, good_below: float, bad_above: float) -> int:
    return 1 if value < good_below else -1 if value > bad_above else 0


# Each gives 1 (good), -1 (bad) or 0 (no opinion); they overlap on purpose.
LABELLERS = {
    "symbols": lambda r: _vote(r["symbols"], 0.02, 0.25),
    "marks": lambda r: _vote(r["marks"], 0.05, 0.5),
    "upper": lambda r: _vote(r["upper"], 0.05, 0.3),
    "again": lambda r: _vote(r["again"], 0.03, 0.2),
    "distinct": lambda r: -1 if r["words"] >= 30 and r["distinct"] < 0.2 else 1 if r["distinct"] > 0.5 else 0,
    "bars": lambda r: _vote(r["bars"], 0.02, 0.2),
    "lines": lambda r: _vote(r["lines"], 0.05, 0.5),
    "letters": lambda r: -1 if r["letters"] < 0.62 else 1 if r["letters"] > 0.75 else 0,
    "junk": lambda r: -1 if r["symbols"] + r["marks"] + r["bars"] + r["upper"] + r["again"] > 0.6 else
            1 if r["symbols"] + r["marks"] + r["bars"] + r["upper"] + r["again"] < 0.15 else 0,
}


def votes(text: str) -> str:
    """One character per labeller: g, b or a dash."""
    if not text.strip():
        return "-" * len(LABELLERS)
    r = _ratios(text)
    return "".join("-gb"[rule(r)] for rule in LABELLERS.values())


@dataclass
class Labels:
    prior: float
    accuracy: np.ndarray  # labeller x class (bad, good) x vote (none, good, bad)
    posterior: dict[str, float]


def estimate(patterns: dict[str, int]) -> Labels:
    """EM over the counted vote patterns."""
    names = sorted(patterns)
    weight = np.array([patterns[n] for n in names], np.float64)
    vote = np.array([["-gb".index(c) for c in n] for n in names]).reshape(len(names), len(LABELLERS))
    # To start with, a labeller is somewhat better than chance.
    accuracy = np.tile(np.array([[0.4, 0.2, 0.4], [0.4, 0.5, 0.1]]), (len(LABELLERS), 1, 1))
    prior, good = PRIOR_GOOD, np.zeros(len(names))
    for _ in range(EM_ROUNDS if len(names) else 0):
        logs = np.log(accuracy)
        by_class = np.stack([sum(logs[k, c, vote[:, k]] for k in range(len(LABELLERS))) for c in (0, 1)], 1)
        by_class += np.log([1 - prior, prior])
        by_class -= by_class.max(1, keepdims=True)
        share = np.exp(by_class)
        good = share[:, 1] / share.sum(1)
        prior = float(np.clip((weight @ good) / weight.sum(), 0.02, 0.98))
        for c, of_class in ((0, weight * (1 - good)), (1, weight * good)):
            for k in range(len(LABELLERS)):
                counted = np.bincount(vote[:, k], of_class, 3) + 1.0
                accuracy[k, c] = counted / counted.sum()
    return Labels(prior, accuracy, dict(zip(names, good.tolist())))


def _shape_table() -> np.ndarray:
    if not _SHAPES:
        shape = np.full(0x110000, 9, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            shape[i] = 1 if c.islower() else 2 if c.isupper() else 3 if c.isalpha() else 4 if c.isdigit() else 5 if c.isspace() else 9
        for i in range(33, 127):
            if not chr(i).isalnum():
                shape[i] = 100 + i
        _SHAPES.append(shape)
    return _SHAPES[0]


def hashed(text: str) -> np.ndarray:
    """Normalised hashed features of a text."""
    found = np.zeros(DIMENSIONS, np.float32)
    if not text.strip():
        return found
    shape = _shape_table()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    total = shape * np.uint32(0x9E3779B1)
    for n, prime in ((2, 0x85EBCA77), (3, 0xC2B2AE3D)):
        if len(shape) >= n:
            mixed = total[:len(shape) - n + 1].copy()
            for k in range(1, n):
                mixed = (mixed ^ shape[k:len(shape) - n + 1 + k]) * np.uint32(prime)
            found += np.bincount(mixed >> np.uint32(21), minlength=DIMENSIONS)[:DIMENSIONS]
    found = np.log1p(found)
    r = _ratios(text)
    for j, name in enumerate(("again", "distinct", "lines", "bars", "upper", "marks", "symbols")):
        # One feature per tenth that is reached.
        found[2048 + 16 * j: 2048 + 16 * j + int(min(10.0, 10 * r[name]) + 1)] = 3.0
    return found / np.linalg.norm(found)


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        x = np.stack([hashed(t) for t in texts])
        return 1 / (1 + np.exp(-(x @ self.weights + self.bias)))


def train(x: np.ndarray, target: np.ndarray) -> Scorer:
    """Logistic regression on soft labels by accelerated gradient steps; both classes weigh the same."""
    share = float(np.clip(target.mean(), 0.02, 0.98))
    weight = target * 0.5 / share + (1 - target) * 0.5 / (1 - share)
    weight, target = weight.astype(np.float32), target.astype(np.float32)
    w, b, vw, vb = np.zeros(x.shape[1], np.float32), 0.0, np.zeros(x.shape[1], np.float32), 0.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        g = weight * (p - target) / len(x)
        vw = 0.9 * vw - STEP * 4 * (x.T @ g + DECAY * w)
        vb = 0.9 * vb - STEP * 4 * float(g.sum())
        w, b = w + vw, b + vb
    return Scorer(w, float(b))


def voted(docs: DataFrame) -> DataFrame:
    """``docs`` with the ``votes`` of the labellers."""
    return batches_with(
        docs, "text", {"votes": pa.string()}, {"votes": "string"},
        lambda texts: {"votes": [votes(t.decode()) for t in texts]},
    )


def fit(docs: DataFrame, sample: int = SAMPLE) -> tuple[Labels, Scorer | None]:
    counted = voted(docs.select("text")).groupBy("votes").count().collect()  # at most 3 ** labellers rows
    labels = estimate({r["votes"]: r["count"] for r in counted})
    total = sum(r["count"] for r in counted)
    share = int(min(1.0, sample / max(1, total)) * (1 << 30))
    drawn = docs.select("doc_id", "text").where(
        F.pmod(F.xxhash64(F.lit("weak"), "doc_id", "text"), F.lit(1 << 30)) < share
    )

    def work(texts: list[bytes]) -> dict[str, list]:
        plain = [t.decode() for t in texts]
        return {"v": [hashed(t).astype("<f2").tobytes() for t in plain], "votes": [votes(t) for t in plain]}

    rows = batches_with(
        drawn.select("text"), "text", {"v": pa.binary(), "votes": pa.string()},
        {"v": "binary", "votes": "string"}, work,
    ).select("v", "votes").distinct().collect()
    rows = sorted((bytes(r["v"]), r["votes"]) for r in rows if r["votes"].strip("-"))
    if not rows:
        return labels, None
    x = np.stack([np.frombuffer(v, "<f2").astype(np.float32) for v, _ in rows])
    return labels, train(x, np.array([labels.posterior[p] for _, p in rows]))


def classify(docs: DataFrame, scorer: Scorer | None) -> DataFrame:
    """``docs`` with ``score`` (probability of good) and ``kept``."""
    held = docs.sparkSession.sparkContext.broadcast(scorer)  # one number per dimension

    def work(texts: list[bytes]) -> dict[str, list]:
        score = held.value.score([t.decode() for t in texts]) if held.value else np.full(len(texts), 0.5)
        blank = np.array([not t.strip() for t in texts])
        score = np.where(blank, np.minimum(score, 0.5), score)
        return {"score": score, "kept": [bool(s >= THRESHOLD) and not z for s, z in zip(score, blank)]}

    return batches_with(
        docs, "text", {"score": pa.float64(), "kept": pa.bool_()}, {"score": "double", "kept": "boolean"}, work,
    )


@query("op3_quality_classifier")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    _, scorer = fit(docs)
    return classify(docs, scorer).select("doc_id", "score", "kept")
